"""Queries of the general problems: skewed keys (2) and spatial neighbours (6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotloom.functions.text_keys import valid_score
from spotloom.operators.skew import heavy_keys, heavy_keys_of, per_key_summary, skew_join
from spotloom.operators.spatial import located, near_on_earth, near_pairs, points_in_boxes, points_in_polygons
from spotloom.session import Scratch
from spotloom.sources.tables import barcode_spots, gene_spots, once_per_spot, table

#: Shares of all spots from which a gene and a roi count as large.
GENE_SHARE, ROI_SHARE = 0.04, 0.10
#: Pixels.
NEAR = 6


def _spots(spark: SparkSession, folder: str) -> DataFrame:
    """gene_spots once per spot, written once because several passes read it."""
    g = once_per_spot(gene_spots(spark, folder), "roi", "gene", valid_score(F.col("spot_score")).alias("score"))
    return Scratch(spark, "p2").save(g)


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    spots = _spots(spark, folder)
    heavy, total = heavy_keys_of(spots, ["gene", "roi"]), spots.count()
    out = None
    for field, share in (("gene", GENE_SHARE), ("roi", ROI_SHARE)):
        s = per_key_summary(spots, field, "score", heavy[field], spread="spot_id")
        s = s.where((F.col("n") > share * total) & F.col(field).isNotNull()).select(F.lit(field).alias("field"), F.col(field).cast("string").alias("item"))
        out = s if out is None else out.unionByName(s)
    return out


def _summary(field: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        s = per_key_summary(_spots(spark, folder), field, "score", spread="spot_id").where(F.col(field).isNotNull())
        return s.select(field, "n", "n_scores", F.round("sum_score", 4).alias("sum_score"), F.round("sd_score", 6).alias("sd_score"), "min_score", "max_score")

    return run


def p2_above_mean(spark: SparkSession, folder: str) -> DataFrame:
    """Per-key results joined back to all rows: how many spots of each gene score above the mean of their gene."""
    spots = _spots(spark, folder).where("gene is not null")
    heavy = heavy_keys(spots, "gene")
    means = Scratch(spark, "p2").save(per_key_summary(spots, "gene", "score", heavy, spread="spot_id").select("gene", "mean_score"))
    j = skew_join(spots.select("gene", "score"), means, "gene", heavy)
    return j.groupBy("gene").agg(F.count("score").alias("n_scores"), F.count_if(F.col("score") > F.col("mean_score") + 1e-9).alias("n_above"))


def _located_spots(spark: SparkSession, folder: str) -> DataFrame:
    return once_per_spot(located(barcode_spots(spark, folder)), "roi", "x", "y")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return near_pairs(_located_spots(spark, folder), NEAR).select("spot_id_a", "spot_id_b")


def p6_neighbour_counts(spark: SparkSession, folder: str) -> DataFrame:
    """For each located spot with neighbours: how many, and the distance of the nearest."""
    pairs = near_pairs(_located_spots(spark, folder), NEAR)
    both = pairs.select("roi", F.explode(F.array("spot_id_a", "spot_id_b")).alias("spot_id"), "distance")
    return both.groupBy("roi", "spot_id").agg(F.count(F.lit(1)).alias("n_near"), F.round(F.min("distance"), 6).alias("nearest"))


def p6_cells(spark: SparkSession, folder: str) -> DataFrame:
    return points_in_boxes(_located_spots(spark, folder), table(spark, folder, "cells"))


def _diamonds(spark: SparkSession, folder: str) -> DataFrame:
    """Regions of interest as polygons: the diamond inside each cell's box, four times as large."""
    c = table(spark, folder, "cells").where("xmin < xmax and ymin < ymax")
    cx, cy, w, h = (F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2, F.col("xmax") - F.col("xmin") + 0.25, F.col("ymax") - F.col("ymin") + 0.25
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return c.select("roi", F.col("label").alias("polygon_id"), F.array(corner(cx, cy - h), corner(cx + w, cy), corner(cx, cy + h), corner(cx - w, cy)).alias("ring"))


def p6_polygons(spark: SparkSession, folder: str) -> DataFrame:
    """The polygons that hold each located spot."""
    return points_in_polygons(_located_spots(spark, folder), _diamonds(spark, folder))


def p6_on_earth(spark: SparkSession, folder: str) -> DataFrame:
    """Pixels of a roi as places on the sphere (one pixel: 0.0001 degrees; rois lie 20 degrees apart): pairs at most 50 m apart."""
    p = _located_spots(spark, folder).select("spot_id", (F.col("y") * 0.0001 - 60.0).alias("lat"), (F.col("x") * 0.0001 + F.col("roi") * 20.0 - 180.0).alias("lon"))
    return near_on_earth(p, 50.0, "spot_id").select("spot_id_a", "spot_id_b", F.round("metres", 3).alias("metres"))


#: The white space that is trimmed, as SQL.
_W = "chr(32)||chr(9)||chr(10)||chr(13)||chr(11)||chr(12)||chr(160)||chr(8199)||chr(8239)||chr(12288)||chr(65279)||chr(8203)"
SQL_GENE = f"nullif(lower(trim(gene, {_W})), '')"


def sql_sequence(c: str) -> str:
    return f"nullif(upper(trim({c}, {_W})), '')"


def sql_score(c: str) -> str:
    return f"case when {c} >= 0 and {c} <= 1 then {c} end"


_SQL_SPOTS = f"select distinct spot_id, roi, {SQL_GENE} as gene, {sql_score('spot_score')} as score from gene_spots where spot_id is not null"
_SQL_LOCATED = "select distinct spot_id, roi, x, y from barcode_spots where spot_id is not null and x is not null and y is not null and not (x = -1 and y = -1)"
_SQL_NEAR = f"""l as ({_SQL_LOCATED}), h as (select *, x // {NEAR} as cx, y // {NEAR} as cy from l),
    o as (select * from (values (-1), (0), (1)) a(dx), (values (-1), (0), (1)) b(dy)),
    far as (select h.*, cx + dx as ex, cy + dy as ey from h, o),
    near as (select a.roi, a.spot_id as spot_id_a, b.spot_id as spot_id_b, sqrt(((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))::double) as distance
      from h a join far b on a.roi = b.roi and a.cx = b.ex and a.cy = b.ey and a.spot_id < b.spot_id
      where (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {NEAR * NEAR})"""


def _sql_summary(field: str) -> str:
    return f"""with s as ({_SQL_SPOTS}) select {field}, count(*) as n, count(score) as n_scores, round(sum(score), 4) as sum_score,
      round(stddev_pop(score), 6) as sd_score, min(score) as min_score, max(score) as max_score from s where {field} is not null group by {field}"""


QUERIES = {
    "p2_found": p2_found,
    "p2_gene_summary": _summary("gene"),
    "p2_roi_summary": _summary("roi"),
    "p6_found": p6_found,
    "p6_neighbour_counts": p6_neighbour_counts,
    "p2_above_mean": p2_above_mean,
    "p6_cells": p6_cells,
    "p6_polygons": p6_polygons,
    "p6_on_earth": p6_on_earth,
}

ORACLES = {
    "p2_found": f"""with s as ({_SQL_SPOTS}), t as (select count(*) as total from s)
      select 'gene' as field, gene as item from s, t where gene is not null group by gene, total having count(*) > {GENE_SHARE} * total
      union all select 'roi', roi::varchar from s, t where roi is not null group by roi, total having count(*) > {ROI_SHARE} * total""",
    "p2_gene_summary": _sql_summary("gene"),
    "p2_roi_summary": _sql_summary("roi"),
    "p6_found": f"with {_SQL_NEAR} select spot_id_a, spot_id_b from near",
    "p6_neighbour_counts": f"""with {_SQL_NEAR}, b as (select roi, spot_id_a as spot_id, distance from near union all select roi, spot_id_b, distance from near)
      select roi, spot_id, count(*) as n_near, round(min(distance), 6) as nearest from b group by roi, spot_id""",
    "p2_above_mean": f"""with s as ({_SQL_SPOTS}), m as (select gene, avg(score) as mean from s where gene is not null group by gene)
      select gene, count(score) as n_scores, count(*) filter (where score > mean + 1e-9) as n_above from s join m using (gene) group by gene""",
    "p6_polygons": f"""with l as ({_SQL_LOCATED}), d as (select roi, label as polygon_id, (xmin + xmax) / 2 as cx, (ymin + ymax) / 2 as cy, xmax - xmin + 0.25::double as w, ymax - ymin + 0.25::double as h from cells where xmin < xmax and ymin < ymax)
      select l.roi, spot_id, polygon_id from l join d on l.roi = d.roi and l.x >= cx - w and l.x <= cx + w and l.y >= cy - h and l.y <= cy + h where abs(l.x - cx) / w + abs(l.y - cy) / h < 1""",
    "p6_on_earth": f"""with p as (select spot_id, y * 0.0001::double - 60 as lat, x * 0.0001::double + roi * 20 - 180 as lon0 from ({_SQL_LOCATED})), q as (select spot_id, lat, lon0 - 360 * floor((lon0 + 180) / 360) as lon from p),
      c as (select *, floor(lat / 0.0005)::int as b from q), f as (select * replace (b + d as b) from c, (values (-1), (0), (1)) o(d)),
      j as (select c.spot_id as a, f.spot_id as z, 2 * 6371008.8 * asin(sqrt(least(1, sin(radians(f.lat - c.lat) / 2) ** 2 + cos(radians(c.lat)) * cos(radians(f.lat)) * sin(radians(f.lon - c.lon) / 2) ** 2))) as m
        from c join f on c.b = f.b and c.spot_id < f.spot_id where abs(f.lon - c.lon) < 0.01 or abs(f.lon - c.lon) > 359.99)
      select a as spot_id_a, z as spot_id_b, round(m, 3) as metres from j where m <= 50""",
    "p6_cells": f"with l as ({_SQL_LOCATED}) select l.roi, spot_id, label from l join cells c on l.roi = c.roi and l.y >= ymin and l.y < ymax and l.x >= xmin and l.x < xmax",
}
