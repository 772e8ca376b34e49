"""Queries of projections, lookups and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotloom.functions.arrays import has_nan
from spotloom.functions.text_keys import valid_score
from spotloom.operators import projections as prj
from spotloom.operators import raster
from spotloom.operators.spatial import located
from spotloom.plans import rasters
from spotloom.plans.problems import SQL_GENE, sql_score
from spotloom.session import Scratch
from spotloom.sources.tables import barcode_spots, gene_spots, once_per_spot, table

CAMERA, GRID = [3, 1, 4, 2], {"spot_score": [0.1, 0.3, 0.5], "dot_product_score": [0.2, 0.4, 0.6]}


def _traces(spark: SparkSession, folder: str) -> DataFrame:
    return once_per_spot(barcode_spots(spark, folder).where("trace is not null"), "trace").where(~F.exists("trace", has_nan))


def camera_order(spark: SparkSession, folder: str) -> DataFrame:
    """Sums per channel of the first round, in the order of the cameras."""
    t = _traces(spark, folder).select(F.posexplode(prj.permuted(F.col("trace")[0], CAMERA)).alias("c", "v"))
    return t.groupBy("c").agg(F.round(F.sum("v"), 3).alias("total"))


def flipped_density(spark: SparkSession, folder: str) -> DataFrame:
    d = rasters._density(spark, folder).withColumn("c", F.col("roi") % 2)
    return prj.flipped(d, [1], "x", 500).groupBy("roi").agg(F.min("x").alias("x_min"), F.max("x").alias("x_max"), F.sum("x").alias("x_sum"))


def preferred_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Versions of a value with a fallback: per tile the shift to the right, else the one down."""
    s = table(spark, folder, "tile_shifts")
    v = lambda n, c: s.where(f"{c} is not null and not isnan({c})").select("roi", "tx", "ty", F.lit(n).alias("version"), F.col(c).alias("v"))
    return prj.preferred(v("right", "right_x").unionByName(v("down", "down_y")), ["roi", "tx", "ty"], "version", ["right", "down"])


def bad_traces(spark: SparkSession, folder: str) -> DataFrame:
    t = once_per_spot(barcode_spots(spark, folder).where("trace is not null"), "trace").select("spot_id", F.posexplode("trace").alias("round", "t"))
    return prj.bad_pixels(t.select("spot_id", "round", F.explode("t").alias("v")), ["spot_id", "round"], "v").groupBy("round").agg(F.count(F.lit(1)).alias("n"))


def cell_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """Shape columns from boxes, then limits on them."""
    c = table(spark, folder, "cells").withColumns({"perimeter": 2.0 * (F.col("xmax") - F.col("xmin") + F.col("ymax") - F.col("ymin")), "s": F.col("xmax") - F.col("xmin"), "b": F.col("ymax") - F.col("ymin")})
    c = prj.within(prj.shape_columns(c, "area", "perimeter", "s", "b"), {"circularity": (0.3, None), "area": (100, 1200), "intensity_ratio": (None, 1.5)})
    return c.select("roi", "label", F.round("circularity", 5).alias("circularity"), F.round("intensity_ratio", 5).alias("intensity_ratio"), F.round("clamped_ratio", 5).alias("clamped_ratio"))


def density_colours(spark: SparkSession, folder: str) -> DataFrame:
    d = rasters._density(spark, folder).withColumn("c", F.col("roi") % 3)
    rgb = prj.colour_map(d, ["roi", "y", "x"], "v", "c", [(1, 0, 0.5), (0, 1, 0), (0.25, 0.25, 1)], 0.0, 4.0)
    return rgb.groupBy("r", "g", "b").agg(F.count(F.lit(1)).alias("n"))


def plane_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Rounds as planes: channel 0 beside channel 1 two rounds on, as a sum of products per round."""
    t = _traces(spark, folder).select("spot_id", F.posexplode("trace").alias("round", "t")).select("spot_id", "round", F.posexplode("t").alias("c", "v")).where("c < 2")
    return prj.shifted_pairs(t, ["spot_id"], "round", "v", 2).groupBy("round").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("v") * F.col("other")), 1).alias("product"))


def atlas_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Spots in a coarse raster of areas, with the name of the area; area 0 is outside."""
    a = raster.block_reduce(rasters._density(spark, folder), ["roi"], 2, F.sum("v")).withColumn("area_id", (F.col("v") % 6).cast("int")).drop("v")
    s = once_per_spot(located(gene_spots(spark, folder)), "roi", "x", "y")
    names = table(spark, folder, "region").select(F.col("r_regionkey").alias("area_id"), "r_name")
    j = prj.scaled_lookup(s, a, ["roi"], 200.0, ["area_id"]).join(names, "area_id", "left")
    return j.groupBy(F.when(F.col("area_id") == 0, "outside").otherwise(F.col("r_name")).alias("area")).agg(F.count(F.lit(1)).alias("n"))


def remove_deleted_labels(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "cells").select("roi", "label", "area")
    return prj.without(c, c.where("area % 7 = 0"), ["roi", "label"])


def keep_cells(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "cells").select("roi", "label", "area", (F.col("xmax") > F.col("xmin") + 10).alias("is_cell"))
    return prj.only_cells(c.select("roi", "label", "area"), c, ["roi", "label"], "is_cell").groupBy("roi", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("area").alias("area"))


def semi_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Tiles that have both kinds of spots with a high score."""
    g = gene_spots(spark, folder).where("spot_score > 0.8 and spot_score <= 1")
    b = barcode_spots(spark, folder).where("spot_score > 0.5 and spot_score <= 1")
    return g.select("roi", "tx", "ty").join(b.select("roi", "tx", "ty"), ["roi", "tx", "ty"], "left_semi").distinct()


def parameter_grid(spark: SparkSession, folder: str) -> DataFrame:
    s = once_per_spot(barcode_spots(spark, folder), valid_score(F.col("spot_score")).alias("spot_score"), valid_score(F.col("dot_product_score")).alias("dot_product_score"))
    return prj.threshold_grid(s.dropna(), GRID)


def black_level(spark: SparkSession, folder: str) -> DataFrame:
    """Mean per channel of the dark rounds: those whose brightest channel stays below 40."""
    t = _traces(spark, folder).select(F.explode("trace").alias("t")).where(F.array_max("t") < 40)
    return t.select(F.posexplode("t").alias("c", "v")).groupBy("c").agg(F.round(F.avg("v"), 4).alias("black"))


def mean_spot_shape(spark: SparkSession, folder: str) -> DataFrame:
    d = rasters._density(spark, folder)
    return prj.mean_window(raster.local_maxima(d, ["roi"], 2.0).select("roi", "y", "x"), d, ["roi"], 3).select("dy", "dx", F.round("v", 6).alias("v"))


def radial_spot_shape(spark: SparkSession, folder: str) -> DataFrame:
    return raster.radial_mean(mean_spot_shape(spark, folder), []).select("r2", F.round("v", 5).alias("v"))


def cells_per_tile(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of each tile that has any, whatever the size of the grid."""
    c = table(spark, folder, "cells").withColumns({"ty": F.floor(F.col("y") / 1800).cast("int"), "tx": F.floor(F.col("x") / 1800).cast("int")})
    return c.groupBy("roi", "ty", "tx").agg(F.count(F.lit(1)).alias("n"))


def cdf_difference(spark: SparkSession, folder: str) -> DataFrame:
    """Cumulative shares of pixel values per roi less those of all rois, for every value from 0 to 20 or the largest there is."""
    own = Scratch(spark, "cdf").save(raster.histogram(rasters._density(spark, folder), ["roi"], "v"))
    largest = max(20, own.agg(F.max("v").alias("v")).collect()[0]["v"] or 0)
    values = own.select("roi").distinct().withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(largest))))
    h = values.join(own, ["roi", "v"], "left").fillna(0, ["n"])
    one = raster.cumulative(h, ["roi"]).select("roi", "v", "cdf")
    every = raster.cumulative(h.groupBy("v").agg(F.sum("n").alias("n")), []).select("v", F.col("cdf").alias("grand"))
    return one.join(every, "v").select("roi", "v", F.round(F.col("cdf") - F.col("grand"), 5).alias("difference"))


def natural_order(spark: SparkSession, folder: str) -> DataFrame:
    """Every gene by its number, then by name."""
    g = gene_spots(spark, folder).select("gene").where("gene is not null").distinct()
    return g.orderBy(*prj.natural_key(F.col("gene")))


def set_operations(spark: SparkSession, folder: str) -> DataFrame:
    """Tiles by the sets they are in: genes, barcodes or both."""
    g, b = (read(spark, folder).where("spot_score > 0.6 and spot_score <= 1").select("roi", "tx", "ty") for read in (gene_spots, barcode_spots))
    parts = [g.intersect(b).withColumn("part", F.lit("both")), g.subtract(b).withColumn("part", F.lit("genes")), b.subtract(g).withColumn("part", F.lit("barcodes")), g.union(b).distinct().withColumn("part", F.lit("any"))]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return out.groupBy("part", "roi").agg(F.count(F.lit(1)).alias("n"))


def daily_steps(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "events").groupBy("event_type", F.to_date("ts").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return prj.consecutive_difference(d, ["event_type"], ["day"], "n")


QUERIES = {f.__name__: f for f in (
    camera_order, flipped_density, preferred_scores, bad_traces, cell_shapes, density_colours, plane_pairs, atlas_lookup, remove_deleted_labels, keep_cells, semi_cells,
    parameter_grid, black_level, mean_spot_shape, radial_spot_shape, cells_per_tile, cdf_difference, natural_order, set_operations, daily_steps,
)}

_D, _T, _PEAKS = rasters._D, rasters._T, rasters._PEAKS
_HIGH = "g as (select distinct roi, tx, ty from gene_spots where spot_score > {g} and spot_score <= 1), b as (select distinct roi, tx, ty from barcode_spots where spot_score > {b} and spot_score <= 1)"
_SHAPE = "o as (select unnest(range(-3, 4))::int as dy), o2 as (select dy, unnest(range(-3, 4))::int as dx from o), ms as (select dy, dx, round(avg(sign(coalesce(d.v, 0))), 6) as v from pk cross join o2 left join d on d.roi = pk.roi and d.y = pk.y + dy and d.x = pk.x + dx group by dy, dx)"

ORACLES = {
    "camera_order": f"with {_T} select case c when 1 then 0 when 3 then 1 when 0 then 2 else 3 end as c, round(sum(v), 3) as total from t where round = 0 group by 1",
    "flipped_density": f"with {_D}, f as (select roi, case when roi % 2 = 1 then 499 - x else x end as x from d) select roi, min(x) as x_min, max(x) as x_max, sum(x)::bigint as x_sum from f group by roi",
    "preferred_scores": """select roi, tx, ty, case when right_x is not null and not isnan(right_x) then 'right' else 'down' end as version, case when right_x is not null and not isnan(right_x) then right_x else down_y end as v
      from tile_shifts where (right_x is not null and not isnan(right_x)) or (down_y is not null and not isnan(down_y))""",
    "bad_traces": f"with {_T}, b as (select distinct spot_id, round from t3 where v is null or isnan(v)) select round, count(*) as n from b group by round",
    "cell_shapes": """with c as (select roi, label, area, 2.0 * (xmax - xmin + ymax - ymin) as p, (xmax - xmin) / (ymax - ymin) as r from cells where xmax > xmin and ymax > ymin), s as (select *, 4 * pi() * area / (p * p) as k from c)
      select roi, label, round(k, 5) as circularity, round(r, 5) as intensity_ratio, round(log10(least(r, 100)), 5) as clamped_ratio from s where k >= 0.3 and area between 100 and 1200 and r <= 1.5""",
    "density_colours": f"""with {_D}, s as (select roi % 3 as c, least(v / 4, 1) * 255 as s from d), k as (select case c when 0 then s when 1 then 0 else 0.25 * s end as r, case c when 0 then 0 when 1 then s else 0.25 * s end as g, case c when 0 then 0.5 * s when 1 then 0 else s end as b from s)
      select floor(r)::int as r, floor(g)::int as g, floor(b)::int as b, count(*) as n from k group by 1, 2, 3""",
    "plane_pairs": f"with {_T} select a.round, count(*) as n, round(sum(a.v * b.v), 1) as product from t a join t b on a.spot_id = b.spot_id and a.c = 0 and b.c = 1 and b.round = a.round + 2 group by a.round",
    "atlas_lookup": f"""with {_D}, a as (select roi, y // 2 as y, x // 2 as x, (sum(v) % 6)::int as area_id from d group by 1, 2, 3), s as (select roi, round_even(y / 200.0, 0)::int as y, round_even(x / 200.0, 0)::int as x from l)
      select case when area_id = 0 then 'outside' else r_name end as area, count(*) as n from s join a using (roi, y, x) left join region on r_regionkey = area_id group by 1""",
    "remove_deleted_labels": "select roi, label, area from cells where area % 7 <> 0",
    "keep_cells": "select roi, case when xmax > xmin + 10 then label else 0 end as label, count(*) as n, sum(area)::bigint as area from cells group by 1, 2",
    "semi_cells": f"with {_HIGH.format(g=0.8, b=0.5)} select roi, tx, ty from g semi join b using (roi, tx, ty)",
    "parameter_grid": f"""with s as (select distinct spot_id, {sql_score('spot_score')} as a, {sql_score('dot_product_score')} as b from barcode_spots where spot_id is not null),
      p as (select * from (values {', '.join(f'({v}::double)' for v in GRID['spot_score'])}) x(spot_score), (values {', '.join(f'({v}::double)' for v in GRID['dot_product_score'])}) y(dot_product_score))
      select spot_score, dot_product_score, (select count(*) from s where a > spot_score and b > dot_product_score) as n from p""",
    "black_level": f"with {_T}, m as (select spot_id, round from t group by all having max(v) < 40) select c, round(avg(v), 4) as black from t semi join m using (spot_id, round) group by c",
    "mean_spot_shape": f"with {_PEAKS}, {_SHAPE} select dy, dx, v from ms",
    "radial_spot_shape": f"with {_PEAKS}, {_SHAPE} select dy * dy + dx * dx as r2, round(avg(v), 5) as v from ms group by 1",
    "cells_per_tile": "select roi, floor(y / 1800)::int as ty, floor(x / 1800)::int as tx, count(*) as n from cells group by all",
    "cdf_difference": f"""with {_D}, h as (select roi, v::int as v, count(*) as n from d group by all), r as (select distinct roi, unnest(range((select greatest(20, max(v)) + 1 from h)))::int as v from (select distinct roi from d)), f as (select r.roi, r.v, coalesce(n, 0) as n from r left join h using (roi, v)),
      a as (select v, sum(n) as n from f group by v), g as (select v, sum(n) over (order by v) / (select sum(n) from a) as grand from a), o as (select roi, v, sum(n) over (partition by roi order by v) / sum(n) over (partition by roi) as cdf from f)
      select roi, v, round(cdf - grand, 5) as difference from o join g using (v)""",
    "natural_order": f"with g as (select distinct {SQL_GENE} as gene from gene_spots) select gene from g where gene is not null order by coalesce(nullif(regexp_extract(gene, '[0-9]+'), '')::bigint, -1), gene",
    "set_operations": f"""with {_HIGH.format(g=0.6, b=0.6)}, p as (select 'both' as part, * from (select * from g intersect select * from b) union all select 'genes', * from (select * from g except select * from b)
      union all select 'barcodes', * from (select * from b except select * from g) union all select 'any', * from (select * from g union select * from b)) select part, roi, count(*) as n from p group by part, roi""",
    "daily_steps": "with d as (select event_type, ts::date::varchar as day, count(*) as n from events group by 1, 2) select event_type, day, n, lead(n) over (partition by event_type order by day) - n as step from d",
}
