"""Queries on tile grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotloom.operators import tiles
from spotloom.operators.spatial import located
from spotloom.sources.tables import barcode_spots, gene_spots, once_per_spot, table

LEAST_CORR, MOST_OFF, SIZE, REACH = 0.5, 20.0, 2000.0, 2


def _shifts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "tile_shifts")


def _origins(spark: SparkSession, folder: str) -> DataFrame:
    return tiles.tile_origins(tiles.clean_shifts(_shifts(spark, folder), LEAST_CORR, MOST_OFF), SIZE)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) + 0.0 for c in columns})


def grid_dims_from_names(spark: SparkSession, folder: str) -> DataFrame:
    s = _shifts(spark, folder)
    named = s.select(F.concat(F.lit("genes_MMStack_"), "roi", F.lit("-Pos"), F.lpad(F.col("tx").cast("string"), 3, "0"), F.lit("_"), F.lpad(F.col("ty").cast("string"), 3, "0"), F.lit(".ome.tif")).alias("name"))
    return tiles.grid_from_names(named, "name")


def missing_tiles(spark: SparkSession, folder: str) -> DataFrame:
    """Tiles of the grid without a barcode spot."""
    dims = _shifts(spark, folder).groupBy("roi").agg((F.max("tx") + 1).alias("nx"), (F.max("ty") + 1).alias("ny"))
    return tiles.expected_tiles(dims).join(barcode_spots(spark, folder).select("roi", "tx", "ty").distinct(), ["roi", "tx", "ty"], "left_anti")


def grid_consistency(spark: SparkSession, folder: str) -> DataFrame:
    """Rois whose acquisitions differ in their grid, and rois in all."""
    parts = [table(spark, folder, t).groupBy("roi").agg(F.max("tx").alias("nx"), F.max("ty").alias("ny")).withColumn("acq", F.lit(t)) for t in ("gene_spots", "barcode_spots", "tile_shifts")]
    all_ = parts[0].unionByName(parts[1]).unionByName(parts[2]).where("roi is not null")
    return all_.groupBy("roi").agg(F.countDistinct("nx", "ny").alias("n_grids"), F.count(F.lit(1)).alias("n_acquisitions"))


def neighbour_tiles(spark: SparkSession, folder: str) -> DataFrame:
    return tiles.neighbours(_shifts(spark, folder))


def shift_outlier_replace(spark: SparkSession, folder: str) -> DataFrame:
    c = tiles.clean_shifts(_shifts(spark, folder), LEAST_CORR, MOST_OFF)
    return _rounded(c.select("roi", "tx", "ty", "right_y", "right_x", "down_y", "down_x"), "right_y", "right_x", "down_y", "down_x")


def shift_medians(spark: SparkSession, folder: str) -> DataFrame:
    s = _shifts(spark, folder)
    n = lambda c: F.median(F.when(~F.isnan(c), F.col(c)))
    return _rounded(s.groupBy("roi").agg(*(n(c).alias(c) for c in ("right_y", "right_x", "down_y", "down_x"))), "right_y", "right_x", "down_y", "down_x")


def tile_origins(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_origins(spark, folder), "origin_y", "origin_x", "centre_y", "centre_x")


def tile_corners(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(tiles.corners(_origins(spark, folder), SIZE), "y", "x")


def rect_overlap(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(tiles.tile_overlaps(_origins(spark, folder), SIZE), "y0", "x0", "y1", "x1")


def home_tile_dedup(spark: SparkSession, folder: str) -> DataFrame:
    spots = once_per_spot(located(barcode_spots(spark, folder)), "roi", "tx", "ty", "x", "y")
    return tiles.home_tile_only(spots, _origins(spark, folder), REACH).select("spot_id", "roi", "tx", "ty")


def affine_apply(spark: SparkSession, folder: str) -> DataFrame:
    """Spots turned by an angle that depends on their tile, summed per tile."""
    a = (F.col("tx") - F.col("ty")) * 0.001
    t = _shifts(spark, folder).select("roi", "tx", "ty", F.cos(a).alias("m00"), (-F.sin(a)).alias("m01"), F.lit(3.0).alias("m02"), F.sin(a).alias("m10"), F.cos(a).alias("m11"), F.lit(-2.0).alias("m12"))
    spots = once_per_spot(located(gene_spots(spark, folder)), "roi", "tx", "ty", "x", "y")
    moved = tiles.apply_affine(spots, t, ["roi", "tx", "ty"])
    return moved.groupBy("roi", "tx", "ty").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("x"), 3).alias("x"), F.round(F.avg("y"), 3).alias("y"))


def stitched_spots(spark: SparkSession, folder: str) -> DataFrame:
    """Tile offset join: sums of the stitched places of each tile's spots."""
    spots = once_per_spot(located(gene_spots(spark, folder)), "roi", "tx", "ty", "x", "y")
    j = spots.join(_origins(spark, folder).select("roi", "tx", "ty", "origin_y", "origin_x"), ["roi", "tx", "ty"])
    return j.groupBy("roi", "tx", "ty").agg(F.round(F.sum(F.col("x") + F.col("origin_x")), 3).alias("x"), F.round(F.sum(F.col("y") + F.col("origin_y")), 3).alias("y"))


def best_transform(spark: SparkSession, folder: str) -> DataFrame:
    raw = _shifts(spark, folder).where("right_y is not null")
    fit = raw.select("roi", "tx", "ty").join(shift_medians(spark, folder), "roi")
    return _rounded(tiles.best_shift(raw, fit, ["roi", "tx", "ty"], ["right_y", "right_x"], 10.0), "right_y", "right_x")


def label_offsets(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "cells").select("roi", F.floor(F.col("x") / 1800).cast("int").alias("tx"), F.floor(F.col("y") / 1800).cast("int").alias("ty"), "label")
    return tiles.label_offsets(c)


def section_position(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders").select("o_custkey", F.datediff("o_orderdate", F.lit("1990-01-01")).alias("day"), "o_orderkey", F.floor("o_totalprice").alias("thickness"))
    return tiles.section_positions(o, "o_custkey", ["day", "o_orderkey"], "thickness").select("o_orderkey", "position", "gap")


QUERIES = {f.__name__: f for f in (
    grid_dims_from_names, missing_tiles, grid_consistency, neighbour_tiles, shift_outlier_replace, shift_medians, tile_origins, tile_corners,
    rect_overlap, home_tile_dedup, affine_apply, stitched_spots, best_transform, label_offsets, section_position,
)}


def _nn(c: str) -> str:
    return f"case when not isnan({c}) then {c} end"


def _sql_clean(side: str, line: str) -> str:
    return f"""{side}0 as (select roi, tx, ty, {side}_y is not null and {side}_x is not null as there,
        case when {_nn(f'corr_{side}')} >= {LEAST_CORR} and {_nn(f'{side}_y')} is not null and {_nn(f'{side}_x')} is not null then {side}_y end as y,
        case when {_nn(f'corr_{side}')} >= {LEAST_CORR} and {_nn(f'{side}_y')} is not null and {_nn(f'{side}_x')} is not null then {side}_x end as x from tile_shifts),
      {side}1 as (select *, coalesce(median(y) over (partition by roi, {line}), median(y) over (partition by roi)) as my, coalesce(median(x) over (partition by roi, {line}), median(x) over (partition by roi)) as mx from {side}0),
      {side}2 as (select roi, tx, ty, case when there then case when abs(y - my) <= {MOST_OFF} and abs(x - mx) <= {MOST_OFF} then y else my end end as {side}_y,
        case when there then case when abs(y - my) <= {MOST_OFF} and abs(x - mx) <= {MOST_OFF} then x else mx end end as {side}_x from {side}1)"""


_CLEAN = f"{_sql_clean('right', 'ty')}, {_sql_clean('down', 'tx')}, cl as (select * from right2 join down2 using (roi, tx, ty))"
_ORIGINS = f"""{_CLEAN}, o0 as (select roi, tx, ty, {', '.join(f"coalesce(sum(right_{c}) over r, 0) + coalesce(sum(down_{c}) over d, 0) as {c}0" for c in 'yx')} from cl
      window r as (partition by roi, ty order by tx rows between unbounded preceding and 1 preceding), d as (partition by roi, tx order by ty rows between unbounded preceding and 1 preceding)),
  o as (select roi, tx, ty, y0 - min(y0) over (partition by roi) as origin_y, x0 - min(x0) over (partition by roi) as origin_x from o0)"""
_MED = "med as (select roi, " + ", ".join(f"round(median({_nn(c)}), 4) as {c}" for c in ("right_y", "right_x", "down_y", "down_x")) + " from tile_shifts group by roi)"
_LOC = "l as (select distinct spot_id, roi, tx, ty, x, y from {t} where spot_id is not null and x is not null and y is not null and not (x = -1 and y = -1))"
_PAIRS = "(values (0, 1), (1, 0), (1, 1)) s(dx, dy)"

ORACLES = {
    "grid_dims_from_names": "select roi, max(tx) + 1 as nx, max(ty) + 1 as ny from tile_shifts group by roi",
    "missing_tiles": """with d as (select roi, max(tx) as nx, max(ty) as ny from tile_shifts group by roi), e as (select roi, unnest(range(nx + 1))::int as tx, ny from d),
      f as (select roi, tx, unnest(range(ny + 1))::int as ty from e) select roi, tx, ty from f anti join barcode_spots using (roi, tx, ty)""",
    "grid_consistency": """with a as (select roi, max(tx) as nx, max(ty) as ny from gene_spots group by roi union all select roi, max(tx), max(ty) from barcode_spots group by roi union all select roi, max(tx), max(ty) from tile_shifts group by roi)
      select roi, count(distinct (nx, ny)) as n_grids, count(*) as n_acquisitions from a where roi is not null group by roi""",
    "neighbour_tiles": f"select a.roi, a.tx, a.ty, b.tx as tx2, b.ty as ty2 from tile_shifts a, {_PAIRS}, tile_shifts b where a.roi = b.roi and b.tx = a.tx + dx and b.ty = a.ty + dy",
    "shift_outlier_replace": f"with {_CLEAN} select roi, tx, ty, round(right_y, 4) as right_y, round(right_x, 4) as right_x, round(down_y, 4) as down_y, round(down_x, 4) as down_x from cl",
    "shift_medians": f"with {_MED} select * from med",
    "tile_origins": f"with {_ORIGINS} select roi, tx, ty, round(origin_y, 4) as origin_y, round(origin_x, 4) as origin_x, round(origin_y + {SIZE / 2}, 4) as centre_y, round(origin_x + {SIZE / 2}, 4) as centre_x from o",
    "tile_corners": f"with {_ORIGINS} select roi, tx, ty, corner, round(origin_y + dy, 4) as y, round(origin_x + dx, 4) as x from o, (values (0, 0.0, 0.0), (1, 0.0, {SIZE}), (2, {SIZE}, {SIZE}), (3, {SIZE}, 0.0)) c(corner, dy, dx)",
    "rect_overlap": f"""with {_ORIGINS} select a.roi, a.tx, a.ty, b.tx as tx2, b.ty as ty2, round(greatest(a.origin_y, b.origin_y), 4) as y0, round(greatest(a.origin_x, b.origin_x), 4) as x0,
      round(least(a.origin_y, b.origin_y) + {SIZE}, 4) as y1, round(least(a.origin_x, b.origin_x) + {SIZE}, 4) as x1 from o a join o b on a.roi = b.roi and (a.tx < b.tx or a.tx = b.tx and a.ty < b.ty)
      where abs(a.origin_y - b.origin_y) <= {SIZE} and abs(a.origin_x - b.origin_x) <= {SIZE}""",
    "home_tile_dedup": f"""with {_ORIGINS}, {_LOC.format(t='barcode_spots')}, d as (select l.*, o.tx as ox, o.ty as oy, (l.y - origin_y - {SIZE / 2}) ** 2 + (l.x - origin_x - {SIZE / 2}) ** 2 as d2 from l join o on l.roi = o.roi)
      select spot_id, roi, tx, ty from d group by spot_id, roi, tx, ty having min(d2) filter (where ox = tx and oy = ty) < coalesce(min(d2) filter (where not (ox = tx and oy = ty)), 1e300)""",
    "affine_apply": f"""with {_LOC.format(t='gene_spots')}, m as (select l.*, (l.tx - l.ty) * 0.001 as a, s.roi is not null as known from l left join tile_shifts s using (roi, tx, ty))
      select roi, tx, ty, count(*) as n, round(avg(case when known then cos(a) * x - sin(a) * y + 3 else x end), 3) as x, round(avg(case when known then sin(a) * x + cos(a) * y - 2 else y end), 3) as y from m group by roi, tx, ty""",
    "stitched_spots": f"with {_ORIGINS}, {_LOC.format(t='gene_spots')} select roi, tx, ty, round(sum(x + origin_x), 3) as x, round(sum(y + origin_y), 3) as y from l join o using (roi, tx, ty) group by roi, tx, ty",
    "best_transform": f"with {_MED} select s.roi, tx, ty, " + ", ".join(f"round(case when not isnan(s.{c}) and abs(s.{c} - med.{c}) <= 10 then s.{c} else med.{c} end, 4) as {c}" for c in ("right_y", "right_x")) + " from tile_shifts s join med on s.roi = med.roi where s.right_y is not null",
    "label_offsets": """with t as (select roi, floor(x / 1800)::int as tx, floor(y / 1800)::int as ty, max(label) as m from cells group by all)
      select roi, tx, ty, coalesce(sum(m) over (partition by roi order by tx, ty rows between unbounded preceding and 1 preceding), 0)::bigint as "offset" from t""",
    "section_position": """with s as (select o_custkey, date_diff('day', date '1990-01-01', o_orderdate::date) as day, o_orderkey, floor(o_totalprice)::bigint as th from orders)
      select o_orderkey, sum(th) over (partition by o_custkey order by day, o_orderkey rows unbounded preceding)::bigint as position, (day - lag(day) over (partition by o_custkey order by day, o_orderkey))::int as gap from s""",
}
