"""Queries that run kernels on planes, and those of sources and streams."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotloom.operators import kernels, raster
from spotloom.operators.spatial import located
from spotloom.session import Scratch
from spotloom.sources.tables import gene_spots, once_per_spot, table
from spotloom.streaming import live

#: Pixels of the stitched roi per pixel of a plane, and the side of a plane.
STEP, SIDE = 50, 40
KEYS = ["roi", "gy", "gx"]
#: Greatest shift of a registered plane, and the least pixels that must stay inside by it.
REACH, SURE = 3, 8
#: Radii, threshold and least pixels of thresholded regions; pixels of a roi per pixel, side and depth of the planes of cells.
INNER, OUTER, ABOVE, LEAST = 1, 4, 0.3, 2
CELL_STEP, CELL_SIDE, CORE = 4, 64, 1


def _pixels(spark: SparkSession, folder: str) -> DataFrame:
    """roi, gy, gx, y, x, v: spot counts in planes of 40 x 40."""
    s = once_per_spot(located(gene_spots(spark, folder)), "roi", "x", "y").where("x >= 0 and y >= 0")
    s = s.withColumns({"py": F.floor(F.col("y") / STEP).cast("int"), "px": F.floor(F.col("x") / STEP).cast("int")})
    return s.groupBy("roi", F.floor(F.col("py") / SIDE).cast("int").alias("gy"), F.floor(F.col("px") / SIDE).cast("int").alias("gx"), (F.col("py") % SIDE).alias("y"), (F.col("px") % SIDE).alias("x")).agg(F.count(F.lit(1)).cast("double").alias("v"))


def _planes(spark: SparkSession, folder: str, least: int = 5) -> DataFrame:
    """Planes with at least some pixels that are not 0."""
    p = kernels.planes_from_pixels(_pixels(spark, folder), KEYS, SIDE, SIDE)
    return p.where(F.size(F.filter("v", lambda v: v != 0)) >= least)


def band_pass_planes(spark: SparkSession, folder: str) -> DataFrame:
    """Largest and least value of each band-passed plane."""
    f = kernels.map_planes(_planes(spark, folder), KEYS, kernels.band_pass)
    return f.select(*KEYS, F.round(F.array_max("v"), 5).alias("top"), F.round(F.array_min("v"), 5).alias("low"))


def registered_planes(spark: SparkSession, folder: str) -> DataFrame:
    """Planes to their reference: each was moved by a shift of its own, lost what left it and was dimmed. Planes count where at least
    half of the pixels, and enough of them, cannot leave."""
    px = Scratch(spark, "planes").save(_pixels(spark, folder))
    dy, dx = (2 * F.col("gy") + F.col("gx")) % (2 * REACH + 1) - REACH, (3 * F.col("gx") + F.col("roi")) % (2 * REACH + 1) - REACH
    stays = F.count_if(F.col("y").between(REACH, SIDE - 1 - REACH) & F.col("x").between(REACH, SIDE - 1 - REACH))
    sure = px.groupBy(*KEYS).agg(stays.alias("n"), F.count(F.lit(1)).alias("every")).where((F.col("n") >= SURE) & (F.col("n") >= 0.5 * F.col("every")))
    px = px.join(sure.select(*KEYS), KEYS, "left_semi")
    p = kernels.planes_from_pixels(px, KEYS, SIDE, SIDE)
    moved = kernels.planes_from_pixels(px.withColumns({"y": F.col("y") + dy, "x": F.col("x") + dx, "v": F.col("v") * 0.5}), KEYS, SIDE, SIDE)
    return kernels.pair_planes(p, moved, KEYS, kernels.phase_shift, ["shift_y", "shift_x", "corr"]).select(*KEYS, F.col("shift_y").cast("int").alias("shift_y"), F.col("shift_x").cast("int").alias("shift_x"))


def warped_planes(spark: SparkSession, folder: str) -> DataFrame:
    """Planes seen half a pixel to the right, between their pixels."""
    half = kernels.map_planes(_planes(spark, folder), KEYS, lambda im: kernels.warp(im, np.array([[1, 0, 0.5], [0, 1, 0], [0, 0, 1.0]]), outside=0.0))
    return half.select(*KEYS, F.round(F.aggregate("v", F.lit(0.0), lambda a, v: a + v), 4).alias("total"), F.array_max("v").alias("top"))


def thresholded_planes(spark: SparkSession, folder: str) -> DataFrame:
    """Regions brighter than their surroundings: how many per plane, and their pixels."""
    labels = kernels.map_planes(_planes(spark, folder), KEYS, lambda im: kernels.centre_surround_regions(im, INNER, OUTER, ABOVE, LEAST))
    found = labels.select(*KEYS, F.explode("v").alias("label")).where("label > 0")
    return found.groupBy(*KEYS).agg(F.countDistinct("label").alias("n_regions"), F.count(F.lit(1)).alias("n_pixels"))


def seeded_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The area of all cells divided around its cores: regions per plane, and pixels that belong to one."""
    m = raster.rasterise_boxes(table(spark, folder, "cells"), ["roi"], "label", CELL_STEP)
    cut = lambda c: F.floor(F.col(c) / CELL_SIDE).cast("int")
    m = m.select("roi", cut("y").alias("gy"), cut("x").alias("gx"), F.pmod("y", F.lit(CELL_SIDE)).alias("y"), F.pmod("x", F.lit(CELL_SIDE)).alias("x"), F.lit(1.0).alias("v"))
    planes = kernels.planes_from_pixels(m, KEYS, CELL_SIDE, CELL_SIDE)
    found = kernels.map_planes(planes, KEYS, lambda im: kernels.seeded_regions(im, 0.5, CORE)).select(*KEYS, F.explode("v").alias("label")).where("label > 0")
    return found.groupBy(*KEYS).agg(F.countDistinct("label").alias("n_regions"), F.count(F.lit(1)).alias("n_pixels"))


def plane_regions(spark: SparkSession, folder: str) -> DataFrame:
    """Connected regions of pixels with spots: how many per plane, and the size of the largest."""
    labels = kernels.map_planes(_planes(spark, folder), KEYS, lambda im: kernels.components(im > 0))
    sizes = labels.select(*KEYS, F.explode("v").alias("label")).where("label > 0").groupBy(*KEYS, "label").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_regions"), F.max("n").alias("largest"))


def halved_planes(spark: SparkSession, folder: str) -> DataFrame:
    """Pyramid level: means of 2 x 2 pixels."""
    half = kernels.map_planes(_planes(spark, folder), KEYS, lambda im: kernels.pyramid(im, 1)[1])
    return kernels.pixels_from_planes(half, KEYS).where("v > 0").groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("v"), 4).alias("total"))


def json_props(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    return e.groupBy("event_type", F.get_json_object("props", "$.k").cast("int").alias("k")).agg(F.count(F.lit(1)).alias("n"))


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a stream of files, appended batch by batch, then counted by day and type."""
    scratch = Scratch(spark, "stream")
    schema = table(spark, folder, "events").schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ", 99)
    stream = live.arriving(spark, folder, schema, glob="events*")
    live.process_available(stream, f"{scratch.at}/out", f"{scratch.at}/state", lambda b: b.select("event_id", F.to_date("ts").cast("string").alias("day"), "event_type"))
    done = spark.read.parquet(f"{scratch.at}/out")
    return done.groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("n_events"))


QUERIES = {f.__name__: f for f in (band_pass_planes, registered_planes, warped_planes, thresholded_planes, seeded_cells, plane_regions, halved_planes, json_props, stream_ingest)}

_P = f"""l as (select distinct spot_id, roi, x, y from gene_spots where spot_id is not null and x >= 0 and y >= 0),
  p as (select roi, y // {STEP} // {SIDE} as gy, x // {STEP} // {SIDE} as gx, y // {STEP} % {SIDE} as y, x // {STEP} % {SIDE} as x, count(*) as v from l group by all),
  k as (select roi, gy, gx from p group by roi, gy, gx having count(*) >= 5)"""

_Q = f"{_P}, q as (select p.* from p semi join k using (roi, gy, gx))"


def _sql_filter(kernel: np.ndarray) -> str:
    """s: a kernel over planes whose border is repeated, from the pixels that are not 0."""
    r = len(kernel) // 2
    weights = ", ".join(f"({i - r}, {j - r}, {float(w)!r}::double)" for (i, j), w in np.ndenumerate(kernel) if w)
    return f"""ax as (select o.v::int as o, d.v::int as d, least(greatest(o.v + d.v, 0), {SIDE - 1})::int as i from (select unnest(range({SIDE})) as v) o, (select unnest(range({-r}, {r + 1})) as v) d),
      s as (select roi, gy, gx, a.o as y, b.o as x, sum(v * w) as s from q join ax a on a.i = q.y join ax b on b.i = q.x join (values {weights}) k(dy, dx, w) on k.dy = a.d and k.dx = b.d group by all)"""


def _sql_regions(mask: str) -> str:
    """m: the pixels of a mask (roi, gy, gx, y, x), each with the least pixel of its region."""
    return f"""r as (select roi, gy, gx, y, x, y * 1000 + x as low from {mask} union select r.roi, r.gy, r.gx, t.y, t.x, r.low from r join {mask} t on r.roi = t.roi and r.gy = t.gy and r.gx = t.gx and abs(r.y - t.y) + abs(r.x - t.x) = 1),
      m as (select roi, gy, gx, y, x, min(low) as low from r group by all)"""


_WIDE, _NARROW = kernels.hann_disk(4), np.pad(kernels.hann_disk(2), 2)
_SURROUND = np.pad(kernels.hann_disk(INNER), OUTER - INNER) - 1.5 * kernels.hann_disk(OUTER)

ORACLES = {
    "registered_planes": f"""with {_P}, n as (select roi, gy, gx from p group by all having count(*) filter (where y between {REACH} and {SIDE - 1 - REACH} and x between {REACH} and {SIDE - 1 - REACH}) >= greatest({SURE}, 0.5 * count(*)))
      select roi, gy::int as gy, gx::int as gx, ({REACH} - (2 * gy + gx) % {2 * REACH + 1})::int as shift_y, ({REACH} - (3 * gx + roi) % {2 * REACH + 1})::int as shift_x from n""",
    "band_pass_planes": f"""with {_Q}, {_sql_filter(_NARROW - _WIDE)} select roi, gy::int as gy, gx::int as gx, round(case when count(*) < {SIDE * SIDE} then greatest(max(s), 0) else max(s) end, 5) as top,
      round(case when count(*) < {SIDE * SIDE} then least(min(s), 0) else min(s) end, 5) as low from s group by roi, gy, gx""",
    "warped_planes": f"""with {_Q}, h as (select roi, gy, gx, y, x, v / 2 as v from q where x < {SIDE - 1} union all select roi, gy, gx, y, x - 1, v / 2 from q where x > 0), g as (select roi, gy, gx, y, x, sum(v) as v from h group by all)
      select roi, gy::int as gy, gx::int as gx, round(sum(v), 4) as total, max(v) as top from g group by roi, gy, gx""",
    "thresholded_planes": f"""with recursive {_Q}, {_sql_filter(_SURROUND)}, b as (select roi, gy, gx, y, x from s where s > {ABOVE}), {_sql_regions('b')}, n as (select roi, gy, gx, low, count(*) as n from m group by all having count(*) >= {LEAST})
      select roi, gy::int as gy, gx::int as gx, count(*) as n_regions, sum(n)::bigint as n_pixels from n group by roi, gy, gx""",
    "seeded_cells": f"""with recursive b0 as (select roi, unnest(range(floor(ymin / {CELL_STEP})::int, floor((ymax - 1) / {CELL_STEP})::int + 1))::int as y, xmin, xmax from cells where ymin < ymax and xmin < xmax),
      b1 as (select distinct roi, y, unnest(range(floor(xmin / {CELL_STEP})::int, floor((xmax - 1) / {CELL_STEP})::int + 1))::int as x from b0),
      b as (select roi, floor(y / {CELL_SIDE})::int as gy, floor(x / {CELL_SIDE})::int as gx, (y - {CELL_SIDE} * floor(y / {CELL_SIDE}))::int as y, (x - {CELL_SIDE} * floor(x / {CELL_SIDE}))::int as x from b1),
      c as (select b.roi, b.gy, b.gx, b.y, b.x from b join b t on t.roi = b.roi and t.gy = b.gy and t.gx = b.gx and abs(t.y - b.y) + abs(t.x - b.x) = 1 group by all having count(*) = 4),
      {_sql_regions('c')}, n as (select roi, gy, gx, count(distinct low) as n_regions from m group by all),
      f as (select * from c union select b.* from f join b on b.roi = f.roi and b.gy = f.gy and b.gx = f.gx and abs(b.y - f.y) + abs(b.x - f.x) = 1)
      select f.roi, f.gy, f.gx, any_value(n_regions) as n_regions, count(*) as n_pixels from f join n using (roi, gy, gx) group by all""",
    "halved_planes": f"with {_P}, h as (select p.roi, p.gy, p.gx, y // 2 as y, x // 2 as x, sum(v) / 4 as v from p semi join k using (roi, gy, gx) group by all) select roi, gy::int as gy, gx::int as gx, count(*) as n, round(sum(v), 4) as total from h group by roi, gy, gx",
    "plane_regions": f"""with recursive {_P}, q as (select p.* from p semi join k using (roi, gy, gx)),
      r as (select roi, gy, gx, y, x, y * {SIDE} + x as low from q union select r.roi, r.gy, r.gx, q.y, q.x, r.low from r join q on r.roi = q.roi and r.gy = q.gy and r.gx = q.gx and abs(r.y - q.y) + abs(r.x - q.x) = 1),
      m as (select roi, gy, gx, y, x, min(low) as low from r group by all), s as (select roi, gy, gx, low, count(*) as n from m group by all)
      select roi, gy::int as gy, gx::int as gx, count(*) as n_regions, max(n) as largest from s group by roi, gy, gx""",
    "json_props": "select event_type, (props->>'k')::int as k, count(*) as n from events group by 1, 2",
    "stream_ingest": "select ts::date::varchar as day, event_type, count(*) as n, count(distinct event_id) as n_events from events group by 1, 2",
}
