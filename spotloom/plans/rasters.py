"""Queries on rasters: the density of gene spots per 100 pixels, cell boxes as labels, trace cycles as planes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spotloom.functions.arrays import has_nan
from spotloom.operators import raster
from spotloom.operators.estimators import exact_median
from spotloom.operators.spatial import located
from spotloom.session import Scratch
from spotloom.sources.tables import barcode_spots, gene_spots, once_per_spot, table

STEP, LABEL_STEP = 100, 20
PEAK, SPREAD, RING = 2.0, raster.gaussian(1.0, 2), (2.0, 3.0)
TEMPLATE = [(dy, dx, 1.0 if dy * dy + dx * dx <= 1 else -1.0) for dy, dx, _ in raster.box(-2, 2)]


def _density(spark: SparkSession, folder: str) -> DataFrame:
    s = once_per_spot(located(gene_spots(spark, folder)), "roi", "x", "y")
    return s.groupBy("roi", F.floor(F.col("y") / STEP).cast("int").alias("y"), F.floor(F.col("x") / STEP).cast("int").alias("x")).agg(F.count(F.lit(1)).cast("double").alias("v"))


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    return raster.rasterise_boxes(table(spark, folder, "cells"), ["roi"], "label", LABEL_STEP)


def _whole_traces(spark: SparkSession, folder: str) -> DataFrame:
    """spot_id, trace: those without gaps."""
    return once_per_spot(barcode_spots(spark, folder).where("trace is not null"), "trace").where(~F.exists("trace", has_nan))


def _traces(spark: SparkSession, folder: str) -> DataFrame:
    """spot_id, round, c, v of the traces without gaps."""
    t = _whole_traces(spark, folder)
    return t.select("spot_id", F.posexplode("trace").alias("round", "t")).select("spot_id", "round", F.posexplode("t").alias("c", "v"))


def histogram_dense(spark: SparkSession, folder: str) -> DataFrame:
    return raster.histogram(_density(spark, folder), ["roi"], "v")


def cumulative_hist(spark: SparkSession, folder: str) -> DataFrame:
    c = raster.cumulative(raster.histogram(_density(spark, folder), ["roi"], "v"), ["roi"])
    return c.select("roi", "v", F.round("cdf", 6).alias("cdf"))


def cdf_quantile(spark: SparkSession, folder: str) -> DataFrame:
    """Normalisation factor per channel and round: the strict 0.999 quantile of truncated intensities."""
    return raster.strict_quantile(raster.histogram(_traces(spark, folder), ["c", "round"], "v"), ["c", "round"], 0.999)


def channel_norm(spark: SparkSession, folder: str) -> DataFrame:
    """Intensities divided by the factor of their channel in the first round: mean per channel and round."""
    t = _traces(spark, folder)
    f = raster.strict_quantile(raster.histogram(t.where("round = 0"), ["c"], "v"), ["c"], 0.999)
    return t.join(f, "c").groupBy("c", "round").agg(F.round(F.avg(F.col("v") / F.col("factor")), 6).alias("mean_v"))


def merged_histograms(spark: SparkSession, folder: str) -> DataFrame:
    return raster.histogram(_density(spark, folder), ["roi"], "v").groupBy("v").agg(F.sum("n").alias("n"))


def norm_shift(spark: SparkSession, folder: str) -> DataFrame:
    """Root of the median energy of the traces."""
    s = Scratch(spark, "energy").save(_whole_traces(spark, folder).select(F.aggregate(F.flatten("trace"), F.lit(0.0), lambda a, v: a + v * v).alias("s")))
    m = exact_median(s, "s")
    return spark.range(1).select(F.lit(None if m is None else round(m**0.5, 4)).cast("double").alias("norm_shift"))


def channel_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _traces(spark, folder).groupBy("c", "round").agg(F.round(F.stddev_pop("v"), 4).alias("sd"), F.round(F.avg("v"), 4).alias("mean"), F.max("v").alias("top"))


def z_projection(spark: SparkSession, folder: str) -> DataFrame:
    """Maximum, median and mean over the rounds, per spot and channel; a trace is one row, so nothing is shuffled for it."""
    t = _whole_traces(spark, folder).where(F.size("trace") > 0).select("spot_id", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda c: F.transform("trace", lambda r: F.get(r, c)))).alias("c", "v"))
    n, s = F.size("v"), F.array_sort("v")
    middle = (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2
    mean = F.aggregate("v", F.lit(0.0), lambda a, x: a + x) / n
    return t.select("spot_id", "c", F.array_max("v").alias("v_max"), middle.alias("v_median"), F.round(mean, 4).alias("v_mean"))


def focus_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Per roi and channel the round of greatest spread, and whether it lies within two of an end."""
    rois = once_per_spot(barcode_spots(spark, folder), "roi").distinct()
    s = _traces(spark, folder).join(rois, "spot_id").groupBy("roi", "c", "round").agg(F.stddev_pop("v").alias("sd"), F.count(F.lit(1)).alias("n")).where("n >= 30")
    best = s.groupBy("roi", "c").agg(F.max_by("round", "sd").alias("round"), F.round(F.max("sd"), 3).alias("sd"))
    return best.withColumn("near_end", (F.col("round") < 2) | (F.col("round") > 13))


def mean_image(spark: SparkSession, folder: str) -> DataFrame:
    """Mean clipped density over the rois, per pixel of a 20 x 20 tile."""
    d = _density(spark, folder)
    return d.groupBy((F.col("y") % 20).alias("y"), (F.col("x") % 20).alias("x")).agg(F.round(F.avg(F.least("v", F.lit(5.0))), 6).alias("v"))


def batch_median_mean(spark: SparkSession, folder: str) -> DataFrame:
    d = _density(spark, folder)
    m = raster.batch_median_mean(d.withColumns({"y": F.col("y") % 20, "x": F.col("x") % 20}), ["y", "x"], F.col("roi") % 3, 0.0, 5.0)
    return m.select("y", "x", F.round("v", 6).alias("v"))


def block_mean(spark: SparkSession, folder: str) -> DataFrame:
    return raster.block_reduce(_density(spark, folder), ["roi"], 5, F.round(F.sum("v") / 25, 6))


def block_max(spark: SparkSession, folder: str) -> DataFrame:
    return raster.block_reduce(_density(spark, folder), ["roi"], 5, F.max("v"))


def mosaic_last_wins(spark: SparkSession, folder: str) -> DataFrame:
    s = once_per_spot(located(gene_spots(spark, folder)), "roi", "tx", "ty", "x", "y")
    p = s.groupBy("roi", "tx", "ty", F.floor(F.col("y") / STEP).cast("int").alias("y"), F.floor(F.col("x") / STEP).cast("int").alias("x")).agg(F.count(F.lit(1)).alias("v"))
    return raster.mosaic(p, ["roi"], ["tx", "ty"])


def local_max(spark: SparkSession, folder: str) -> DataFrame:
    return raster.local_maxima(_density(spark, folder), ["roi"], PEAK)


def isolated_peaks(spark: SparkSession, folder: str) -> DataFrame:
    d = _density(spark, folder)
    return raster.isolated(raster.local_maxima(d, ["roi"], PEAK), d, ["roi"], *RING, 1.0)


def smoothed_density(spark: SparkSession, folder: str) -> DataFrame:
    s = raster.stencil(_density(spark, folder), ["roi"], SPREAD, F.sum("value"))
    return s.select("roi", "y", "x", F.round("s", 6).alias("s"))


def local_mean(spark: SparkSession, folder: str) -> DataFrame:
    return raster.stencil(_density(spark, folder), ["roi"], raster.box(-1, 1), F.round(F.sum("v") / 9, 6), "v")


def spot_trace(spark: SparkSession, folder: str) -> DataFrame:
    """Mean density over a disk around each cell's centre."""
    cells = table(spark, folder, "cells").select("roi", "label", F.floor(F.col("y") / STEP).cast("int").alias("y"), F.floor(F.col("x") / STEP).cast("int").alias("x"))
    return raster.disk_means(cells, _density(spark, folder), ["roi"], 2.0).select("roi", "label", F.round("mean", 6).alias("mean"))


def peak_shape_score(spark: SparkSession, folder: str) -> DataFrame:
    d = _density(spark, folder)
    s = raster.shape_score(raster.local_maxima(d, ["roi"], PEAK), d, ["roi"], TEMPLATE, 2.0)
    return s.select("roi", "y", "x", F.round("score", 6).alias("score"), F.round("pos_pixels", 6).alias("pos_pixels"), F.round("neg_pixels", 6).alias("neg_pixels"))


def region_props(spark: SparkSession, folder: str) -> DataFrame:
    p = raster.region_properties(_labels(spark, folder), ["roi", "label"])
    return p.select("roi", "label", "area", F.round("cy", 4).alias("cy"), F.round("cx", 4).alias("cx"), "ymin", "xmin", "ymax", "xmax", F.round("major", 4).alias("major"), F.round("minor", 4).alias("minor"))


def label_overlap_pairs(spark: SparkSession, folder: str) -> DataFrame:
    a = _labels(spark, folder)
    b = a.withColumns({"y": F.col("y") + 1, "x": F.col("x") + 1})
    o = raster.label_overlaps(a, b, ["roi"], 0.3)
    return o.withColumns({"share_a": F.round("share_a", 6), "share_b": F.round("share_b", 6)})


def grown_labels(spark: SparkSession, folder: str) -> DataFrame:
    return raster.expand_labels(_labels(spark, folder), ["roi"], 2.0)


def border_labels(spark: SparkSession, folder: str) -> DataFrame:
    return raster.edge_labels(_labels(spark, folder), ["roi"], 4)


def raster_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Spots per label, background (0) included."""
    s = once_per_spot(located(gene_spots(spark, folder)), "roi", "x", "y")
    return raster.lookup(s, _labels(spark, folder), ["roi"], float(LABEL_STEP), "label", 0).groupBy("roi", "label").agg(F.count(F.lit(1)).alias("n"))


def area_acronym(spark: SparkSession, folder: str) -> DataFrame:
    """Areas (nations) by region, area 0 being outside."""
    c, n, r = (table(spark, folder, t) for t in ("customer", "nation", "region"))
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, F.col("n_regionkey") == r.r_regionkey, "left")
    area = F.when(F.col("c_nationkey") == 0, "outside").otherwise(F.col("r_name"))
    return j.groupBy(area.alias("area")).agg(F.count(F.lit(1)).alias("n"))


def density_binarised(spark: SparkSession, folder: str) -> DataFrame:
    d = _density(spark, folder)
    q = d.groupBy("roi").agg(F.percentile("v", 0.9).alias("q"))
    return d.join(q, "roi").groupBy("roi", "q").agg(F.count_if(F.col("v") > F.col("q")).alias("n_above"))


def density_clipped(spark: SparkSession, folder: str) -> DataFrame:
    """Rescaled to 0-1 between the 1st and 99th percentile: mean per roi."""
    d = _density(spark, folder)
    q = d.groupBy("roi").agg(F.percentile("v", 0.01).alias("lo"), F.percentile("v", 0.99).alias("hi"))
    v = F.try_divide(F.least(F.greatest("v", "lo"), "hi") - F.col("lo"), F.col("hi") - F.col("lo"))
    return d.join(q, "roi").groupBy("roi").agg(F.round(F.avg(v), 6).alias("mean_v"))


def density_zscore(spark: SparkSession, folder: str) -> DataFrame:
    """Daily spot counts per roi against their 40th percentile, as z-scores."""
    s = once_per_spot(gene_spots(spark, folder), "roi", F.to_date("called_at").alias("day")).where("roi is not null and day is not null")
    daily = s.groupBy("roi", "day").agg(F.count(F.lit(1)).cast("double").alias("n"))
    w = Window.partitionBy("roi")
    f0 = daily.withColumn("q", F.percentile("n", 0.4).over(w)).withColumn("f", F.try_divide(F.col("n") - F.col("q"), F.col("q")))
    z = F.try_divide(F.col("f") - F.avg("f").over(w), F.stddev_pop("f").over(w))
    return f0.select("roi", F.col("day").cast("string").alias("day"), F.round(z, 4).alias("z"))


QUERIES = {f.__name__: f for f in (
    histogram_dense, cumulative_hist, cdf_quantile, channel_norm, merged_histograms, norm_shift, channel_stats, z_projection, focus_profile, mean_image,
    batch_median_mean, block_mean, block_max, mosaic_last_wins, local_max, isolated_peaks, smoothed_density, local_mean, spot_trace, peak_shape_score,
    region_props, label_overlap_pairs, grown_labels, border_labels, raster_lookup, area_acronym, density_binarised, density_clipped, density_zscore,
)}

_LOC = "l as (select distinct spot_id, roi, tx, ty, x, y from gene_spots where spot_id is not null and x is not null and y is not null and not (x = -1 and y = -1))"
_D = f"{_LOC}, d as (select roi, floor(y / {STEP})::int as y, floor(x / {STEP})::int as x, count(*)::double as v from l group by all)"
_H = "h0 as (select roi, v::int as v, count(*) as n from d group by all), hm as (select roi, max(v) as m from h0 group by roi), hr as (select roi, unnest(range(m + 1))::int as v from hm), h as (select hr.roi, hr.v, coalesce(n, 0) as n from hr left join h0 using (roi, v))"
_T = """t0 as (select spot_id, any_value(roi) as roi, any_value(trace) as trace from barcode_spots where spot_id is not null and trace is not null group by spot_id),
  t1 as (select spot_id, roi, unnest(range(len(trace)))::int as round, trace from t0), t2 as (select spot_id, roi, round, unnest(range(4))::int as c, trace[round + 1] as r from t1),
  t3 as (select spot_id, roi, round, c, r[c + 1] as v from t2), good as (select spot_id from t3 group by spot_id having not bool_or(isnan(v) or v is null)), t as (select * from t3 semi join good using (spot_id))"""
_Q = """q0 as (select c, round, greatest(trunc(v), 0)::int as v, count(*) as n from t group by all), q1 as (select *, sum(n) over (partition by c, round order by v) / sum(n) over (partition by c, round) as cdf from q0),
  q as (select c, round, min(v) as factor from q1 where cdf > 0.999 group by c, round)"""


def _values(offsets) -> str:
    return "(values " + ", ".join(f"({dy}, {dx}, {w!r}::double)" for dy, dx, w in offsets) + ") o(dy, dx, w)"


def _sql_stencil(name: str, offsets, agg: str, source: str = "d") -> str:
    return f"{name} as (select roi, y - dy as y, x - dx as x, {agg} as s from {source}, {_values(offsets)} group by all)"


_PEAKS = f"{_D}, {_sql_stencil('mx', raster.box(-1, 2), 'max(v)')}, pk as (select d.* from d join mx using (roi, y, x) where v > {PEAK} and v + 1e-6 > s)"
_L = f"""b0 as (select roi, label, unnest(range(floor(ymin / {LABEL_STEP})::int, floor((ymax - 1) / {LABEL_STEP})::int + 1))::int as y, xmin, xmax from cells where ymin < ymax and xmin < xmax),
  b1 as (select roi, label, y, unnest(range(floor(xmin / {LABEL_STEP})::int, floor((xmax - 1) / {LABEL_STEP})::int + 1))::int as x from b0), lab as (select roi, y, x, max(label) as label from b1 group by all)"""
_POS = sum(w > 0 for *_, w in TEMPLATE)
_NEG = len(TEMPLATE) - _POS

ORACLES = {
    "histogram_dense": f"with {_D}, {_H} select roi, v, n from h",
    "cumulative_hist": f"with {_D}, {_H} select roi, v, round(sum(n) over (partition by roi order by v) / sum(n) over (partition by roi), 6) as cdf from h",
    "cdf_quantile": f"with {_T}, {_Q} select c, round, factor from q",
    "channel_norm": f"with {_T}, {_Q} select t.c, t.round, round(avg(v / factor), 6) as mean_v from t join q on t.c = q.c and q.round = 0 group by t.c, t.round",
    "merged_histograms": f"with {_D}, {_H} select v, sum(n)::bigint as n from h group by v",
    "norm_shift": f"with {_T}, s as (select spot_id, sum(v * v) as s from t group by spot_id) select round(sqrt(median(s)), 4) as norm_shift from s",
    "channel_stats": f"with {_T} select c, round, round(stddev_pop(v), 4) as sd, round(avg(v), 4) as mean, max(v) as top from t group by c, round",
    "z_projection": f"with {_T} select spot_id, c, max(v) as v_max, median(v) as v_median, round(avg(v), 4) as v_mean from t group by spot_id, c",
    "focus_profile": f"""with {_T}, s as (select roi, c, round, stddev_pop(v) as sd from t group by all having count(*) >= 30)
      select roi, c, arg_max(round, sd) as round, round(max(sd), 3) as sd, arg_max(round, sd) < 2 or arg_max(round, sd) > 13 as near_end from s group by roi, c""",
    "mean_image": f"with {_D} select y % 20 as y, x % 20 as x, round(avg(least(v, 5)), 6) as v from d group by 1, 2",
    "batch_median_mean": f"with {_D}, m as (select y % 20 as y, x % 20 as x, roi % 3 as b, avg(least(v, 5)) as m from d group by 1, 2, 3) select y, x, round(median(m), 6) as v from m group by y, x",
    "block_mean": f"with {_D} select roi, floor(y / 5)::int as y, floor(x / 5)::int as x, round(sum(v) / 25, 6) as v from d group by all",
    "block_max": f"with {_D} select roi, floor(y / 5)::int as y, floor(x / 5)::int as x, max(v) as v from d group by all",
    "mosaic_last_wins": f"""with {_LOC}, p as (select roi, tx, ty, floor(y / {STEP})::int as y, floor(x / {STEP})::int as x, count(*) as v from l group by all)
      select roi, y, x, arg_max(v, tx * 100000 + ty) as v from p group by roi, y, x""",
    "local_max": f"with {_PEAKS} select roi, y, x, v from pk",
    "isolated_peaks": f"with {_PEAKS}, {_sql_stencil('ring', raster.annulus(*RING), f'sum(v) / {len(raster.annulus(*RING))}')} select pk.roi, pk.y, pk.x, v from pk left join ring using (roi, y, x) where coalesce(s, 0) < 1.0",
    "smoothed_density": f"with {_D}, {_sql_stencil('g', SPREAD, 'sum(v * w)')} select roi, y, x, round(s, 6) as s from g",
    "local_mean": f"with {_D}, {_sql_stencil('g', raster.box(-1, 1), 'round(sum(v) / 9, 6)')} select roi, y, x, s as v from g",
    "spot_trace": f"""with {_D}, {_sql_stencil('g', raster.disk(2.0), f'sum(v) / {len(raster.disk(2.0))}')}, c as (select roi, label, floor(y / {STEP})::int as y, floor(x / {STEP})::int as x from cells)
      select roi, label, round(coalesce(s, 0), 6) as mean from c left join g using (roi, y, x)""",
    "peak_shape_score": f"""with {_PEAKS}, {_sql_stencil('g', TEMPLATE, 'struct_pack(p := count(*) filter (where w > 0), q := count(*) filter (where w < 0))')},
      n as (select pk.roi, pk.y, pk.x, coalesce(s.p, 0) as pos, {_NEG} - coalesce(s.q, 0) as neg from pk left join g using (roi, y, x))
      select roi, y, x, round((neg + 2.0 * pos) / {_NEG + 2.0 * _POS}, 6) as score, round(pos / {_POS}, 6) as pos_pixels, round(neg / {_NEG}, 6) as neg_pixels from n""",
    "region_props": f"""with {_L}, p as (select roi, label, count(*) as area, avg(y) as cy, avg(x) as cx, min(y) as ymin, min(x) as xmin, max(y) + 1 as ymax, max(x) + 1 as xmax, var_pop(y) + 1.0 / 12 as vy, var_pop(x) + 1.0 / 12 as vx, covar_pop(y, x) as c from lab group by all)
      select roi, label, area, round(cy, 4) as cy, round(cx, 4) as cx, ymin, xmin, ymax, xmax, round(4 * sqrt((vy + vx) / 2 + sqrt((vy - vx) * (vy - vx) / 4 + c * c)), 4) as major, round(4 * sqrt(greatest(0, (vy + vx) / 2 - sqrt((vy - vx) * (vy - vx) / 4 + c * c))), 4) as minor from p""",
    "label_overlap_pairs": f"""with {_L}, two as (select roi, y + 1 as y, x + 1 as x, label from lab), a as (select roi, label, count(*) as n from lab where label <> 0 group by all),
      n as (select roi, lab.label as label_a, two.label as label_b, count(*) as shared from lab join two using (roi, y, x) where lab.label <> 0 and two.label <> 0 group by all)
      select n.roi, label_a, label_b, shared, round(shared / a.n, 6) as share_a, round(shared / b.n, 6) as share_b, shared / a.n > 0.3 or shared / b.n > 0.3 as delete_b
      from n join a on n.roi = a.roi and label_a = a.label join a b on n.roi = b.roi and label_b = b.label""",
    "grown_labels": f"""with {_L}, s as (select roi, y + dy as y, x + dx as x, dy * dy + dx * dx as d2, label from lab, {_values(raster.disk(2.0))} where label <> 0)
      select roi, y, x, arg_min(label, d2::bigint * 1000000000 + label) as label from s group by roi, y, x""",
    "border_labels": f"""with {_L}, m as (select roi, min(y) as y0, max(y) as y1, min(x) as x0, max(x) as x1 from lab group by roi)
      select distinct roi, label from lab join m using (roi) where label <> 0 and (y < y0 + 4 or y > y1 - 4 or x < x0 + 4 or x > x1 - 4)""",
    "raster_lookup": f"with {_LOC}, {_L} select l.roi, coalesce(label, 0) as label, count(*) as n from l left join lab on l.roi = lab.roi and round_even(l.y / {LABEL_STEP}.0, 0)::int = lab.y and round_even(l.x / {LABEL_STEP}.0, 0)::int = lab.x group by all",
    "area_acronym": "select case when c_nationkey = 0 then 'outside' else r_name end as area, count(*) as n from customer left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey group by 1",
    "density_binarised": f"with {_D}, q as (select roi, quantile_cont(v, 0.9) as q from d group by roi) select roi, q, count(*) filter (where v > q) as n_above from d join q using (roi) group by roi, q",
    "density_clipped": f"with {_D}, q as (select roi, quantile_cont(v, 0.01) as lo, quantile_cont(v, 0.99) as hi from d group by roi) select roi, round(avg(case when hi <> lo then (least(greatest(v, lo), hi) - lo) / (hi - lo) end), 6) as mean_v from d join q using (roi) group by roi",
    "density_zscore": """with s as (select distinct spot_id, roi, called_at::date as day from gene_spots where spot_id is not null and roi is not null and called_at is not null), n as (select roi, day, count(*)::double as n from s group by all),
      q as (select roi, quantile_cont(n, 0.4) as q from n group by roi), f as (select roi, day, (n - q) / nullif(q, 0) as f from n join q using (roi)), m as (select roi, avg(f) as a, stddev_pop(f) as sd from f group by roi)
      select roi, day::varchar as day, round((f - a) / nullif(sd, 0), 4) as z from f join m using (roi)""",
}
