"""Rasters as rows (keys, y, x, v): neighbourhoods, histograms, projections, labels. Absent pixels are 0.

Everything that looks at a neighbourhood is one operator, `stencil`: each pixel is sent to the places that see it, and
what arrives is aggregated. It is one shuffle with partial aggregation and needs no tile in memory.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Offset = tuple[int, int, float]


def box(lo: int, hi: int, weight: float = 1.0) -> list[Offset]:
    return [(dy, dx, weight) for dy in range(lo, hi + 1) for dx in range(lo, hi + 1)]


def disk(radius: float, weight: float = 1.0) -> list[Offset]:
    r = int(radius)
    return [(dy, dx, weight) for dy in range(-r, r + 1) for dx in range(-r, r + 1) if dy * dy + dx * dx <= radius * radius]


def annulus(inner: float, outer: float) -> list[Offset]:
    ring = [(dy, dx) for dy, dx, _ in disk(outer) if dy * dy + dx * dx >= inner * inner]
    return [(dy, dx, 1.0 / len(ring)) for dy, dx in ring]


def gaussian(sigma: float, reach: int) -> list[Offset]:
    """Weights of a Gaussian cut off at `reach`, summing to 1."""
    import math

    w = {(dy, dx): math.exp(-(dy * dy + dx * dx) / (2 * sigma * sigma)) for dy, dx, _ in box(-reach, reach)}
    total = sum(w.values())
    return [(dy, dx, v / total) for (dy, dx), v in w.items()]


def stencil(raster: DataFrame, keys: list[str], offsets: Iterable[Offset], agg: Column, name: str = "s") -> DataFrame:
    """keys, y, x, name: agg over `value` (v times the offset's weight) and `v` of the pixels at (y + dy, x + dx)."""
    steps = F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"), F.lit(float(w)).alias("w")) for dy, dx, w in offsets))
    sent = raster.select(*keys, "y", "x", "v").withColumn("o", F.explode(steps))
    seen = sent.select(*keys, (F.col("y") - F.col("o.dy")).alias("y"), (F.col("x") - F.col("o.dx")).alias("x"), "v", (F.col("v") * F.col("o.w")).alias("value"))
    return seen.groupBy(*keys, "y", "x").agg(agg.alias(name))


def local_maxima(raster: DataFrame, keys: list[str], threshold: float, lo: int = -1, hi: int = 2) -> DataFrame:
    """Pixels above threshold that no pixel of their window exceeds by 1e-6; plateaus give several."""
    top = stencil(raster, keys, box(lo, hi), F.max("v"), "top")
    return raster.where(F.col("v") > threshold).join(top, [*keys, "y", "x"]).where(F.col("v") + 1e-6 > F.col("top")).drop("top")


def seen_from(points: DataFrame, raster: DataFrame, keys: list[str], offsets: Iterable[Offset], *aggs: Column) -> DataFrame:
    """keys, y, x and aggs over the pixels (v, and the offset's weight w) at (y + dy, x + dx) of the distinct points: the work follows the
    points and not the raster. Points that see no pixel give no row."""
    steps = F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"), F.lit(float(w)).alias("w")) for dy, dx, w in offsets))
    at = points.select(*keys, "y", "x").distinct().withColumn("o", F.explode(steps))
    at = at.select(*keys, F.col("y").alias("y0"), F.col("x").alias("x0"), (F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x"), F.col("o.w").alias("w"))
    met = at.join(raster.select(*keys, "y", "x", "v"), [*keys, "y", "x"])
    return met.groupBy(*keys, "y0", "x0").agg(*aggs).withColumnsRenamed({"y0": "y", "x0": "x"})


def isolated(peaks: DataFrame, raster: DataFrame, keys: list[str], inner: float, outer: float, below: float) -> DataFrame:
    """Peaks whose surrounding ring has a mean below a value."""
    around = annulus(inner, outer)
    ring = seen_from(peaks, raster, keys, around, (F.sum("v") / len(around)).alias("ring"))
    return peaks.join(ring, [*keys, "y", "x"], "left").where(F.coalesce("ring", F.lit(0.0)) < below).drop("ring")


def disk_means(spots: DataFrame, raster: DataFrame, keys: list[str], radius: float, name: str = "mean") -> DataFrame:
    """spots (keys, y, x, ...) with the mean over a disk around them."""
    around = disk(radius)
    means = seen_from(spots, raster, keys, around, (F.sum("v") / len(around)).alias(name))
    return spots.join(means, [*keys, "y", "x"], "left").fillna(0.0, [name])


def shape_score(spots: DataFrame, raster: DataFrame, keys: list[str], template: list[Offset], rho: float) -> DataFrame:
    """spots with score, pos_pixels, neg_pixels: pixels that have the sign of the template's (weights +1, -1), positive ones
    weighted by rho. A negative pixel counts where the raster is at most 0, absent pixels included."""
    n_pos, n_neg = sum(w > 0 for *_, w in template), sum(w < 0 for *_, w in template)
    signs = seen_from(spots, raster.where("v > 0"), keys, template, F.count_if(F.col("w") > 0).alias("p"), F.count_if(F.col("w") < 0).alias("q"))
    j = spots.join(signs, [*keys, "y", "x"], "left")
    pos, neg = F.coalesce("p", F.lit(0)), n_neg - F.coalesce("q", F.lit(0))
    return j.withColumns({"score": (neg + rho * pos) / (n_neg + rho * n_pos), "pos_pixels": pos / n_pos, "neg_pixels": neg / n_neg}).drop("p", "q")


def radial_mean(window: DataFrame, keys: list[str]) -> DataFrame:
    """keys, r2, v: mean of the pixels at one squared distance from the centre (dy, dx)."""
    return window.groupBy(*keys, (F.col("dy") * F.col("dy") + F.col("dx") * F.col("dx")).alias("r2")).agg(F.avg("v").alias("v"))


def block_reduce(raster: DataFrame, keys: list[str], k: int, agg: Column) -> DataFrame:
    """keys, y, x, v of blocks of k times k pixels."""
    return raster.groupBy(*keys, F.floor(F.col("y") / k).cast("int").alias("y"), F.floor(F.col("x") / k).cast("int").alias("x")).agg(agg.alias("v"))


def mosaic(pixels: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """keys, y, x, v where tiles overlap: the pixel of the last tile in `order`."""
    return pixels.groupBy(*keys, "y", "x").agg(F.max_by("v", F.struct(*order)).alias("v"))


def histogram(values: DataFrame, keys: list[str], value: str, top: int | None = None) -> DataFrame:
    """keys, v, n for every whole number from 0 to the largest value of the group (or top); values are truncated."""
    h = values.where(F.col(value).isNotNull()).groupBy(*keys, F.greatest(F.col(value), F.lit(0)).cast("int").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    last = h.groupBy(*keys).agg(F.max("v").alias("last")) if top is None else h.select(*keys).distinct().withColumn("last", F.lit(top))
    return last.withColumn("v", F.explode(F.sequence(F.lit(0), "last"))).drop("last").join(h, [*keys, "v"], "left").fillna(0, ["n"])


def cumulative(hist: DataFrame, keys: list[str]) -> DataFrame:
    """hist with cdf. Its rows are values, not pixels, so the window is small."""
    w = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hist.withColumn("cdf", F.sum("n").over(w) / F.sum("n").over(Window.partitionBy(*keys)))


def strict_quantile(hist: DataFrame, keys: list[str], q: float) -> DataFrame:
    """keys, factor: the first value whose cumulative share strictly exceeds q."""
    return cumulative(hist, keys).where(F.col("cdf") > q).groupBy(*keys).agg(F.min("v").alias("factor"))


def region_properties(labels: DataFrame, keys: list[str]) -> DataFrame:
    """keys, area, centroid, half-open box, and the axes and orientation of the ellipse with the same second moments."""
    y, x = F.col("y").cast("double"), F.col("x").cast("double")
    p = labels.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("area"), F.avg(y).alias("cy"), F.avg(x).alias("cx"), F.min("y").alias("ymin"), F.min("x").alias("xmin"),
        (F.max("y") + 1).alias("ymax"), (F.max("x") + 1).alias("xmax"), (F.var_pop(y) + 1 / 12).alias("vy"), (F.var_pop(x) + 1 / 12).alias("vx"), F.covar_pop(y, x).alias("vyx"),
    )
    half = F.sqrt((F.col("vy") - F.col("vx")) * (F.col("vy") - F.col("vx")) / 4 + F.col("vyx") * F.col("vyx"))
    mid = (F.col("vy") + F.col("vx")) / 2
    p = p.withColumns({"major": 4 * F.sqrt(mid + half), "minor": 4 * F.sqrt(F.greatest(F.lit(0.0), mid - half))})
    return p.withColumn("eccentricity", F.sqrt(F.lit(1.0) - F.pow(F.col("minor") / F.col("major"), F.lit(2.0)))).drop("vy", "vx", "vyx")


def label_overlaps(a: DataFrame, b: DataFrame, keys: list[str], most: float) -> DataFrame:
    """keys, label_a, label_b, shared, share_a, share_b, delete_b for labels of two images that share pixels: the
    second is deleted where the shared part of either exceeds `most`, else only the shared pixels go."""
    size = lambda d, n: d.where("label <> 0").groupBy(*keys, F.col("label").alias(f"label_{n}")).agg(F.count(F.lit(1)).alias(f"area_{n}"))
    pairs = a.where("label <> 0").select(*keys, "y", "x", F.col("label").alias("label_a")).join(b.where("label <> 0").select(*keys, "y", "x", F.col("label").alias("label_b")), [*keys, "y", "x"])
    n = pairs.groupBy(*keys, "label_a", "label_b").agg(F.count(F.lit(1)).alias("shared"))
    j = n.join(size(a, "a"), [*keys, "label_a"]).join(size(b, "b"), [*keys, "label_b"])
    j = j.withColumns({"share_a": F.col("shared") / F.col("area_a"), "share_b": F.col("shared") / F.col("area_b")})
    return j.withColumn("delete_b", (F.col("share_a") > most) | (F.col("share_b") > most)).select(*keys, "label_a", "label_b", "shared", "share_a", "share_b", "delete_b")


def expand_labels(labels: DataFrame, keys: list[str], radius: float) -> DataFrame:
    """Labels grown by a radius: a background pixel takes the nearest label, the smallest on ties."""
    steps = F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"), F.lit(dy * dy + dx * dx).alias("d2")) for dy, dx, _ in disk(radius)))
    sent = labels.where("label <> 0").withColumn("o", F.explode(steps))
    near = sent.groupBy(*keys, (F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x")).agg(F.min(F.struct("o.d2", "label")).alias("b"))
    return near.select(*keys, "y", "x", F.col("b.label").alias("label"))


def edge_labels(labels: DataFrame, keys: list[str], border: int) -> DataFrame:
    """keys, label of the labels that touch a border of an image (least to greatest pixel of its keys)."""
    lim = labels.groupBy(*keys).agg(F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("x").alias("x0"), F.max("x").alias("x1"))
    near = (F.col("y") < F.col("y0") + border) | (F.col("y") > F.col("y1") - border) | (F.col("x") < F.col("x0") + border) | (F.col("x") > F.col("x1") - border)
    return labels.where("label <> 0").join(lim, keys or None).where(near).select(*keys, "label").distinct()


def rasterise_boxes(boxes: DataFrame, keys: list[str], label: str, step: int) -> DataFrame:
    """keys, y, x, label: the pixels of `step` units that boxes cover; where boxes overlap the largest label wins."""
    at = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / step).cast("int"), F.floor((F.col(hi) - 1) / step).cast("int")))
    b = boxes.where("ymin < ymax and xmin < xmax").withColumn("py", at("ymin", "ymax")).withColumn("px", at("xmin", "xmax"))
    return b.groupBy(*keys, F.col("py").alias("y"), F.col("px").alias("x")).agg(F.max(label).alias("label"))


def lookup(spots: DataFrame, raster: DataFrame, keys: list[str], step: float, column: str, default) -> DataFrame:
    """spots with the raster's value at their rounded (half to even) place in units of `step`; default where there is none."""
    s = spots.withColumns({"_y": F.rint(F.col("y") / step).cast("int"), "_x": F.rint(F.col("x") / step).cast("int")})
    r = raster.select(*keys, F.col("y").alias("_y"), F.col("x").alias("_x"), column)
    return s.join(r, [*keys, "_y", "_x"], "left").withColumn(column, F.coalesce(column, F.lit(default))).drop("_y", "_x")


def flat_field(pixels: DataFrame, flat: DataFrame, black: DataFrame, on: list[str]) -> DataFrame:
    """(v - black) / flat by pixel and channel; images that are all zero stay zero."""
    j = pixels.join(flat.withColumnRenamed("v", "flat"), on, "left").join(black.withColumnRenamed("v", "black"), "c", "left")
    return j.withColumn("v", F.when(F.col("v") == 0, 0.0).otherwise(F.try_divide(F.col("v") - F.coalesce("black", F.lit(0.0)), F.coalesce("flat", F.lit(1.0))))).drop("flat", "black")


def batch_median_mean(pixels: DataFrame, keys: list[str], batch: Column, lo: float, hi: float) -> DataFrame:
    """keys, v: the median over batches of the mean clipped pixel. Batches of any size count, the last one included."""
    m = pixels.groupBy(*keys, batch.alias("batch")).agg(F.avg(F.least(F.greatest(F.col("v"), F.lit(lo)), F.lit(hi))).alias("m"))
    return m.groupBy(*keys).agg(F.median("m").alias("v"))
