"""Projections, predicates, lookups and set operations of the tabular parts of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Circularity of a disk is 4 pi area / perimeter^2; ratios are clipped before their logarithm.
FOUR_PI, RATIO_TOP = 12.566370614359172, 100.0


def permuted(values: Column, order: list[int]) -> Column:
    """An array in the order of a permutation: channel k is where order has its k-th smallest number."""
    return F.transform(F.array(*(F.lit(order.index(v)) for v in sorted(order))), lambda i: F.get(values, i))


def flipped(pixels: DataFrame, channels: list[int], across: str, size: int) -> DataFrame:
    """Pixels with some channels mirrored along y or x in an image of `size` pixels there."""
    return pixels.withColumn(across, F.when(F.col("c").isin(channels), size - 1 - F.col(across)).otherwise(F.col(across)))


def preferred(versions: DataFrame, keys: list[str], version: str, order: list[str]) -> DataFrame:
    """For each key the row of the first version in `order` that it has; keys with none of them go."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col(version))
    rest = [c for c in versions.columns if c not in keys]
    best = versions.withColumn("_rank", rank).where("_rank > 0").groupBy(*keys).agg(F.min(F.struct("_rank", *rest)).alias("_b"))
    return best.select(*keys, *(F.col(f"_b.{c}").alias(c) for c in rest))


def bad_pixels(values: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys of pixels with a value that is null or NaN in any channel or round."""
    return values.groupBy(*keys).agg(F.bool_or(F.col(value).isNull() | F.isnan(value)).alias("_bad")).where("_bad").select(*keys)


def shape_columns(cells: DataFrame, area: str, perimeter: str, signal: str, background: str) -> DataFrame:
    """cells with circularity, intensity_ratio and clamped_ratio (log10 of the ratio clipped to 0..100; -infinity at 0)."""
    ratio = F.try_divide(F.col(signal), F.col(background))
    kept = F.least(F.greatest(ratio, F.lit(0.0)), F.lit(RATIO_TOP))
    return cells.withColumns({
        "circularity": F.try_divide(FOUR_PI * F.col(area), F.col(perimeter) * F.col(perimeter)),
        "intensity_ratio": ratio,
        "clamped_ratio": F.when(kept > 0, F.log10(kept)).when(kept == 0, F.lit(float("-inf"))),
    })


def within(df: DataFrame, limits: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Rows whose columns lie within inclusive limits; a limit of None is none. Null and NaN lie within no limit."""
    for c, (lo, hi) in limits.items():
        if lo is not None:
            df = df.where((F.col(c) >= lo) & ~F.isnan(F.col(c).cast("double")))
        if hi is not None:
            df = df.where(F.col(c) <= hi)
    return df


def every_kth(df: DataFrame, key: str, k: int) -> DataFrame:
    """A repeatable sample: rows whose hashed key falls into one of k parts. A sampling operator; a feature, not a shortcut."""
    return df.where(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint") % k == 0)


def colour_map(pixels: DataFrame, keys: list[str], value: str, channel: str, colours: list[tuple[float, float, float]], low: float, high: float) -> DataFrame:
    """keys, r, g, b (0 to 255): channels scaled between two values, cut to whole numbers, coloured and added."""
    scaled = F.least(F.greatest((F.col(value) - low) / (high - low), F.lit(0.0)), F.lit(1.0))
    table = F.array(*(F.array(*map(F.lit, map(float, c))) for c in colours))
    part = lambda i: F.sum(scaled * 255 * F.get(F.get(table, F.col(channel)), F.lit(i)))
    return pixels.groupBy(*keys).agg(*(F.least(F.floor(part(i)), F.lit(255)).cast("int").alias(n) for i, n in enumerate("rgb")))


def shifted_pairs(planes: DataFrame, keys: list[str], z: str, value: str, shift: int) -> DataFrame:
    """keys, z, value, other: the value of channel 0 beside that of channel 1 `shift` planes further."""
    a = planes.where("c = 0").select(*keys, z, F.col(value))
    b = planes.where("c = 1").select(*keys, (F.col(z) - shift).alias(z), F.col(value).alias("other"))
    return a.join(b, [*keys, z])


def scaled_lookup(spots: DataFrame, raster: DataFrame, keys: list[str], ratio: float, columns: list[str]) -> DataFrame:
    """spots with columns of a coarser raster: places are divided by ratio and rounded half to even; spots outside go."""
    s = spots.withColumns({"_y": F.rint(F.col("y") / ratio).cast("int"), "_x": F.rint(F.col("x") / ratio).cast("int")})
    return s.join(raster.select(*keys, F.col("y").alias("_y"), F.col("x").alias("_x"), *columns), [*keys, "_y", "_x"]).drop("_y", "_x")


def without(labels: DataFrame, removed: DataFrame, keys: list[str]) -> DataFrame:
    """Labels not listed as removed; a listed label that does not exist is an error."""
    lost = removed.join(labels.select(*keys).distinct(), keys, "left_anti")
    if lost.limit(1).count():
        raise ValueError(f"a label to be removed does not exist: {lost.first()}")
    return labels.join(removed.select(*keys).distinct(), keys, "left_anti")


def only_cells(labels: DataFrame, classes: DataFrame, keys: list[str], is_cell: str) -> DataFrame:
    """labels whose `label` becomes 0 where its class is no cell. Labels without a class give an error when they are read."""
    j = labels.join(classes.select(*keys, F.col(is_cell).alias("_c")), keys, "left")
    known = F.when(F.col("_c").isNull() & (F.col("label") != 0), F.raise_error(F.lit("a label has no class")).cast("int"))
    return j.withColumn("label", F.coalesce(known, F.when(F.col("_c"), F.col("label")).otherwise(0))).drop("_c")


def threshold_grid(scores: DataFrame, grid: dict[str, list[float]]) -> DataFrame:
    """One row per combination of thresholds and the number of rows of scores above all of them: each grid is crossed with the
    counts of rows per combination of passed thresholds, so the table is read once."""
    names = list(grid)
    above = lambda k, t: F.when((F.col(k) > t) & ~F.isnan(k), 1).otherwise(0)
    passed = [sum((above(k, t) for t in v), F.lit(0)).alias(f"_{k}") for k, v in grid.items()]
    counts = scores.select(*passed).groupBy(*(f"_{k}" for k in names)).agg(F.count(F.lit(1)).alias("n"))
    every = scores.sparkSession.range(1).drop("id")
    for k, v in grid.items():
        every = every.withColumn("_t", F.explode(F.array(*(F.struct(F.lit(i + 1).alias("i"), F.lit(float(t)).alias("t")) for i, t in enumerate(sorted(v)))))).withColumns({k: F.col("_t.t"), f"i_{k}": F.col("_t.i")}).drop("_t")
    on = [F.col(f"_{k}") >= F.col(f"i_{k}") for k in names]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return F.broadcast(every).join(counts, cond, "left").groupBy(*names).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def natural_key(name: Column) -> list[Column]:
    """Sort columns under which names order by their first number, then as text."""
    return [F.coalesce(F.nullif(F.regexp_extract(name, r"\d+", 0), F.lit("")).cast("bigint"), F.lit(-1)), name]


def mean_window(points: DataFrame, raster: DataFrame, keys: list[str], reach: int) -> DataFrame:
    """dy, dx, v: the mean of the raster's signs around points, pixels outside it counting 0."""
    steps = F.explode(F.sequence(F.lit(-reach), F.lit(reach)))
    w = points.withColumn("dy", steps).withColumn("dx", steps)
    w = w.select(*keys, (F.col("y") + F.col("dy")).alias("y"), (F.col("x") + F.col("dx")).alias("x"), "dy", "dx")
    return w.join(raster.select(*keys, "y", "x", "v"), [*keys, "y", "x"], "left").groupBy("dy", "dx").agg(F.avg(F.signum(F.coalesce("v", F.lit(0.0)))).alias("v"))


def consecutive_difference(df: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    """df with step, the next row's value minus this one's; null at the end of a group."""
    return df.withColumn("step", F.lead(value).over(Window.partitionBy(*group).orderBy(*order)) - F.col(value))
