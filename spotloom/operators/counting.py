"""Counts of spots per cell or tile and item, in long form; wide only at the edge."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotloom.session import Scratch


def count_spots(spots: DataFrame, mask: list[str], item: str) -> DataFrame:
    """mask, item, n: rows with a null key are dropped, mask 0 (background) is kept like any other."""
    return spots.dropna(subset=[*mask, item]).groupBy(*mask, item).agg(F.count(F.lit(1)).alias("n"))


def pivot_counts(counts: DataFrame, mask: list[str], item: str, items: list, other: str) -> DataFrame:
    """One column per named item, 0 where there is none, and one for all items that are not named. No pass looks for items."""
    aggs = [F.coalesce(F.sum(F.when(F.col(item) == i, F.col("n"))), F.lit(0)).alias(str(i)) for i in items]
    return counts.groupBy(*mask).agg(*aggs, F.coalesce(F.sum(F.when(~F.col(item).isin(items), F.col("n"))), F.lit(0)).alias(other))


def fuse_counts(first: DataFrame, second: DataFrame, mask: list[str], item: str) -> DataFrame:
    """Long counts of two assays; an item that the second has anywhere replaces the first's counts of it."""
    names = second.select(item).distinct()
    return first.join(names, item, "left_anti").select(*mask, item, "n").unionByName(second.select(*mask, item, "n"))


def multiplicity(counts: DataFrame, mask: list[str], item: str) -> DataFrame:
    """mask, total, main (item of the largest count, least on ties), n_main, share."""
    best = F.max(F.struct("n", F.lit(0).alias("z")))
    top = counts.groupBy(*mask).agg(F.sum("n").alias("total"), best.alias("best"))
    main = counts.join(top.select(*mask, F.col("best.n").alias("n")), [*mask, "n"]).groupBy(*mask).agg(F.min(item).alias("main"))
    return top.join(main, mask).select(*mask, "total", "main", F.col("best.n").alias("n_main"), (F.col("best.n") / F.col("total")).alias("share"))


def edit_profile(counts: DataFrame, main: DataFrame, mask: list[str], item: str) -> DataFrame:
    """mask, distance, n: how many spots lie at each edit distance from the main item of their mask."""
    j = counts.join(main.select(*mask, "main"), mask)
    return j.groupBy(*mask, F.levenshtein(item, "main").alias("distance")).agg(F.sum("n").alias("n"))


def log_normalised(counts: DataFrame, mask: list[str], to: float, least: int) -> DataFrame:
    """counts of masks with at least `least` spots, scaled to `to` per mask, as log(1 + x)."""
    w = Window.partitionBy(*mask)
    c = counts.withColumn("total", F.sum("n").over(w)).where(F.col("total") >= least)
    return c.withColumn("value", F.log1p(F.col("n") * to / F.col("total"))).drop("total")


def ordinal_ids(df: DataFrame, key: str, name: str = "ordinal", scratch: Scratch | None = None) -> DataFrame:
    """Distinct keys numbered from 0 in their order, without a global window: ranges are numbered locally, then shifted.

    The number of ranges is the number of shuffle partitions, so the table of offsets is small at any size. The ranges come from
    a sample, which another run of the stage might draw differently; so the numbered keys are written before they are counted.
    """
    d = df.select(key).where(F.col(key).isNotNull()).distinct().repartitionByRange(key).sortWithinPartitions(key)
    # one place per partition: the 33 low bits of the increasing id count rows, the high bits the partition
    scratch = scratch or Scratch(df.sparkSession, "ordinals")
    d = scratch.save(d.withColumn("m", F.monotonically_increasing_id())).withColumns({"p": F.shiftrightunsigned("m", 33), "i": F.col("m").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = d.groupBy("p").agg(F.count(F.lit(1)).alias("c"))
    before = sizes.withColumn("before", F.coalesce(F.sum("c").over(Window.partitionBy(F.lit(0)).orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return d.join(F.broadcast(before.select("p", "before")), "p").select(key, (F.col("before") + F.col("i")).alias(name))
