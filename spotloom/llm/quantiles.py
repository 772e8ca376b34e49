"""Percentiles of very large columns by mergeable sketches (problem 1).

A sketch is a hierarchy of randomized compactors: a full level is sorted and every other value, from a random
start, moves up with doubled weight; sketches merge level by level. Spark's KLL aggregates do this in the JVM with
partial aggregation. With parameter k a percentile's rank is off by no more than rank_error(k) of the rows, with
99 % probability, and not at all while a group holds no more than k values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Compactor size of the production queries: rank error 0.13 %; a sketch takes at most about 100 kB.
K = 4096


def rank_error(k: int = K) -> float:
    """Rank error of one percentile at 99 % confidence, as published for KLL sketches: 2.296 / k^0.9021."""
    return 2.296 / k**0.9021


def sketches(df: DataFrame, keys: list[str], value: str, k: int = K) -> DataFrame:
    """keys, n, sketch: one row per group with at least one value.

    Null and NaN values are none; null keys form groups of their own; repeated and tied values count as often as
    they come. No rows give no sketches.
    """
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"))


def merge(parts: DataFrame, keys: list[str], k: int = K) -> DataFrame:
    """Sketches of partitions, days or files into sketches of the coarser keys."""
    return parts.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def percentiles(parts: DataFrame, pcts: list[int], k: int = K) -> DataFrame:
    """keys, n, pct, value, low, high: each percentile, and the values between which the true one lies with 99 %
    probability. In groups of at most k values the three only differ by the rounding of ranks."""
    e = rank_error(k)
    ranks = [min(1.0, max(0.0, r)) for p in pcts for r in (p / 100, p / 100 - e, p / 100 + e)]
    q = F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, ranks)))
    rows = F.array(*(F.struct(F.lit(p).alias("pct"), q[3 * i].alias("value"), q[3 * i + 1].alias("low"), q[3 * i + 2].alias("high")) for i, p in enumerate(pcts)))
    return parts.withColumn("q", F.explode(rows)).select(*[c for c in parts.columns if c != "sketch"], "q.*")
