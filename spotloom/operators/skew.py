"""Per-key results and joins where a few keys hold most rows.

Heavy keys are found with a bounded sketch. Rows that meet them in a broadcast join (a table of at most 2 / share
rows) take a way of their own; all other keys take the ordinary shuffle; the two are unioned. The routes
only differ in where rows are processed, so the result is whole and the same whatever the sketch finds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key is heavy from this share of the rows on. No more than 1 / SHARE keys can be.
SHARE = 0.02
#: Items a frequent-items sketch tracks.
TRACKED = 4096
#: Parts into which the rows of a heavy key are spread.
PARTS = 64


def heavy_keys_of(df: DataFrame, keys: list[str], share: float = SHARE) -> dict[str, list]:
    """For each key column the values that may hold at least `share` of the rows of df: at most 2 / share each.

    A mergeable frequent-items sketch (bounded memory, partial aggregation) runs over all rows, one pass for
    all keys. Null is not reported: a null key never joins, and in aggregates it is salted like a heavy key.
    """
    tops = [F.expr(f"approx_top_k(`{k}`, {int(2 / share)}, {TRACKED})").alias(k) for k in keys]
    (found,) = df.agg(F.count(F.lit(1)).alias("rows of all"), *tops).collect()
    least = share * found["rows of all"]
    return {k: [r["item"] for r in found[k] or [] if r["item"] is not None and r["count"] >= least] for k in keys}


def heavy_keys(df: DataFrame, key: str, share: float = SHARE) -> list:
    """heavy_keys_of for one key."""
    return heavy_keys_of(df, [key], share)[key]


def _in(key: str, keys: list) -> Column:
    return F.coalesce(F.col(key).isin(keys), F.lit(False)) if keys else F.lit(False)


def key_table(spark: SparkSession, key: str, kind: str, keys: list, **columns: Column) -> DataFrame:
    """A table of heavy keys, small enough to be broadcast: one row per key, with more columns computed from it."""
    one = spark.range(1).select(F.explode(F.array(*map(F.lit, keys)).cast(f"array<{kind}>")).alias(key))
    return one.withColumns(columns) if columns else one


def skew_join(left: DataFrame, right: DataFrame, key: str, heavy: list, how: str = "inner") -> DataFrame:
    """left join right on key, where right has at most one row per key and left may be of any skew.

    The rows of right for heavy keys are at most len(heavy), so broadcasting them is safe at any size.
    how: inner or left. Null keys of left stay for how = left and are never shuffled together. Other columns of right
    whose names left has too come out as right_<name>.
    """
    right = right.withColumnsRenamed({c: f"right_{c}" for c in right.columns if c != key and c in left.columns})
    light_left = left.where(~_in(key, heavy) & F.col(key).isNotNull())
    parts = [light_left.join(right.where(~_in(key, heavy)) if heavy else right, key, how)]
    if heavy:
        parts.append(left.where(_in(key, heavy)).join(F.broadcast(right.where(_in(key, heavy))), key, how))
    if how == "left":
        more = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name != key]
        parts.append(left.where(F.col(key).isNull()).select(key, *[c for c in left.columns if c != key], *more))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: A summary: (partial aggregate over rows, how partials merge).
Summary = tuple[Column, Callable[[Column], Column]]


def _score_summaries(value: str, k: int) -> dict[str, Summary]:
    v = F.col(value)
    return {
        "n": (F.count(F.lit(1)), F.sum),
        "n_scores": (F.count(v), F.sum),
        "sum_score": (F.sum(v), F.sum),
        "sum_squares": (F.sum(v * v), F.sum),
        "min_score": (F.min(v), F.min),
        "max_score": (F.max(v), F.max),
        "sketch": (F.kll_sketch_agg_double(v, F.lit(k)), F.kll_merge_agg_double),
    }


def per_key_summary(df: DataFrame, key: str, value: str, heavy: list | None = None, *, spread: str, k: int = 1024) -> DataFrame:
    """Per key: number of rows, of values, mean, population deviation, extremes and median (rank error below 1 %).

    A broadcast join with the table of heavy keys (at most 2 / share rows) gives their rows the number of parts over
    which a hash of `spread` puts them; they are reduced in parts, and the parts merged. Rows that find no heavy key go
    through one ordinary shuffle, and the two results are unioned. value must be null where there is no value. A null key is
    a group of its own, put into parts like a heavy one; no rows give no groups.
    Returns key, n, n_scores, sum_score, mean_score, sd_score, min_score, max_score, median_score.
    """
    heavy = heavy_keys(df, key) if heavy is None else heavy
    kind = df.schema[key].dataType.simpleString()
    name, key = key, "key of group"
    df = df.select(F.col(name).alias(key), F.col(value).cast("double").alias("value"), F.col(spread).alias("spread"))
    sums = _score_summaries("value", k)
    large = F.broadcast(key_table(df.sparkSession, key, kind, heavy, parts=F.lit(PARTS)))
    merged = {n: m(F.col(n)).alias(n) for n, (_, m) in sums.items()}
    aggs = [a.alias(n) for n, (a, _) in sums.items()]
    hot = (
        df.join(large, key)
        .unionByName(df.where(F.col(key).isNull()).withColumn("parts", F.lit(PARTS)))
        .withColumn("part", F.pmod(F.xxhash64("spread"), F.col("parts")))
        .groupBy(key, "part")
        .agg(*aggs)
        .groupBy(key)
        .agg(*merged.values())
    )
    cold = df.where(F.col(key).isNotNull()).join(large, key, "left_anti").groupBy(key).agg(*aggs)
    mean = F.try_divide("sum_score", "n_scores")
    return (
        hot.unionByName(cold)
        .withColumn("mean_score", mean)
        .withColumn("sd_score", F.sqrt(F.greatest(F.lit(0.0), F.try_divide("sum_squares", "n_scores") - mean * mean)))
        .withColumn("median_score", F.when(F.col("n_scores") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.5))))
        .select(F.col(key).alias(name), "n", "n_scores", "sum_score", "mean_score", "sd_score", "min_score", "max_score", "median_score")
    )
