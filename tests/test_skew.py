import random
import statistics

from pyspark.sql import functions as F

from spotloom.operators.skew import heavy_keys, heavy_keys_of, per_key_summary, skew_join


def _rows(n=3000):
    r = random.Random(1)
    return [(i, "hot" if r.random() < 0.4 else None if r.random() < 0.1 else f"k{r.randrange(300)}", None if r.random() < 0.1 else round(r.random(), 3)) for i in range(n)]


def test_heavy_keys_are_found_and_bounded(spark):
    df = spark.createDataFrame(_rows(), "id bigint, key string, v double")
    assert heavy_keys(df, "key", 0.1) == ["hot"]
    assert len(heavy_keys(df, "key", 0.002)) <= 1000
    assert heavy_keys_of(df.limit(0), ["key"]) == {"key": []}


def test_summary_equals_plain_grouping(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "id bigint, key string, v double")
    got = {r["key"]: r for r in per_key_summary(df, "key", "v", spread="id").collect()}
    groups = {}
    for _, k, v in rows:
        groups.setdefault(k, []).append(v)
    assert set(got) == set(groups)
    for k, vs in groups.items():
        some = [v for v in vs if v is not None]
        r = got[k]
        assert (r["n"], r["n_scores"]) == (len(vs), len(some))
        if some:
            assert abs(r["mean_score"] - statistics.fmean(some)) < 1e-9 and (r["min_score"], r["max_score"]) == (min(some), max(some))
            assert abs(r["sd_score"] - statistics.pstdev(some)) < 1e-6
            rank = sum(v <= r["median_score"] for v in some) / len(some)
            assert 0.45 < rank <= 0.5 + 0.5 / len(some) + 0.05 or len(set(some)) < 20
        else:
            assert r["mean_score"] is None and r["median_score"] is None


def test_summary_with_clashing_names_ties_and_nothing(spark):
    df = spark.createDataFrame([(1, "a", 0.5, "x"), (1, "a", 0.5, "x")], "part int, n string, sketch double, value string")
    (r,) = per_key_summary(df, "n", "sketch", spread="part").collect()
    assert (r[0], r[1], r["median_score"]) == ("a", 2, 0.5)
    assert per_key_summary(df.limit(0), "n", "sketch", spread="part").count() == 0


def test_skew_join_equals_plain_join(spark):
    left = spark.createDataFrame(_rows(), "id bigint, key string, v double")
    right = spark.createDataFrame([(f"k{i}", i, 0.0) for i in range(0, 300, 2)] + [("hot", -1, 1.0)], "key string, w int, v double")
    plain = right.withColumnRenamed("v", "right_v")
    for how in ("inner", "left"):
        a = skew_join(left, right, "key", ["hot"], how).select("id", "key", "v", "w", "right_v")
        b = left.join(plain, "key", how).select("id", "key", "v", "w", "right_v")
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert skew_join(left, right, "key", []).count() == left.join(plain, "key").count()
    assert left.where(F.col("key").isNull()).count() > 0
