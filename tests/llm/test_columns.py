"""Sketches, bitmaps, components and packing."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spotloom.llm import components, heavy, packing, postings, quantiles
from spotloom.session import Scratch

# Percentiles


def test_percentiles_keep_their_bound_and_merge(spark):
    k = 256
    df = spark.range(60_000).select((F.col("id") % 2).alias("g"), (F.col("id") % 5).alias("day"), F.rand(3).alias("v"))
    by_day = quantiles.sketches(df, ["g", "day"], "v", k)
    rows = quantiles.percentiles(quantiles.merge(by_day, ["g"], k), [1, 50, 90, 99], k).collect()
    values = {g: np.sort([r["v"] for r in df.where(f"g = {g}").collect()]) for g in (0, 1)}
    assert len(rows) == 8
    for r in rows:
        v = values[r["g"]]
        assert r["n"] == len(v)
        rank = np.searchsorted(v, r["value"], "right") / len(v)
        assert abs(rank - r["pct"] / 100) <= quantiles.rank_error(k)
        true = v[min(len(v) - 1, int(np.ceil(len(v) * r["pct"] / 100)) - 1)]
        assert r["low"] <= true <= r["high"]


def test_percentiles_of_small_groups_are_exact(spark):
    rows = [("a", 3.0), ("a", 1.0), ("a", 2.0), ("a", 2.0), ("b", None), ("b", float("nan")), (None, 7.0), ("c", 5.0), ("c", 5.0)]
    df = spark.createDataFrame(rows, "g string, v double").withColumn("n", F.lit("clash")).withColumn("sketch", F.lit(1))
    got = {(r["g"], r["pct"]): (r["n"], r["value"]) for r in quantiles.percentiles(quantiles.sketches(df, ["g"], "v"), [50, 100]).collect()}
    assert got == {("a", 50): (4, 2.0), ("a", 100): (4, 3.0), (None, 50): (1, 7.0), (None, 100): (1, 7.0), ("c", 50): (2, 5.0), ("c", 100): (2, 5.0)}
    assert quantiles.percentiles(quantiles.sketches(df.limit(0), ["g"], "v"), [50]).count() == 0


# Frequent values


def _zipf(n, seed):
    r = random.Random(seed)
    return [None if r.random() < 0.02 else f"v{int(r.paretovariate(0.7))}" for _ in range(n)]


@pytest.mark.parametrize("width", [16, 8192])
def test_frequent_values_are_complete_and_bounded(spark, width):
    values = _zipf(20_000, 1)
    df = spark.createDataFrame([(v, 1) for v in values], "v string, n int").repartition(7)
    sk = Scratch(spark, "t").save(heavy.sketch(df, "v", 3, width))
    true = Counter(v for v in values if v is not None)
    total = sum(true.values())
    assert sk.count() <= 3 * width and sk.where("row = 0").agg(F.sum("total")).collect()[0][0] == total
    for r in heavy.bounds(sk, 3, width).collect():
        assert r["lower"] <= true[r["candidate"]] <= r["upper"]
    got = {r["v"]: r["n"] for r in heavy.frequent(df, "v", 0.01, sk, 3, width).collect()}
    assert got == {v: c for v, c in true.items() if c >= 0.01 * total}


def test_frequent_values_with_ties_long_texts_and_nothing(spark):
    df = spark.createDataFrame([("x" * 100_000,), ("",), ("",), ("x" * 100_000,), (None,)], "cell string")
    sk = heavy.sketch(df, "cell")
    assert {(len(r["cell"]), r["n"]) for r in heavy.frequent(df, "cell", 0.5, sk).collect()} == {(100_000, 2), (0, 2)}
    none = df.limit(0)
    assert heavy.frequent(none, "cell", 0.5, heavy.sketch(none, "cell")).count() == 0


def test_sketches_of_parts_merge_like_one(spark):
    a, b = (spark.createDataFrame([(v,) for v in _zipf(3000, s)], "v string") for s in (5, 6))
    parts = heavy.merge(heavy.sketch(a, "v", 2, 64).unionByName(heavy.sketch(b, "v", 2, 64)))
    true = Counter(r["v"] for r in a.unionByName(b).collect() if r["v"] is not None)
    for r in heavy.bounds(parts, 2, 64).collect():
        assert r["lower"] <= true[r["candidate"]] <= r["upper"]


# Bitmaps


@given(st.sets(st.integers(0, postings.BUCKET - 1), max_size=40))
@settings(max_examples=40, deadline=None)
def test_container_round_trip(s):
    p = np.array(sorted(s), np.int64)
    assert postings.positions_of(postings._container(p)).tolist() == p.tolist()


def test_dense_container_is_a_bitmap():
    p = np.arange(0, postings.BUCKET, 3)
    c = postings._container(p)
    assert len(c) == postings.BUCKET // 8 and postings.positions_of(c).tolist() == p.tolist()


def test_frequencies_equal_counting(spark):
    r = random.Random(2)
    rows = [(r.choice(["a", "b", None, "c" * 5000, ""]), r.choice([1, 2, None]), r.randrange(-3, 300), r.randrange(0, 3)) for _ in range(6000)]
    rows += [("a", 1, x, y) for x in range(100) for y in range(60)]
    df = spark.createDataFrame(rows, "item string, roi int, tx int, ty int").withColumn("n", F.lit(9))
    half = df.select("item", F.lit("extra").alias("positions"), *postings.tile_bucket()).withColumn("late", F.rand(1) < 0.5)
    whole = postings.layout(half, ["item"])
    merged = postings.merge(postings.layout(half.where("late"), ["item"]), postings.layout(half.where("not late"), ["item"]), ["item"])
    want = {}
    for item, *tile in rows:
        if item is not None:
            n, tiles = want.setdefault(item, [0, set()])
            want[item][0] += 1
            if None not in tile:
                tiles.add(tuple(tile))
    for lay in (whole, merged):
        got = {x["item"]: (x["n_occurrences"], x["n_records"]) for x in postings.frequencies(lay, ["item"]).collect()}
        assert got == {k: (n, len(t)) for k, (n, t) in want.items()}
        for x in lay.collect():
            assert len(postings.positions_of(x["container"])) == x["cardinality"]
    assert postings.frequencies(postings.layout(half.limit(0), ["item"]), ["item"]).count() == 0


# Groups


def _groups_of(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            parent[find(a)] = find(b)
    out = {}
    for x in list(parent):
        out.setdefault(find(x), []).append(x)
    return {m: (min(g), len(g)) for g in out.values() for m in g}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "dirty"])
def test_groups_equal_union_find(spark, shape):
    r = random.Random(4)
    links = {
        "chain": [(f"c{i:04}", f"c{i + 1:04}") for i in range(700)],
        "star": [("hub", f"l{i}") for i in range(3000)] + [("x", "y")],
        "random": [(f"n{r.randrange(900)}", f"n{r.randrange(900)}") for _ in range(700)],
        "dirty": [("a", "a"), ("a", None), (None, None), ("b", "c"), ("b", "c"), ("c", "b"), ("", "z" * 50_000)],
    }[shape]
    df = spark.createDataFrame(links, "u string, first string").withColumn("root", F.lit(1))
    got = {x["member"]: (x["first"], x["size"]) for x in components.groups(df, "u", "first", Scratch(spark, "t")).collect()}
    assert got == _groups_of(links)


def test_no_links_give_no_groups(spark):
    assert components.groups(spark.createDataFrame([], "a string, b string"), "a", "b", Scratch(spark, "t")).count() == 0


# Packing


def test_bins_are_best_fit_and_bounded():
    b = packing.Bins(10, 2, 0)
    assert [b.add(6), b.add(5), b.add(4), b.add(5)] == [0, 1, 0, 1]  # the tightest that fits
    b = packing.Bins(10, 2, 0)
    assert [b.add(7), b.add(6), b.add(8), b.add(4), b.add(3)] == [0, 1, 2, 1, 3]  # bin 0, the fullest, was closed


@given(st.lists(st.integers(1, 50), max_size=300), st.integers(1, 12))
@settings(max_examples=60, deadline=None)
def test_bins_never_overflow(sizes, most_open):
    bins, fill = packing.Bins(50, most_open, 7), Counter()
    for s in sizes:
        fill[bins.add(s)] += s
        assert bins.n_open <= most_open
    assert all(f <= 50 for f in fill.values()) and sum(fill.values()) == sum(sizes)


def test_packing_is_whole_and_tight(spark):
    r = random.Random(9)
    rows = [(i, r.choice([0, None, r.randrange(1, 60), r.randrange(1, 400), 100, 950])) for i in range(3000)] + [(5, 40), (None, 30)]
    df = spark.createDataFrame(rows, "piece bigint, container_id bigint")
    out = packing.pack(df, "piece", "container_id", Scratch(spark, "t"), capacity=100, most_open=32, per_task=500).collect()
    fill = Counter()
    for x in out:
        if x["container_id"] is not None:
            fill[x["container_id"]] += x["n_units"]
    assert max(fill.values()) <= 100 and sum(fill.values()) == sum(n or 0 for _, n in rows)
    assert sum(fill.values()) / (100 * len(fill)) > 0.95
    by_item = {}
    for x in out:
        by_item.setdefault(x["id"], []).append((x["piece"], x["first_unit"], x["n_units"]))
    for i, n in rows:
        if i not in (5, None):
            pieces = sorted(by_item[i])
            assert sum(p[2] for p in pieces) == (n or 0) and len(pieces) == max(1, -(-(n or 0) // 100))
            assert [p[1] for p in pieces] == [100 * k for k in range(len(pieces))]
    assert packing.pack(df.limit(0), "piece", "container_id", Scratch(spark, "t")).count() == 0


def test_token_counts_are_those_of_the_tokenizer(spark):
    from tokenizers import Tokenizer

    texts = [None, "", "  ", "A spot, 3.14 µm", "Größe\n\n<|endoftext|>", "word " * 50_000, "a" * 30_000]
    df = spark.createDataFrame(list(enumerate(texts)), "n_id bigint, text string")
    got = {r["n_id"]: r["n_tokens"] for r in packing.token_counts(df, "text").collect()}
    t = Tokenizer.from_file(f"{packing.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    assert got == {i: len(t.encode(x or "", add_special_tokens=False).ids) for i, x in enumerate(texts)}


def test_days_unite_in_any_number(spark):
    r = random.Random(4)
    rows = [(f"i{r.randrange(6)}", r.randrange(5), r.randrange(3000), r.randrange(40)) for _ in range(20_000)] + [("i0", 9, None, 1), ("far", None, 5, 5)]
    df = spark.createDataFrame(rows, "item string, day int, tx int, ty int").withColumn("roi", F.lit(1))
    days = postings.layout(df.select("item", "day", *postings.tile_bucket()), ["day", "item"])
    assert days.groupBy("day").count().count() == 7
    whole = {x["item"]: (x["n_occurrences"], x["n_records"]) for x in postings.frequencies(postings.union(days, ["item"]), ["item"]).collect()}
    want = {}
    for item, _, tx, ty in rows:
        n, tiles = want.setdefault(item, [0, set()])
        want[item][0] += 1
        if tx is not None:
            tiles.add((tx, ty))
    assert whole == {k: (n, len(t)) for k, (n, t) in want.items()} and max(len(t) for _, t in want.values()) > postings.DENSE


def test_a_full_item_closes_no_container():
    b = packing.Bins(10, 2, 0)
    assert [b.add(6), b.add(5), b.add(10), b.add(4), b.add(5)] == [0, 1, 2, 0, 1]
