"""Base calling, codebook matching and trace scores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotloom.functions.arrays import LETTERS, hamming, has_nan

#: Rows up to which a codebook is broadcast; the number of codewords is checked before.
BROADCAST_CODES = 100_000


def usable_round(r: Column) -> Column:
    """A round that can be called: without null or NaN, not all zero."""
    return ~has_nan(r) & F.exists(r, lambda v: v != 0)


def base_centroids(spots: DataFrame, trace: str = "trace", base: str = "sequence") -> DataFrame:
    """round, base, c0..c3: mean trace of each base (0 to 3) in each round, over the rounds that can be called."""
    t = spots.select(F.posexplode(F.arrays_zip(F.col(trace).alias("t"), F.col(base).alias("b"))).alias("round", "z"))
    t = t.select("round", F.col("z.b").alias("base"), F.col("z.t").alias("t")).where(F.col("base").between(0, 3) & usable_round(F.col("t")))
    return t.groupBy("round", "base").agg(*(F.avg(F.col("t")[c]).alias(f"c{c}") for c in range(4)))


def centroid_cube(centroids: DataFrame, rounds: int) -> np.ndarray:
    """cube[round, base, channel] of `rounds` rounds; NaN where no base was called. Rounds x 16 values reach the driver."""
    cube = np.full((rounds, 4, 4), np.nan)
    for r in centroids.where(F.col("round") < rounds).collect():
        cube[r["round"], r["base"]] = [r[f"c{k}"] for k in range(4)]
    return cube


def _matrices(column: pa.ListArray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that hold a trace of rounds x 4 values, and these traces; nulls inside are NaN."""
    n = np.asarray(pc.fill_null(pc.list_value_length(column), -1))
    at = np.flatnonzero(n == rounds)
    inner = column.take(pa.array(at)).flatten()
    width = np.asarray(pc.fill_null(pc.list_value_length(inner), -1)).reshape(len(at), rounds)
    whole = (width == 4).all(1)
    flat = inner.filter(pa.array(np.repeat(whole, rounds))).flatten()
    values = np.asarray(flat.cast(pa.float64()).to_numpy(zero_copy_only=False), float).reshape(-1, rounds, 4)
    return at[whole], values


def _mapped(spots: DataFrame, keep: list[str], columns: list[str], run, added: str) -> DataFrame:
    head = ", ".join(f"`{c}` {spots.schema[c].dataType.simpleString()}" for c in keep)
    return spots.select(*keep, *columns).mapInArrow(run, f"{head}, {added}")


def call_bases(spots: DataFrame, cube: np.ndarray, keep: list[str], trace: str = "trace") -> DataFrame:
    """keep, called array<int>, called_scores array<double>, called_bases, called_mean_score.

    Each round gets the base whose centroid has the largest cosine with it, the first on ties; a round that is null, NaN or
    zero gets 4 (N) and score 0. Traces that are null or of another shape give nulls. Traces travel in Arrow batches.
    """
    unit = cube / np.sqrt((cube * cube).sum(2, keepdims=True))
    rounds, names = len(cube), np.array(list(LETTERS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, t = _matrices(b.column(len(keep)), rounds)
            ok = np.isfinite(t).all(2) & (t != 0).any(2)
            cos = np.einsum("nrc,rbc->nrb", np.where(ok[..., None], t, 0), np.nan_to_num(unit, nan=-1e9))
            cos /= np.where(ok, np.sqrt((t * t).sum(2)), 1)[..., None]
            base, score = np.where(ok, cos.argmax(2), 4), np.where(ok, cos.max(2), 0.0)
            place = np.full(b.num_rows, -1)
            place[at] = np.arange(len(at))
            index = pa.array(place, mask=place < 0)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), rounds).cast(pa.list_(k)) for v, k in ((base.astype(np.int32), pa.int32()), (score, pa.float64()))]
            text = pa.array(["".join(r) for r in names[base]], pa.string())
            found = [*lists, text, pa.array(score.mean(1) if rounds else score[:, 0])]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), *(f.take(index) for f in found)], names=[*keep, "called", "called_scores", "called_bases", "called_mean_score"])

    return _mapped(spots, keep, [trace], run, "called array<int>, called_scores array<double>, called_bases string, called_mean_score double")


def dot_product_scores(spots: DataFrame, cube: np.ndarray, keep: list[str], trace: str = "trace", sequence: str = "sequence", shift: float = 0.0) -> DataFrame:
    """keep, score: how well a trace fits its sequence, as the dot product of the observed and the expected trace over the called rounds.

    The observed trace loses each channel's mean over those rounds (its projection on the channel background), then both
    are scaled by their norm (the observed one plus `shift`). Null if a round of the trace is null or NaN, none is called, the
    shapes differ, or nothing is left of the trace.
    """
    rounds = len(cube)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = len(keep)
            at, t = _matrices(b.column(n), rounds)
            seq = b.column(n + 1)
            same = np.asarray(pc.fill_null(pc.list_value_length(seq), -1))[at] == rounds
            at, t = at[same], t[same]
            base = np.asarray(pc.fill_null(seq.take(pa.array(at)).flatten(), 4)).reshape(-1, rounds)
            called = (base >= 0) & (base < 4)
            k = called.sum(1)
            with np.errstate(all="ignore"):
                mean = np.where(called[..., None], t, 0).sum(1) / k[:, None]
                seen = np.where(called[..., None], t - mean[:, None], 0)
                expected = np.where(called[..., None], cube[np.arange(rounds), np.where(called, base, 0)], 0)
                size = np.sqrt((seen * seen).sum((1, 2))) + shift
                score = (seen * expected).sum((1, 2)) / (size * np.sqrt((expected * expected).sum((1, 2))))
            good = np.isfinite(t).all((1, 2)) & (k > 0) & np.isfinite(score)
            out = np.full(b.num_rows, np.nan)
            out[at[good]] = score[good]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(n)), pa.array(out, mask=np.isnan(out))], names=[*keep, "score"])

    return _mapped(spots, keep, [trace, sequence], run, "score double")


def packed(seq: Column) -> Column:
    """Up to 15 letters of G, T, A, C, N as nibbles of a long, so that distances are bit counts; null for other strings."""
    return F.when(seq.rlike("^[GTACN]{1,15}$"), F.conv(F.translate(seq, "GTACN", "12345"), 16, 10).cast("bigint"))


def packed_distance(a: Column, b: Column) -> Column:
    """Differing letters of two packed sequences of one length."""
    x = a.bitwiseXOR(b)
    x = x.bitwiseOR(F.shiftright(x, 1))
    x = x.bitwiseOR(F.shiftright(x, 2))
    return F.bit_count(x.bitwiseAND(F.lit(0x111111111111111)))


def nearest_codeword(seqs: DataFrame, codebook: DataFrame, seq: str = "seq") -> DataFrame:
    """seq, gene, code, distance for each distinct sequence: the codeword of least Hamming distance, the first in `ord` on ties.

    Exact matches take an equi-join; only distinct sequences without one meet all codewords of their length. The codewords are
    broadcast, above BROADCAST_CODES of them in parts of about that many, one after another. Nulls and lengths without a codeword
    give no row.
    """
    d = seqs.select(F.col(seq).alias("s")).where("s is not null").distinct()
    book = codebook.where("seq is not null").groupBy("seq").agg(F.min_by("gene", "ord").alias("gene"), F.min("ord").alias("ord"))
    n_book = book.count()
    small = n_book <= BROADCAST_CODES
    side = F.broadcast(book) if small else book
    exact = d.join(side, d.s == side.seq).select("s", "gene", F.col("seq").alias("code"), F.lit(0).alias("distance"))
    coded = book.withColumns({"n": F.length("seq"), "p2": packed(F.col("seq"))})
    # each row costs a pass over the codebook: spread the few bytes of sequences over all cores
    cores = seqs.sparkSession.sparkContext.defaultParallelism
    rest = d.join(side, d.s == side.seq, "left_anti").repartition(2 * cores, "s").withColumn("p1", packed(F.col("s")))
    n_parts = -(-n_book // BROADCAST_CODES)
    parts = [F.broadcast(coded if n_parts == 1 else coded.where(F.pmod(F.xxhash64("seq"), F.lit(n_parts)) == k)) for k in range(max(1, n_parts))]
    same = F.length("s") == F.col("n")

    def keyed(pairs: DataFrame, distance: Column) -> DataFrame:
        """Distance and order in one long, so that the minimum is a hash aggregate."""
        return pairs.select("s", (F.shiftleft(distance.cast("bigint"), 32) + F.col("ord")).alias("key"))

    # pairs of packed sequences stay in generated code; the few with other letters or more of them are compared letter by letter
    near = None
    for part in parts:
        bits = keyed(rest.where("p1 is not null").join(part.where("p2 is not null"), same), packed_distance(F.col("p1"), F.col("p2")))
        other = rest.join(part, same & (F.col("p1").isNull() | F.col("p2").isNull()))
        met = bits.unionByName(keyed(other, hamming(F.col("s"), F.col("seq"))))
        near = met if near is None else near.unionByName(met)
    near = near.groupBy("s").agg(F.min("key").alias("best"))
    near = near.select("s", F.shiftright("best", 32).cast("int").alias("distance"), F.col("best").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("o"))
    best = near.join(F.broadcast(book) if small else book, F.col("o") == F.col("ord")).select("s", F.struct("distance", "gene", "seq").alias("b"))
    return exact.unionByName(best.select("s", "b.gene", F.col("b.seq").alias("code"), F.col("b.distance").alias("distance"))).withColumnRenamed("s", seq)


def normalised_traces(spots: DataFrame, id: str, trace: str = "trace") -> DataFrame:
    """id, trace divided by each round's and channel's mean over all spots; null for spots with a round that is all zero."""
    t = spots.select(id, F.col(trace).alias("t")).where(F.col("t").isNotNull() & ~F.exists("t", has_nan))
    long = t.select(F.posexplode("t").alias("round", "v"))
    means = long.groupBy("round").agg(*(F.avg(F.col("v")[c]).alias(f"c{c}") for c in range(4)))
    cube = means.agg(F.array_sort(F.collect_list(F.struct("round", F.array("c0", "c1", "c2", "c3").alias("m")))).alias("r")).select(F.transform("r", lambda r: r["m"]).alias("means"))
    n = t.withColumn("means", cube.scalar())
    dark = F.exists("t", lambda r: ~F.exists(r, lambda v: v != 0))
    return n.select(id, F.when(~dark, F.zip_with("t", "means", lambda r, m: F.zip_with(r, m, lambda v, x: F.try_divide(v, x)))).alias("trace"))
