"""Clusters of records with the same pattern of bright entries, whatever their brightness (problem 5).

A record is a matrix of cycles by channels. Its set has one element per cycle: the cycle and which channels reach
half of the cycle's brightest. Records of one set are one class; all pairwise work is between classes, so copies
cost nothing. MinHash bands propose pairs of classes, their exact Jaccard similarity decides, connected components
of the links form groups, and groups that are not tight around their mean are split around medoids: classes of greater degree
(records that differ from them in one cycle at most) than any linked class. Each record's cosine with its group's mean is
checked; records that are trimmed by that are grouped anew, until no group of them is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotloom.llm.components import HUBS, components
from spotloom.operators.skew import skew_join
from spotloom.session import Scratch

#: Jaccard similarity of linked classes, and bands x rows: a pair at 0.8 is missed with probability 6e-5, one at 11/13
#: (one cycle called differently) with 4e-7.
SIMILAR, BANDS, ROWS = 0.8, 32, 6
#: Patterns that share a band from which on they are compared through the most frequent one.
CROWD = 64
#: Share of a cycle's brightest channel from which a channel counts as bright.
BRIGHT = 0.5

def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def vectors(df: DataFrame, id: str, trace: str, cycles: int, channels: int) -> DataFrame:
    """id, unit array<double>, pattern string: one row per id with a trace that is not all zero, NaN, infinite or null.

    The pattern has one letter per cycle: "a" plus the bits of its bright channels, "a" where the cycle is dark.
    Traces of another shape have no place here and are left out. Of rows that repeat an id the least trace counts.
    """
    t = df.where(F.col(id).isNotNull() & F.col(trace).isNotNull()).select(F.col(id).alias("id"), F.flatten(trace).alias("flat"))
    t = t.where(F.size("flat") == cycles * channels).groupBy("id").agg(F.min("flat").alias("flat"))
    return t.mapInArrow(_read(cycles, channels), f"id {t.schema['id'].dataType.simpleString()}, unit array<double>, pattern string")


def _read(cycles: int, channels: int):
    dims, bits = cycles * channels, 1 << np.arange(channels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            flat = np.nan_to_num(flat.astype(float), posinf=0.0, neginf=0.0)
            norm = np.sqrt((flat * flat).sum(1))
            some = np.flatnonzero(norm)
            unit = flat[some] / norm[some, None]
            shaped = unit.reshape(-1, cycles, channels)
            top = shaped.max(2, keepdims=True)
            codes = (((shaped >= top * BRIGHT) & (top > 0)) * bits).sum(2) + 97
            text = codes.astype(np.uint32).view(f"<U{cycles}").ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * dims), pa.array(unit.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(some)), lists, pa.array(text, pa.string())], names=["id", "unit", "pattern"])

    return run


def _bands(cycles: int, letters: int, bands: int, rows: int):
    """MinHash over the small universe of (cycle, letter): true random permutations, looked up."""
    rng = np.random.default_rng(5)
    ranks = np.argsort(rng.random((bands * rows, cycles * letters)), axis=1).astype(np.uint16).T.copy()
    mix = rng.integers(1, 2**62, (bands, rows), dtype=np.int64) * 2 + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.column(0).to_pylist()
            if not names:
                continue
            m = np.frombuffer("".join(names).encode(), np.uint8).reshape(len(names), cycles) - 97
            low = np.full((len(names), bands * rows), 65535, np.uint16)
            for c in range(cycles):
                r = ranks[c * letters + m[:, c]]
                r[m[:, c] == 0] = 65535
                np.minimum(low, r, out=low)
            with np.errstate(over="ignore"):
                keys = (low.reshape(len(names), bands, rows).astype(np.int64) * mix).sum(2) * 31 + np.arange(bands)
                keys ^= keys >> 29
            at = pa.array(np.repeat(np.arange(len(names)), bands))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), b.column(0).take(at), b.column(1).take(at)], names=["key", "pattern", "g"])

    return run


def _similarity(a: str, b: str, cycles: int) -> Column:
    """Exact Jaccard similarity of two patterns."""
    same, both = "+".join(f"if(substr({a},{i},1)=substr({b},{i},1) and substr({a},{i},1)<>'a',1,0)" for i in range(1, cycles + 1)), f"length(replace({a},'a',''))+length(replace({b},'a',''))"
    return F.expr(f"({same})/(({both})-({same}))")


def _ranked(classes: DataFrame) -> DataFrame:
    """pattern, n (records, 1 if not given), g (group within which patterns are compared, 0 if not given), and w if it is there."""
    n = F.col("n").cast("bigint") if "n" in classes.columns else F.lit(1).cast("bigint")
    g = F.col("g") if "g" in classes.columns else F.lit(0).cast("bigint")
    return classes.select("pattern", n.alias("n"), g.alias("g"), *(["w"] if "w" in classes.columns else []))


def degrees(classes: DataFrame, cycles: int) -> DataFrame:
    """pattern, w: the records of all patterns that differ from it in one cycle at most, its own included. Counted by patterns with one cycle
    masked, so no pair is made; all masked alike are at most as many as a cycle has letters."""
    masks = F.array(*(F.struct(F.lit(i).alias("i"), F.expr(f"overlay(pattern placing '_' from {i + 1})").alias("m")) for i in range(cycles)))
    k = classes.select("pattern", "n", F.explode(masks).alias("k")).select("pattern", "n", "k.i", "k.m")
    alike = k.groupBy("i", "m").agg(F.sum("n").alias("s"))
    return k.join(alike, ["i", "m"]).groupBy("pattern", "n").agg(F.sum(F.col("s") - F.col("n")).alias("others")).select("pattern", (F.col("others") + F.col("n")).alias("w"))


def _parts(df: DataFrame, pattern: str, cycles: int, similar: float) -> DataFrame:
    """df once for each of d + 1 parts of its pattern: patterns of at least that similarity differ in d cycles at most and so share a part."""
    parts = int(cycles * (1 - similar) + 1e-9) + 1
    edges = [round(i * cycles / parts) for i in range(parts + 1)]
    return df.withColumn("part", F.explode(F.array(*(F.concat(F.lit(f"{i}:"), F.substring(pattern, a + 1, z - a)) for i, (a, z) in enumerate(zip(edges, edges[1:], strict=False))))))


def links(classes: DataFrame, cycles: int, channels: int, similar: float = SIMILAR, bands: int = BANDS, rows: int = ROWS, crowd: int = CROWD, scratch: Scratch | None = None) -> DataFrame:
    """(a, b, a < b): pairs of different patterns with a Jaccard similarity of at least `similar`.

    Where more than `crowd` patterns share a band, they are first compared with the one of greatest degree. Those like it are
    linked through it, and only those unlike it meet the others, where they share a part of the pattern: pairs of two that are both like
    the centre are not listed. Nothing that follows depends on these: groups stay connected through the centre, and as it ranks before
    both, neither is a medoid, and no class is cut off from the medoid it belongs to.
    classes: pattern and, if they are there, n (records of the pattern), g (only patterns of one g are compared) and w (degree).
    """
    scratch = scratch or Scratch(classes.sparkSession, "links")
    classes = _ranked(classes)
    keyed = classes.select("pattern", "g").mapInArrow(_bands(cycles, 1 << channels, bands, rows), "key bigint, pattern string, g bigint")
    keyed = scratch.save(keyed.select(F.when(F.col("g") == 0, F.col("key")).otherwise(F.xxhash64("key", "g")).alias("key"), "pattern"))
    crowded = scratch.save(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > crowd).select("key"))
    any_crowd = crowded.limit(1).count() > 0
    few = (keyed.join(crowded, "key", "left_anti") if any_crowd else keyed).select("key", "pattern")
    pairs = few.withColumnRenamed("pattern", "a").join(few.withColumnRenamed("pattern", "b"), "key").where("a < b")
    found = pairs.where(_similarity("a", "b", cycles) >= similar).select("a", "b")
    if not any_crowd:
        return found.distinct()
    many = scratch.save(keyed.join(crowded, "key"))
    ranks = classes.select("pattern", "w") if "w" in classes.columns else degrees(classes.groupBy("pattern").agg(F.sum("n").alias("n")), cycles)
    centres = many.join(ranks, "pattern").groupBy("key").agg(F.max(F.struct("w", "pattern")).alias("c")).select("key", F.col("c.pattern").alias("b"))
    near = many.select("key", F.col("pattern").alias("a")).join(centres, "key").where("a <> b").withColumn("s", _similarity("a", "b", cycles))
    star = near.where(F.col("s") >= similar).select("a", "b")
    apart = _parts(near.where(F.col("s") < similar).select("key", "a"), "a", cycles, similar)
    apart = apart.join(_parts(many.select("key", F.col("pattern").alias("b")), "b", cycles, similar), ["key", "part"]).where("a <> b")
    both = star.unionByName(apart.where(_similarity("a", "b", cycles) >= similar).select("a", "b"))
    return found.unionByName(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()


def _means(rows: DataFrame, dims: int) -> DataFrame:
    """root, mean, n: the mean of the unit vectors of a group, scaled to length 1."""
    avg = rows.groupBy("root").agg(F.count(F.lit(1)).alias("n"), *(F.avg(F.col("unit")[i]).alias(f"m{i}") for i in range(dims)))
    mean = F.array(*(F.col(f"m{i}") for i in range(dims)))
    return avg.select("root", "n", mean.alias("raw")).select("root", "n", F.transform("raw", lambda v: v / F.sqrt(_dot(F.col("raw"), F.col("raw")))).alias("mean"))


def _with_cosine(rows: DataFrame, dims: int, least: int, scratch: Scratch) -> DataFrame:
    """rows of groups of at least `least`, with n and the cosine with the group's mean."""
    means = scratch.save(_means(rows, dims).where(F.col("n") >= least))
    total = means.agg(F.sum("n").alias("n")).collect()[0]["n"] or 0
    large = [r["root"] for r in means.where(F.col("n") > max(1000, total // HUBS)).select("root").collect()]
    return scratch.save(skew_join(rows, means, "root", large).withColumn("cosine", _dot(F.col("unit"), F.col("mean"))).drop("mean"))


def _split(classes: DataFrame, linked: DataFrame) -> DataFrame:
    """(u, root) for classes (u, w, pattern) of loose groups: each goes to the medoid it is linked to, if there is one.

    A medoid ranks before every linked class, by its degree w and then its pattern. Classes without an adjacent medoid get no row.
    """
    rank = classes.select("u", F.struct("w", "pattern").alias("r"))
    both = linked.select("u", "v").unionByName(linked.select(F.col("v").alias("u"), F.col("u").alias("v")))
    best = both.join(rank.select(F.col("u").alias("v"), "r"), "v").groupBy("u").agg(F.max("r").alias("best"))
    medoids = rank.join(best, "u").where(F.col("r") > F.col("best")).select("u", "r")
    joined = both.join(medoids.select(F.col("u").alias("v"), "r"), "v").groupBy("u").agg(F.max(F.struct("r", "v")).alias("m"))
    return medoids.select("u", F.col("u").alias("root")).unionByName(joined.select("u", F.col("m.v").alias("root")))


def _grouped(vecs: DataFrame, cycles: int, channels: int, cosine: float, least: int, scratch: Scratch, alone: bool) -> tuple[DataFrame, DataFrame | None]:
    """The members of tight groups, and the rows that are left of loose ones (None where no group was loose).

    Loose groups are split until that changes none of them: a turn either divides a group or leaves it to the medoid that all of it is
    linked to, so the turns end. alone: each class is a group of its own, and all other rows are left."""
    dims = cycles * channels
    seed = 0
    while True:
        classes = scratch.save(vecs.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).withColumn("u", F.xxhash64(F.lit(seed), "pattern")))
        if classes.groupBy("u").agg(F.count(F.lit(1)).alias("k")).where("k > 1").limit(1).count() == 0:
            break
        seed += 1
    h = lambda c: F.xxhash64(F.lit(seed), c)

    def linked(some: DataFrame) -> DataFrame:
        return scratch.save(links(some, cycles, channels, scratch=scratch).select(h("a").alias("u"), h("b").alias("v")))

    if alone:
        roots = classes.select("u", F.col("u").alias("root"), "n")
    else:
        roots = classes.join(components(linked(classes), scratch), "u", "left").select("u", F.coalesce("root", "u").alias("root"), "n")
    rows = vecs.select("id", "unit", h("pattern").alias("u"))
    done, suspects, turn, ranks = None, vecs, 0, None
    while True:
        roots = scratch.save(roots.select("u", "root", "n"))
        measured = _with_cosine(_placed(rows, roots), dims, least, scratch)
        loose = measured.where(F.col("cosine") < cosine).select("root").distinct()
        tight = measured.join(loose, "root", "left_anti").select("id", "root", "n", "cosine")
        done = tight if done is None else done.unionByName(tight)
        loose = scratch.save(loose)
        if loose.limit(1).count() == 0:
            if turn == 0 and not alone:
                return done, None
            break
        if turn == 0 and not alone:
            suspects = vecs.join(measured.join(loose, "root", "left_semi").select("id"), "id", "left_semi")
        if alone:
            break
        # whole groups that are loose are split; what does not change by that is trimmed below
        if ranks is None:
            ranks = scratch.save(classes.join(degrees(classes, cycles), "pattern").select("u", "pattern", "w"))
        inside = scratch.save(roots.join(loose, "root", "left_semi").join(ranks, "u").select("u", "pattern", "n", "w", F.col("root").alias("g")))
        again = _split(inside, linked(inside))
        kept = scratch.save(inside.join(again, "u", "left").select("u", "pattern", "n", "w", "g", F.col("root").alias("new")))
        if kept.where("new is not null and new <> g").limit(1).count() == 0:
            break
        part = components(linked(kept.where("new is null")), scratch, seed=turn + 11).select("u", F.col("root").alias("part"))
        roots = kept.join(part, "u", "left").select("u", F.coalesce("new", "part", "u").alias("root"), "n")
        turn += 1
    rows = measured.join(loose, "root", "left_semi").select("id", "root", "n", "unit", "cosine")
    while rows.where(F.col("cosine") < cosine).limit(1).count() > 0:  # each time there are fewer rows
        rows = _with_cosine(rows.where(F.col("cosine") >= cosine).select("id", "root", "unit"), dims, least, scratch)
    done = scratch.save(done.unionByName(rows.select("id", "root", "n", "cosine")))
    return done, scratch.save(suspects.join(done.select("id"), "id", "left_anti"))


def clusters(df: DataFrame, id: str, trace: str, cycles: int, channels: int, cosine: float, least: int, scratch: Scratch) -> DataFrame:
    """(id, root, n, cosine) for the members of clusters: at least `least` records that each have at least `cosine`
    with their common mean. Null, all-zero and misshapen traces belong to none; repeated ids count once.

    What is trimmed from loose groups is grouped again, like a new input. Where that gives nothing more, single classes are
    tried, until these give nothing either."""
    left: DataFrame | None = scratch.save(vectors(df, id, trace, cycles, channels))
    done, turn, alone = None, 0, False
    while left is not None:
        found, left = _grouped(left, cycles, channels, cosine, least, scratch, alone)
        if done is None:
            done = found
        else:
            done = done.unionByName(found.withColumn("root", F.xxhash64(F.lit(turn), "root")))  # a class can be a root in several turns
        if left is not None and found.limit(1).count() == 0:
            if alone:
                break
            alone = True
        else:
            alone = False
        turn += 1
    return done


def _placed(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """rows with the root of their class; classes with many rows go by broadcast."""
    total = roots.agg(F.sum("n").alias("n")).collect()[0]["n"] or 0
    large = [r["u"] for r in roots.where(F.col("n") > max(1000, total // HUBS)).select("u").collect()]
    return skew_join(rows, roots.select("u", "root"), "u", large).select("id", "root", "unit")


def leads(members: DataFrame, scratch: Scratch) -> DataFrame:
    """members with lead, the least id of the cluster."""
    saved = scratch.save(members)
    by = scratch.save(saved.groupBy("root").agg(F.min("id").alias("lead"), F.count(F.lit(1)).alias("size")))
    scratch.keep(saved, by)
    total = saved.count()
    large = [r["root"] for r in by.where(F.col("size") > max(1000, total // HUBS)).select("root").collect()]
    return skew_join(saved, by.select("root", "lead"), "root", large)
