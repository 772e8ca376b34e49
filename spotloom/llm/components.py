"""Consolidating pairwise links into groups by randomized contraction (problem 7).

Each round every vertex hooks to the first of its neighbours and itself in an order that is fresh each round, edges are
relabelled by the hooks, loops dropped and repeats removed, until no edge is left. A constant share of the vertices goes
each round, so rounds grow with the logarithm of the input whatever the shape of the groups (chains included).
The hooks of all rounds, applied from the last to the first, give each vertex its group.

Vertices are 64-bit ids that are evenly spread (hashes). A round's order is the id, rotated and xored by random
constants: a bijection, so the minimum over neighbours is a plain long and names its vertex.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotloom.operators.skew import skew_join
from spotloom.session import Scratch

#: Vertices of more than 1 / HUBS of a round's edges are joined by broadcast: there are at most 2 x HUBS of them.
HUBS, LEAST_HUB = 100, 1000


def _order(v: Column, turn: int, mask: int) -> Column:
    return F.shiftleft(v, turn).bitwiseOR(F.shiftrightunsigned(v, 64 - turn)).bitwiseXOR(F.lit(mask))


def _back(o: Column, turn: int, mask: int) -> Column:
    x = o.bitwiseXOR(F.lit(mask))
    return F.shiftrightunsigned(x, turn).bitwiseOR(F.shiftleft(x, 64 - turn))


def _clean(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _hubs(hooks: DataFrame, edges: int) -> list[int]:
    """Vertices with more than 1 / HUBS of all edges, and a thousand at least: bounded, as degrees add up to twice the edges."""
    if edges <= LEAST_HUB:
        return []  # no vertex has more edges than there are
    return [r["u"] for r in hooks.where(F.col("degree") > max(LEAST_HUB, edges // HUBS)).select("u").collect()]


def components(edges: DataFrame, scratch: Scratch, seed: int = 7) -> DataFrame:
    """(u, root) for each vertex of the edges (u bigint, v bigint); all vertices of a group share one root.

    Loops and repeated edges are harmless; null ends are no edges; no edges give no rows.
    """
    rng = random.Random(seed)
    left = scratch.save(_clean(edges.where("u is not null and v is not null")))
    n = left.count()
    rounds: list[tuple[DataFrame, list[int]]] = []
    while n:
        turn, mask = rng.randrange(1, 64), rng.getrandbits(63)
        both = left.select("u", "v").unionByName(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(_order(F.col("v"), turn, mask)).alias("o"), F.count(F.lit(1)).alias("degree"))
        hooks = scratch.save(least.select("u", _back(F.least("o", _order(F.col("u"), turn, mask)), turn, mask).alias("root"), "degree"))
        hubs = _hubs(hooks, n)
        to = hooks.select("u", "root")
        half = skew_join(left, to, "u", hubs).select(F.col("v").alias("u"), F.col("root").alias("a"))
        new = skew_join(half, to, "u", hubs).select(F.col("a").alias("u"), F.col("root").alias("v"))
        after = scratch.save(_clean(new))
        scratch.drop(left)
        left, n = after, after.count()
        rounds.append((hooks, hubs))
    if not rounds:
        return left.select("u", F.col("v").alias("root"))
    hooks, _ = rounds.pop()
    out = hooks.select("u", "root")
    while rounds:
        hooks, hubs = rounds.pop()
        later = out.select(F.col("u").alias("root"), F.col("root").alias("end"))
        out = skew_join(hooks.select("u", "root"), later, "root", hubs, "left").select("u", F.coalesce("end", "root").alias("root"))
        if len(rounds) % 3 == 0:
            out = scratch.save(out)
    return out


def _ids(links: DataFrame, seed: int) -> DataFrame:
    return links.select(F.xxhash64(F.lit(seed), "a").alias("u"), F.xxhash64(F.lit(seed), "b").alias("v"))


def groups(links: DataFrame, a: str, b: str, scratch: Scratch) -> DataFrame:
    """(member, first, size) for each value in links of two string columns: the alphabetically first value of its group.

    Values are hashed to 64 bits; that no two share a hash is checked over all values, and another seed taken if two do.
    Links of a value to itself, with null, and repeated ones change nothing; no links give no rows.
    """
    pairs = links.select(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")).where("a is not null and b is not null and a <> b")
    pairs = scratch.save(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    seed = 0
    while True:
        values = pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct().select(F.xxhash64(F.lit(seed), "name").alias("u"), "name")
        values = scratch.save(values)
        total = values.count()
        if values.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count() == 0:
            break
        seed += 1
    roots = components(_ids(pairs, seed), scratch)
    named = scratch.save(roots.join(values, "u").select("root", "name"))
    firsts = scratch.save(named.groupBy("root").agg(F.min("name").alias("first"), F.count(F.lit(1)).alias("size")))
    scratch.keep(named, firsts)
    large = [r["root"] for r in firsts.where(F.col("size") > max(LEAST_HUB, total // HUBS)).select("root").collect()]
    return skew_join(named, firsts, "root", large).select(F.col("name").alias("member"), "first", "size")
