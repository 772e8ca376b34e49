"""Most frequent values by a majority-vote sketch (problem 3).

The sketch has ROWS rows of hash cells. A cell keeps the total of its counts, a candidate and the candidate's vote
surplus. Cells merge by vote cancellation: surpluses of the same candidate add up, those of others cancel. A candidate's
count lies between its surplus and (total + surplus) / 2, any other value's is at most (total - surplus) / 2.

Memory is ROWS x WIDTH cells per partition whatever the number of distinct values; what is shuffled is at most that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of cells, and cells per row. A value of share s is lost only if others fill half its cell in each row:
#: with 4 x 8192 cells and s = 0.5 % next to impossible, and the certificate below shows it.
ROWS, WIDTH = 4, 8192


def cell(value: Column, row: int, width: int = WIDTH) -> Column:
    """The cell of a value in a row of the sketch."""
    return F.pmod(F.xxhash64(F.lit(row), value), F.lit(width)).cast("int")


def _vote(cells: np.ndarray, ids: np.ndarray, surplus: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, ...]:
    """One summary per cell from rows of (cell, candidate id, surplus, total): cells, candidates, surplus, total."""
    order = np.lexsort((ids, cells))
    cells, ids, surplus, totals = cells[order], ids[order], surplus[order], totals[order]
    first = np.flatnonzero(np.r_[True, (cells[1:] != cells[:-1]) | (ids[1:] != ids[:-1])])
    c, i, s = cells[first], ids[first], np.add.reduceat(surplus, first)
    start = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
    every = np.add.reduceat(s, start)
    row_start = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    total = np.add.reduceat(totals, row_start)
    group = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(c)]))
    best = np.lexsort((-s, group))[start]
    return c[start], i[best], np.maximum(0, 2 * s[best] - every), total


def _partition(rows: int, width: int):
    """Partial sketch of a partition: batches are counted, then folded into the cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values: list = [np.empty(0, object)] * rows
        state = [(np.empty(0, np.int64),) * 3 for _ in range(rows)]
        for b in batches:
            if not b.num_rows:
                continue
            d = pc.dictionary_encode(b.column(0))
            codes, names = np.asarray(d.indices), np.asarray(d.dictionary.to_pylist(), object)
            n = np.bincount(codes, minlength=len(names)).astype(np.int64)
            where = np.empty(len(names), np.int64)
            known = {x: k for k, x in enumerate(names)}
            for r in range(rows):
                where[codes] = np.asarray(b.column(r + 1))
                old_cells, old_surplus, old_total = state[r]
                old_ids = np.fromiter((known.get(x, len(names) + k) for k, x in enumerate(values[r])), np.int64, len(values[r]))
                pool = np.concatenate([names, values[r]])
                c, i, s, t = _vote(np.r_[where, old_cells], np.r_[np.arange(len(names)), old_ids], np.r_[n, old_surplus], np.r_[n, old_total])
                values[r], state[r] = pool[i], (c, s, t)
        for r in range(rows):
            c, s, t = state[r]
            if len(c):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(c), r, np.int32)), pa.array(c.astype(np.int32)), pa.array(t), pa.array(list(values[r]), pa.string()), pa.array(s)],
                    names=["row", "cell", "total", "candidate", "surplus"],
                )

    return run


SCHEMA = "row int, cell int, total bigint, candidate string, surplus bigint"


def sketch(df: DataFrame, value: str, rows: int = ROWS, width: int = WIDTH) -> DataFrame:
    """row, cell, total, candidate, surplus: the merged sketch of the non-null values of a string column."""
    v = F.col(value).cast("string")
    keyed = df.where(v.isNotNull()).select(v.alias("v"), *(cell(v, r, width).alias(f"c{r}") for r in range(rows)))
    return merge(keyed.mapInArrow(_partition(rows, width), SCHEMA))


def merge(parts: DataFrame) -> DataFrame:
    """Sketches of partitions or days into one, by vote cancellation in two partially aggregated steps."""
    votes = parts.groupBy("row", "cell", "candidate").agg(F.sum("total").alias("total"), F.sum("surplus").alias("surplus"))
    best = F.max(F.struct("surplus", "candidate"))
    merged = votes.groupBy("row", "cell").agg(F.sum("total").alias("total"), F.sum("surplus").alias("votes"), best.alias("best"))
    return merged.select("row", "cell", "total", F.col("best.candidate").alias("candidate"), F.greatest(F.lit(0), 2 * F.col("best.surplus") - F.col("votes")).cast("bigint").alias("surplus"))


def bounds(sk: DataFrame, rows: int = ROWS, width: int = WIDTH) -> DataFrame:
    """candidate, lower, upper: bounds on each candidate's count, the best over the rows of the sketch.

    sk has at most rows x width rows, so the two broadcasts here are bounded by the sketch's size.
    """
    c = sk.select("candidate").distinct()
    at = c.select("candidate", F.posexplode(F.array(*(cell(F.col("candidate"), r, width) for r in range(rows)))).alias("row", "cell"))
    mine = F.col("candidate") == F.col("other")
    j = at.join(F.broadcast(sk.withColumnRenamed("candidate", "other")), ["row", "cell"])
    up = F.when(mine, F.floor((F.col("total") + F.col("surplus")) / 2)).otherwise(F.floor((F.col("total") - F.col("surplus")) / 2))
    return j.groupBy("candidate").agg(F.max(F.when(mine, F.col("surplus")).otherwise(F.lit(0))).alias("lower"), F.min(up).alias("upper"))


def frequent(df: DataFrame, value: str, share: float, sk: DataFrame, rows: int = ROWS, width: int = WIDTH) -> DataFrame:
    """value, n, lower, upper for the values that make up at least `share` of the non-null values of df, exactly.

    Candidates whose upper bound reaches the share are counted in df: at most 2 x rows / share of them. Cells in
    which a value other than the candidate could reach it (usually none) are counted as well, so nothing is missed.
    """
    v = F.col(value).cast("string")
    found = sk.where(F.col("row") == 0).agg(F.sum("total").alias("n")).collect()[0]["n"] or 0
    least = share * found
    b = bounds(sk, rows, width)
    cand = {r["candidate"]: (r["lower"], r["upper"]) for r in b.where(F.col("upper") >= least).collect()}
    open_cells = {r: [] for r in range(rows)}
    for r in sk.where((F.col("total") - F.col("surplus")) / 2 >= least).select("row", "cell").collect():
        open_cells[r["row"]].append(r["cell"])
    wanted = v.isin(list(cand))
    if all(open_cells.values()):
        rest = F.lit(True)
        for r, cells in open_cells.items():
            rest = rest & cell(v, r, width).isin(cells)
        wanted = wanted | rest
    counted = df.where(wanted).groupBy(v.alias(value)).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    limits = df.sparkSession.createDataFrame([(k, *x) for k, x in cand.items()], f"`{value}` string, lower bigint, upper bigint")
    return counted.join(F.broadcast(limits), value, "left")
