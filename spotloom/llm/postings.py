"""Frequency of every distinct item by compressed record bitmaps (problem 4).

Vertical layout: per item and bucket of records one container of record positions and, beside it, the number
of occurrences. A container holds up to BUCKET positions as sorted 16-bit numbers while that is smaller, else as
a bitmap, as in published compressed bitmap formats. Layouts of days or files merge by union; record frequency is read from the
containers as their cardinality.

Rows become words of 64 positions first, by a partially aggregated bitwise or, and words become containers. No group ever
holds more than BUCKET positions, so an item that occurs everywhere is no hot spot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Positions in a bucket, and the number from which a bitmap is smaller than 16-bit numbers.
BUCKET = 32768
DENSE = BUCKET // 16
_SIDE_X, _SIDE_Y = 128, 256
#: Words that are unpacked at a time.
_WORDS = 65536


def tile_bucket() -> list[Column]:
    """The bucket of a tile (roi and a block of 128 x 256 tiles) and its position there; null where a part is. Blocks of 8 x 8
    tiles are consecutive, so that neighbours share a word."""
    tx, ty = F.col("tx"), F.col("ty")
    block = F.concat_ws(":", "roi", F.floor(tx / _SIDE_X), F.floor(ty / _SIDE_Y))
    placed = F.col("roi").isNotNull() & tx.isNotNull() & ty.isNotNull()
    x, y = F.pmod(tx, F.lit(_SIDE_X)), F.pmod(ty, F.lit(_SIDE_Y))
    word = F.shiftright(x, 3) * (_SIDE_Y // 8) + F.shiftright(y, 3)
    return [F.when(placed, block).alias("bucket"), F.when(placed, (word * 64 + (x % 8) * 8 + y % 8).cast("int")).alias("pos")]


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """..., words -> ..., container."""
    for whole in batches:
        todo = [whole]
        while todo:
            b = todo.pop()
            lists = b.column(b.schema.get_field_index("words"))
            flat, counts = lists.flatten(), np.asarray(lists.value_lengths()).astype(np.int64)
            if len(flat) > _WORDS and b.num_rows > 1:
                half = b.num_rows // 2
                todo += [b.slice(half), b.slice(0, half)]
                continue
            row = np.repeat(np.arange(b.num_rows), counts)
            word, bits = (np.asarray(flat.field(i)) for i in (0, 1))
            order = np.lexsort((word, row))
            row, word, bits = row[order], word[order].astype(np.int64), np.ascontiguousarray(bits[order].astype("<i8"))
            at, bit = np.nonzero(np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")) if len(bits) else (np.empty(0, np.int64),) * 2
            positions = (word[at] * 64 + bit).astype("<u2")
            sizes = np.bincount(row[at], minlength=b.num_rows)
            offsets = np.r_[0, np.cumsum(sizes)]
            if (sizes <= DENSE).all():
                data = pa.Array.from_buffers(pa.large_binary(), b.num_rows, [None, pa.py_buffer((offsets * 2).astype(np.int64).tobytes()), pa.py_buffer(positions.tobytes())])
            else:
                data = pa.array([_container(positions[a:z]) for a, z in zip(offsets[:-1], offsets[1:], strict=True)], pa.large_binary())
            keep = [c for c in b.schema.names if c != "words"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), data.cast(pa.binary())], names=[*keep, "container"])


def _container(sorted_positions: np.ndarray) -> bytes:
    if len(sorted_positions) <= DENSE:
        return sorted_positions.astype("<u2").tobytes()
    bits = np.zeros(BUCKET, bool)
    bits[sorted_positions] = True
    return np.packbits(bits, bitorder="little").tobytes()


def positions_of(container: bytes) -> np.ndarray:
    """The sorted positions in a container; a bitmap is told by its full length."""
    if len(container) == BUCKET // 8:
        return np.flatnonzero(np.unpackbits(np.frombuffer(container, np.uint8), bitorder="little"))
    return np.frombuffer(container, "<u2").astype(np.int64)


def cardinality(container: Column) -> Column:
    """How many positions a container holds, read from its bytes."""
    return F.when(F.length(container) == BUCKET // 8, F.bitmap_count(container)).otherwise(F.length(container) / 2).cast("bigint")


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """..., occurrences, container -> ..., occurrences, word, bits: the occurrences stay with a row's first word; an empty container
    gives one row without a word."""
    for b in batches:
        keep = [c for c in b.schema.names if c not in ("container", "occurrences")]
        packed = b.column(b.schema.get_field_index("container")).to_pylist()
        sparse = np.array([len(c) != BUCKET // 8 for c in packed], bool)
        n = np.array([len(c) // 2 if s else 0 for c, s in zip(packed, sparse, strict=True)], np.int64)
        flat = np.frombuffer(b"".join(c for c, s in zip(packed, sparse, strict=True) if s), "<u2").astype(np.int64)
        row, word, bit = np.repeat(np.arange(len(packed)), n), flat >> 6, np.left_shift(np.uint64(1), (flat & 63).astype(np.uint64))
        first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (word[1:] != word[:-1])]) if len(row) else np.empty(0, np.int64)
        bits = np.bitwise_or.reduceat(bit, first) if len(first) else bit
        row, word = row[first], word[first]
        for i in np.flatnonzero(~sparse):
            full = np.frombuffer(packed[i], "<u8")
            some = np.flatnonzero(full)
            row, word, bits = np.r_[row, np.full(len(some), i)], np.r_[word, some], np.r_[bits, full[some]]
        empty = np.setdiff1d(np.arange(len(packed)), row)
        gone = np.r_[np.zeros(len(row), bool), np.ones(len(empty), bool)]
        row, word, bits = np.r_[row, empty], np.r_[word, empty * 0], np.r_[bits, empty.astype(np.uint64) * np.uint64(0)]
        _, lead = np.unique(row, return_index=True)
        times = np.zeros(len(row), np.int64)
        times[lead] = np.asarray(b.column(b.schema.get_field_index("occurrences")))[row[lead]]
        at = pa.array(row.astype(np.int64))
        yield pa.RecordBatch.from_arrays([*(b.column(c).take(at) for c in keep), pa.array(times), pa.array(word.astype(np.int32), mask=gone), pa.array(bits.astype("<u8").view("<i8"), mask=gone)], names=[*keep, "occurrences", "word", "bits"])


def _packed(words: DataFrame, keys: list[str]) -> DataFrame:
    """The layout of rows (keys, bucket, word, bits, n) with one row per word."""
    kinds = {f.name: f.dataType.simpleString() for f in words.schema}
    head = ", ".join(f"`{k}` {kinds[k]}" for k in [*keys, "bucket"])
    held = words.groupBy(*keys, "bucket").agg(F.sum("n").alias("occurrences"), F.collect_list(F.when(F.col("word").isNotNull(), F.struct("word", "bits"))).alias("words"))
    packed = held.mapInArrow(_encode, f"{head}, occurrences bigint, container binary")
    return packed.withColumn("cardinality", cardinality(F.col("container")))


def layout(occurrences: DataFrame, keys: list[str]) -> DataFrame:
    """The vertical layout (keys, bucket, occurrences, container, cardinality) of rows (keys, bucket, pos), each one occurrence of an item
    in a record. The last key is the item.

    Occurrences are put into words with partial aggregation, so neither a frequent item nor a full record gathers rows. Null
    items are none. A null bucket or pos is an occurrence outside any record.
    """
    some = occurrences.where(F.col(keys[-1]).isNotNull())
    word, bit = F.shiftright("pos", 6), F.expr("shiftleft(1L, pos % 64)")
    return _packed(some.groupBy(*keys, "bucket", word.alias("word")).agg(F.count(F.lit(1)).alias("n"), F.bit_or(bit).alias("bits")), keys)


def union(lay: DataFrame, keys: list[str]) -> DataFrame:
    """Layout of coarser keys: containers of one item and bucket are united, their occurrences added. Rows may come from layouts of any
    number of days or files, over different occurrences of the same records; other key columns are dropped."""
    kinds = {f.name: f.dataType.simpleString() for f in lay.schema}
    head = ", ".join(f"`{k}` {kinds[k]}" for k in [*keys, "bucket"])
    opened = lay.select(*keys, "bucket", "occurrences", "container").mapInArrow(_decode, f"{head}, occurrences bigint, word int, bits bigint")
    return _packed(opened.groupBy(*keys, "bucket", "word").agg(F.sum("occurrences").alias("n"), F.bit_or("bits").alias("bits")), keys)


def merge(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Union of two layouts."""
    return union(a.unionByName(b), keys)


def frequencies(lay: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_occurrences, n_records: record frequency is the sum of the cardinalities of an item's containers."""
    return lay.groupBy(*keys).agg(F.sum("occurrences").alias("n_occurrences"), F.sum(cardinality(F.col("container"))).alias("n_records"))


def mark(freq: DataFrame, total: Column, rare_below: int, common_above: Column) -> DataFrame:
    """With column mark: rare below a number of records, common above a share of `total` (and not rare), else null."""
    n = F.col("n_records")
    return freq.withColumn("mark", F.when(n < rare_below, "rare").when(n > common_above * total, "common"))
