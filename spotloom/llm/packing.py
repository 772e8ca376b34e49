"""Filling fixed-capacity containers with texts (problem 8): bounded-space online best fit.

Texts are measured in tokens of a public tokenizer. Each task fills containers of its own: a fixed number is open,
their free spaces are the set bits of one integer, so the tightest container that fits is the lowest set bit at or above
the text's size. When none fits and all are open, the fullest closes. A task gets some thousands of containers' worth of tokens,
so what stays open at its end is a small constant share whatever the size of the corpus.
"""

from __future__ import annotations

import base64
import importlib.util
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotloom.session import Scratch

#: Tokens a container holds, containers open at a time, and containers' worth of tokens per task.
CAPACITY, OPEN, PER_TASK = 2048, 128, 8192
COLUMNS = ("container_id", "piece", "first_unit", "n_units")
#: Default folder of the vocabulary files.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"


def _encoding(path: str):
    import tiktoken

    spec = importlib.util.spec_from_file_location("public_tokenizers_at", f"{Path(path).parent}/__init__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}
    return tiktoken.Encoding("own", pat_str=module.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, text: str, path: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """df without its text but with n_tokens; 0 for a null or empty text. Whole texts are measured."""
    keep = [c for c in df.columns if c != text]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoding(path)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(n, pa.int64())], names=[*keep, "n_tokens"])

    return df.select(*keep, text).mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "n_tokens bigint"]))


class Bins:
    """Best fit over a bounded number of open bins."""

    def __init__(self, capacity: int, most_open: int, first_id: int):
        self.capacity, self.most_open, self.next_id = capacity, most_open, first_id
        self.free_bits, self.by_free, self.n_open = 0, {}, 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        b = bins.pop()
        if not bins:
            del self.by_free[free]
            self.free_bits ^= 1 << free
        self.n_open -= 1
        return b

    def _put(self, b: int, free: int) -> None:
        if free:
            self.by_free.setdefault(free, []).append(b)
            self.free_bits |= 1 << free
            self.n_open += 1

    def add(self, size: int) -> int:
        """The bin that takes an item of 1 to capacity units. One that fills a bin alone needs no open one and closes none."""
        if size == self.capacity:
            self.next_id += 1
            return self.next_id - 1
        fits = self.free_bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = self._take(free)
        else:
            if self.n_open >= self.most_open:
                self._take((self.free_bits & -self.free_bits).bit_length() - 1)  # the fullest closes
            b, free = self.next_id, self.capacity
            self.next_id += 1
        self._put(b, free - size)
        return b


def pack(sizes: DataFrame, id: str, size: str, scratch: Scratch, capacity: int = CAPACITY, most_open: int = OPEN, per_task: int = PER_TASK) -> DataFrame:
    """(container_id, id, piece, first_unit, n_units): where each item goes. The id keeps its name unless it is one of these.

    Only an item above the capacity is split: into full containers of its own, and a rest that is packed like any item.
    Items of size 0 or null take no container (container_id null, 0 units). Rows with a null or repeated id are items
    too. The order of arrival within a task is that of a hash of the id, so a run can be repeated.
    """
    s = scratch.save(sizes.select(F.col(id).alias("id"), F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("n")))
    total = s.agg(F.sum("n").alias("n")).collect()[0]["n"] or 0
    tasks = max(1, round(total / (capacity * per_task)))
    kind = s.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bins = Bins(capacity, most_open, TaskContext.get().partitionId() << 40)
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [], [])

            def put(c, i, piece, first, n, out=out):
                for column, v in zip(out, (c, i, piece, first, n), strict=True):
                    column.append(v)

            for row, n in enumerate(b.column(1).to_pylist()):
                if n <= 0:
                    put(None, row, 0, 0, 0)
                for piece, first in enumerate(range(0, n, capacity)):
                    m = min(capacity, n - first)
                    put(bins.add(m), row, piece, first, m)
            c, i, piece, first, n = out
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), b.column(0).take(pa.array(i, pa.int64())), pa.array(piece, pa.int32()), pa.array(first, pa.int64()), pa.array(n, pa.int64())], names=["container_id", "id", "piece", "first_unit", "n_units"])

    spread = s.withColumn("h", F.xxhash64(F.lit(3), "id", "n")).repartition(tasks, "h").sortWithinPartitions("h", "id").select("id", "n")
    return spread.mapInArrow(run, f"container_id bigint, id {kind}, piece int, first_unit bigint, n_units bigint").withColumnRenamed("id", id if id not in COLUMNS else "id")
