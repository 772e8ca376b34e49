"""Evaluation passages inside a corpus (problem 9): a distributed positional inverted index.

`build_index` reads the corpus once and stores the index: blocks of documents (shards), each with one posting list per term, the
differences of its positions as variable-length bytes, beside the ids and lengths of its documents. `search` reads no
text: it takes the lists of the terms of the test items, brings those of a shard together, and for each phrase of PHRASE words of an item
intersects the lists, shifted by the terms' offsets, from the rarest term of the shard on. A stretch of L item
words with at most L / 8 changes always holds an unchanged phrase of 6 words, so no case is lost here. From each phrase
match the stretch is then extended both ways, counting words replaced, dropped and added.

A shard holds some hundred thousand tokens, so no list is longer, whatever the term; only lists of terms of the items are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotloom.llm.text import is_one_word, tokens, words
from spotloom.session import Scratch

#: Words of a phrase, least words of a stretch, words per change, tokens of a shard, items per pass over the index, and their words.
PHRASE, STRETCH, PER_CHANGE, BLOCK_TOKENS, ITEMS_PER_PASS, WORDS_PER_PASS = 6, 20, 8, 400_000, 5000, 1_000_000
#: A stretch has a part of 20 to 39 words with at most 4 changes: how far that part reaches beyond a run of 6 of its words, its changes, and
#: the least number of its words that are unchanged.
_ASIDE, _DRIFT, _UNCHANGED = 33, 4, 18
INDEX = "shard bigint, term string, n int, postings binary, docs array<bigint>, lengths array<int>, breaks array<int>, pieces array<string>"


class Items:
    """Test items as arrays of term ids, and all their phrases."""

    def __init__(self, items: list[tuple[int, str | None]]):
        texts = [(i, words(t)) for i, t in items]
        texts = [(i, w) for i, w in texts if len(w) >= STRETCH]
        self.terms = {t: k for k, t in enumerate(dict.fromkeys(t for _, w in texts for t in w))}
        self.ids = [i for i, _ in texts]
        self.words = [np.array([self.terms[t] for t in w], np.int64) for _, w in texts]
        at = [(k, o) for k, w in enumerate(self.words) for o in range(len(w) - PHRASE + 1)]
        self.item, self.offset = (np.array(x, np.int64) for x in zip(*at, strict=True)) if at else (np.empty(0, np.int64),) * 2
        self.phrases = np.array([self.words[k][o : o + PHRASE] for k, o in at], np.int64).reshape(-1, PHRASE)


def phrase_matches(ids: np.ndarray, doc: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, start) of each phrase of the items in a block of documents, given term ids (-1: none) and document numbers."""
    known = np.flatnonzero(ids >= 0)
    order = known[np.argsort(ids[known], kind="stable")]
    first = np.searchsorted(ids[order], np.arange(len(items.terms) + 1))
    n = np.diff(first)
    rarity = np.argsort(n[items.phrases], axis=1, kind="stable")
    rarest = np.take_along_axis(items.phrases, rarity[:, :1], 1)[:, 0]
    count = n[rarest]
    some = np.flatnonzero(count)
    count = count[some]
    phrase = np.repeat(some, count)
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = order[np.repeat(first[rarest[some]], count) + within] - rarity[phrase, 0]
    fits = (start >= 0) & (start + PHRASE <= len(ids))
    phrase, start = phrase[fits], start[fits]
    for k in range(1, PHRASE):
        off = rarity[phrase, k]
        fits = ids[start + off] == items.phrases[phrase, off]
        phrase, start = phrase[fits], start[fits]
    fits = doc[start] == doc[start + PHRASE - 1]
    return phrase[fits], start[fits]


def runs(phrase: np.ndarray, start: np.ndarray, items: Items) -> Iterator[tuple[int, int, int, int]]:
    """(item, item position, start, length): phrase matches that follow one another on a diagonal, joined."""
    if not len(phrase):
        return
    item, off = items.item[phrase], items.offset[phrase]
    order = np.lexsort((off, start - off, item))
    item, off, start = item[order], off[order], start[order]
    new = np.r_[True, (item[1:] != item[:-1]) | (start[1:] - off[1:] != start[:-1] - off[:-1]) | (off[1:] != off[:-1] + 1)]
    at = np.flatnonzero(new)
    for a, z in zip(at, np.r_[at[1:], len(item)], strict=True):
        yield int(item[a]), int(off[a]), int(start[a]), int(z - a) + PHRASE - 1


def reach(a: np.ndarray, b: np.ndarray, most: int) -> list[int]:
    """For 0 to `most` changes: how many words of a can be aligned with a beginning of b, the last one unchanged."""
    b = b[: len(a) + most]
    steps = np.arange(len(b) + 1)
    row, cheapest = steps, np.full(len(a) + 1, most + 1)  # changes between a[:i] and each beginning of b
    cheapest[0] = 0
    new = np.empty_like(steps)
    for i in range(1, len(a) + 1 if len(b) else 1):
        same = b == a[i - 1]
        if same.any():
            cheapest[i] = row[:-1][same].min()
        new[0] = i
        np.add(row[:-1], ~same, out=new[1:])
        row = np.minimum.accumulate(np.minimum(row + 1, new) - steps) + steps
        if row.min() > most:
            break
    return [int(np.flatnonzero(cheapest <= e)[-1]) for e in range(most + 1)]


def _worth_it(item: np.ndarray, text: np.ndarray, i: int, j: int, n: int) -> bool:
    """Whether enough words of the item around a run are in the text at nearly their place, as they are in each allowed stretch."""
    lo, hi = max(0, i - _ASIDE), min(len(item), i + n + _ASIDE)
    if hi - lo < STRETCH:
        return False
    a, z = lo + j - i - _DRIFT, hi + j - i + _DRIFT
    near = np.full(z - a, -2)
    near[max(0, -a) : len(text) - a] = text[max(0, a) : z]
    there = (np.lib.stride_tricks.sliding_window_view(near, 2 * _DRIFT + 1) == item[lo:hi, None]).any(1)
    return int(there.sum()) >= _UNCHANGED


def longest_stretch(item: np.ndarray, text: np.ndarray, i: int, j: int, n: int) -> int:
    """Words of the longest allowed stretch through the run item[i:i+n] = text[j:j+n]; 0 if none is long enough."""
    if not _worth_it(item, text, i, j, n):
        return 0
    sides = (item[:i][::-1], text[:j][::-1]), (item[i + n :], text[j + n :])
    left, right = (reach(a, b, len(item) // PER_CHANGE) for a, b in sides)
    best = 0
    for e1, x in enumerate(left):
        for e2, y in enumerate(right):
            if (total := n + x + y) >= STRETCH and (e1 + e2) * PER_CHANGE <= total:
                best = max(best, total)
    return best


def packed(deltas: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 as bytes, seven bits each, the lowest first, all but the last of a number marked; and how many bytes each takes."""
    size = 1 + sum((deltas >= 1 << (7 * k)).astype(np.int64) for k in range(1, 5))
    end = np.cumsum(size)
    out = np.empty(end[-1] if len(end) else 0, np.uint8)
    for k in range(5):
        some = size > k
        out[end[some] - size[some] + k] = (deltas[some] >> (7 * k)) & 127 | np.where(size[some] > k + 1, 128, 0)
    return out, size


def unpacked(data: np.ndarray) -> np.ndarray:
    """The numbers of packed bytes."""
    last = np.flatnonzero(data < 128)
    first = np.r_[0, last[:-1] + 1] if len(last) else last
    place = np.arange(len(data)) - np.repeat(first, last - first + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), first) if len(first) else np.empty(0, np.int64)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    shard, docs, lengths, breaks, held, text = TaskContext.get().partitionId() << 32, [], [], [], 0, []

    def stored() -> pa.RecordBatch:
        number: dict[str, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in text), np.int64, len(text))
        names = list(number)
        by_name = sorted(range(len(names)), key=names.__getitem__)
        rank = np.empty(len(names), np.int64)
        rank[by_name] = np.arange(len(names))
        ids = rank[ids]
        order = np.argsort(ids, kind="stable")
        n = np.bincount(ids, minlength=len(names))
        start = np.cumsum(n) - n
        deltas = np.diff(order, prepend=0)
        deltas[start] = order[start]
        data, size = packed(deltas)
        ends = np.r_[0, np.cumsum(size)][np.r_[start, len(order)]]
        lists = pa.Array.from_buffers(pa.large_binary(), len(names), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())
        k, head = len(names), lambda v, t: pa.concat_arrays([pa.array([v], t), pa.nulls(len(names), t)])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(k + 1, shard)), pa.array([None, *(names[i] for i in by_name)], pa.string()), pa.array(np.r_[len(text), n].astype(np.int32)), pa.concat_arrays([pa.nulls(1, pa.binary()), lists]),
             head(docs, pa.list_(pa.int64())), head(lengths, pa.list_(pa.int32())), head(breaks, pa.list_(pa.int32())), head([f"{text[p]} {text[p + 1]}" for p in breaks], pa.list_(pa.string()))],
            names=["shard", "term", "n", "postings", "docs", "lengths", "breaks", "pieces"],
        )

    for b in batches:
        for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            w, parted = tokens(t)
            if d is None or len(w) < PHRASE:
                continue
            docs.append(d)
            lengths.append(len(w))
            breaks += [held + p for p in parted]
            text += w
            held += len(w)
            if held >= BLOCK_TOKENS:
                yield stored()
                shard, docs, lengths, breaks, held, text = shard + 1, [], [], [], 0, []
    if docs:
        yield stored()


def build_index(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored positional index of a corpus: per shard a row without a term (ids and lengths of its documents, broken words) and one row per
    term, in order of the terms. Whole texts are read; null and empty texts, texts of less than a phrase and null ids have no place in it."""
    return scratch.save(docs.select(doc_id, text).mapInArrow(_index, INDEX))


def _block(names: np.ndarray, lengths: np.ndarray, ids: np.ndarray, items: Items) -> pa.Table:
    doc = np.repeat(np.arange(len(lengths)), lengths)
    bounds = np.r_[0, np.cumsum(lengths)]
    found: dict[tuple[int, int], int] = {}
    for k, i, s, n in runs(*phrase_matches(ids, doc, items), items):
        d = int(doc[s])
        if found.get((d, k), 0) >= len(items.words[k]):
            continue
        w = len(items.words[k]) * 9 // 8 + 4
        lo, hi = max(int(bounds[d]), s - w), min(int(bounds[d + 1]), s + n + w)
        if length := longest_stretch(items.words[k], ids[lo:hi], i, s - lo, n):
            found[d, k] = max(length, found.get((d, k), 0))
    keys = sorted(found)
    return pa.table({"doc_id": pa.array([int(names[d]) for d, _ in keys], pa.int64()), "item_id": pa.array([items.ids[k] for _, k in keys], pa.int64()), "n_words": pa.array([found[x] for x in keys], pa.int32())})


def _searched(items: Items):
    def run(shard: pa.Table) -> pa.Table:
        at = shard.column("id").to_pylist()
        own = at.index(None)
        meta = {c: shard.column(c)[own].as_py() for c in ("docs", "lengths", "breaks", "pieces", "n")}
        ids = np.full(meta["n"], -1, np.int64)
        rows = [r for r, k in enumerate(at) if k is not None]
        if rows:
            lists = shard.take(pa.array(rows)).combine_chunks()
            n = np.asarray(lists.column("n")).astype(np.int64)
            deltas = unpacked(np.frombuffer(b"".join(lists.column("postings").to_pylist()), np.uint8))
            position = np.cumsum(deltas)
            start = np.cumsum(n) - n
            position -= np.repeat(position[start] - deltas[start], n)
            ids[position] = np.repeat(np.asarray(lists.column("id")), n)
        lengths = np.array(meta["lengths"], np.int64)
        gone = np.zeros(len(ids), bool)
        for p, pieces in zip(meta["breaks"], meta["pieces"], strict=True):
            a, b = pieces.split(" ")
            if is_one_word(a, b, items.terms):
                ids[p], gone[p + 1] = items.terms.get(a + b, -1), True
        if gone.any():
            lengths -= np.bincount(np.repeat(np.arange(len(lengths)), lengths)[gone], minlength=len(lengths))
            ids = ids[~gone]
        return _block(np.array(meta["docs"]), lengths, ids, items)

    return run


def _passes(queries: list[tuple[int, str | None]], per_pass: int) -> Iterator[list[tuple[int, str | None]]]:
    block, held = [], 0
    for q in queries:
        size = len(q[1] or "") // 4
        if block and (len(block) >= per_pass or held + size > WORDS_PER_PASS):
            yield block
            block, held = [], 0
        block.append(q)
        held += size
    yield block


def search(index: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """(doc_id, item_id, n_words) of a stored index: see `leaks`. Any number of item sets can be searched in one index.

    The items are the stated query set and are read to the driver. Each block of at most per_pass items, and of a million words or one
    item, is one pass over the lists of its terms; the table of these terms is broadcast, which the block bounds.
    """
    spark = index.sparkSession
    queries = [(r[0], r[1]) for r in items.select(item_id, text).where(f"`{item_id}` is not null").distinct().sort(item_id, text).collect()]
    own = index.where("term is null").withColumn("id", F.lit(None).cast("int"))
    out = None
    for block in _passes(queries, per_pass):
        known = Items(block)
        terms = spark.createDataFrame(list(known.terms.items()), "term string, id int")
        lists = index.select("shard", "term", "n", "postings").join(F.broadcast(terms), "term")
        shards = own.unionByName(lists, allowMissingColumns=True).select("shard", "id", "n", "postings", "docs", "lengths", "breaks", "pieces")
        found = shards.groupBy("shard").applyInArrow(_searched(known), "doc_id bigint, item_id bigint, n_words int")
        out = found if out is None else out.unionByName(found)
    return out.groupBy("doc_id", "item_id").agg(F.max("n_words").alias("n_words"))


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", per_pass: int = ITEMS_PER_PASS, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, item_id, n_words): documents that carry at least STRETCH consecutive words of an item, with at most one in
    PER_CHANGE replaced, dropped or added, and the length of the longest such stretch.

    Ids are bigint. Null and empty texts carry nothing; items of fewer than STRETCH words are not searched; a document with
    a null id is not reported; repeated rows give one result.
    """
    index = build_index(docs, scratch or Scratch(docs.sparkSession, "leaks"), doc_id, text)
    return search(index, items, item_id, text, per_pass)
