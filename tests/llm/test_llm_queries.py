"""The llm queries against SQL where there is some, on the smallest tables; the others against plain computations on the same tables."""

from collections import Counter
from pathlib import Path

import numpy as np
import pytest

import verify
from spotloom.llm import leaks, packing, quantiles, queries
from spotloom.llm.text import words
from spotloom.sources.tables import table

WITHOUT_SQL = {"p1_roi_percentiles", "p8_containers", "p9_found", "p9_leaked_items", "p10_found", "p10_composition"}


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - WITHOUT_SQL))
def test_query(spark, duck, small, name):
    said = verify.compare(spark, duck, small, name)
    assert said.startswith("ok"), said


def test_queries_without_sql_have_tests():
    assert set(queries.QUERIES) - set(queries.ORACLES) == WITHOUT_SQL
    here = Path(__file__).read_text()
    assert all(f"queries.{q}(" in here for q in WITHOUT_SQL)


def test_percentiles_of_rois_keep_their_bounds(spark, duck, small):
    """Days merged into rois: the exact percentile lies between low and high, and the value's rank is off by the stated error at most."""
    scores = {}
    for field, roi, s in duck.execute(f"select field, roi, s from ({queries._SQL_P1}) where s is not null").fetchall():
        scores.setdefault((field, roi), []).append(s)
    rows = queries.p1_roi_percentiles(spark, small).collect()
    assert {(r["field"], r["roi"]) for r in rows} == set(scores) and len(rows) == 6 * len(scores)
    for r in rows:
        v = np.sort(scores[r["field"], r["roi"]])
        assert r["n"] == len(v)
        assert r["low"] <= v[int(np.ceil(len(v) * r["pct"] / 100)) - 1] <= r["high"]
        first, last = np.searchsorted(v, r["value"], "left") / len(v), np.searchsorted(v, r["value"], "right") / len(v)
        assert first - quantiles.rank_error() - 1 / len(v) <= r["pct"] / 100 <= last + quantiles.rank_error() + 1 / len(v)


def test_limits_within_the_bounds_of_a_sketch_are_counted(spark, tmp_path, monkeypatch):
    """With small sketches every group above their size is unsure, and the result is still the exact one."""
    rng = np.random.default_rng(3)
    rows = [(i, int(i % 4), "2024-01-0" + str(1 + i % 3), float(np.clip(rng.normal(0.45 + 0.002 * (i % 4 - 1.5), 0.15), 0, 1))) for i in range(12_000)]
    t = spark.createDataFrame(rows, "spot_id bigint, roi int, day string, spot_score double").selectExpr("*", "cast(day as timestamp) as called_at", "spot_score as dot_product_score", "'x' as gene", "'x' as bases", "'x' as corrected_bases")
    for name in ("gene_spots", "barcode_spots"):
        t.write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(quantiles, "K", 64)
    default = quantiles.sketches, quantiles.percentiles
    monkeypatch.setattr(quantiles, "sketches", lambda *a: default[0](*a, k=64))
    monkeypatch.setattr(quantiles, "percentiles", lambda *a: default[1](*a, k=64))
    got = {tuple(r) for r in queries.p1_found(spark, str(tmp_path)).collect()}
    want = set()
    for roi in range(4):
        for day in range(3):
            v = np.sort([s for i, r, d, s in rows if r == roi and d.endswith(str(1 + day))])
            for pct, limit in queries.LOW:
                if v[int(np.ceil(len(v) * pct / 100)) - 1] < limit:
                    want |= {(f, roi, f"2024-01-0{1 + day}", pct) for f in queries.FIELDS}
    assert got == want


def test_containers_hold_all_tokens_and_little_room(spark):
    from tokenizers import Tokenizer

    folder = "/root/testdata/sf0.1"
    t = Tokenizer.from_file(f"{packing.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    docs = table(spark, folder, "documents").select("doc_id", "text").collect()
    n = {r["doc_id"]: len(e.ids) for r, e in zip(docs, t.encode_batch([r["text"] or "" for r in docs], add_special_tokens=False), strict=True)}
    fill, pieces = Counter(), {}
    for r in queries.p8_containers(spark, folder).collect():
        pieces.setdefault(r["doc_id"], []).append((r["first_unit"], r["n_units"]))
        if r["container_id"] is not None:
            fill[r["container_id"]] += r["n_units"]
    assert {d: sum(m for _, m in p) for d, p in pieces.items()} == n
    for d, p in pieces.items():
        p.sort()
        assert len(p) == max(1, -(-n[d] // packing.CAPACITY)) and [f for f, _ in p] == [packing.CAPACITY * i for i in range(len(p))]
    assert max(fill.values()) <= packing.CAPACITY and sum(fill.values()) / (packing.CAPACITY * len(fill)) > 0.99


def _carries(item, text):
    """The longest stretch of an item in a text, both ends unchanged, by alignment from every word of the item."""
    text, best = np.array(text), 0
    for i in range(len(item) - leaks.STRETCH + 1):
        most = (len(item) - i) // leaks.PER_CHANGE
        row = np.where(text == item[i], 0, 99)  # changes of item[i : j + 1] that ends with each place of the text
        for j in range(i + 1, len(item)):
            same = text == item[j]
            before = np.r_[99, row[:-1]]
            hit = np.where(same, before, 99)
            new = np.minimum(np.minimum(row + 1, before + 1), hit)
            new = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
            length = j - i + 1
            if length >= leaks.STRETCH and hit.min() * leaks.PER_CHANGE <= length:
                best = max(best, length)
            row = new
            if row.min() > most:
                break
    return best


def test_leaks_equal_an_alignment_of_all_texts_and_items(spark, small):
    items = {r["item_id"]: r["text"] for r in table(spark, small, "eval_items").collect()}
    known = {w for t in items.values() for w in words(t)}
    items = {i: words(t, known) for i, t in items.items()}
    want = {}
    for r in table(spark, small, "documents").collect():
        text = words(r["text"], known)
        there = set(text)
        for i, item in items.items():
            if sum(w in there for w in item) >= 17 and (n := _carries(item, text)):
                want[r["doc_id"], i] = n
    got = {(r["doc_id"], r["item_id"]) for r in queries.p9_found(spark, small).collect()}
    assert got == set(want) and want
    by = {r["item_id"]: (r["n_documents"], r["n_words"]) for r in queries.p9_leaked_items(spark, small).collect()}
    assert by == {i: (sum(k == i for _, k in want), max(n for (_, k), n in want.items() if k == i)) for i in {k for _, k in want}}


def test_subjects_agree_with_hand_labels_and_their_composition(spark):
    """Labels of documents that took no part in the fit: those of another table of the same kind."""
    folder = "/root/testdata/sf0.1"
    found = {}
    for r in queries.p10_found(spark, folder).collect():
        found.setdefault(r["subject_code"], set()).add(r["doc_id"])
    codes = {r["subject_code"] for r in table(spark, folder, "subject_areas").collect()}
    assert set(found) == codes
    got = {r["subject_code"]: (r["n_documents"], r["weight"]) for r in queries.p10_composition(spark, folder).collect()}
    assert {c: n for c, (n, _) in got.items()} == {c: len(d) for c, d in found.items()}
    assert all(0.2 * n - 1e-6 <= w <= n for n, w in got.values())
    labels = {(r["doc_id"], r["subject_code"]) for r in table(spark, folder, "subject_labels").collect() if r["subject_code"] in codes}
    assert sum(d in found[c] for d, c in labels) / len(labels) > 0.9
