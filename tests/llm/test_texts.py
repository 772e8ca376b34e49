"""Clusters of traces, leaked passages, subjects."""

import random
import shutil

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from spotloom.llm import clusters, leaks, subjects
from spotloom.llm.text import words
from spotloom.session import Scratch

# Clusters


def _traces(seed=1):
    rng = np.random.default_rng(seed)
    rows, truth = [], {}
    for c in range(8):
        pattern = np.zeros((12, 4))
        for r in range(12):
            pattern[r, rng.choice(4, rng.integers(1, 3), replace=False)] = 1
        for i in range(3 if c == 0 else 25):
            t = (pattern + rng.normal(0, 0.05, (12, 4))) * rng.uniform(20, 2000)
            if i % 6 == 0:
                t[rng.integers(12)] = 0
            if i % 9 == 1:
                t[rng.integers(12)] = np.nan
            truth[len(rows)] = c
            rows.append((len(rows), t.tolist()))
    for _ in range(60):
        truth[len(rows)] = None
        rows.append((len(rows), rng.random((12, 4)).tolist()))
    return rows, truth


def test_clusters_are_the_planted_ones(spark):
    rows, truth = _traces()
    rows += [rows[5], (9000, None), (9001, [[0.0] * 4] * 12), (9002, [[1.0] * 4] * 3), (None, rows[0][1])]
    df = spark.createDataFrame(rows, "spot_id bigint, trace array<array<double>>").withColumn("root", F.lit(0)).withColumn("n", F.lit("x"))
    s = Scratch(spark, "t")
    got = clusters.leads(clusters.clusters(df, "spot_id", "trace", 12, 4, 0.91, 5, s), s).collect()
    by = {}
    for r in got:
        by.setdefault(r["lead"], set()).add(r["id"])
        assert r["cosine"] >= 0.91
    want = {}
    for i, c in truth.items():
        if c not in (None, 0):
            want.setdefault(c, set()).add(i)
    assert sorted(map(sorted, by.values())) == sorted(map(sorted, want.values()))
    assert all(lead == min(m) for lead, m in by.items())


def test_loose_groups_are_split(spark):
    """A chain of patterns, each like the next, whose ends have nothing in common."""
    rng = np.random.default_rng(3)
    rows, pattern = [], np.zeros((12, 4))
    pattern[:, 0] = 1
    for step in range(13):
        for _ in range(10 if step in (0, 12) else 2):
            rows.append((len(rows), ((pattern + rng.normal(0, 0.01, (12, 4))) * 100).tolist()))
        if step < 12:
            pattern[step] = [0, 1, 0, 0]
    df = spark.createDataFrame(rows, "spot_id bigint, trace array<array<double>>")
    s = Scratch(spark, "t")
    got = clusters.leads(clusters.clusters(df, "spot_id", "trace", 12, 4, 0.91, 5, s), s).collect()
    unit = {i: (v := np.array(t).ravel()) / np.linalg.norm(v) for i, t in rows}
    by = {}
    for r in got:
        by.setdefault(r["lead"], []).append(r["id"])
    assert len(by) >= 2 and len(got) == len({r["id"] for r in got})
    for m in by.values():
        mean = np.mean([unit[i] for i in m], 0)
        assert len(m) >= 5 and min(unit[i] @ mean for i in m) / np.linalg.norm(mean) >= 0.91 - 1e-9


def _linked_but_apart(heavy, light, bright):
    """Two patterns that are linked, as they differ in one cycle, but not alike, as that cycle is the brightest."""
    rng = np.random.default_rng(9)
    rows, truth = [], [set(), set()]
    for k, n in enumerate((heavy, light)):
        pattern = np.zeros((12, 4))
        pattern[:, 0] = 1
        pattern[5] = [bright, 0, 0, 0] if k == 0 else [0, 0, bright, 0]
        for _ in range(n):
            truth[k].add(len(rows))
            rows.append((len(rows), ((pattern + rng.normal(0, 0.02, (12, 4))) * 100).tolist()))
    return rows, truth


def test_trimmed_records_are_grouped_again(spark):
    for heavy, light, bright in ((40, 8, 2), (30, 30, 8)):
        rows, truth = _linked_but_apart(heavy, light, bright)
        df = spark.createDataFrame(rows, "spot_id bigint, trace array<array<double>>")
        s = Scratch(spark, "t")
        by = {}
        for r in clusters.leads(clusters.clusters(df, "spot_id", "trace", 12, 4, 0.91, 5, s), s).collect():
            assert r["cosine"] >= 0.91
            by.setdefault(r["lead"], set()).add(r["id"])
        assert sorted(map(sorted, by.values())) == sorted(map(sorted, truth))


def test_links_equal_exact_similarity(spark):
    rng = random.Random(6)
    base = ["".join(rng.choice("bcdefgijkm") for _ in range(12)) for _ in range(15)]
    names = set(base)
    for b in base:
        for _ in range(6):
            p = list(b)
            for _ in range(rng.randrange(1, 3)):
                p[rng.randrange(12)] = rng.choice("abcdefg")
            names.add("".join(p))
    names = sorted(names)

    def jaccard(a, b):
        same = sum(x == y != "a" for x, y in zip(a, b, strict=True))
        return same / (12 - a.count("a") + 12 - b.count("a") - same)

    got = {(r["a"], r["b"]) for r in clusters.links(spark.createDataFrame([(n,) for n in names], "pattern string"), 12, 4).collect()}
    assert got == {(a, b) for a in names for b in names if a < b and jaccard(a, b) >= 0.8}


def test_crowded_bands_connect_the_same_patterns(spark):
    rng = random.Random(7)
    names = set()
    for base in ("bcdefgijkmbc", "ffggiijjkkmm"):
        for _ in range(150):
            p = list(base)
            for _ in range(rng.randrange(1, 4)):
                p[rng.randrange(12)] = rng.choice("abcdefgijkm")
            names.add("".join(p))
    df = spark.createDataFrame([(n, rng.randrange(9)) for n in sorted(names)], "pattern string, n bigint")

    def groups(crowd):
        parent = {n: n for n in names}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        pairs = [(r["a"], r["b"]) for r in clusters.links(df, 12, 4, crowd=crowd).collect()]
        for a, b in pairs:
            parent[find(a)] = find(b)
        return sorted(sorted(n for n in names if find(n) == r) for r in names if parent[r] == r), len(pairs)

    (whole, n_whole), (crowded, n_crowded) = groups(10_000), groups(3)
    assert whole == crowded and n_crowded <= n_whole


def _dense_family(seed=2):
    """One family of patterns with chance changes, loose as a whole and with many patterns in a band."""
    rng = np.random.default_rng(seed)
    rows = []
    for base in (0, 1):
        for _ in range(160):
            pattern = np.zeros((12, 4))
            pattern[np.arange(12), (np.arange(12) + base) % 4 if base else 0] = 1
            for c in rng.choice(12, rng.integers(0, 5), replace=False):
                pattern[c] = 0
                pattern[c, rng.integers(4)] = 1
            rows.append((len(rows), ((pattern + rng.normal(0, 0.01, (12, 4))) * 100).tolist()))
    return rows


def test_clusters_do_not_depend_on_what_counts_as_crowded(spark, monkeypatch):
    df = spark.createDataFrame(_dense_family(), "spot_id bigint, trace array<array<double>>")
    found = []
    default = clusters.links
    for crowd in (2, 8, 10**9):
        monkeypatch.setattr(clusters, "links", lambda *a, c=crowd, **k: default(*a, **k, crowd=c))
        s = Scratch(spark, "t")
        by = {}
        for r in clusters.leads(clusters.clusters(df, "spot_id", "trace", 12, 4, 0.91, 5, s), s).collect():
            assert r["cosine"] >= 0.91
            by.setdefault(r["lead"], []).append(r["id"])
        found.append({k: sorted(v) for k, v in by.items()})
    assert found[0] == found[1] == found[2] and len(found[0]) > 1


def test_degrees_equal_counting(spark):
    rng = random.Random(5)
    rows = {"".join(rng.choice("ab") if rng.random() < 0.3 else "c" for _ in range(6)): rng.randrange(1, 9) for _ in range(40)}
    got = {r["pattern"]: r["w"] for r in clusters.degrees(spark.createDataFrame(list(rows.items()), "pattern string, n bigint"), 6).collect()}
    assert got == {p: sum(n for q, n in rows.items() if sum(x != y for x, y in zip(p, q, strict=True)) <= 1) for p in rows}


def test_no_traces_give_no_clusters(spark):
    df = spark.createDataFrame([], "spot_id bigint, trace array<array<double>>")
    assert clusters.clusters(df, "spot_id", "trace", 12, 4, 0.91, 5, Scratch(spark, "t")).count() == 0


# Leaks


def test_words_are_compared_without_their_dress():
    plain = words("The cooling-rate of Zürich cafe was fine in office")
    assert words("<p>THE **cooling</b>-rate** of​ Zürich c<b>a</b>fé wаs &#102;ine in oﬃce") == plain
    assert words("an inter-\n  polation, step") == ["an", "interpolation", "step"]
    assert words("a low-\nlevel step", {"low", "level"}) == ["a", "low", "level", "step"]
    assert words(None) == [] == words(" \n") and words("5 < 6 and 7 > 3") == ["5", "6", "and", "7", "3"]


def _passages():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(60))) for i in range(12)]
    filler = lambda n: [rng.choice(vocabulary) + "x" for _ in range(n)]
    docs, want = [], set()
    for d in range(120):
        i = rng.randrange(12)
        w = items[i][1].split()
        n = rng.choice([8, 12, 15, 20, 24, 32, 60])
        at = rng.randrange(0, 61 - n)
        part, changes = w[at : at + n], rng.randrange(0, n // 8 + 1) if n >= 20 else 0
        # changes lie inside, apart from one another, so that both ends stay
        for k in sorted(rng.sample(range(1, n - 1), changes), reverse=True):
            part[k : k + 1] = rng.choice([["other"], [], [part[k], "more"]])
        if n >= 20:
            want.add((d, items[i][0]))
        docs.append((d, " ".join([*filler(rng.randrange(40)), *part, *filler(rng.randrange(40))])))
    return items, docs, want


def test_leaks_equal_the_planted_ones(spark):
    items, docs, want = _passages()
    docs += [(500, None), (501, ""), (502, items[0][1] + " " + "long " * 300_000), (503, items[1][1].upper().replace(" ", ",\n")), (None, items[2][1]), (503, items[1][1])]
    items += [(90, None), (91, "too short"), (0, items[0][1])]
    want |= {(502, 0), (503, 1)}
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit(3)).withColumn("n_words", F.lit("x"))
    q = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    for per_pass in (5000, 5):
        rows = leaks.leaks(d, q, per_pass=per_pass).collect()
        assert len(rows) == len({(r["doc_id"], r["item_id"]) for r in rows})
        assert {(r["doc_id"], r["item_id"]) for r in rows} == want
        assert all(20 <= r["n_words"] <= 60 for r in rows)
    assert leaks.leaks(d.limit(0), q).count() == 0 and leaks.leaks(d, q.limit(0)).count() == 0


def test_adjacent_changes_do_not_hide_a_stretch(spark):
    """Runs of 16 words or fewer with 2, 3 and 4 adjacent words replaced, dropped or added between them."""
    shapes = [(16, 3, 16), (16, 4, 16), (11, 1, 4, 2, 10), (8, 1, 8, 2, 8)]
    items, docs, want = [], [], {}
    for shape in shapes:
        for kind in ("replaced", "dropped", "added"):
            k, item, text = len(items), [], []
            for at, n in enumerate(shape):
                new = [f"i{k}p{at}n{m}" for m in range(n)]
                if at % 2 == 0 or kind != "added":
                    item += new
                if at % 2 == 0 or kind != "dropped":
                    text += new if at % 2 == 0 else [f"{x}other" for x in new]
            assert sum(shape[1::2]) * 8 <= len(item)
            items.append((k, " ".join(item)))
            docs.append((k, "before it " + " ".join(text) + " after it"))
            want[k, k] = len(item)
    d, q = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert {(r["doc_id"], r["item_id"]): r["n_words"] for r in leaks.leaks(d, q).collect()} == want


def test_a_stored_index_serves_other_items_without_the_texts(spark, tmp_path):
    items, docs, want = _passages()
    items.append((50, "alpha beta " * 6 + "the low level of the inter polation interpolation " + "gamma delta " * 6))
    broken = [(700, "alpha beta " * 6 + "the low-\nlevel of the inter-\n polation inter-\npolation " + "gamma delta " * 6)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(docs + broken, "doc_id bigint, text string").repartition(3).write.parquet(path)
    index = leaks.build_index(spark.read.parquet(path), Scratch(spark, "t"))
    shutil.rmtree(path)
    first, rest = items[:4], items[4:]
    got = [{(r["doc_id"], r["item_id"]): r["n_words"] for r in leaks.search(index, spark.createDataFrame(q, "item_id bigint, text string")).collect()} for q in (first, rest)]
    assert {k for g in got for k in g} == want | {(700, 50)} and got[1][700, 50] >= 27
    assert {i for _, i in got[0]} <= {i for i, _ in first}


def test_posting_lists_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 5000):
        v = (rng.random(n) * 2.0 ** rng.integers(0, 34, n)).astype(np.int64)
        data, size = leaks.packed(v)
        assert (leaks.unpacked(data) == v).all() and size.sum() == len(data)


def test_reach_equals_edit_distance():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.randrange(3) for _ in range(rng.randrange(9))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a) + 1):
            for j in range(len(b) + 1):
                table[i, j] = i + j if not i or not j else min(table[i - 1, j] + 1, table[i, j - 1] + 1, table[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
        for e, got in enumerate(leaks.reach(np.array(a, int), np.array(b, int), 4)):
            want = max((i for i in range(1, len(a) + 1) for j in range(1, len(b) + 1) if a[i - 1] == b[j - 1] and table[i - 1, j - 1] <= e), default=0)
            assert got == want


def test_phrase_matches_equal_a_scan():
    rng = np.random.default_rng(2)
    items = leaks.Items([(1, " ".join(rng.choice(list("abcd"), 30))), (2, " ".join(rng.choice(list("abcd"), 25)))])
    doc = np.repeat([0, 1, 2], 300)
    ids = np.array([items.terms.get(x, -1) for x in rng.choice(list("abcde"), 900)])
    p, s = leaks.phrase_matches(ids, doc, items)
    want = {(k, i) for k, ph in enumerate(items.phrases) for i in range(895) if doc[i] == doc[i + 5] and (ids[i : i + 6] == ph).all()}
    assert set(zip(p.tolist(), s.tolist(), strict=True)) == want and len(p) == len(want)


# Subjects


def _corpus(n=600, seed=5):
    rng = random.Random(seed)
    terms = [[f"{s}{k}term" for k in "abcdefgh"] for s in ("op", "ch", "re")]
    docs, truth = [], {}
    for d in range(n):
        mine = rng.sample(range(3), rng.choice([1, 1, 2]))
        said, lines = [], []
        for _ in range(rng.randrange(5, 14)):
            s = rng.choice([*mine, *mine, None])
            said.append(s)
            t = terms[s] if s is not None else None
            lines.append(f"The {rng.choice(t)} and the {rng.choice(t)} were checked on day {rng.randrange(9)}." if t else rng.choice(["Same as last time.", "More will follow soon.", "Nothing else was changed."]))
        truth[d] = {f"s{k}" for k in range(3) if said.count(k) / len(said) >= 0.2}
        docs.append((d, "## Notes\n" + "\n".join(f"- {x}" for x in lines) + "\n1\t2\t3\n", "note", rng.choice(["a", "b"])))
    return docs, truth


def test_subjects_of_held_out_documents(spark):
    docs, truth = _corpus()
    rng = random.Random(1)
    labels = [(d, s) for d in range(80) for s in truth[d] if rng.random() > 0.05] + [(0, "s1"), (0, "s1"), (1, None), (None, "s2"), (2, "unknown")]
    docs += [(9000, None, "note", "a"), (9001, "", None, None), (9002, " \n", "note", "a"), (9003, "The opaterm and the opbterm were checked. " * 20_000, "note", "b")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, kind string, source string").withColumn("votes", F.lit(1)).withColumn("subject_code", F.lit("x"))
    areas = spark.createDataFrame([("s0", "a"), ("s1", "b"), ("s2", "c"), (None, "d"), ("s2", "c")], "subject_code string, title string")
    lab = spark.createDataFrame(labels, "doc_id bigint, subject_code string")
    rows = subjects.subjects(d, areas, lab, Scratch(spark, "t")).collect()
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], set()).add(r["subject_code"])
        assert 0.2 <= r["share"] + 1e-9 and r["share"] <= 1
    assert len(rows) == sum(map(len, got.values())) and not {9000, 9001, 9002} & set(got) and got[9003] == {"s0"}
    held = range(80, 600)
    assert sum(got.get(i, set()) == truth[i] for i in held) / len(held) >= 0.98


def test_every_function_votes_where_it_can_tell():
    told, subjects_ = [], 3
    for i in range(60):
        k = i % subjects_
        lines = [f"## {['Lens', 'Buffer', 'Seam'][k]} report {i % 7}", f"The {'abc'[k]}term and the plain part {i} were seen.", "It is there, as the usual thing went.", f"Look at https://{['lens', 'wet', 'seam'][k]}.example.org/x{i}/file or ask someone."]
        told.append(("\n".join(lines), f"kind{i % 2}", f"folder{k}", {k}))
    labeller = subjects.Labeller(told, subjects_)
    votes = [subjects.decode(v, subjects_) for v in labeller.votes([(t, k, s) for t, k, s, _ in told])]
    for f, name in enumerate(subjects.FUNCTIONS):
        said = [(v[:, f], next(iter(s)) + 1) for v, (*_, s) in zip(votes, told, strict=True)]
        assert any(v.any() for v, _ in said), name
        assert all(set(v[v > 0]) <= {k} for v, k in said), name
    assert subjects.address_parts("https://www2.lens.example.org/a/b") == ["https://www2.lens.example.org/a/b", "@www2.lens.example.org", "@lens.example.org", "@example.org", "/a", "/b"]


def test_two_hundred_subjects(spark):
    docs = [(i, f"The {_word(i % 200)} and the {_word(i % 200)}x were checked. Both {_word(i % 200)}y are fine.", None, None) for i in range(800)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, kind string, source string")
    areas = spark.createDataFrame([(f"s{k:03}", None) for k in range(200)], "subject_code string, title string")
    labels = spark.createDataFrame([(i, f"s{i % 200:03}") for i in range(600)], "doc_id bigint, subject_code string")
    got = {(r["doc_id"], r["subject_code"]) for r in subjects.subjects(d, areas, labels, Scratch(spark, "t")).collect()}
    assert got == {(i, f"s{i % 200:03}") for i in range(800)}


def _word(k):
    return "q" + "".join("abcdefghij"[int(c)] for c in f"{k:03}")


def test_blocks_of_patterns_change_nothing():
    rng = np.random.default_rng(3)
    votes, weight = rng.integers(0, 4, (500, 5)), rng.integers(1, 50, 500).astype(float)
    assert (subjects.latent_model(votes, weight, 3) == subjects.latent_model(votes, weight, 3, at_once=37)).all()


def test_titles_and_scopes_help_where_labels_are_few(spark):
    docs, truth = _corpus()
    d = spark.createDataFrame(docs, "doc_id bigint, text string, kind string, source string")
    labels = spark.createDataFrame([(i, s) for i in range(6) for s in truth[i]], "doc_id bigint, subject_code string")
    bare = spark.createDataFrame([(f"s{k}",) for k in range(3)], "subject_code string")
    named = spark.createDataFrame([(f"s{k}", f"About {t}aterm and {t}bterm", f"Also {t}cterm, {t}dterm, {t}eterm, {t}fterm, {t}gterm.") for k, t in enumerate(("op", "ch", "re"))], "subject_code string, title string, scope string")
    right = [sum((r["doc_id"], r["subject_code"]) in {(i, s) for i, x in truth.items() for s in x} for r in subjects.subjects(d, a, labels, Scratch(spark, "t")).collect()) for a in (bare, named)]
    assert right[1] > 200 > right[0]


def test_subjects_without_labels_or_documents(spark):
    docs, _ = _corpus(5)
    d = spark.createDataFrame(docs, "doc_id bigint, text string, kind string, source string")
    areas, lab = spark.createDataFrame([("s0",)], "subject_code string"), spark.createDataFrame([(0, "s0")], "doc_id bigint, subject_code string")
    for a, b, c in ((d.limit(0), areas, lab), (d, areas, lab.limit(0)), (d, areas.limit(0), lab)):
        assert subjects.subjects(a, b, c, Scratch(spark, "t")).count() == 0


def test_sentences():
    text = "## Head\n1. First one is here. Second, at 2.5 mm, too!\n10:20:30 WARN Could you look at it? The one here broke.\nThanks\nx\t3 a b.\nQ: is it so? A: it is not.\n"
    assert [s for s, _ in subjects.sentences(text)] == ["first one is here.", "second, at 2.5 mm, too!", "could you look at it? the one here broke.", "q: is it so? a: it is not."]
    assert subjects.sentences(None) == [] and {h for _, h in subjects.sentences(text)} == {"head"}


def test_terms_are_counted_once_per_document_and_label():
    parsed = subjects.Parsed(np.array([3, 1, 0]), np.array([3, 2, 3, 2]), pa.array(["a", "b", "a", "a", "b", "b", "c", "b", "a", "b"]), np.zeros(4, np.int64))
    label = np.array([1, 1, 0, -1])
    got = {(r["kind"], r["term"], r["subject"]): r["n"] for r in subjects.term_counts(parsed, label).to_pylist()}
    words = {(0, "a", 1): 1, (0, "b", 1): 1, (0, "b", 0): 1, (0, "c", 0): 1}
    phrases = {(1, "a b", 1): 1, (1, "b a", 1): 1, (1, "b c", 0): 1, (1, "c b", 0): 1}
    assert got == words | phrases | {(2, "", 1): 1, (2, "", 0): 1}
    assert subjects.term_counts(subjects.Parsed(np.array([0]), np.empty(0, np.int64), pa.array([], pa.string()), np.empty(0, np.int64)), np.empty(0, np.int64)).num_rows == 0
