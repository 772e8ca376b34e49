"""Subject areas of documents (problem 10): labelling functions and a latent model that learns their accuracies.

Five labelling functions vote on each sentence, or abstain: its words, its phrases, addresses in it (whole, hosts and steps of paths), its
section (heading, words of the heading, kind of document) and the source. Their lexicons are fitted on a bounded sample of labelled
documents and on the titles and scopes of the subjects; those of words and phrases then once more on all sentences of the corpus, by the
subjects found so far. The votes of all sentences of the corpus are counted by vote pattern; on these counts EM learns, without labels, how often each function
abstains and how often it is right, for sentences of a subject and for those of none. A document's subjects are those that
at least a share of its sentences most probably treat.
"""

from __future__ import annotations

import copy
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotloom.llm.text import folded
from spotloom.session import Scratch

#: Labelled documents the lexicons are fitted on, at most: chosen by a hash of their id.
LABELLED = 4000
#: Share of a document's sentences.
SHARE = 0.2
#: Least labelled documents with a term, pseudo-count, least divergence of its subjects from the usual ones in documents and
#: in sentences (as a share of the largest there can be), rounds of re-estimation, usual share of stray sentences.
LEAST, SMOOTH, IN_DOCS, IN_SENTENCES, ROUNDS, STRAY = 2, 3.0, 0.14, 0.23, 4, 0.15
#: Least divergence of a term over the documents of the corpus, and the share of them and the number in which it must occur at least.
IN_CORPUS, CORPUS_SHARE, CORPUS_LEAST = 0.4, 1e-5, 5
#: Documents that are read together, and rows of counts that a task holds.
DOCUMENTS_AT_ONCE, COUNTS_AT_ONCE = 2048, 2_000_000
FUNCTIONS = ("words", "phrases", "addresses", "section", "source")
#: Patterns up to which their table is broadcast.
PATTERNS = 1_000_000
#: How often, at least, words and phrases abstain on a sentence of no subject: a telling term is seldom there by chance.
QUIET = 0.97

_ITEM = regex.compile(r"^\s*(?:>+\s*)?(?:\d{1,2}:\d{2}(?::\d{2})?\s+(?:[a-z]{3,8}\s+)?|\(?\d+[.)]\s+|[-*•+]\s+)+")
_HEADING = regex.compile(r"^\s*#+\s*(.*)$")
_END = re.compile(r"([.?!…])[\"'»”)]*\s+")
_CLOSING = "\"'»”)" + "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_ANSWER = regex.compile(r"^(?:a:|the ones? )")
_NAME = re.compile(r"[^\W\d_]+")
_ENDS = frozenset(".?!…")
#: Bytes of plain sentences that stand in words; all others become blanks.
_LETTERS = bytes(b if chr(b).isalpha() and b < 128 else 32 for b in range(256))
_TWO_NAMES = re.compile(r"[^\W\d_][\W\d_]+[^\W\d_]")
_ADDRESS = regex.compile(r"(?:https?://|www\.)[^\s/]+|[\w.+-]+@[\w-]+\.[\w.-]+|(?:/[\w.-]+){2,}")


def sentences(text: str | None) -> list[tuple[str, str]]:
    """(sentence, heading above it) of a whole text. A sentence ends with a full stop, question or exclamation mark and has two
    words at least; list marks and times before it are no part of it; headings, greetings, table rows and
    other lines without an end are none. An answer, or a follow-up that only refers ("the one ..."), belongs to its question."""
    out: list[tuple[str, str]] = []
    heading = ""
    for line in folded(text).split("\n") if text else ():
        if not line.strip():
            continue
        if m := _HEADING.match(line):
            heading = m.group(1).strip()
            continue
        if "\t" in line or "|" in line:
            continue
        asked = False
        line, at = _ITEM.sub("", line).strip(), 0
        ends = [(m.end(1), m.end()) for m in _END.finditer(line)]
        for end, after in (*ends, (len(line), 0)):
            s, at = line[at:end], after
            if s.rstrip(_CLOSING)[-1:] not in _ENDS or not _TWO_NAMES.search(s):
                continue
            if asked and _ANSWER.match(s):
                out[-1] = (f"{out[-1][0]} {s}", heading)
            else:
                out.append((s, heading))
            asked = s.rstrip("\"'»”) ").endswith("?")
    return out


def address_parts(address: str) -> list[str]:
    """An address, its host or mail domain and the domains above it but the last, and the steps of its path."""
    head, _, path = address.removeprefix("https://").removeprefix("http://").removeprefix("www.").partition("/")
    host = head.rpartition("@")[2].split(".")
    return [address, *(f"@{'.'.join(host[k:])}" for k in range(len(host) - 1)), *(f"/{step}" for step in path.split("/") if step)]


def addresses(sentence: str) -> list[str]:
    found = _ADDRESS.findall(sentence) if "/" in sentence or "@" in sentence or "www." in sentence else []
    return list(dict.fromkeys(p for a in found for p in address_parts(a)))


def section(heading: str, kind: str | None) -> list[str]:
    out = [f"kind {kind}"] if kind else []
    return [*out, f"heading {heading}", *dict.fromkeys(_NAME.findall(heading))] if heading else out


class Lexicon:
    """Log odds of the subjects for each telling term of one kind."""

    def __init__(self) -> None:
        self.odds: dict[str, np.ndarray] = {}

    @staticmethod
    def told(counts: np.ndarray, usual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Smoothed shares of the subjects for rows of counts, and their divergence from the usual shares, 1 at most or so."""
        p = (counts + SMOOTH * usual) / (counts.sum(1, keepdims=True) + SMOOTH)
        return p, (p * np.log(p / usual)).sum(1) / np.log(max(2, len(usual)))

    def fit(self, names: list[str], counts: np.ndarray, usual: np.ndarray, least: float) -> None:
        if names:
            p, d = self.told(counts, usual)
            odds = np.log(p / usual) * np.minimum(1, 2 * d)[:, None]
            self.odds = {names[i]: odds[i] for i in np.flatnonzero(d > least)}

    def score(self, terms: list[str]) -> np.ndarray | None:
        hits = [self.odds[t] for t in terms if t in self.odds]
        return sum(hits[1:], hits[0]) if hits else None


def _counted(rows: list[tuple[list[str], np.ndarray]], subjects: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    index: dict[str, int] = {}
    at, who = [], []
    for r, (terms, _) in enumerate(rows):
        for t in terms:
            at.append(index.setdefault(t, len(index)))
            who.append(r)
    counts, n = np.zeros((len(index), subjects)), np.zeros(len(index))
    if at:
        np.add.at(counts, at, np.array([v for _, v in rows])[who])
        np.add.at(n, at, 1)
    return list(index), counts, n


@dataclass
class Parsed:
    """Documents in columns: sentences of each document, words of each sentence, these words, and a number per sentence. Words are kept
    as one text per document, which is cheaper to store than a list."""

    lengths: np.ndarray
    sizes: np.ndarray
    words: pa.Array
    fixed: np.ndarray
    texts: pa.Array | None = None


def _sums(sentence: np.ndarray, row: np.ndarray, odds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of odds over the different rows of each of n sentences, and which sentences have any."""
    total, some = np.zeros((n, odds.shape[1])), np.zeros(n, bool)
    if len(row):
        key = np.unique(sentence * len(odds) + row)
        sentence, row = key // len(odds), key % len(odds)
        first = np.flatnonzero(np.r_[True, sentence[1:] != sentence[:-1]])
        total[sentence[first]] = np.add.reduceat(odds[row], first, axis=0)
        some[sentence[first]] = True
    return total, some


class Terms:
    """Words and phrases of two lexicons as sorted arrays, so that whole columns of words are looked up at once."""

    def __init__(self, words: Lexicon, phrases: Lexicon, subjects: int):
        self.words, self.word_odds = pa.array(list(words.odds), pa.string()), np.array(list(words.odds.values())).reshape(-1, subjects)
        pairs = [t.split(" ") for t in phrases.odds]
        names = sorted({x for p in pairs for x in p})
        number = {x: i for i, x in enumerate(names)}
        keys = np.array([number[x] * len(names) + number[y] for x, y in pairs], np.int64)
        order = np.argsort(keys)
        self.names, self.keys, self.pair_odds = pa.array(names, pa.string()), keys[order], np.array(list(phrases.odds.values())).reshape(-1, subjects)[order]

    def scores(self, parsed: Parsed) -> list[tuple[np.ndarray, np.ndarray]]:
        """For words and for phrases: the score of each subject in each sentence, and which sentences have a term."""
        n, sentence = len(parsed.sizes), np.repeat(np.arange(len(parsed.sizes)), parsed.sizes)
        coded = parsed.words.dictionary_encode()
        at, names = np.asarray(coded.indices).astype(np.int64), coded.dictionary
        find = lambda known: np.asarray(pc.fill_null(pc.index_in(names, value_set=known), -1)).astype(np.int64)[at]
        row = find(self.words)
        out = [_sums(sentence[row >= 0], row[row >= 0], self.word_odds, n)]
        name = find(self.names)
        both = np.flatnonzero((sentence[1:] == sentence[:-1]) & (name[1:] >= 0) & (name[:-1] >= 0))
        key = name[both] * len(self.names) + name[both + 1]
        place = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
        hit = self.keys[place] == key if len(self.keys) else np.zeros(len(key), bool)
        return [*out, _sums(sentence[both[hit]], place[hit], self.pair_odds, n)]


def term_counts(parsed: Parsed, label: np.ndarray) -> pa.Table:
    """kind (0: word, 1: phrase, 2: nothing but the label), term, subject, n: in how many documents a term occurs in a sentence of a label, so
    that no long or repetitive text outweighs others. Sentences of label -1 do not count."""
    sentence = np.repeat(np.arange(len(parsed.sizes)), parsed.sizes)
    doc = np.repeat(np.arange(len(parsed.lengths)), parsed.lengths)
    coded = parsed.words.dictionary_encode()
    at, names = np.asarray(coded.indices).astype(np.int64), coded.dictionary
    kept = label[sentence] >= 0
    pair = np.flatnonzero((sentence[1:] == sentence[:-1]) & kept[1:])
    said = np.flatnonzero(label >= 0)
    every = max(1, len(names))
    tables = []
    for kind, (s, term) in enumerate(((sentence[kept], at[kept]), (sentence[pair], at[pair] * every + at[pair + 1]), (said, np.zeros(len(said), np.int64)))):
        d, k = doc[s], label[s]
        order = np.lexsort((d, k, term))
        term, k, d = term[order], k[order], d[order]
        other = np.r_[True, (term[1:] != term[:-1]) | (k[1:] != k[:-1])] if len(term) else np.zeros(0, bool)
        new = other | np.r_[True, d[1:] != d[:-1]] if len(term) else other
        first = np.flatnonzero(other)
        n = np.add.reduceat(new.astype(np.int64), first) if len(first) else np.empty(0, np.int64)
        term, k = term[first], k[first]
        if kind == 2:
            text = pa.array([""] * len(n), pa.string())
        else:
            text = names.take(pa.array(term)) if kind == 0 else pc.binary_join_element_wise(names.take(pa.array(term // every)), names.take(pa.array(term % every)), " ")
        tables.append(pa.table({"kind": pa.array(np.full(len(n), kind, np.int32)), "term": text.cast(pa.string()), "subject": pa.array(k.astype(np.int32)), "n": pa.array(n.astype(np.int64))}))
    return pa.concat_tables(tables)


class Labeller:
    """The labelling functions, fitted on labelled documents (text, kind, source, set of subject numbers)."""

    def __init__(self, docs: list[tuple[str | None, str | None, str | None, set[int]]], subjects: int):
        self.subjects, self._terms = subjects, None
        marks = np.array([[k in s for k in range(subjects)] for *_, s in docs], float).reshape(-1, subjects)
        self.usual = (marks.sum(0) + 1) / (marks.sum() + subjects)
        share = marks / np.maximum(1, marks.sum(1, keepdims=True))
        self.lexicons = {f: Lexicon() for f in FUNCTIONS}
        parts = [[self.parts(s, h, kind, source) for s, h in sentences(t)] for t, kind, source, _ in docs]
        for f, name in enumerate(FUNCTIONS):
            names, counts, n = _counted([(list({t for p in ps for t in p[f]}), v) for ps, v in zip(parts, share, strict=True)], subjects)
            keep = np.flatnonzero(n >= LEAST)
            self.lexicons[name].fit([names[i] for i in keep], counts[keep], self.usual, IN_DOCS)
        # sentences of a labelled document mostly treat its labels: sharpen the words and phrases sentence by sentence
        every = [p for ps in parts for p in ps]
        prior = np.log(STRAY * self.usual + (1 - STRAY) * np.repeat(share, [len(ps) for ps in parts], axis=0)).reshape(-1, subjects)
        known = [list(self.lexicons[f].odds) for f in FUNCTIONS[:2]]
        met = []  # which known terms stand in which sentences
        for f in (0, 1):
            number = {t: i for i, t in enumerate(known[f])}
            met.append(np.array([(r, i) for r, p in enumerate(every) for t in p[f] if (i := number.get(t)) is not None], np.int64).reshape(-1, 2))
        for _ in range(ROUNDS):
            score, some = prior.copy(), np.zeros(len(every), bool)
            for f in (0, 1):
                odds = self.lexicons[FUNCTIONS[f]].odds
                table = np.array([odds.get(t, np.zeros(subjects)) for t in known[f]]).reshape(-1, subjects)
                told = np.array([t in odds for t in known[f]], bool)
                np.add.at(score, met[f][:, 0], table[met[f][:, 1]])
                some[met[f][told[met[f][:, 1]], 0]] = True
            x = np.exp(score - score.max(1, keepdims=True)) if len(score) else score
            x /= x.sum(1, keepdims=True)
            for f in (0, 1):
                row, term = met[f][some[met[f][:, 0]]].T
                counts, n = np.zeros((len(known[f]), subjects)), np.bincount(term, minlength=len(known[f]))
                np.add.at(counts, term, x[row])
                keep = np.flatnonzero(n >= LEAST)
                self.lexicons[FUNCTIONS[f]].fit([known[f][i] for i in keep], counts[keep], self.usual, IN_SENTENCES)

    @staticmethod
    def parts(sentence: str, heading: str, kind: str | None, source: str | None) -> tuple[list[str], ...]:
        """What each function looks at: words, phrases of two words, addresses, section, source."""
        w = _NAME.findall(sentence)
        return list(dict.fromkeys(w)), list(dict.fromkeys(f"{a} {b}" for a, b in pairwise(w))), addresses(sentence), section(heading, kind), [source] if source else []

    def parse(self, docs: list[tuple[str | None, str | None, str | None]]) -> Parsed:
        """Documents (text, kind, source) as the words of their sentences, with the votes of the functions that do not look at words."""
        sizes, texts, fixed, lengths = [], [], [], []
        base = self.subjects + 1

        def vote(name: str, terms: list[str]) -> int:
            score = self.lexicons[name].score(terms)
            return 0 if score is None else int((score + np.log(self.usual)).argmax()) + 1

        able = [bool(self.lexicons[f].odds) for f in FUNCTIONS]
        for text, kind, source in docs:
            from_source = vote("source", [source]) if source and able[4] else 0
            headings: dict[str, int] = {}
            words: list[str] = []
            said = sentences(text)
            lengths.append(len(said))
            for s, h in said:
                w = s.encode().translate(_LETTERS).decode().split() if s.isascii() else _NAME.findall(s)
                sizes.append(len(w))
                words += w
                if able[3] and h not in headings:
                    headings[h] = vote("section", section(h, kind))
                address = vote("addresses", addresses(s)) if able[2] else 0
                fixed.append((address * base + headings.get(h, 0)) * base + from_source)
            texts.append(" ".join(words) or None)
        column = pa.array(texts, pa.string())
        return Parsed(np.array(lengths, np.int64), np.array(sizes, np.int64), pc.split_pattern(column, " ").flatten(), np.array(fixed, np.int64), column)

    def codes(self, parsed: Parsed) -> np.ndarray:
        """A number per sentence: the votes as digits to the base subjects + 1, 0 for an abstention."""
        code = np.zeros(len(parsed.sizes), np.int64)
        for score, some in self.terms().scores(parsed):
            code = code * (self.subjects + 1) + np.where(some, (score + np.log(self.usual)).argmax(1) + 1, 0)
        return code * (self.subjects + 1) ** (len(FUNCTIONS) - 2) + parsed.fixed

    def terms(self) -> Terms:
        if self._terms is None:
            self._terms = Terms(self.lexicons["words"], self.lexicons["phrases"], self.subjects)
        return self._terms

    def votes(self, docs: list[tuple[str | None, str | None, str | None]]) -> list[np.ndarray]:
        """The codes of each document."""
        parsed = self.parse(docs)
        return np.split(self.codes(parsed), np.cumsum(parsed.lengths)[:-1])

    def taught(self, told: list[tuple[int, str, list[tuple[int, int]]]], usual: np.ndarray) -> Labeller:
        """A labeller whose words and phrases have new lexicons, from counts of documents: (0 for a word or 1, term, [(subject, n), ...]).
        Terms that are not among them stay as they are."""
        out = copy.copy(self)
        out.usual, out._terms, out.lexicons = usual, None, dict(self.lexicons)
        for f in (0, 1):
            terms = [(t, c) for k, t, c in told if k == f]
            counts = np.zeros((len(terms), self.subjects))
            for i, (_, c) in enumerate(terms):
                for k, n in c:
                    counts[i, k] = n
            old, new = self.lexicons[FUNCTIONS[f]].odds, Lexicon()
            new.fit([t for t, _ in terms], counts, usual, 0.0)
            d = Lexicon.told(counts, usual)[1]
            new.odds = {t: new.odds[t] for (t, _), x in zip(terms, d, strict=True) if x > (IN_SENTENCES if t in old else IN_CORPUS)}
            seen = {t for t, _ in terms}
            new.odds |= {t: v for t, v in old.items() if t not in seen}
            out.lexicons[FUNCTIONS[f]] = new
        return out


def decode(codes: np.ndarray, subjects: int) -> np.ndarray:
    """Vote patterns as a matrix of votes."""
    base = subjects + 1
    return np.stack([codes // base**i % base for i in reversed(range(len(FUNCTIONS)))], 1)


def latent_model(votes: np.ndarray, weight: np.ndarray, subjects: int, rounds: int = 40, at_once: int = 65536) -> np.ndarray:
    """The most probable class of each vote pattern (0: none, else the number of the subject), by EM over the patterns and their counts.

    Of each function it learns the rate of abstention for sentences of no subject and of any, its accuracy where there
    is a subject, and what it votes where there is none; and how common each class is. Nothing here knows a label.
    """
    m = votes.shape[1]
    none_silent, some_silent, right = np.full(m, 0.5), np.full(m, 0.5), np.full(m, 0.6)
    none_silent[:2], some_silent[:2], right[:2] = QUIET, 0.1, 0.9
    stray = np.full((m, subjects), 1 / subjects)
    prior = np.r_[0.3, np.full(subjects, 0.7 / subjects)]

    def posterior(votes: np.ndarray) -> np.ndarray:
        logp = np.tile(np.log(prior), (len(votes), 1))
        for j in range(m):
            v, silent = np.maximum(votes[:, j] - 1, 0), votes[:, j] == 0
            logp[:, 0] += np.where(silent, np.log(none_silent[j]), np.log1p(-none_silent[j]) + np.log(stray[j, v]))
            hit = np.log1p(-some_silent[j]) + np.where(votes[:, j, None] == np.arange(1, subjects + 1), np.log(right[j]), np.log((1 - right[j]) / max(1, subjects - 1)))
            logp[:, 1:] += np.where(silent[:, None], np.log(some_silent[j]), hit)
        post = np.exp(logp - logp.max(1, keepdims=True))
        return post / post.sum(1, keepdims=True)

    blocks = [slice(i, i + at_once) for i in range(0, len(votes), at_once)]  # many patterns need no large matrix
    for _ in range(rounds):
        classes, spoke, hits = np.zeros(subjects + 1), np.zeros((m, 2)), np.zeros(m)
        strays = np.zeros((m, subjects))
        for part in blocks:
            v = votes[part]
            w = posterior(v) * weight[part, None]
            none, some = w[:, 0], w[:, 1:].sum(1)
            classes += w.sum(0)
            for j in range(m):
                said = v[:, j] > 0
                spoke[j] += none[said].sum(), some[said].sum()
                hits[j] += w[np.flatnonzero(said), v[said, j]].sum()
                strays[j] += np.bincount(v[said, j] - 1, none[said], subjects)
        none, some = classes[0], classes[1:].sum()
        prior = (classes + 1) / (classes.sum() + subjects + 1)
        for j in range(m):
            none_silent[j] = np.clip((none - spoke[j, 0] + 1) / (none + 2), QUIET if j < 2 else 0.01, 0.99)
            some_silent[j] = np.clip((some - spoke[j, 1] + 1) / (some + 2), 0.01, 0.99)
            right[j] = np.clip((hits[j] + 1) / (spoke[j, 1] + 2), 1 / subjects, 0.99)
            if j >= 2:  # a chance hit of a telling term favours no subject
                stray[j] = (strays[j] + 1) / (spoke[j, 0] + subjects)
    return np.concatenate([posterior(votes[part]).argmax(1) for part in blocks]) if blocks else np.zeros(0, int)


def singular(word: str) -> str:
    """An English word without the ending of its plural."""
    return f"{word[:-3]}y" if word.endswith("ies") else word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def described(*texts: str | None) -> str:
    """The title and scope of a subject as a text of sentences, and once more its words in the singular."""
    said = [f"{t.strip().rstrip('.')}." for t in texts if t and t.strip()]
    return "\n".join([*said, *(f"{' '.join(map(singular, _NAME.findall(t.lower())))}." for t in said)])


def subjects(docs: DataFrame, areas: DataFrame, labels: DataFrame, scratch: Scratch, share: float = SHARE, labelled: int = LABELLED) -> DataFrame:
    """(doc_id, subject_code, share): subjects that at least `share` of a document's sentences treat.

    docs: doc_id, text, kind, source; areas: subject_code (the closed list of subjects), title and scope if they are there, which count like
    LEAST labelled documents; labels: doc_id, subject_code, of which
    at most `labelled` documents are used. Whole texts are read. Null and empty texts, and texts without a sentence, give no row;
    neither do subjects outside the list. Without any usable label no function can vote, and there are no rows.
    The list of subjects is read to the driver, and the patterns of votes: no more than the documents' sentences show, and no more than
    (subjects + 1)^5.
    """
    more = [c for c in ("title", "scope") if c in areas.columns]
    texts = areas.select("subject_code", *more).where("subject_code is not null").distinct().sort("subject_code", *more).collect()
    codes = sorted({r[0] for r in texts})
    number = {c: k for k, c in enumerate(codes)}
    marked = labels.where(F.col("subject_code").isin(codes)).groupBy("doc_id").agg(F.collect_set("subject_code").alias("subject_codes"))
    picked = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    sample = docs.select("doc_id", "text", "kind", "source").join(F.broadcast(picked), "doc_id").orderBy("doc_id", "text", "kind", "source")
    told = [(t, k, s, {number[c] for c in cs}) for _, t, k, s, cs in sample.toLocalIterator()]
    if told:
        told += [(described(*r[1:]), None, None, {number[r[0]]}) for r in texts] * LEAST
    labeller = Labeller(told, max(1, len(codes)))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, DOCUMENTS_AT_ONCE):
                b = whole.slice(first, DOCUMENTS_AT_ONCE)
                p = labeller.parse(list(zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True)))
                ends = np.r_[0, np.cumsum(p.lengths)]
                listed = lambda v, ends=ends: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v))
                yield pa.RecordBatch.from_arrays([b.column(0), listed(p.sizes.astype(np.int32)), p.texts, listed(p.fixed), listed(labeller.codes(p))], names=["doc_id", "sizes", "words", "fixed", "votes"])

    parsed = scratch.save(docs.where("doc_id is not null").select("doc_id", "text", "kind", "source").mapInArrow(read, f"doc_id {kind}, sizes array<int>, words string, fixed array<bigint>, votes array<bigint>"))
    code, n, best = _classes(parsed, len(codes))
    labeller, parsed = _from_corpus(parsed, labeller, code, n, best, scratch)
    code, n, best = _classes(parsed, len(codes))
    table = docs.sparkSession.createDataFrame([(int(c), codes[k - 1]) for c, k in zip(code, best, strict=True) if k], "code bigint, subject_code string")
    told = parsed.select("doc_id", F.size("votes").alias("n"), F.explode("votes").alias("code")).join(F.broadcast(table) if len(code) <= PATTERNS else table, "code")
    shares = told.groupBy("doc_id", "subject_code", "n").agg((F.count(F.lit(1)) / F.col("n")).alias("share"))
    return shares.where(F.col("share") >= share - 1e-9).select("doc_id", "subject_code", "share")


def _classes(voted: DataFrame, subjects: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vote patterns in ascending order, how many sentences show each, and its most probable class."""
    patterns = voted.select(F.explode("votes").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n")).orderBy("code").collect()
    code, n = np.array([r["code"] for r in patterns], np.int64), np.array([r["n"] for r in patterns], float)
    return code, n, latent_model(decode(code, subjects), n, subjects) if len(code) and subjects else np.zeros(len(code), int)


def _column(b: pa.RecordBatch) -> Parsed:
    sizes = b.column("sizes")
    return Parsed(np.asarray(sizes.value_lengths()).astype(np.int64), np.asarray(sizes.flatten()).astype(np.int64), pc.split_pattern(b.column("words"), " ").flatten(), np.asarray(b.column("fixed").flatten()))


def _from_corpus(parsed: DataFrame, labeller: Labeller, code: np.ndarray, n: np.ndarray, best: np.ndarray, scratch: Scratch) -> tuple[Labeller, DataFrame]:
    """The labeller with lexicons from all sentences of the corpus, and the table with its votes.

    Each sentence gets the subject that its terms and the subjects of its document (the classes of its sentences' votes) make most
    probable; sentences of documents without any do not count. In how many documents a term occurs in sentences of each subject is counted over
    the whole corpus, and terms that are telling and not too rare make the new lexicons: at most the terms of a document / CORPUS_SHARE.
    """
    subjects = labeller.subjects
    if not len(code) or not best.any():
        return labeller, parsed

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def merged() -> list[pa.RecordBatch]:
            t = pa.concat_tables(held).group_by(["kind", "term", "subject"]).aggregate([("n", "sum")])
            return t.select(["kind", "term", "subject", "n_sum"]).rename_columns(["kind", "term", "subject", "n"]).combine_chunks().to_batches()

        for whole in batches:
            for first in range(0, whole.num_rows, DOCUMENTS_AT_ONCE):
                b = whole.slice(first, DOCUMENTS_AT_ONCE)
                p = _column(b)
                doc = np.repeat(np.arange(len(p.lengths)), p.lengths)
                of = best[np.searchsorted(code, np.asarray(b.column("votes").flatten()))]
                share = np.zeros((len(p.lengths), subjects))
                np.add.at(share, (doc[of > 0], of[of > 0] - 1), 1)
                some = share.sum(1) > 0
                share = share / np.maximum(1, share.sum(1, keepdims=True))
                score = np.log(STRAY * labeller.usual + (1 - STRAY) * share)[doc] + sum(x for x, _ in labeller.terms().scores(p))
                held.append(term_counts(p, np.where(some[doc], score.argmax(1), -1)))
                if sum(t.num_rows for t in held) > COUNTS_AT_ONCE:
                    yield from merged()
                    held = []
        if held:
            yield from merged()

    counts = parsed.select("sizes", "words", "fixed", "votes").mapInArrow(counted, "kind int, term string, subject int, n bigint").groupBy("kind", "term", "subject").agg(F.sum("n").alias("n"))
    counts = scratch.save(counts)
    classes = np.zeros(subjects)
    for r in counts.where("kind = 2").collect():
        classes[r["subject"]] = r["n"]
    usual = ((classes + 1) / (classes.sum() + subjects) + labeller.usual) / 2  # a subject that is not found yet keeps its share of the labels
    terms = counts.where("kind < 2").groupBy("kind", "term").agg(F.sum("n").alias("n"), F.collect_list(F.struct("subject", "n")).alias("by"))  # a list holds each subject once
    u, all_ = F.array(*(F.lit(float(x)) for x in usual)), F.col("n") + SMOOTH
    part = lambda c: (F.get(u, c["subject"]) * SMOOTH + c["n"]) / all_
    none = lambda c: F.get(u, c["subject"]) * SMOOTH / all_
    gain = F.aggregate("by", F.lit(0.0), lambda s, c: s + part(c) * F.ln(part(c) / F.get(u, c["subject"])) - none(c) * F.ln(SMOOTH / all_))
    divergence = (gain + SMOOTH / all_ * F.ln(SMOOTH / all_)) / float(np.log(max(2, subjects)))
    old = [(f, t) for f in (0, 1) for t in labeller.lexicons[FUNCTIONS[f]].odds]  # as many as a bounded sample has
    old = parsed.sparkSession.createDataFrame(old, "kind int, term string").withColumn("old", F.lit(True))
    terms = terms.where(F.col("n") >= max(CORPUS_LEAST, CORPUS_SHARE * classes.sum())).withColumn("telling", divergence > IN_CORPUS - 1e-9)
    telling = terms.join(F.broadcast(old), ["kind", "term"], "left").where("telling or old").orderBy("kind", "term").collect()
    taught = labeller.taught([(r["kind"], r["term"], [(c["subject"], c["n"]) for c in r["by"]]) for r in telling], usual)

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, DOCUMENTS_AT_ONCE):
                b = whole.slice(first, DOCUMENTS_AT_ONCE)
                p = _column(b)
                votes = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(p.lengths)], pa.int32()), pa.array(taught.codes(p)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), votes], names=["doc_id", "votes"])

    kind = parsed.schema["doc_id"].dataType.simpleString()
    return taught, scratch.save(parsed.select("doc_id", "sizes", "words", "fixed").mapInArrow(voted, f"doc_id {kind}, votes array<bigint>"))
