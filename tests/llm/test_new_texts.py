"""Periodic runs, SentencePiece ids and fill-in-the-middle against plain Python on whole tables and odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from panelspark.llm import fill_in_middle, queries, runs, sentence_pieces
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- runs


def plain_runs(w, least=6, power=4):
    """All runs by comparing the words q apart, for every q; those of a smaller period are left out."""
    found = []
    for q in range(1, len(w) // power + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if (length := j - i + q) >= max(least, power * q) and j > i:
                if not any(all(w[k] == w[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def repeated_tail(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not w or doc_id is None:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def plain_row(doc_id, text):
    w = repeated_tail(doc_id, brute.words(text))
    found = plain_runs(w)
    best = None
    for s, n, p in found:
        if best is None or n * best[2] > best[1] * p:
            best = (s, n, p)
    dropped = {i for s, n, p in found for i in range(s + p, s + n)}
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    rest = " ".join(x for i, x in enumerate(w) if i not in dropped)
    tops = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *tops, digest(lines), digest(rest))


def some_texts(seed, many):
    rng = random.Random(seed)
    for _ in range(many):
        k = rng.choice([1, 2, 2, 3, 5, 30])
        w = [rng.randrange(k) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            unit = [rng.randrange(k) for _ in range(rng.randint(1, 7))]
            at = rng.randint(0, len(w))
            w[at:at] = unit * rng.randint(3, 6) + unit[: rng.randint(0, len(unit))]
        yield w


@pytest.mark.parametrize("seed", range(5))
def test_runs_equal_plain_search(seed):
    texts = list(some_texts(seed, 60))
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    got = list(zip(*(x.tolist() for x in runs.find_runs(np.array([x for t in texts for x in t], np.int64), doc)), strict=True))
    expected, at = [], 0
    for t in texts:
        expected += [(s + at, n, p) for s, n, p in plain_runs(t)]
        at += len(t)
    assert got == expected


def test_grammar_derives_the_texts_and_no_pair_is_left_twice():
    texts = [t for t in some_texts(9, 40) if t]
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    w = np.array([x for t in texts for x in t], np.int64)
    g = runs.Grammar(doc * 100 + w, doc)
    # Every place of a nonterminal reads like its first place, and every place between two words of a text is some boundary.
    bounds = set()
    for rule, place in zip(g.rule_of.tolist(), g.place.tolist(), strict=True):
        s, m, e = g.start[rule], g.middle[rule], g.end[rule]
        assert (w[s:e] == w[place : place + e - s]).all() and doc[place] == doc[place + e - s - 1]
        bounds.add(place + m - s)
    assert bounds == set((np.flatnonzero(doc[1:] == doc[:-1]) + 1).tolist())


def test_highly_repetitive_texts():
    fib = ["a", "a b"]
    while len(fib[-1]) < 20_000:
        fib.append(fib[-1] + " " + fib[-2])
    long_period = " ".join(str(i) for i in range(2_000)) + " "
    texts = ["w " * 50_000, fib[-1], long_period * 20, "x y " * 9 + "x"]
    n, found, best, rest = runs._results(pa.array(texts), 6, 4)
    assert found[0].as_py() == [{"start": 0, "length": 50_000, "period": 1}] and rest[0].as_py() == "w"
    assert found[1].as_py() == []  # a Fibonacci word has no fourth power
    assert found[2].as_py() == [{"start": 0, "length": 40_000, "period": 2_000}] and rest[2].as_py() == long_period.strip()
    assert best[3].as_py() == {"start": 0, "length": 19, "period": 2} and n.to_pylist()[3] == 19


def test_op11_equals_plain_version(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r) for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert set(got) == set(docs)
    short = [i for i, t in docs.items() if len(brute.words(t)) < 900]
    assert len(short) > len(docs) * 0.8
    for i in short:
        assert got[i] == plain_row(i, docs[i])
    assert sum(r[1] > 0 for r in got.values()) > 0.08 * len(docs)


def test_runs_on_odd_rows(odd_docs, no_docs, odd_rows):
    got = sorted(odd_docs.transform(runs.periodic_runs).collect(), key=repr)
    expected = []
    for doc_id, text, *_ in odd_rows:
        w = brute.words(text)
        if len(w) > 10_000:
            found = [(0, 30_000, 1)]
        else:
            found = plain_runs(w)
        dropped = {i for s, n, p in found for i in range(s + p, s + n)}
        expected.append((doc_id, len(w), found, " ".join(x for i, x in enumerate(w) if i not in dropped)))
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=repr) == sorted(expected, key=repr)
    assert runs.periodic_runs(no_docs).collect() == []


def test_smaller_powers_are_refused():
    with pytest.raises(ValueError):
        runs.find_runs(np.zeros(9, np.int64), np.zeros(9, np.int64), 6, 2)


# ---------------------------------------------------------------- SentencePiece


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.default_model())


def test_op12_equals_the_library(spark, library):
    expected = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_eos=True)
        expected.add((r.doc_id, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids))))
    assert {tuple(r) for r in queries.op12_sentence_pieces(spark, SF).collect()} == expected


def test_ids_on_odd_rows(odd_docs, no_docs, odd_rows, library):
    got = sentence_pieces.decode(sentence_pieces.encode(odd_docs)).collect()
    expected = [(r[0], library.encode(r[1] or "", add_eos=True)) for r in odd_rows]
    assert sorted(((r.doc_id, r.ids) for r in got), key=repr) == sorted(expected, key=repr)
    assert all(r.decoded == library.decode(r.ids) for r in got)
    assert sentence_pieces.decode(sentence_pieces.encode(no_docs)).collect() == []


@pytest.mark.parametrize("memory", [0, 50, 10**6])
def test_ids_of_random_texts(library, memory):
    """Markers, runs of blanks, line breaks and the cut character in any place; also when words are forgotten."""
    rng = random.Random(memory)
    parts = ["a", "b", " ", "  ", "\n", "▁", "\x1f", "é", "\U0001f600", "the", "ing", "<s>", "</s>", "<0x0A>", "\t", "\x00", "zz9", "漢", "　", "\r\n"]
    segmenter = sentence_pieces.Segmenter(sentence_pieces.default_model(), memory)
    for _ in range(20):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(100)] + [None, ""]
        ids, places = segmenter.batch(pa.array(texts, pa.string()))
        got = [ids[a:b].tolist() for a, b in zip(places[:-1], places[1:], strict=True)]
        assert got == library.encode([t or "" for t in texts], add_eos=True)


# ---------------------------------------------------------------- fill-in-the-middle


def test_skip_list_finds_every_rank():
    rng = random.Random(3)
    for n in [0, 1, 2, 3, 7, 64, 500]:
        widths = np.array([rng.randint(1, 9) for _ in range(n)], np.int64)
        skip = fill_in_middle.SkipList(widths)
        assert [skip.chars_before(r) for r in range(n + 1)] == [int(widths[:r].sum()) for r in range(n + 1)]
        for bad in (-1, n + 1):
            with pytest.raises(IndexError):
                skip.chars_before(bad)
    # Each lane is about half as long as the one below, so a descent takes few steps.
    lanes = [len(units) for units, *_ in fill_in_middle.SkipList(np.ones(100_000, np.int64)).lanes]
    assert len(lanes) < 30 and all(0.4 < b / a < 0.6 for a, b in zip(lanes[:8], lanes[1:9], strict=True))


def test_fill_in_middle_on_odd_rows(spark, odd_docs, no_docs, odd_rows):
    marked = spark.createDataFrame([(i, f"text {m} number {i}", None) for i in range(40) for m in ("<P>", "<S>", "<M>")], "doc_id long, text string, form string")
    docs = odd_docs.select("doc_id", "text", odd_docs.source.alias("form")).union(marked)
    cut = fill_in_middle.fill_in_middle(docs, rate=100)
    rows = cut.withColumn("back", fill_in_middle.restored(cut.output, cut.form)).collect()
    texts = [(r[0], r[1] or "") for r in odd_rows] + [(r.doc_id, r.text) for r in marked.collect()]
    assert sorted(((r.doc_id, r.back) for r in rows), key=repr) == sorted(texts, key=repr)
    for r in rows:
        units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", r.back)
        a, b, _, form = (int(digest(f"42:{'' if r.doc_id is None else r.doc_id}")[k : k + 8], 16) for k in (0, 8, 16, 24))
        a, b = sorted((a % (len(units) + 1), b % (len(units) + 1)))
        prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        if not r.back or any(m in r.back for m in ("<P>", "<S>", "<M>")):
            expected = ("plain", None, None, r.back)
        elif form % 100 < 80:
            expected = ("spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}")
        else:
            expected = ("psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}")
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == (len(units), *expected)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert fill_in_middle.fill_in_middle(no_docs).collect() == []
