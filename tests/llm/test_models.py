"""Language identification and line quality: parts against plain versions, held-out accuracy, odd rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import language_id, line_crf, queries

SF = "/root/testdata/sf0.01"


def greedy_phrases(text, sample):
    """Longest prefixes of the rest that occur in the sample; a symbol that does not occur is a phrase."""
    n, at = 0, 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in sample:
            end += 1
        n, at = n + 1, end
    return n


def test_parsing_equals_greedy_longest_matches():
    rng = random.Random(7)
    for _ in range(30):
        sample = "".join(rng.choice("abc ") for _ in range(rng.randint(3, 120)))
        texts = ["".join(rng.choice("abcd ") for _ in range(rng.randint(1, 200))) for _ in range(5)]
        model = language_id.fit({"x": [sample]})
        coded = [model.symbol_of[language_id.code_points(t)] for t in texts]
        # Unknown letters and everything but letters are one symbol each.
        plain = [t.replace("d", "?" if "d" not in sample else "d") for t in texts]
        expected = [greedy_phrases(t, sample) for t in plain]
        assert model.phrases(coded)[:, 0].tolist() == expected


def test_automaton_accepts_exactly_the_substrings():
    text = np.array([0, 1, 0, 0, 1, 1, 0, 1, 0])
    nxt = language_id.suffix_automaton(text)

    def accepts(word):
        state = 0
        for c in word:
            if c not in nxt[state]:
                return False
            state = nxt[state][c]
        return True

    all_substrings = {tuple(text[i:j].tolist()) for i in range(len(text)) for j in range(i, len(text) + 1)}
    for n in range(5):
        for bits in range(2**n):
            word = tuple(bits >> k & 1 for k in range(n))
            assert accepts(word) == (word in all_substrings)


def test_long_texts_and_batches_do_not_matter():
    model = language_id.fit({"a": ["the cat sat on the mat"], "b": ["le chat sur la table"]})
    long = "the cat on the mat " * 2_000
    together, s1 = model.predict([long, "la table", None, "123", "", "zzz"])
    alone = [model.predict([t]) for t in (long, "la table", None, "123", "", "zzz")]
    assert together == [p[0] for p, _ in alone] and together[:5] == ["a", "b", "und", "und", "und"]
    assert s1.tolist() == pytest.approx([s[0] for _, s in alone]) and s1[2] == s1[3] == 0


def test_every_letter_of_large_alphabets_counts():
    """Texts of one script without blanks: only the letters tell the languages apart."""
    rng = random.Random(11)
    alphabets = {"el": range(0x3B1, 0x3C2), "fr": range(0x61, 0x7B), "ja": range(0x3041, 0x3094), "ko": range(0xAC00, 0xB000), "ru": range(0x430, 0x450)}
    alphabets |= {"th": range(0xE01, 0xE2F), "zh": range(0x4E00, 0x5400), "zu": range(0x5400, 0x5A00), "hi": range(0x905, 0x93A), "ar": range(0x620, 0x64B)}
    words = {k: ["".join(chr(rng.choice(a)) for _ in range(rng.randint(1, 4))) for _ in range(400)] for k, a in alphabets.items()}

    def text(lang, n):
        return "".join(rng.choice(words[lang]) for _ in range(n))

    model = language_id.fit({k: [text(k, 1_000) for _ in range(6)] for k in words})
    assert model.n_symbols > 2_000 and max(len(t.entry) for t in model.tables) < 20 * language_id.SAMPLE_CHARS
    assert model.predict([text(k, 40) for k in words])[0] == list(words)
    sample, other = text("zh", 500), text("zu", 30)
    one = language_id.fit({"zh": [sample]})
    for t in (text("zh", 60), other, sample[100:300]):
        plain = "".join(c if c in sample else "\u3042" for c in t)
        assert one.phrases([one.symbol_of[language_id.code_points(t)]])[0, 0] == greedy_phrases(plain, sample)


def test_op3_held_out_accuracy(spark):
    rows = queries.op3_language_id(spark, SF).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    assert len(held) > 100 and sum(held) / len(held) > 0.98


def test_language_on_odd_rows(odd_docs, odd_rows, no_docs):
    rows = language_id.identify(odd_docs, F.lit(True)).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, *_ in odd_rows)
    assert {r.doc_id: r.lang_pred for r in rows if r.doc_id in (0, 1, 2)} == {0: "und", 1: "und", 2: "und"}
    nothing = language_id.identify(odd_docs, F.lit(False)).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert language_id.identify(no_docs, F.lit(True)).collect() == []


def test_rows_without_letters_take_no_place_in_the_sample(spark):
    """One usable text in a hundred, its words far behind numbers: it is found, and so is the end of it."""
    words = {"a": "der hund lief heim ", "b": "the cat sat here "}
    rows = [(i, "ab"[i % 2], "1 2 3" if i % 3 else None) for i in range(1_000)]
    rows += [(5_000 + i, lang, "7 " * 20_000 + words[lang] * 1_000) for i, lang in enumerate("ab")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    found = language_id.labelled_sample(docs, F.lit(True))
    assert {k: len(v) for k, v in found.items()} == {"a": 1, "b": 1}
    assert all(words[k].strip() in t and len(t) <= language_id.SAMPLE_CHARS for k, (t,) in found.items())
    assert language_id.fit(found).predict(list(words.values()))[0] == list(words)
    long = "".join(chr(0x4E00 + i) for i in range(20_000))
    cut = language_id.spread(long, 1_000)
    assert len(cut) <= 1_000 and {(ord(c) - 0x4E00) // 2_500 for c in cut if c != " "} == set(range(8))
    assert language_id.spread(long, 10) in long and language_id.spread("short", 10) == "short"


# ---------------------------------------------------------------- line quality


def plain_marginals(evidence, stay):
    """Marginal of good by summing over all labellings of a chain."""
    n = len(evidence)
    total = np.zeros(2)
    good = np.zeros(n)
    for bits in range(2**n):
        y = [bits >> k & 1 for k in range(n)]
        w = math.exp(sum(e for e, v in zip(evidence, y) if v) + stay * sum(a == b for a, b in zip(y, y[1:])))
        total[0] += w
        good += w * np.array(y)
    return good / total[0]


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(2)
    n_lines = np.array([3, 1, 7, 7, 2])
    evidence = rng.normal(size=n_lines.sum()) * 2
    got = 1 / (1 + np.exp(-line_crf.marginals(evidence, n_lines, 1.3)))
    at = 0
    for n in n_lines:
        assert got[at : at + n] == pytest.approx(plain_marginals(evidence[at : at + n], 1.3))
        at += n


def test_line_features_by_hand():
    texts = [b"The cat. The cat!", b"", b"a | b\na | b\n\nTHE END"]
    features, size, n_lines = line_crf.line_features(texts)
    assert n_lines.tolist() == [1, 1, 4] and size.tolist() == [17, 0, 5, 5, 0, 7]
    own = {name: features[:, i].tolist() for i, name in enumerate(line_crf.OWN)}
    assert own["same_line"] == [0, 0, 0, 1, 0, 0] and own["empty"] == [0, 1, 0, 0, 1, 0]
    assert own["upper"] == pytest.approx([2 / 17, 0, 0, 0, 0, 6 / 7])
    assert own["bar"] == pytest.approx([0, 0, 2 / 3, 2 / 3, 0, 0]) and own["ends_stop"] == [1, 0, 0, 0, 0, 0]
    # neighbours stay within their text
    k = len(line_crf.OWN)
    assert features[0, k : 3 * k].tolist() == [0] * (2 * k) and features[3, k : 2 * k].tolist() == features[2, :k].tolist()


def test_messages_between_pieces_are_exact(monkeypatch):
    rng = np.random.default_rng(5)
    n_lines = np.array([40, 1, 7, 90, 21])
    evidence = rng.normal(size=n_lines.sum()) * 9
    evidence[::11] *= 100
    for stay in (0.0, 0.7, 3.0):
        whole = line_crf.marginals(evidence, n_lines, stay)
        for piece in (1, 2, 7, 20):
            with monkeypatch.context() as m:
                m.setattr(line_crf, "PIECE", piece)
                assert line_crf.marginals(evidence, n_lines, stay) == pytest.approx(whole, abs=1e-9)


def test_blocks_of_lines_have_the_features_of_the_whole(monkeypatch):
    rng = random.Random(4)
    parts = ["", "", "a b b", "The cat sat.", "The cat sat.", "$ | !", "long " * 30]
    for case in range(30):
        text = "\n".join(rng.choice(parts) for _ in range(rng.randint(1, 60))).encode()
        want, size, _ = line_crf.line_features([text])
        with monkeypatch.context() as m:
            m.setattr(line_crf, "BATCH_BYTES", rng.choice([1, 8, 40, 300]))
            m.setattr(line_crf, "BATCH_LINES", rng.choice([1, 2, 9]))
            got = list(line_crf.features_of([text]))
        assert np.array_equal(np.vstack([f for f, _ in got]), want) and np.concatenate([s for _, s in got]).tolist() == size.tolist(), case


def test_whole_texts_teach(spark):
    """What makes a text bad may stand far behind its start."""
    head = "The cat sat on the mat. It was happy.\n" * 300
    tail = "$$$ | buy | now !!!\n" * 900
    docs = spark.createDataFrame([(i, head + (tail if i % 2 else head)) for i in range(8)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(8)], "doc_id long, quality int")
    texts, _ = line_crf.labelled_sample(docs, labels, F.lit(True))
    assert sorted(texts) == sorted(r.text for r in docs.collect())
    model = line_crf.train(docs, labels, F.lit(True))
    good, bad = model.score(["The dog sat on the mat. It was old.\n" * 5, tail])
    assert good > 0.9 and bad < 0.1 and model.stay in line_crf.CHAINS


def test_scores_do_not_depend_on_the_batch():
    good = ["The cat sat on the mat.\nIt was happy, and so was I."] * 20
    bad = ["*** buy | now | !!!\n$$$ | free | !!!"] * 20
    model = line_crf.fit(good + bad, [1] * 20 + [0] * 20)
    texts = [*good[:2], None, "", "word " * 50_000, bad[0], "x\n" * 3_000]
    together = model.score(texts)
    assert together == pytest.approx([model.score([t])[0] for t in texts])
    assert together[0] > 0.9 and together[5] < 0.1 and model.score([]).tolist() == []


def test_op8_held_out_accuracy(spark):
    rows = queries.op8_line_quality(spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 50 and sum(p == y for p, y in held) / len(held) > 0.95


def test_quality_on_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(4, 1), (7, 0), (7, 1), (None, 1), (14, 1), (9, 0), (8, None)], "doc_id long, quality int")
    model = line_crf.train(odd_docs, labels, F.lit(True))
    assert model.weights is not None
    scored = line_crf.score_documents(odd_docs, model, score="quality")
    assert scored.columns == [*odd_docs.columns, "quality"]
    assert Counter(r.doc_id for r in scored.collect()) == Counter(i for i, *_ in odd_rows)
    flat = line_crf.train(odd_docs, labels.filter("quality = 1"), F.lit(True))
    assert flat.weights is None and {r.quality for r in line_crf.score_documents(odd_docs, flat, score="quality").collect()} == {1.0}
    assert line_crf.train(odd_docs, labels.limit(0), F.lit(True)).share == 0.5
    assert line_crf.score_documents(no_docs, model).collect() == []
