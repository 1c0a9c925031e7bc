"""Chat rotation and packing: exact round trips and odd rows; the pipeline's stages."""

import gc
import tracemalloc
import zlib
from collections import Counter, defaultdict

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelspark.llm import chat, line_crf, minhash, packing, queries, secrets
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def plain_rotation(messages):
    """(conv_id, participant) -> (text, mask, messages, own messages) of whole dialogues."""
    convs = defaultdict(list)
    for conv, turn, role, text in messages:
        convs[conv].append((turn is None, turn or 0, role or "unknown", text or ""))
    out = {}
    for conv, said in convs.items():
        said.sort()
        for who in {s for _, _, s, _ in said}:
            text, mask = "", []
            for _, _, speaker, words in said:
                text += "<|assistant|>\n" if speaker == who else f"<|user name={speaker}|>\n"
                if speaker == who:
                    mask.append((len(text), len(text) + len(words) + len("<|end|>")))
                text += words + "<|end|>\n"
            out[conv, who] = (text, mask, len(said), sum(s == who for _, _, s, _ in said))
    return out


def whole(rows):
    """Parts put together, after checking that each starts where the ones before end."""
    parts = defaultdict(list)
    for r in rows:
        parts[r.conv_id, r.participant].append(r)
    out = {}
    for key, found in parts.items():
        text, mask, n, own = "", [], 0, 0
        for k, r in enumerate(sorted(found, key=lambda r: r.part)):
            assert r.part == k and r.start == len(text)
            mask += [(r.start + m.start, r.start + m.end) for m in r.mask]
            text += r.text
            n, own = n + r.n_messages, own + r.n_trained
        out[key] = (text, mask, n, own)
    return out


def test_op4_rebuilds_every_dialogue(spark):
    messages = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    expected = plain_rotation(map(tuple, messages.collect()))
    assert whole(chat.rotate(messages).collect()) == expected
    assert whole(chat.rotate(messages, part=2).collect()) == expected
    rows = queries.op4_chat_rotation(spark, SF).collect()
    assert len(rows) == len(expected)
    assert {(r.conv_id, r.participant): r.mask for r in rows} == {k: ",".join(f"{s}:{e}" for s, e in v[1]) for k, v in expected.items()}


ODD = [
    (1, 0, "ann", "hé"), (1, 1, "bob", None), (1, 2, None, "x"), (1, None, "ann", "late"), (1, 2, None, "x"), (1, 1, "ann", ""),
    (None, 5, "ann", "no conversation"), (None, 4, "cy", "<|end|>\n"), (2, -3, "solo", "alone"), (2, 70, "solo", "far"),
]


def test_chat_on_odd_rows(spark):
    df = spark.createDataFrame([(*m, "p", 1, "q") for m in ODD], "conv_id long, turn long, role string, text string, part string, start int, mask string")
    assert whole(chat.rotate(df).collect()) == plain_rotation(ODD)
    assert whole(chat.rotate(df, part=1).collect()) == plain_rotation(ODD)
    assert chat.rotate(df.limit(0)).collect() == []


def test_a_large_conversation_is_cut_by_turn_and_by_text(spark):
    """More messages than a piece in one part, and in one turn: no part holds them all, nothing is lost."""
    messages = [(1, i % 3, "a" if i % 2 else "b", f"m{i}") for i in range(200)] + [(1, None, "a", f"n{i}") for i in range(60)]
    df = spark.createDataFrame(messages, "conv_id long, turn long, role string, text string")
    rows = chat.rotate(df, piece=20).collect()
    assert max(r.n_messages for r in rows) < 60
    built = whole(rows)
    expected = plain_rotation(messages)
    assert set(built) == set(expected)
    for key, (text, mask, n, own) in built.items():
        assert Counter(text.split("<|end|>\n")) == Counter(expected[key][0].split("<|end|>\n")) and (n, own) == expected[key][2:]
        assert sorted(text[s:e] for s, e in mask) == sorted(expected[key][0][s:e] for s, e in expected[key][1])
    turns = [r.text for r in sorted(rows, key=lambda r: r.part) if r.participant == "a"]
    order = [int(m[1:]) % 3 for t in turns for m in t.split() if m[0] == "m" and m[1:2].isdigit() for m in [m.split("<")[0]]]
    assert order == sorted(order)


def test_large_parts_equal_the_sql(spark, tmp_path):
    """More than 4,096 messages in a part and in one turn, equal ones among them: the rows are those of the SQL."""
    import duckdb

    messages = [(1, i % 3, "ab"[i % 2], f"m{i % 900}") for i in range(5_000)]
    messages += [(1, 70, "a", None if i % 2 else f"n{i}") for i in range(4_500)] + [(2, None, None, "x")] * 4_200
    df = spark.createDataFrame(messages, "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op4_chat_rotation(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    result = con.execute(queries.ORACLE_SQL["op4_chat_rotation"])
    columns = [d[0] for d in result.description]
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(result.fetchall())


def test_pieces_cut_the_one_order(spark):
    """With a piece every part is bounded, repeated rows too, and the parts together are the same dialogue."""
    messages = [(1, i % 3, "ab"[i % 2], f"m{i % 7}") for i in range(200)] + [(1, None, "a", None)] * 65
    df = spark.createDataFrame(messages, "conv_id long, turn long, role string, text string")
    rows = chat.rotate(df, piece=20).collect()
    assert max(r.n_messages for r in rows) == 20 and whole(rows) == plain_rotation(messages)


# ---------------------------------------------------------------- packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_tokenizer())


def check_packed(rows, texts, tokenizer, window):
    """Every id in exactly one piece, sequences filled from 0 without gaps; returns the share of padding."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, copies in texts.items():
        ids = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for t in copies]
        pieces = sorted((r.start, r.length, bytes(r.ids), r.doc_tokens) for r in docs.pop(i))
        expected = []
        for x in ids:
            cuts = sorted({s for s, n, b, total in pieces if total == len(x)})
            for s, e in zip(cuts, [*cuts[1:], len(x)]):
                expected.append((s, e - s, x[s:e].tobytes(), len(x)))
        assert pieces == sorted(expected)
    assert not docs
    used = padded = 0
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at and length > 0
            at += length
        assert at <= window
        used += at
        padded += window - at if at & (at - 1) else 0
    return padded / max(1, used + padded)


def test_op9_round_trip_and_padding(spark, tokenizer):
    texts = {r.doc_id: [r.text] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack(docs).collect()
    assert check_packed(rows, texts, tokenizer, packing.WINDOW) < 0.05
    query = queries.op9_pack(spark, SF).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in query) == Counter(
        (r.doc_id, r.start, r.length, zlib.crc32(bytes(r.ids)), r.doc_tokens) for r in rows
    )


@pytest.mark.parametrize(("window", "most", "parts"), [(64, 3, 5), (2048, 64, 3)])
def test_packing_odd_rows(odd_docs, odd_rows, no_docs, tokenizer, window, most, parts):
    texts = defaultdict(list)
    for i, t, *_ in odd_rows:
        texts[i].append(t)
    rows = packing.pack(odd_docs.repartition(parts), window=window, open_windows=most, merge_partitions=2).collect()
    check_packed(rows, texts, tokenizer, window)
    assert packing.pack(no_docs).collect() == []


@pytest.mark.parametrize("memory", [0, 40, 10**6])
def test_ids_of_random_texts(tokenizer, memory):
    """Blanks of every kind in every place, letters of several alphabets, the special token's text; also when pieces are forgotten."""
    rng = random.Random(memory)
    parts = ["a", "the", "Ing", " ", " ", "  ", "\n", "\r\n", "\t", "\x1f", "\x85", "\xa0", "　", "'s", "'", "12", "3.5", "_", "é", "漢", "я", "\U0001f600", "<|endoftext|>", "<|", "\x00", "!?"]
    own = packing.Tokenizer(packing.default_tokenizer(), packing.default_ranks(), memory)
    for _ in range(25):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(80)] + [None, ""]
        texts += [" ".join(rng.choice(["the", "ça", "x1", "l'eau,", "\nnew", "漢字"]) for _ in range(rng.randint(1, 20))) for _ in range(40)]
        expected = [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        assert [g.tolist() for g in own.batch(texts)] == expected


def test_pieces_give_the_ids_of_the_whole_text(tokenizer):
    odd = ["a  b", "a\n\nb", " a", "a ", "\ta b", "a\xa0b", "it's a 's\n's x<|endoftext|>y", "", "\n", " ", "a\0b c", "x\x1cy z",
           "é ü\nß  ", "中文 字 \U0001f600 emoji​x", "don't WE'LL 've", None, "x " * 5_000 + "y"]
    for own in (packing.tokenizer_of(None), packing.Tokenizer(packing.default_tokenizer(), memory=3)):
        for _ in range(2):
            got = own.batch(odd)
            assert [g.tolist() for g in got] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in odd]


@pytest.mark.parametrize(("memory", "limit", "long"), [(60, 10**6, 8), (10**6, 400, 8), (10**6, 400, 0), (50, 0, 10**6)])
def test_ids_when_long_pieces_are_forgotten(tokenizer, monkeypatch, memory, limit, long):
    monkeypatch.setattr(packing, "MEMORY_BYTES", limit)
    monkeypatch.setattr(packing, "LONG_PIECE", long)
    monkeypatch.setattr(packing, "JOINED", 7)
    monkeypatch.setattr(packing, "PART_BYTES", 300)
    rng = random.Random(memory + limit)
    own = packing.Tokenizer(packing.default_tokenizer(), packing.default_ranks(), memory)
    for k in range(12):
        words = ["the", "l'eau,", "漢字" * k, "x" * 40, f"w{k}-{rng.random()}", "é<|endoftext|>", "a" * rng.randint(1, 99)]
        texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 40))] + ["a  b", None] * (k % 3)
        expected = [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        assert [g.tolist() for g in own.batch(texts)] == expected


def held_mb(own, batches):
    """MB that a tokenizer still holds after some batches of texts, in Python, numpy and Arrow."""
    gc.collect()
    tracemalloc.start()
    try:
        arrow = pa.total_allocated_bytes()
        for texts in batches:
            for _ in own.batch(texts):
                pass
        gc.collect()
        return (tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - arrow) / 1e6
    finally:
        tracemalloc.stop()


def test_a_tokenizer_holds_little_for_what_it_remembers():
    """A hundred thousand pieces, of which none is an object of its own, and then a batch or so of long ones, however many there were."""
    own = packing.Tokenizer(packing.default_tokenizer(), packing.default_ranks())
    assert held_mb(own, ([" ".join(f"w{i * 7919}" for i in range(k, k + 500)) for k in range(at, at + 20_000, 500)] for at in range(0, 100_000, 20_000))) < 8
    own = packing.Tokenizer(packing.default_tokenizer(), packing.default_ranks())
    assert held_mb(own, ([" ".join(f"{i}," + "of/the/" * 100 for i in range(k, k + 50)) for k in range(at, at + 1_500, 50)] for at in range(0, 12_000, 1_500))) < 20


def test_open_windows_place_best_fit_and_emit_the_fullest():
    spaces = packing.OpenWindows(10, 2)
    assert spaces.add(6, "a") is None and spaces.add(7, "b") is None
    assert spaces.add(3, "c") == [(0, "b"), (7, "c")]  # fits best behind b and fills it
    assert spaces.add(5, "d") is None
    assert spaces.add(9, "e") == [(0, "a")]  # nothing has room: the fullest goes
    assert spaces.add(5, "f") == [(0, "d"), (5, "f")]
    assert [h for h in spaces.held] == [[(0, "e")]]


# ---------------------------------------------------------------- pipeline


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("extra", F.lit("x")).withColumn("score", F.lit(1))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "near-duplicates", "secret scans", "mixing", "packing"]
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}

    model = line_crf.train(docs, spark.read.parquet(f"{SF}/labels.parquet"), F.lit(True))
    scores = dict(zip(rows, model.score([r.text for r in rows.values()]).tolist()))
    good = stages["quality classifier"](spark, docs, SF)
    assert good.columns == columns and {r.doc_id for r in good.collect()} == {i for i, s in scores.items() if s >= 0.3}

    unique = stages["near-duplicates"](spark, docs, SF)
    component = brute.components({i: r.text for i, r in rows.items()}, 5)
    assert unique.columns == columns and sorted(r.doc_id for r in unique.collect()) == sorted(set(component.values()))

    clean = stages["secret scans"](spark, docs, SF)
    assert clean.columns == columns
    for r in clean.collect():
        *_, spans = brute.secrets(rows[r.doc_id].text)
        assert (r.text == rows[r.doc_id].text) if "[SECRET]" not in r.text else brute.secrets(r.text)[4] == []
        assert not spans or "[SECRET]" in r.text

    mixed = stages["mixing"](spark, docs, SF)
    taken = Counter(r.doc_id for r in mixed.collect())
    plan = {r.doc_id: r.taken // r.size for r in queries.op10_mix_sources(spark, SF).collect() if r.size}
    assert mixed.columns == columns and taken == +Counter(plan)


def test_run_covers_what_each_stage_keeps(spark):
    pieces = corpus_pipeline.run(spark, SF)
    starts = Counter(r.doc_id for r in pieces.filter("start = 0").select("doc_id").collect())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = line_crf.train(docs, spark.read.parquet(f"{SF}/labels.parquet"), F.lit(True))
    good = line_crf.score_documents(docs, model).filter("score >= 0.3").drop("score")
    left = secrets.redact(minhash.deduplicate(good))
    assert starts == Counter(r.doc_id for r in corpus_pipeline.mixing_stage(spark, left, SF).select("doc_id").collect())


def test_pipeline_stages_on_odd_and_empty_tables(spark, odd_docs, no_docs, tmp_path):
    spark.createDataFrame([(4, 1, 0), (8, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns and out.count() <= 3 * docs.count()
        assert stage is not None and corpus_pipeline.packing_stage(spark, docs, str(tmp_path)).count() >= docs.count()
