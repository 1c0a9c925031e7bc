"""Near-duplicates, components and exact top-k against brute force."""

import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import components as components_module
from panelspark.llm import minhash, queries, topk
from panelspark.llm.components import components
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def copies(seed=4):
    """Families of texts with few and many edits, exact copies and a chain, with ids in random order."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3_000)]
    texts = []
    for family in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([6, 40, 150]))]
        for k in range(14):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, max(1, len(w) // 30), len(w) // 12])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            texts.append(" ".join(w if family % 2 else [x.upper() if k % 2 else x for x in w]))
    chain = [rng.choice(vocabulary) for _ in range(120)]
    for _ in range(15):  # each is close to the one before, the ends are not
        texts.append(" ".join(chain))
        chain[rng.randrange(len(chain))] = rng.choice(vocabulary)
        chain[rng.randrange(len(chain))] = rng.choice(vocabulary)
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts += [f"{passage} " + " ".join(rng.choice(vocabulary) for _ in range(40)) for _ in range(30)]
    ids = rng.sample(range(10_000), len(texts))
    return dict(zip(ids, texts))


@pytest.mark.parametrize("size", [4, 5])
def test_components_equal_brute_force(spark, size):
    texts = copies()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    rows = minhash.near_duplicates(docs, size).collect()
    expected = brute.components(texts, size)
    assert {r.doc_id: r.component_id for r in rows} == expected and len(rows) == len(texts)
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(brute.shingles(texts[r.doc_id], size)) for r in rows)
    kept = minhash.deduplicate(docs, size).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(expected.values()))


def test_blocks_find_what_the_star_leaves(spark, monkeypatch):
    """With blocks of three nodes every bucket is dealt into many pairs of blocks; the result stays the same."""
    monkeypatch.setattr(minhash, "BLOCK", 3)
    texts = copies(9)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 4).collect()}
    assert got == brute.components(texts, 4)


def test_marked_rows_hold_all_that_are_wanted(spark, monkeypatch):
    rows = spark.range(5_000).withColumnRenamed("id", "node").withColumn("x", F.lit("x"))
    wanted = spark.createDataFrame([(i,) for i in range(0, 5_000, 50)] + [(None,), (0,)], "node bigint")
    for words, most in ((minhash.BITMAP_WORDS, 110), (1, 5_000)):  # one word is crowded: more rows, none lost
        monkeypatch.setattr(minhash, "BITMAP_WORDS", words)
        got = minhash.marked(rows, wanted, "node")
        assert got.columns == ["node", "x", "marked"] and got.count() == 5_000
        found = {r.node for r in got.filter("marked").collect()}
        assert set(range(0, 5_000, 50)) <= found and len(found) <= most
    assert minhash.marked(rows, wanted.limit(0), "node").filter("NOT marked").count() == 5_000


def test_a_crowded_bitmap_changes_no_component(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BITMAP_WORDS", 1)
    texts = copies(5)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 4).collect()} == brute.components(texts, 4)


def test_texts_without_a_neighbour_shuffle_their_buckets_once(spark, monkeypatch):
    """Signatures and bands of rows that no join uses are not shuffled, even where nothing is small enough to broadcast."""
    files, stored = {}, minhash.stored
    places = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def shuffled():
        return {f: f.stat().st_size for d in places for f in Path(d).rglob("shuffle_*.data")}

    def watched(*args, **options):
        result = stored(*args, **options)
        files.update(shuffled())
        return result

    monkeypatch.setattr(minhash, "stored", watched)
    monkeypatch.setattr(components_module, "stored", watched)
    rng = random.Random(6)
    texts = [(i, " ".join(str(rng.random()) for _ in range(8))) for i in range(3_000)]
    texts += [(3_000 + i, texts[i][1].replace("0", "O")) for i in range(5)] + [(4_000 + i, texts[i][1]) for i in range(5)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    before = set(shuffled())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = minhash.near_duplicates(docs, 4).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(rows) == len(texts) and sum(not r.kept for r in rows) == 5
    volume = sum(n for f, n in files.items() if f not in before)
    assert volume / len(texts) < 1_200  # 620 bytes a text; 2,750 when every row's bands go through each join


def test_block_rows_and_links_join_every_label(spark):
    """Equal signatures, sets of four families: the labels of a family are joined, whatever the cut into blocks."""
    n, nb = 40, 4
    sig, bands = bytes(minhash.HASHES), [7] + list(range(100, 100 + minhash.BANDS - 1))
    sets = {node: np.arange(1000 * (node % 4), 1000 * (node % 4) + 50, dtype=np.uint64).tobytes() for node in range(n)}
    rows = []
    for bucket in (7, 100):  # the second bucket holds the same pairs, which come up in the first one only
        for node in range(n):
            for other in range(nb):
                blk = node % 3
                rows.append((bucket, min(blk, other), max(blk, other), blk, node, node, 50, sig, bands))
    df = spark.createDataFrame(rows, minhash.BLOCK_ROW)
    kept = minhash.block_rows(df, 80)
    assert {r.node for r in kept.collect()} == set(range(n)) and {r.bucket for r in kept.collect()} == {7}
    named = spark.createDataFrame(list(sets.items()), "node bigint, hashes binary")
    columns = [c.split()[0] for c in minhash.BLOCK_ROW.split(", ")]
    links = minhash.block_links(kept.join(named, "node").select(*columns, "hashes"), 80).collect()
    assert all(r.la % 4 == r.lb % 4 for r in links) and len(links) < n * nb
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.node: r.label for r in found} == {i: i % 4 for i in range(n)}


def test_op5_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op5_minhash_dedup(spark, SF).collect()
    assert {r.doc_id: r.component_id for r in rows} == brute.components({r.doc_id: r.text for r in docs}, 4)
    assert len(rows) == len(docs)


def test_near_duplicates_on_odd_rows(odd_docs, odd_rows, no_docs):
    rows = minhash.near_duplicates(odd_docs, 4).collect()
    assert Counter((r.doc_id, r.n_shingles) for r in rows) == Counter((i, len(brute.shingles(t, 4))) for i, t, *_ in odd_rows)
    texts = {i: t for i, t, *_ in odd_rows if i is not None}
    expected = brute.components(texts, 4)
    assert all(r.component_id == expected[r.doc_id] if r.doc_id is not None else (r.component_id is None and r.kept) for r in rows)
    kept = minhash.deduplicate(odd_docs, 4)
    assert kept.columns == odd_docs.columns and {r.doc_id for r in kept.collect()} == {*expected.values(), None}
    assert minhash.near_duplicates(no_docs, 4).collect() == [] and minhash.deduplicate(no_docs).collect() == []


def test_one_row_of_each_component_stays(spark):
    """Repeated rows, rows without an id and rows of one id with different texts are dropped or kept row by row."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(4, a, "x"), (4, a, "x"), (4, a, "y"), (None, a, "x"), (9, a + " end", "x")]  # one component
    rows += [(9, b, "x"), (7, c, "x"), (None, c.upper(), "x"), (None, d, "x"), (None, d, "x"), (5, None, "x"), (6, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(3)
    kept = Counter((r.doc_id, r.text) for r in minhash.deduplicate(docs).collect())
    assert kept == Counter([(4, a), (9, b), (7, c), (None, d), (5, None), (6, "")])
    assert minhash.deduplicate(docs).columns == docs.columns
    many = spark.range(500).select(F.lit(1).cast("long").alias("doc_id"), F.lit(a).alias("text"))
    assert minhash.deduplicate(many).count() == 1


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for similar in (0.3, 0.6, 0.8, 0.95):
        est = []
        for _ in range(40):
            n = 600
            common = round(2 * n * similar / (1 + similar))
            pool = rng.integers(0, 1 << 62, 2 * n - common, dtype=np.uint64)
            a, b = pool[:n], np.concatenate([pool[:common], pool[n:]])
            est.append((minhash.signature(a) == minhash.signature(b)).mean())
        assert np.mean(est) == pytest.approx(similar, abs=0.02)


def test_sequential_bounds():
    need = minhash.least_matches(0.8)
    assert len(need) == minhash.HASHES // minhash.BATCH and need == sorted(need)
    # at the threshold itself, a pair is dropped with a small probability
    rng = np.random.default_rng(0)
    a = np.zeros((20_000, minhash.HASHES), np.uint8)
    b = (rng.random(a.shape) > 0.8).astype(np.uint8)
    alive, _ = minhash.surviving(a, b, need)
    assert len(alive) >= len(a) - 2
    far = (rng.random((2_000, minhash.HASHES)) > 0.5).astype(np.uint8)
    assert len(minhash.surviving(a[:2_000], far, need)[0]) == 0


def test_long_text_hashes_every_shingle():
    text = " ".join(str(i % 977) for i in range(50_000))
    assert len(minhash.shingle_set(text, 4)) == len(brute.shingles(text, 4))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 60)] + [(500, 500), (700, 650), (650, 700)]
    rng.shuffle(links)
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 0 for i in range(60)}, 650: 650, 700: 650}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---------------------------------------------------------------- top-k


def plain_top(vectors, is_query, k=10):
    """(query_id, rank, vec_id, score) over usable rows."""
    use = [(i, np.floor(np.asarray(v, float) * 1024)) for i, v in vectors if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for q, x in use:
        if is_query(q):
            scored = sorted((-int(x @ y), i) for i, y in use if i != q and len(y) == len(x))
            out.update((q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k]))
    return out


def test_op6_against_brute_force(spark):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = Counter(map(tuple, queries.op6_exact_top_k(spark, SF).select("query_id", "rank", "vec_id", "score").collect()))
    assert got == plain_top(vectors, lambda i: i % 100 == 0)


@pytest.mark.parametrize("blocks", [(256, 4096), (2, 20)])
def test_top_k_with_ties_nulls_and_odd_vectors(spark, blocks):
    rng = np.random.default_rng(3)
    vectors = [(i, [float(x) for x in rng.integers(-2, 3, 12) / 4]) for i in range(300)]
    vectors += [(300, None), (301, []), (302, [None] * 12), (303, [float("nan")] * 12), (304, [float("inf")] + [0.0] * 11), (305, [0.5] * 7)]
    vectors += [(None, [1.0] * 12), (306, [0.5] * 7), vectors[5]]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in vectors], "vec_id long, embedding array<double>, score int, rank string")
    got = topk.top_k(df.repartition(3), F.col("vec_id") % 50 == 6, query_block=blocks[0], row_block=blocks[1])
    assert Counter(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == plain_top(vectors, lambda i: i % 50 == 6)
    assert topk.top_k(df.limit(0), F.lit(True)).collect() == []
    assert topk.top_k(df, F.lit(False)).collect() == []


def test_statistics_bound_the_inner_product():
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(50, 30)) * 100, rng.normal(size=(60, 30)) * 100
    exact = x @ y.T
    last = None
    for segments in (1, 4, 16, 30):
        bound = topk.segment_statistics(x, segments) @ topk.segment_statistics(y, segments).T
        assert (bound >= exact - 1e-6).all()
        assert last is None or bound.mean() <= last
        last = bound.mean()
