"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact confirmation.

A document is the set of its distinct shingles (as 64-bit hashes). Two documents are linked if their sets'
Jaccard similarity reaches the threshold; a component is what links connect.

1. *Sketch* (one pass over the texts): size of the set, a 128-bit key of the whole set, ``BANDS * ROWS``
   min-hashes kept as one byte each, and one number per band. At similarity 0.8 a pair shares no band with
   probability (1 - 0.8**6)**42, about 3 in a million.
2. *Classes*: documents with equal sets are one node, named by the smallest id.
3. *Star round*: in each band's bucket every node is compared with one pivot (of the smallest hash), so a
   bucket of m nodes makes m - 1 pairs and the large groups of copies fall together.
4. *Block round*: buckets whose nodes still carry different labels are dealt into blocks of bounded size,
   and pairs of blocks compare the signatures of nodes of different labels. Nodes with a survivor meet once more with their
   full sets, and a task sends on one link between any two labels. Together with the star round this covers
   all pairs of a bucket that are not connected already: nothing is capped, and no list of pairs is ever written.
5. *Verification*: a pair's signatures are compared ``BATCH`` min-hashes at a time. After m equal ones of n,
   the similarity has (with a flat prior) a Beta(m + 1, n - m + 1) posterior; the pair is dropped when the
   posterior puts less than ``MISS`` on similarities from the threshold up. Survivors are confirmed on
   the full sets, every node's most promising pair first, so that pairs which became connected meanwhile need no
   check; the star round's survivors are settled before the block round begins.

Defined cases: a null text or one without words has an empty set, is linked with nothing and is its own
component; a text of fewer words than a shingle is one shingle; rows that share an id are one document; a row without an id
has no component and is kept; repeated rows are returned as often as they occur; an empty table gives an
empty result. :func:`deduplicate` takes every row as a document, whatever its id, and keeps all columns whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm.common import file_rows, stored, temporary, unused
from panelspark.llm.components import components

BANDS, ROWS = 42, 6
HASHES = BANDS * ROWS
BATCH = 36
MISS = 1e-6
BLOCK = 256  # nodes in a block of the block round
BITMAP_WORDS = 1 << 18  # 2 MB of marks
ROUNDS = 3  # of confirmation: the last one checks whatever is left

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _mixed(n: int, seed: int) -> np.ndarray:
    """n well-mixed 64-bit numbers (the public splitmix64 sequence)."""
    with np.errstate(over="ignore"):
        z = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
        return _mix(z)


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


_BYTE_VALUE = _mixed(256, 11)
_BASE = int(_mixed(1, 12)[0]) | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_XOR = (_mixed(HASHES, 13) >> np.uint64(32)).astype(np.uint32)
_MUL = (_mixed(HASHES, 14) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_BAND_MUL = _mixed(HASHES, 15).reshape(BANDS, ROWS) | np.uint64(1)
_BAND_ADD = _mixed(BANDS, 16)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as they were needed."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            m = len(self.up)
            up, down = (np.uint64(pow(b, m, 1 << 64)) for b in (_BASE, _BASE_INVERSE))
            self.up = np.concatenate([self.up, self.up * up])
            self.down = np.concatenate([self.down, self.down * down])
        return self.up, self.down


_POWERS = _Powers()


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of ``size`` words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    up, down = _POWERS.to(len(data))
    # A polynomial hash of every run of bytes from its prefix sums.
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * up[: len(data)], out=prefix[1:])
    ends = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(size, len(words))
    s, e = starts[: len(words) - k + 1], ends[k - 1 :]
    return np.unique(_mix((prefix[e] - prefix[s]) * down[s]))


def signature(hashes: np.ndarray) -> np.ndarray:
    """Min-hashes (uint32) of a non-empty set."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 1024):
        part = (low[i : i + 1024, None] ^ _XOR) * _MUL
        np.minimum(least, part.min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    return _mix((least.reshape(BANDS, ROWS).astype(np.uint64) * _BAND_MUL).sum(axis=1, dtype=np.uint64) + _BAND_ADD).astype(np.int64)


def signature_bytes(least: np.ndarray) -> bytes:
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()


def least_matches(threshold: float, miss: float = MISS) -> list[int]:
    """Per batch, the fewest equal min-hashes with which a pair goes on.

    P(similarity >= t | m of n) under a flat prior is the chance of at most m successes in n + 1 trials of
    probability t.
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        below, m = 0.0, -1
        while below < miss:
            m += 1
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def surviving(a: np.ndarray, b: np.ndarray, need: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(positions that survive, their equal min-hashes) for rows of signatures, batch by batch."""
    alive, same = np.arange(len(a)), np.zeros(len(a), np.int64)
    for i, least in enumerate(need):
        part = slice(i * BATCH, (i + 1) * BATCH)
        same = same + (a[alive, part] == b[alive, part]).sum(axis=1)
        go = same >= least
        alive, same = alive[go], same[go]
        if not len(alive):
            break
    return alive, same


def _bytes_column(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


# ---------------------------------------------------------------- steps


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """The columns of ``docs`` but its last one, the text, with (n_shingles, set_key, sig, bands); the last three are null for an empty set."""
    kept = docs.schema.fields[:-1]
    names = [f.name for f in kept] + ["n_shingles", "set_key", "sig", "bands"]
    found = "n_shingles bigint, set_key binary, sig binary, bands array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, sigs, bands = [], [], [], []
            for text in batch.column(len(kept)).to_pylist():
                hashes = shingle_set(text, size)
                n.append(len(hashes))
                if len(hashes):
                    least = signature(hashes)
                    keys.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                    sigs.append(signature_bytes(least))
                    bands.append(band_keys(least))
                else:
                    for out in (keys, sigs, bands):
                        out.append(None)
            made = [pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *made], names=names)

    return docs.mapInArrow(run, T.StructType([*kept, *T.StructType.fromDDL(found).fields]))


def similar_size(a: str, b: str, percent: int) -> Column:
    """Sets of very different sizes cannot reach the threshold."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def marked(rows: DataFrame, wanted: DataFrame, *key: str) -> DataFrame:
    """``rows`` with ``marked``: true for all whose ``key`` is in ``wanted``, and for a few others. Nothing of ``rows`` is shuffled.

    A bitmap of ``BITMAP_WORDS`` 64-bit words, the union of the wanted keys' hashed positions, is joined to the rows' own
    positions. Its size is fixed, so it is broadcast; where many keys crowd it, more rows are marked than are asked for.
    """
    place = F.xxhash64(*key)
    word, bit = F.pmod(place, F.lit(BITMAP_WORDS)).cast("int"), F.shiftright(place, 50).bitwiseAND(F.lit(63)).cast("int")
    of_bit = f"bit_or(shiftleft(1L, cast(shiftright(xxhash64({', '.join(key)}), 50) & 63 AS INT)))"
    marks = wanted.groupBy(word.alias("word")).agg(F.expr(of_bit).alias("marks"))
    placed = rows.withColumns({"word": word, "bit": bit}).join(F.broadcast(marks), "word", "left")
    return placed.select(*rows.columns, F.expr("coalesce(shiftrightunsigned(marks, bit) & 1L = 1L, false)").alias("marked"))


def screen(pairs: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose signatures survive the sequential comparison, with ``same``."""
    need = least_matches(percent / 100)
    sigs = marked(sigs, ends_of(pairs), "node").filter("marked")
    both = pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
    both = both.join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b").select("a", "b", "sig_a", "sig_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                alive, same = surviving(_bytes_column(batch.column(2), HASHES), _bytes_column(batch.column(3), HASHES), need)
                keep = pa.array(alive)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep), pa.array(same, pa.int64())], names=["a", "b", "same"])

    return both.mapInArrow(run, "a bigint, b bigint, same bigint")


BLOCK_ROW = "bucket bigint, i int, j int, blk int, node bigint, label bigint, n bigint, sig binary, bands array<bigint>"


def promising(table: pa.Table, need: list[int], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows x, rows y, equal min-hashes) of the pairs of one or more (bucket, i, j) groups that are worth a check.

    Two rows of different labels whose signatures survive, in the first of the bands that they share: so a pair comes
    up once however many buckets hold it.
    """
    bucket, i, j, blk, node, label, n = (table.column(k).to_numpy() for k in range(7))
    sig = _bytes_column(table.column(7), HASHES)
    bands = table.column(8).combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    cut = np.flatnonzero((bucket[1:] != bucket[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
    for s, e in zip([0, *cut], [*cut, len(node)], strict=True):
        if e - s < 2 or (label[s:e] == label[s]).all():
            continue
        x, y = np.triu_indices(e - s, 1)
        x, y = x + s, y + s
        ok = (label[x] != label[y]) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))
        # Two different blocks meet here for the pairs between them only.
        ok &= (i[s] == j[s]) | (blk[x] != blk[y])
        x, y = x[ok], y[ok]
        for at in range(0, len(x), 1 << 15):
            px, py = x[at : at + (1 << 15)], y[at : at + (1 << 15)]
            alive, same = surviving(sig[px], sig[py], need)
            px, py = px[alive], py[alive]
            shared = bands[px] == bands[py]
            first = bands[px, shared.argmax(axis=1)] == bucket[s]
            if first.any():
                yield px[first], py[first], same[first]


def by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables that hold whole (bucket, i, j) groups, from batches sorted by these first three columns."""
    kept: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([kept, table]) if kept is not None else table
        # The last group may go on in the next batch.
        key = [table.column(k).to_numpy() for k in range(3)]
        last = np.flatnonzero((key[0] != key[0][-1]) | (key[1] != key[1][-1]) | (key[2] != key[2][-1]))
        done = int(last[-1]) + 1 if len(last) else 0
        if done:
            yield table.slice(0, done)
        kept = table.slice(done)
    if kept is not None and kept.num_rows:
        yield kept


def block_rows(rows: DataFrame, percent: int) -> DataFrame:
    """The rows (as BLOCK_ROW) that are an end of a promising pair of their group.

    A group is a pair of blocks of one bucket, so it is bounded; a task holds a batch and a group at a time.
    """
    need = least_matches(percent / 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_group(batches):
            wanted = np.zeros(table.num_rows, bool)
            for x, y, _ in promising(table, need, percent):
                wanted[x] = wanted[y] = True
            yield from table.filter(pa.array(wanted)).combine_chunks().to_batches()

    dealt = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return dealt.mapInArrow(run, BLOCK_ROW)


def block_links(rows: DataFrame, percent: int) -> DataFrame:
    """(la, lb): labels that a link joins, confirmed on the full sets, from ``block_rows`` with ``hashes``.

    Within a task, pairs whose labels an earlier link has joined are not checked again, so a group sends on
    fewer links than it has labels.
    """
    need = least_matches(percent / 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_group(batches):
            hashes = [np.frombuffer(h, np.uint64) for h in table.column(9).to_pylist()]
            label = table.column(5).to_numpy()
            parent: dict[int, int] = {}

            def root(v: int, parent: dict[int, int] = parent) -> int:
                while parent.get(v, v) != v:
                    v = parent[v]
                return v

            found = []
            for x, y, same in promising(table, need, percent):
                for k in np.argsort(-same, kind="stable").tolist():
                    p, q = int(label[x[k]]), int(label[y[k]])
                    rp, rq = root(p), root(q)
                    if rp != rq and is_link(hashes[x[k]], hashes[y[k]], percent):
                        parent[rp] = rq
                        found.append((p, q))
            la, lb = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(la, pa.int64()), pa.array(lb, pa.int64())], names=["la", "lb"])

    dealt = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return dealt.mapInArrow(run, "la bigint, lb bigint")


def is_link(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(p, q, assume_unique=True))
    return 100 * common >= percent * (len(p) + len(q) - common)


def sets_of(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """The columns of ``nodes``, of which all but ``node`` name a document, with ``hashes``: the full sets of these nodes.

    ``docs`` has the columns that name a document and ``text`` as its last one. The texts are read again and not shuffled: only
    the sets of the documents that :func:`marked` lets through are joined.
    """
    key = docs.columns[:-1]
    wanted = marked(docs.dropna(subset=key), nodes, *key).filter("marked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, size).tobytes() for t in batch.column(len(key)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sets, pa.binary())], names=[*key, "hashes"])

    schema = T.StructType([*docs.schema.fields[:-1], T.StructField("hashes", T.BinaryType())])
    return nodes.join(wanted.select(*docs.columns).mapInArrow(run, schema), key).select("node", "hashes")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links by their full sets."""
    sets = sets.join(ends_of(pairs), "node", "left_semi")  # later rounds ask for few of them
    both = pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("hashes_a")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("hashes_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = zip(batch.column(2), batch.column(3), strict=True)
            keep = [is_link(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in sets]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "hashes_a", "hashes_b").mapInArrow(run, "a bigint, b bigint")


def labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs with the labels of both ends (a node without one is its own), those of one label dropped."""
    la, lb = (labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")) for c in ("a", "b"))
    both = pairs.join(la, "a", "left").join(lb, "b", "left")
    both = both.withColumns({"la": F.coalesce("la", "a"), "lb": F.coalesce("lb", "b")})
    return both.filter("la <> lb")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after joining the components that ``links`` (la, lb) connect; nodes without a label are their own."""
    joined = components(links.select(F.col("la").alias("a"), F.col("lb").alias("b")))
    of_label = joined.select(F.col("node").alias("old"), F.col("label").alias("new"))
    kept = labels.withColumnRenamed("label", "old").join(of_label, "old", "left").select("node", F.coalesce("new", "old").alias("label"))
    alone = joined.join(labels, "node", "left_anti")
    return stored(kept.unionByName(alone), "merged")


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def resolve(pairs: DataFrame, labels: DataFrame | None, sets: DataFrame, percent: int, rounds: int = ROUNDS) -> DataFrame:
    """Labels after confirming ``pairs`` (a, b, same) on the full sets.

    In each round every node's most promising pair is checked, then pairs whose ends have got one label are
    dropped; the last round checks all that are left.
    """
    if labels is None:
        labels = pairs.sparkSession.createDataFrame([], "node bigint, label bigint")
    waiting = pairs
    for i in range(rounds):
        chosen = waiting.select("a", "b")
        if i < rounds - 1:
            ends = waiting.select(F.explode(F.array("a", "b")).alias("node"), F.struct("same", "a", "b").alias("pair"))
            chosen = stored(ends.groupBy("node").agg(F.max("pair").alias("m")).select("m.a", "m.b").distinct(), "chosen")
        labels = merged(labels, stored(labelled(confirm(chosen, sets, percent), labels), "links"))
        if i < rounds - 1:
            waiting = stored(labelled(waiting.join(chosen, ["a", "b"], "left_anti"), labels).select("a", "b", "same"), "waiting")
            if waiting.isEmpty():
                break
    return labels


def connected(sketch: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) for the rows of ``sketch``; ``sets`` gives (node, hashes) for a table of nodes."""
    spark = sketch.sparkSession
    named = sketch.filter("doc_id IS NOT NULL AND set_key IS NOT NULL")
    classes = named.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("rows"))
    copies = stored(classes.filter("rows > 1").select("set_key", "node"), "copies")
    # Bands are wide: only those of rows that may be copies are shuffled to tell a class's first row.
    likely = marked(named.select("set_key", "doc_id", "n_shingles", "bands"), copies, "set_key")
    first = likely.filter("marked").join(copies, "set_key", "left").filter("node IS NULL OR node = doc_id")
    first = likely.filter("NOT marked").select("doc_id", "n_shingles", "bands").unionByName(first.select("doc_id", "n_shingles", "bands"))
    # Buckets of two nodes or more; their pivot is the smallest node. Most buckets have one: these are shuffled as counts only.
    rows = first.select(F.explode("bands").alias("bucket"), F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"))
    with temporary(spark) as counting:
        shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.min("node").alias("pivot")).filter("m > 1")
        shared = stored(shared, "shared")
        likely = marked(rows, shared, "bucket").filter("marked").drop("marked")
        members = counting.kept(likely.join(shared, "bucket"), "members")
    sigs = named.select(F.col("doc_id").alias("node"), "sig", "bands")
    with temporary(spark) as star_round:
        pivots = members.filter("node = pivot").select("bucket", F.col("node").alias("q"), F.col("n").alias("nq"))
        star = members.filter("node <> pivot").join(pivots, "bucket").filter(similar_size("n", "nq", percent))
        pairs = stored(star.select(F.least("node", "q").alias("a"), F.greatest("node", "q").alias("b")).distinct(), "pairs")
        close = stored(screen(pairs, sigs, percent), "star")
        full = stored(sets(ends_of(close)), "sets")
        labels = star_round.kept(resolve(close, None, full, percent), "labels")
    # Block round over the buckets whose nodes are not of one component yet.
    with temporary(spark) as block_round:
        tagged = members.select("bucket", "node", "n", "m").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        mixed = tagged.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("c"))
        mixed = mixed.filter("lo <> hi AND c > 2").select("bucket")  # of two nodes, the star round has settled the pair
        tagged = stored(tagged.join(mixed, "bucket"), "mixed")
        n_blocks = F.ceil(F.col("m") / F.lit(BLOCK)).cast("int")
        blocks = tagged.join(marked(sigs, tagged, "node").filter("marked"), "node").withColumns({"nb": n_blocks, "blk": F.pmod(F.hash("node"), n_blocks)})
        blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
        blocks = blocks.withColumns({"i": F.least("blk", "other"), "j": F.greatest("blk", "other")})
        columns = [c.split()[0] for c in BLOCK_ROW.split(", ")]
        open_rows = stored(block_rows(blocks.select(*columns), percent), "open")
        if not open_rows.isEmpty():
            full = stored(sets(open_rows.select("node").distinct()), "sets")
            links = block_links(open_rows.join(full, "node").select(*columns, "hashes"), percent)
            labels = block_round.kept(merged(labels, stored(links.distinct(), "links")), "labels")
    # Every row takes its component by its set's class.
    of_class = copies.join(labels, "node", "left").select("set_key", F.coalesce("label", "node").alias("by_class"))
    of_node = labels.select(F.col("node").alias("doc_id"), F.col("label").alias("by_node"))
    out = sketch.select("doc_id", "n_shingles", "set_key").join(of_class, "set_key", "left").join(of_node, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("by_class", "by_node", "doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text)."""
    with temporary(docs.sparkSession) as scratch:
        named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        sketch = stored(sketches(named, size), "sketches")
        texts = named.withColumnRenamed("doc_id", "node")
        found = connected(sketch, lambda nodes: sets_of(texts, nodes, size), percent)
        kept = F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))
        return scratch.kept(found.withColumn("kept", kept), "near_duplicates")


def deduplicate(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, with its own columns.

    Every row is a document of its own: rows without an id, repeated rows and rows of one id with different texts too. The row
    with the smallest id stays (one without an id only if no other has one), of equal ids the one whose columns
    have the least digest. A row without words is its own component.

    Rows are told apart by their places in the files of ``docs``; a table that is not read from Parquet files is written first.
    Texts are not copied otherwise, and what the search writes is removed but for the list of the rows that go.
    """
    at = file_rows(docs)
    if at is None:
        docs = stored(docs, "rows")
        at = file_rows(docs)
    with temporary(docs.sparkSession) as scratch:
        whole = F.unhex(F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]))))
        place = [at[0].alias("path"), at[1].alias("at")]
        rows = docs.select(*place, F.col("doc_id").cast("long").alias("id"), whole.alias("digest"), "text")
        # Numbers are given once and written, so that every later pass sees the same ones.
        sketch = stored(sketches(rows, size).withColumn("doc_id", F.monotonically_increasing_id()), "sketches")
        numbers = sketch.select(F.col("doc_id").alias("node"), "path", "at")
        texts = docs.select(*place, "text")
        found = connected(sketch, lambda nodes: sets_of(texts, numbers.join(nodes, "node", "left_semi"), size), percent)
        found = stored(found.select(F.col("doc_id").alias("row"), "component_id"), "found")
        groups = found.filter("row <> component_id").select("component_id").distinct()
        members = found.join(groups, "component_id", "left_semi")
        named = sketch.select(F.col("doc_id").alias("row"), "id", "digest", "path", "at")
        best = F.min(F.struct(F.col("id").isNull().alias("late"), "id", "digest", "row")).alias("best")
        members = stored(members.join(named, "row"), "members")
        chosen = members.groupBy("component_id").agg(best).select(F.col("best.row").alias("row"))
        drop = scratch.kept(members.join(chosen, "row", "left_anti").select("path", "at"), "dropped")
    path, number = unused(docs, "path"), unused(docs, "at")
    gone = drop.select(F.col("path").alias(path), F.col("at").alias(number))
    left = docs.withColumns({path: at[0], number: at[1]}).join(gone, [path, number], "left_anti")
    return left.select(*[f"`{c}`" for c in docs.columns])
