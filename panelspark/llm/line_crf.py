"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is labelled good or bad. A line's evidence is a linear function of its own features
and of those of the lines before and after it, and the chain ties the labels of neighbouring lines
together. Forward-backward gives each line's marginal probability of being good; weighted by the lines'
lengths these make up the document's quality.

Learning sees a bounded sample of labelled documents (``SAMPLE_DOCS`` per label; the rows of smallest id hash in
as many classes, one aggregation that combines map-side), each as a whole text. A document's label stands for all
its lines, so the documents of the sample are chains of known labels, and the evidence weights maximise their
conditional likelihood (gradient ascent with Adam, in a fixed number of rounds, both labels weighing the
same). Such chains never change label and say nothing about how often lines do. So in a second step the lines'
labels are hidden and the document's label is what is seen: of the ``CHAINS`` of weights for staying, with a scale and a shift
of the evidence, the ones that make the documents' labels likeliest under the documents' qualities are taken.

Features are counted with numpy on the bytes of a batch of texts, or of a block of lines of a long text, and
forward-backward runs over pieces of ``PIECE`` lines side by side, each started with the exact message of the
piece before; whole texts are scored.

Defined cases: a null text is scored as an empty one; an empty text is one empty line; without labels
of both kinds every score is the share of label 1 (0.5 without labels); labels that are null or contradict each other for an id are
not learned from; repeated rows are scored alike; an empty table gives an empty result; columns other than id and text
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_DOCS = 1_000
ROUNDS = 200
BATCH_BYTES = 1 << 20  # bytes counted at a time; a longer text is counted in blocks of lines
BATCH_LINES = 1 << 14  # lines counted at a time
PIECE = 512  # lines of a chain that forward-backward takes one after the other
STAY = 1.5  # log weight for two neighbouring lines of the same label while the evidence is learned
CHAINS = (0.0, 0.5, 1.0, 1.5, 2.0, 3.0)  # what it may become
PENALTY = 1e-4

_BYTE = np.arange(256)
_CLASSES = {
    "upper": (_BYTE >= 65) & (_BYTE <= 90),
    "lower": ((_BYTE >= 97) & (_BYTE <= 122)),
    "beyond": _BYTE >= 128,
    "digit": (_BYTE >= 48) & (_BYTE <= 57),
    "blank": np.isin(_BYTE, list(b" \t\r\x0b\x0c")),
    "stop": np.isin(_BYTE, list(b".?")),
    "comma": np.isin(_BYTE, list(b",;:")),
    "exclaim": np.isin(_BYTE, list(b"!")),
    "symbol": np.isin(_BYTE, list(b"#*$%&<>@^~_=+\\/{}[]")),
    "bar": np.isin(_BYTE, list(b"|")),
}
# Byte -> its class; the classes do not overlap, and what is in none comes last.
_N_CLASSES = len(_CLASSES) + 1
_CLASS_OF = np.full(256, len(_CLASSES))
for _i, _member in enumerate(_CLASSES.values()):
    _CLASS_OF[_member] = _i
# The own features of a line; the same of the lines before and after follow, then a constant.
OWN = (
    "upper", "beyond", "digit", "stop", "comma", "exclaim", "symbol", "bar", "word_length", "short", "long", "repeats",
    "same_line", "ends_stop", "empty",
)


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of all lines, length of each line, number of lines of each text)."""
    joined = b"\n".join(texts)
    data = np.frombuffer(joined + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = (ends - starts).astype(np.float64)
    n_lines = np.array([t.count(b"\n") + 1 for t in texts])

    line = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends + 1])))
    counts = np.bincount(line * _N_CLASSES + _CLASS_OF[data], minlength=len(ends) * _N_CLASSES).reshape(-1, _N_CLASSES)
    count = {name: counts[:, i].astype(np.float64) for i, name in enumerate(_CLASSES)}
    blank = _CLASSES["blank"][data] | (data == 10)
    first = ~blank & np.concatenate([[True], blank[:-1]])
    words = np.bincount(line[first], minlength=len(ends)).astype(np.float64)
    # A word equal to the one before: compare hashes of neighbouring words.
    word_hash, word_line = _word_hashes(data, first, blank, ends)
    again = (word_hash[1:] == word_hash[:-1]) & (word_line[1:] == word_line[:-1])
    repeats = np.bincount(word_line[1:][again], minlength=len(ends)).astype(np.float64)
    line_hash = np.add.reduceat(np.concatenate([word_hash * np.uint64(3), [np.uint64(0)]]), _first_word(word_line, len(ends)))
    same = np.zeros(len(ends))
    same[1:] = (line_hash[1:] == line_hash[:-1]) & (words[1:] > 0) & (words[1:] == words[:-1])
    ends_of = np.cumsum(n_lines)
    same[np.concatenate([[0], ends_of[:-1]])] = 0
    last = data[np.maximum(ends - 1, 0)]
    per_word, per_char = np.maximum(words, 1), np.maximum(size, 1)
    own = np.column_stack([
        count["upper"] / per_char,
        count["beyond"] / per_char,
        count["digit"] / per_char,
        np.minimum(count["stop"] / per_word * 4, 2),
        np.minimum(count["comma"] / per_word * 4, 2),
        np.minimum(count["exclaim"] / per_word * 2, 2),
        np.minimum(count["symbol"] / per_word * 2, 2),
        np.minimum(count["bar"] / per_word * 2, 2),
        np.minimum((size - count["blank"]) / per_word / 8, 3),
        words < 4,
        words > 40,
        repeats / per_word,
        same,
        (size > 0) & (_CLASSES["stop"][last] | _CLASSES["exclaim"][last]),
        words == 0,
    ]).astype(np.float64)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[np.concatenate([[0], ends_of[:-1]])] = 0
    after[ends_of - 1] = 0
    return np.hstack([own, before, after, np.ones((len(own), 1))]), size, n_lines


def _word_hashes(data: np.ndarray, first: np.ndarray, blank: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(first)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # Sum of byte values weighted by the position in the word.
    where = np.arange(len(data), dtype=np.int64)
    begin = np.repeat(at, np.diff(np.append(at, len(data))))
    inside = np.where(blank[at[0] :], 0, data[at[0] :].astype(np.uint64) * ((where[at[0] :] - begin).astype(np.uint64) * np.uint64(2654435761) + np.uint64(40503)))
    return np.add.reduceat(inside.astype(np.uint64), at - at[0]), np.searchsorted(ends, at)


def _first_word(word_line: np.ndarray, n_lines: int) -> np.ndarray:
    return np.searchsorted(word_line, np.arange(n_lines))


def marginals(evidence: np.ndarray, n_lines: np.ndarray, stay: float) -> np.ndarray:
    """Marginal log odds of good for every line; ``evidence`` is each line's own log odds."""
    out = messages(evidence, n_lines, stay)
    out += messages(evidence[::-1], n_lines[::-1], stay)[::-1]
    out += evidence
    return out


def messages(evidence: np.ndarray, n_lines: np.ndarray, stay: float) -> np.ndarray:
    """What the lines before a line contribute to its log odds.

    One step of a chain with weight ``stay`` for equal labels turns log odds m into
    ``log((e^(m+s) + 1) / (e^m + e^s))``. Chains are cut into pieces of ``PIECE`` lines, and all pieces take a step at the
    same time, longest first. What a whole piece does to its first message is a 2 x 2 matrix on the odds; with these
    the first messages go from piece to piece.
    """
    n_pieces = -(-n_lines // PIECE)
    chain = np.repeat(np.arange(len(n_lines)), n_pieces)
    number = np.arange(len(chain)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
    first = (np.cumsum(n_lines) - n_lines)[chain] + number * PIECE
    lengths = np.minimum(PIECE, n_lines[chain] - number * PIECE)
    arriving = np.zeros(len(chain))
    passing = np.flatnonzero(number + 1 < n_pieces[chain])  # pieces that another one follows: whole ones
    if len(passing):
        same = np.exp(stay)
        a, b, c, d = np.ones(len(passing)), np.zeros(len(passing)), np.zeros(len(passing)), np.ones(len(passing))
        for step in range(PIECE):
            e = evidence[first[passing] + step]
            up, down = np.exp(np.minimum(e, 0)), np.exp(-np.maximum(e, 0))
            a, b, c, d = up * a * same + down * c, up * b * same + down * d, up * a + down * c * same, up * b + down * d * same
            total = a + b + c + d
            a, b, c, d = a / total, b / total, c / total, d / total
        at = np.argsort(number[passing], kind="stable")
        bounds = np.searchsorted(number[passing][at], np.arange(number.max() + 1))
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            k = at[lo:hi]
            odds = np.exp(arriving[passing[k]])
            arriving[passing[k] + 1] = np.log(a[k] * odds + b[k]) - np.log(c[k] * odds + d[k])

    order = np.argsort(-lengths, kind="stable")
    first, lengths = first[order], lengths[order]
    running = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    out = np.empty(len(evidence))
    out[first] = arriving[order]
    for step in range(1, lengths[0]):
        here = first[: running[step]] + step
        m = out[here - 1] + evidence[here - 1]
        out[here] = np.logaddexp(m + stay, 0) - np.logaddexp(m, stay)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    out = x / 2
    np.tanh(out, out=out)
    out += 1
    out *= 0.5
    return out


@dataclass
class LineModel:
    weights: np.ndarray | None
    scale: float
    shift: float
    share: float  # of label 1, when there is nothing else
    stay: float = STAY

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.share)
        scores = [self._score(group) for group in batches(texts)]
        return np.concatenate(scores) if scores else np.zeros(0)

    def _score(self, texts: list[bytes]) -> np.ndarray:
        parts = [(f @ self.weights * self.scale + self.shift, size.astype(np.int32)) for f, size in features_of(texts)]
        evidence, size = (np.concatenate(p) if len(p) > 1 else p[0] for p in zip(*parts, strict=True))
        del parts
        return document_scores(evidence, size, count_lines(texts), self.stay)


def count_lines(texts: list[bytes]) -> np.ndarray:
    return np.array([t.count(b"\n") + 1 for t in texts])


def batches(texts: list[str | None]) -> Iterator[list[bytes]]:
    """The texts in groups of ``BATCH_BYTES`` and ``BATCH_LINES``; a text beyond either is a group of its own."""
    group, held, lines = [], 0, 0
    for t in texts:
        data = (t or "").encode("utf-8", "surrogatepass")
        n = data.count(b"\n") + 1
        if group and (held + len(data) > BATCH_BYTES or lines + n > BATCH_LINES):
            yield group
            group, held, lines = [], 0, 0
        group.append(data)
        held, lines = held + len(data), lines + n
    if group:
        yield group


def features_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, lengths) of the lines of a group of :func:`batches`, a single text in blocks of lines.

    A block is counted with the two lines before and the one after it, which its features depend on.
    """
    if len(texts) > 1:
        features, size, _ = line_features(texts)
        yield features, size
        return
    (text,) = texts
    data, at = np.frombuffer(text, np.uint8), 0
    while at <= len(text):
        breaks = np.flatnonzero(data[at : at + BATCH_BYTES] == 10)[:BATCH_LINES]
        if len(breaks) == BATCH_LINES or (len(breaks) and at + BATCH_BYTES < len(text)):
            end = at + int(breaks[-1])
        else:
            end = text.find(b"\n", at + BATCH_BYTES)  # the block's only line, or the rest of the text
            end = len(text) if end < 0 else end
        lead, before = at, 0
        while lead and before < 2:
            lead, before = text.rfind(b"\n", 0, lead - 1) + 1, before + 1
        tail = end if end == len(text) else text.find(b"\n", end + 1)
        features, size, n = line_features([text[lead : len(text) if tail < 0 else tail]])
        own = slice(before, int(n[0]) - (end < len(text)))
        yield features[own], size[own]
        at = end + 1


def document_scores(evidence: np.ndarray, size: np.ndarray, n_lines: np.ndarray, stay: float) -> np.ndarray:
    good = _sigmoid(marginals(evidence, n_lines, stay))
    starts = np.concatenate([[0], np.cumsum(n_lines)[:-1]])
    sums = np.add.reduceat(good, starts)
    good *= size
    return (sums + np.add.reduceat(good, starts)) / (np.add.reduceat(size, starts, dtype=np.float64) + n_lines)


def fit(texts: list[str], labels: list[int], rounds: int = ROUNDS, stay: float = STAY) -> LineModel:
    """Weights from texts and their labels (0 or 1)."""
    y = np.asarray(labels, np.float64)
    if not len(y) or y.min() == y.max():
        return LineModel(None, 1.0, 0.0, float(y.mean()) if len(y) else 0.5)
    parts = [part for group in batches(texts) for part in features_of(group)]
    features, size = np.vstack([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    del parts
    n_lines = np.array([t.count("\n") + 1 for t in texts])
    starts = np.concatenate([[0], np.cumsum(n_lines)[:-1]])
    sign = np.repeat(2 * y - 1, n_lines)
    # Every document weighs the same, its lines by length, and both labels weigh the same.
    weight = np.repeat(np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum()), n_lines) * (size + 1)
    weight /= np.repeat(np.add.reduceat(size + 1, starts), n_lines)
    w, m, v = np.zeros(features.shape[1]), np.zeros(features.shape[1]), np.zeros(features.shape[1])
    for t in range(1, rounds + 1):
        # The gradient of a chain's log likelihood: observed minus expected features of its lines.
        expected = _sigmoid(marginals(features @ w, n_lines, stay))
        observed = (sign + 1) / 2
        g = features.T @ (weight * (observed - expected)) - PENALTY * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w += 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    # The lines' labels hidden: chain weight, scale and shift under which the document scores fit the labels best.
    evidence = features @ w
    doc_weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())

    def loss(scale: float, shift: float, chain: float) -> float:
        s = np.clip(document_scores(evidence * scale + shift, size, n_lines, chain), 1e-6, 1 - 1e-6)
        return -float((doc_weight * np.where(y == 1, np.log(s), np.log(1 - s))).sum())

    tried = ((loss(a, b, c), a, b, c) for a in (0.25, 0.5, 1.0, 2.0, 4.0) for b in (0.0, 0.25, 0.5, 1.0) for c in CHAINS)
    _, scale, shift, chain = min(tried)
    return LineModel(w, scale, shift, float(y.mean()), chain)


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, most: int = SAMPLE_DOCS) -> tuple[list[str], list[int]]:
    """At most ``most`` texts of each label from documents where ``learn`` holds, chosen by a hash of the id."""
    clean = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .filter("quality = other")
        .select("doc_id", "quality")
    )
    usable = clean.filter(learn)
    h = F.xxhash64("doc_id")
    least = usable.groupBy("quality", F.pmod(h, F.lit(most)).alias("class")).agg(F.min(F.struct(h, F.col("doc_id"))).alias("m"))
    # At most 2 * most ids come to the driver, then as many texts.
    chosen = {r["doc_id"]: r["quality"] for r in least.select("quality", "m.doc_id").collect()}
    picked = docs.filter(F.col("doc_id").isin(list(chosen))).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = sorted({(r["doc_id"], r["text"]) for r in picked.collect()})
    return [t for _, t in rows], [chosen[i] for i, _ in rows]


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> LineModel:
    return fit(*labelled_sample(docs, labels, learn))


def score_documents(docs: DataFrame, model: LineModel, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the document quality (0 to 1) as column ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)
    # Columns go by place, so any names may occur.
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)] + [T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = shared.value.score(batch.column(place).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], names=schema.names)

    scored = docs.toDF(*schema.names[:-1]).mapInArrow(run, schema)
    return scored.toDF(*docs.columns, score)
