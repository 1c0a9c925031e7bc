"""Language identification by cross-parsing entropy.

For each language a bounded sample of labelled text is made into a suffix automaton. A text is parsed
into phrases, each the longest string from its position that occurs in the language's sample; few phrases
mean that the text looks like the sample. With a sample of n symbols a phrase costs about log2 n bits, so
``phrases * log2 n`` is compared between languages and the smallest wins.

A text is lower-cased and cut into blocks of ``BLOCK`` symbols; a phrase ends with its block. All blocks of a
batch are parsed side by side with one table look-up per symbol. Every letter of every sample is a symbol, so
the table is sparse: the rows of all states lie interleaved in one array, and an entry names the state it belongs to.
Where a state has no entry for a symbol, a new phrase begins. Whole texts are parsed.

Learning: the labelled rows of every language that hold a letter are dealt into ``SAMPLE_ROWS`` classes by a hash of
the id, of each class the row of smallest hash is kept (one aggregation that combines map-side, so a hot language
is no group of its own), and at most ``SAMPLE_CHARS`` symbols of these rows are used, the same share of each, from
up to ``PLACES`` hash-chosen places of a text. The model's size depends on these bounds and the number of languages only.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; with no labelled language
every text is; ties go to the language that sorts first; labelled rows without letters or id teach nothing; repeated
rows are predicted alike; an empty table gives an empty result; columns other than id, text and label are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_CHARS = 12_000
SAMPLE_ROWS = 64
PLACES = 8
LEAST_PLACE = 64  # symbols taken at one place of a text, unless its share is less
BLOCK = 512
BATCH_SYMBOLS = 1 << 21  # symbols parsed side by side
SEARCH = 4_096  # places of a sparse table looked at together
UNKNOWN = "und"


def suffix_automaton(text: np.ndarray) -> list[dict[int, int]]:
    """Transitions per state (0 is the start) of the smallest automaton of all substrings of ``text``."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text.tolist():
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


@dataclass
class ParseTable:
    """``entry[base[state] + symbol]`` is ``state << 32 | next`` if the state goes on with the symbol.

    If not, a new phrase begins with the symbol and leads to ``start[symbol]``. A symbol that the sample does not hold is
    a phrase of its own; the one after it begins another.
    """

    base: np.ndarray
    entry: np.ndarray
    start: np.ndarray


def parse_table(text: np.ndarray, symbols: int) -> ParseTable:
    nxt = suffix_automaton(text)
    start = np.zeros(symbols, np.int64)
    for c, s in nxt[0].items():
        start[c] = s
    # From the start state every symbol begins a phrase, so it has no entries. Rows of many symbols are placed first,
    # each where all its places are free; a row of one symbol takes any free place.
    base = np.zeros(len(nxt), np.int64)
    entry = np.full(2 * symbols + 4 * len(nxt), -1, np.int64)
    top = symbols  # a row's base may lie up to ``symbols`` before its first symbol
    first_free = 0
    for state in sorted(range(1, len(nxt)), key=lambda i: -len(nxt[i])):
        if not nxt[state]:
            break
        row = np.array(sorted(nxt[state]), np.int64)
        offset = row - row[0]
        while entry[first_free] >= 0:
            first_free += 1
        at = -1
        for low in range(first_free, top, SEARCH):
            places = low + np.flatnonzero(entry[low : min(low + SEARCH, top)] < 0)
            for o in offset[1:].tolist():
                places = places[entry[places + o] < 0]
            if len(places):
                at = int(places[0])
                break
        if at < 0:
            at = top
        top = max(top, at + int(offset[-1]) + 1)
        while len(entry) < top + symbols:
            entry = np.concatenate([entry, np.full(len(entry), -1, np.int64)])
        base[state] = at - row[0]
        entry[at + offset] = (state << 32) + np.array([nxt[state][c] for c in row.tolist()], np.int64)
    # Bases may be negative by less than ``symbols``; look-ups reach less than ``symbols`` beyond the last base.
    entry = np.concatenate([np.full(symbols, -1, np.int64), entry[: top + symbols]])
    return ParseTable(base + symbols, entry, start)


@dataclass
class LanguageModel:
    languages: list[str]
    symbol_of: np.ndarray  # code point -> symbol; 0: anything but a letter, 1: a letter of no sample
    n_symbols: int
    tables: list[ParseTable]
    bits: list[float]  # bits a phrase

    def phrases(self, coded: list[np.ndarray]) -> np.ndarray:
        """Phrases of each coded text (rows) by language (columns)."""
        out = np.zeros((len(coded), len(self.tables)))
        owner = np.repeat(np.arange(len(coded)), [-(-len(c) // BLOCK) for c in coded])
        blocks = [c[i : i + BLOCK] for c in coded for i in range(0, len(c), BLOCK)]
        # Long blocks first, so that the columns still running are always the first ones.
        order = np.argsort([-len(b) for b in blocks], kind="stable")
        for at in range(0, len(order), max(1, BATCH_SYMBOLS // BLOCK)):
            group = order[at : at + max(1, BATCH_SYMBOLS // BLOCK)]
            sizes = np.array([len(blocks[i]) for i in group])
            symbols = np.zeros((sizes[0], len(group)), np.int32)
            for col, i in enumerate(group):
                symbols[: sizes[col], col] = blocks[i]
            running = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
            for k, table in enumerate(self.tables):
                np.add.at(out[:, k], owner[group], self._ragged(symbols, running, table))
        return out

    def _ragged(self, symbols: np.ndarray, running: np.ndarray, table: ParseTable) -> np.ndarray:
        phrases = np.zeros(symbols.shape[1], np.int64)
        state = np.zeros(symbols.shape[1], np.int64)
        for row, n in zip(symbols, running.tolist(), strict=True):
            found = table.entry[table.base[state[:n]] + row[:n]]
            new = found >> 32 != state[:n]
            phrases[:n] += new
            state[:n] = np.where(new, table.start[row[:n]], found & 0xFFFFFFFF)
        return phrases

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        coded = [self.symbol_of[code_points((t or "").lower())] for t in texts]
        known = np.array([bool(len(self.languages)) and bool(c.any()) for c in coded], bool)
        if not known.any():
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        cost = self.phrases([c if k else c[:0] for c, k in zip(coded, known, strict=True)]) * np.array(self.bits)
        best = cost.argmin(axis=1)
        # Share of the winner when languages weigh 2 ** -(their extra bits per phrase of the winner).
        low = cost.min(axis=1, keepdims=True)
        weight = np.exp2(-(cost - low) / np.maximum(low, 1.0) * 8.0)
        score = np.where(known, 1.0 / weight.sum(axis=1), 0.0)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], score


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """1 for code points that are letters."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.uint8, 0x110000))
    return _LETTERS[0]


def spread(text: str, take: int) -> str:
    """At most ``take`` symbols of the text: all of it, or one hash-chosen stretch in each of equal parts of it.

    Of a text that is cut, runs of blanks count as one blank.
    """
    if len(text) > take:
        text = " ".join(text.split())
    if len(text) <= take:
        return text
    parts = max(1, min(PLACES, take // LEAST_PLACE))
    width, span = (take - parts + 1) // parts, len(text) // parts
    if width <= 0:
        return ""
    seed = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    starts = [k * span + (seed * (2 * k + 1) >> 5) % (span - width + 1) for k in range(parts)]
    return " ".join(text[i : i + width] for i in starts)


def fit(samples: dict[str, list[str]], sample_chars: int = SAMPLE_CHARS) -> LanguageModel:
    """A model from texts per language; of each text the same share is used, up to ``sample_chars`` in all."""
    chosen: dict[str, str] = {}
    for lang, texts in samples.items():
        lowered = [t.lower() for t in sorted(texts)]
        total = sum(map(len, lowered))
        parts, room = [], sample_chars
        for t in lowered:
            take = min(room, -(-len(t) * sample_chars // max(total, sample_chars)))
            parts.append(spread(t, take))
            room -= take
        joined = " ".join(p for p in parts if any(map(str.isalpha, p)))
        if joined:
            chosen[lang] = joined
    used = sorted({c for t in chosen.values() for c in t if c.isalpha()})
    symbol_of = letters().astype(np.int32)
    for i, c in enumerate(used):
        symbol_of[ord(c)] = i + 2
    languages = sorted(chosen)
    coded = [symbol_of[code_points(chosen[lang])] for lang in languages]
    n = len(used) + 2
    return LanguageModel(languages, symbol_of, n, [parse_table(c, n) for c in coded], [float(np.log2(len(c) + 1)) for c in coded])


def labelled_sample(docs: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> dict[str, list[str]]:
    """At most ``rows`` texts of each language, of each up to ``SAMPLE_CHARS`` symbols, from the rows with a letter where ``learn`` holds."""
    h = F.xxhash64("doc_id")
    usable = docs.filter(learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.regexp_like("text", F.lit(r"\p{L}")))
    least = usable.groupBy("lang", F.pmod(h, F.lit(rows)).alias("class")).agg(F.min(h).alias("h"))
    # At most rows * languages numbers come to the driver, then as many texts.
    chosen = [r["h"] for r in least.select("h").collect()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [spread(t, SAMPLE_CHARS) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["lang", "text"])

    picked = usable.filter(h.isin(chosen)).select("lang", "text").mapInArrow(run, "lang string, text string")
    found: dict[str, list[str]] = {}
    for r in picked.dropDuplicates(["lang", "text"]).collect():
        if r["text"]:
            found.setdefault(r["lang"], []).append(r["text"])
    return found


def identify(docs: DataFrame, learn: Column, keep: tuple[str, ...] = ("doc_id",), sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` for every row; learns from rows where ``learn`` holds.

    ``docs`` has doc_id, text and lang; a prediction sees the text alone.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(labelled_sample(docs, learn), sample_chars))
    fields = [T.StructField(c, docs.schema[c].dataType) for c in keep]
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            predicted, score = model.value.predict(batch.column(len(keep)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(predicted, pa.string()), pa.array(score)], names=schema.names)

    return docs.select(*keep, "text").mapInArrow(run, schema)
