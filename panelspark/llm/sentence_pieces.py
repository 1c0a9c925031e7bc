"""SentencePiece ids of whole texts by a table of distinct marked words, and texts back from ids.

The library puts a marker before a text and in place of every space; a piece of the given vocabulary never holds a marker
behind another character. Merges of byte-pair encoding therefore stay within a marked word: a run of markers and what
follows up to the next marker. So a batch of texts is cut into marked words, each distinct one is segmented once by
the library, and the ids are joined back by position. A line break that no piece holds is a boundary as well.

The table of a worker remembers at most ``MEMORY_WORDS`` words besides those of the batch at hand, which has at most
``BATCH_BYTES`` of text (or one longer text).

A vocabulary whose pieces can cross markers, or whose rules rewrite texts, is refused (``ValueError``).

Defined cases: a null or empty text is the end id alone, and decodes to an empty text; repeated rows get a row each; a marker
that stands in the text is one, as in the library, and decodes to a space; an empty table gives an empty result; other
columns than the id and the text are left out.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.runs import batches_of, within

MARKER = "▁"
CUT = "\x1f"  # put between the words of a text that does not hold it
MEMORY_WORDS = 300_000
BATCH_BYTES = 4 << 20
ENCODED = "doc_id bigint, ids array<int>"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class WordTable(dict):
    """Marked word -> number, given at its first sight; ``new`` holds those without ids yet."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Segmenter:
    """Ids of texts, equal to the library's ``encode(text)`` followed by the end id."""

    def __init__(self, path: str, memory: int = MEMORY_WORDS) -> None:
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        self.memory = memory
        pieces = _checked_pieces(path)
        # The library segments a word behind its own marker; behind a line break that marker is a piece by itself.
        self.breaks = not any("\n" in p for p in pieces)
        self.words_of = re.compile(f"(?:\n|{MARKER}+)[^{MARKER}\n]*" if self.breaks else f"{MARKER}+[^{MARKER}]*").findall
        self.marker_id = self.library.piece_to_id(MARKER)
        self.end_id = self.library.eos_id()
        self._clear()

    def _clear(self) -> None:
        self.table, self.flat, self.ends = WordTable(), array("i"), array("q", [0])

    def _learn(self) -> None:
        words, self.table.new = self.table.new, []
        raw = [w if w[0] == "\n" else w[1:].replace(MARKER, " ") for w in words]
        for word, ids in zip(words, self.library.encode(raw, num_threads=1), strict=True):
            if word[0] == "\n":
                if ids[0] != self.marker_id:
                    raise ValueError("the library did not put a marker before the text")
                ids = ids[1:]
            self.flat.extend(ids if word != MARKER else [self.marker_id])
            self.ends.append(len(self.flat))

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each with the end id behind, and the places where the texts' ids begin and end."""
        if len(self.table) > self.memory:
            self._clear()
        words, first, counts = self._words(pc.fill_null(texts, ""))
        distinct = words.dictionary_encode()
        numbers = np.fromiter(map(self.table.__getitem__, distinct.dictionary.to_numpy(zero_copy_only=False).tolist()), np.int64, len(distinct.dictionary))
        self._learn()
        flat, ends = np.array(self.flat, np.int32), np.array(self.ends, np.int64)
        # One row of ids per word, by position, and one for each text's end.
        text_ends = np.cumsum(counts) + np.arange(len(counts))
        is_word = np.ones(int(counts.sum()) + len(counts), bool)
        is_word[text_ends] = False
        rows = np.full(len(is_word), -1, np.int64)
        rows[is_word] = numbers[distinct.indices.to_numpy()[np.repeat(first, counts) + within(counts)]]
        sizes = np.where(is_word, ends[rows + 1] - ends[rows], 1)
        begin = np.repeat(np.where(is_word, ends[rows], -1), sizes)
        ids = np.append(flat, np.int32(self.end_id))[np.where(begin < 0, len(flat), begin + within(sizes))]
        return ids, np.concatenate([[0], np.cumsum(sizes)[text_ends]])

    def _words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Marked words of all texts, and where each text's begin and how many they are.

        Texts whose blanks are single spaces within the text are cut by Arrow, all others by the pattern.
        """
        odd = pc.match_substring_regex(texts, f"^ |  |{MARKER}|{CUT}").to_numpy(zero_copy_only=False)
        cut = pc.replace_substring(texts.filter(pa.array(~odd)), " ", CUT + MARKER)
        if self.breaks:
            cut = pc.replace_substring(cut, "\n", CUT + "\n")
        lists = pc.split_pattern(pc.binary_join_element_wise(MARKER, cut, ""), CUT)
        others = [self.words_of(MARKER + t.replace(" ", MARKER)) for t in texts.filter(pa.array(odd)).to_pylist()]
        words = pa.concat_arrays([lists.flatten(), pa.array([w for ws in others for w in ws], pa.string())])
        counts = np.zeros(len(texts), np.int64)
        counts[~odd], counts[odd] = np.diff(lists.offsets.to_numpy()), [len(ws) for ws in others]
        order = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
        first = np.zeros(len(texts), np.int64)
        first[order] = np.cumsum(counts[order]) - counts[order]
        # An empty text has no words, though cutting gives it a marker.
        counts[pc.equal(texts, "").to_numpy(zero_copy_only=False)] = 0
        return words, first, counts


def _checked_pieces(path: str) -> list[str]:
    """The pieces that merges can make; raises if marked words could not be segmented one by one."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    rules, kinds = model.normalizer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
    pieces = [p.piece for p in model.pieces if p.type in (kinds.NORMAL, kinds.USER_DEFINED, kinds.UNUSED)]
    if model.trainer_spec.model_type != sentencepiece_model_pb2.TrainerSpec.BPE or any(p.type == kinds.USER_DEFINED for p in model.pieces):
        raise ValueError("only byte-pair models without symbols of the user's own are segmented word by word")
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not (rules.add_dummy_prefix and rules.escape_whitespaces):
        raise ValueError("the model's rules rewrite texts before they are segmented")
    if any(MARKER in p.lstrip(MARKER) for p in pieces):
        raise ValueError("some piece holds a marker behind another character")
    return pieces


@lru_cache(maxsize=1)
def segmenter_of(path: str | None) -> Segmenter:
    """One table per worker process."""
    return Segmenter(path or default_model())


def encode(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (``doc_id``, ``text``); the last id is the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = segmenter_of(model_path)
        for batch in batches:
            for part in batches_of(batch.column(1), BATCH_BYTES):
                some = batch.slice(part.start, part.stop - part.start)
                ids, places = segmenter.batch(some.column(1))
                lists = pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([some.column(0), lists], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded): the text that the library makes of each row's ids (null ids: an empty text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = segmenter_of(model_path).library
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                texts = library.decode([ids or [] for ids in some.column(1).to_pylist()], num_threads=1)
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"{ENCODED}, decoded string")
