"""Packing documents into windows of a fixed number of tokens.

Bounded-space online packing: every partition keeps a fixed number of open windows. A document's ids are
cut into full windows and a rest; the rest goes into the open window that it fills best. When none has
room, the fullest open window is emitted and a new one opened. What is still open at a partition's end is
merged with the leftovers of a bounded number of other partitions, fullest first.

The windows of one pass are written to the shared scratch folder (ids as little-endian unsigned 32-bit
bytes), so every text is tokenized once and the layout stays the same if an executor is lost; only the
leftovers, a bounded number per partition, are packed again.

Tokenizing: texts are cut at single spaces and line breaks, where the byte-level vocabulary's splitting
rule starts a new piece anyway; each distinct piece of a batch is looked up in a bounded table of remembered ids, an Arrow
array of pieces beside numpy arrays, so that a worker holds no object for each of them. Texts with other blanks go to the
tokenizer as they are.

Defined cases: a null or empty text is the end id alone; a text of any length is cut into whole windows;
repeated rows are packed as often as they occur; an empty table gives an empty result; columns other than the
id and the text are ignored.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import stored
from panelspark.llm.runs import batches_of, within

WINDOW = 2048
OPEN_WINDOWS = 64
MERGE_PARTITIONS = 32  # partitions whose leftovers meet in one task: at most OPEN_WINDOWS windows each
MEMORY_PIECES = 200_000  # remembered pieces per worker
MEMORY_BYTES = 4 << 20  # and bytes of them
LONG_PIECE = 64  # bytes; longer pieces seldom come again and are the first to be forgotten
END_ID = 1

PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
_LAID = PIECES + ", leftover boolean"
_ARROW = {"bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
JOINED = 5_000  # new pieces encoded in one go
BATCH_BYTES = 2 << 20  # of text tokenized at once, or one longer text
PART_BYTES = 1 << 18  # of text whose ids are laid out at once, or one longer text


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def default_ranks() -> str:
    """The same vocabulary as ranks, for the faster encoder."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Tokenizer:
    """Ids of whole texts as uint32 arrays, equal to those of ``tokenizers`` on the given file.

    The byte-level splitting rule starts a new piece at every single blank: a space goes to the piece
    after it, a line break stands before its own. So where blanks are single spaces and line breaks, the ids of a
    text are the ids of its pieces. Arrow cuts a batch of such texts and finds the distinct pieces; those seen before are
    remembered, and of too many (in number or bytes) the more frequent half is kept, but for long ones. New pieces of the common alphabets go to the encoder built from the
    ranks (same ids, faster), all others, and texts with other blanks, to the tokenizer.
    """

    # In texts that Arrow does not cut: other blanks, two blanks together, and blanks at either end.
    ODD = (
        "[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
        "|[ \n][ \n]|^[ \n]|[ \n]$"
    )
    CUT = "\x1f"  # one of the other blanks
    COMMON = "^[ \n][\x21-\x7e\xa1-\u024f]*$"

    def __init__(self, path: str, ranks: str | None = None, memory: int = MEMORY_PIECES) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer as File

        self.file = File.from_file(path)
        self.fast, self.token_bytes = _ranked(ranks) if ranks else (None, None)
        self.memory = memory
        self.known = pa.array([], pa.string())
        self.flat, self.ends, self.times = np.empty(0, np.uint32), np.zeros(1, np.int64), np.empty(0, np.int64)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.file.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after the other, and how many each has."""
        # The special token's text is left to the tokenizer, and a text's first piece too if it has no blank before it.
        joinable = np.zeros(len(pieces), bool)
        if self.fast:
            joinable = pc.match_substring_regex(pieces, self.COMMON).to_numpy(zero_copy_only=False)
            joinable &= ~pc.match_substring(pieces, "<|").to_numpy(zero_copy_only=False)
        sizes = np.zeros(len(pieces), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        easy, hard = np.flatnonzero(joinable), np.flatnonzero(~joinable)
        for at in range(0, len(easy), JOINED):
            # Each starts with a blank, so in a row they are cut where they begin.
            some = easy[at : at + JOINED]
            texts = pieces.take(pa.array(some))
            ids = np.asarray(self.fast("".join(texts.to_pylist())), np.uint32)
            stops = np.searchsorted(np.cumsum(self.token_bytes[ids]), np.cumsum(pc.binary_length(texts).to_numpy())) + 1
            sizes[some] = np.diff(stops, prepend=0)
            found.append((some, ids))
        for at in range(0, len(hard), JOINED):
            some = hard[at : at + JOINED]
            encoded = self._ids(pieces.take(pa.array(some)).to_pylist())
            sizes[some] = [len(ids) for ids in encoded]
            found.append((some, np.fromiter(chain.from_iterable(encoded), np.uint32)))
        starts, flat = np.cumsum(sizes) - sizes, np.empty(int(sizes.sum()), np.uint32)
        for some, ids in found:
            flat[np.repeat(starts[some], sizes[some]) + within(sizes[some])] = ids
        return flat, sizes

    def _learn(self, pieces: pa.Array) -> np.ndarray:
        """The numbers of these distinct pieces; the new ones get theirs and their ids."""
        numbers = pc.fill_null(pc.index_in(pieces, value_set=self.known), -1).to_numpy().astype(np.int64)
        fresh = numbers < 0
        if fresh.any():
            new = pieces.filter(pa.array(fresh))
            numbers[fresh] = np.arange(len(self.known), len(self.known) + len(new))
            ids, sizes = self._encode(new)
            self.known = pa.concat_arrays([self.known, new])
            self.flat = np.concatenate([self.flat, ids])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            self.times = np.concatenate([self.times, np.zeros(len(new), np.int64)])
        return numbers

    def _forget(self) -> None:
        """Keep the more frequent half of the memory, without long pieces and within half of the bytes."""
        length = pc.binary_length(self.known).to_numpy()
        kept = np.argsort(-np.where(length > LONG_PIECE, -1, self.times), kind="stable")[: self.memory // 2]
        kept = kept[length[kept] <= LONG_PIECE]
        kept = np.sort(kept[np.cumsum(length[kept]) <= MEMORY_BYTES // 2])
        sizes = np.diff(self.ends)[kept]
        self.flat = self.flat[np.repeat(self.ends[kept], sizes) + within(sizes)]
        self.ends, self.times = np.concatenate([[0], np.cumsum(sizes)]), self.times[kept]
        self.known = self.known.take(pa.array(kept, pa.int64()))

    def _remembered(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces of these numbers one after the other, and where each piece's begin (with the end)."""
        first, stops = self.ends[rows], np.zeros(len(rows) + 1, np.int64)
        np.cumsum(self.ends[rows + 1] - first, out=stops[1:])
        at = np.repeat(first - stops[:-1], np.diff(stops))
        at += np.arange(len(at))
        return self.flat[at], stops

    def batch(self, texts: pa.Array | list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text in turn, without the end id."""
        if len(self.known) > self.memory or pc.sum(pc.binary_length(self.known), min_count=0).as_py() > MEMORY_BYTES:
            self._forget()
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        odd = pc.match_substring_regex(texts, self.ODD).to_numpy(zero_copy_only=False)
        cut = texts.filter(pa.array(~odd))
        parts = list(batches_of(cut, PART_BYTES))
        for blank in " \n":
            cut = pc.replace_substring(cut, blank, self.CUT + blank)
        lists = pc.split_pattern(cut, self.CUT)
        offsets, distinct = lists.offsets.to_numpy(), lists.flatten().dictionary_encode()
        del cut, lists
        numbers, places = self._learn(distinct.dictionary), distinct.indices.to_numpy()
        self.times[numbers] += np.bincount(places, minlength=len(numbers))

        def even() -> Iterator[np.ndarray]:
            for part in parts:
                at = offsets[part.start : part.stop + 1]
                ids, stops = self._remembered(numbers[places[at[0] : at[-1]]])
                bounds = stops[at - at[0]].tolist()
                for start, stop in zip(bounds[:-1], bounds[1:], strict=True):
                    yield ids[start:stop]

        def others() -> Iterator[np.ndarray]:
            whole = texts.filter(pa.array(odd))
            for part in batches_of(whole, PART_BYTES):
                for ids in self._ids(whole[part].to_pylist()):
                    yield np.asarray(ids, np.uint32)

        cut_up, as_they_are = even(), others()
        for o in odd.tolist():
            yield next(as_they_are if o else cut_up)


def _ranked(path: str):
    """Encoder of the vocabulary's ranks, and the bytes of each id."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    encoding = tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return encoding.encode_ordinary, sizes


@lru_cache(maxsize=1)
def tokenizer_of(path: str | None) -> Tokenizer:
    """One tokenizer per worker process, so that what it has learned serves all its tasks."""
    return Tokenizer(path) if path else Tokenizer(default_tokenizer(), default_ranks())


class OpenWindows:
    """A fixed number of open windows; ``add`` returns a window that had to be emitted, or None."""

    def __init__(self, window: int, most: int) -> None:
        self.window, self.most = window, most
        self.room: list[int] = []
        self.held: list[list] = []

    def add(self, size: int, item) -> list | None:
        best, best_room = -1, self.window + 1
        for i, r in enumerate(self.room):
            if size <= r < best_room:
                best, best_room = i, r
        out = None
        if best < 0:
            if len(self.room) == self.most:
                out = self.close(min(range(self.most), key=self.room.__getitem__))
            self.room.append(self.window)
            self.held.append([])
            best = len(self.room) - 1
        self.held[best].append((self.window - self.room[best], item))
        self.room[best] -= size
        return self.close(best) if not self.room[best] and out is None else out

    def close(self, i: int) -> list:
        self.room.pop(i)
        return self.held.pop(i)


def _layout(window: int, most: int, tokenizer_path: str | None):
    """Arrow iterator function: (doc_id, text) of one partition -> pieces with their place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer = tokenizer_of(tokenizer_path)
        spaces = OpenWindows(window, most)
        # Windows are numbered within their partition; the partition fills the upper bits.
        base, used = TaskContext.get().partitionId() << 32, 0
        schema = pa.schema([(n, _ARROW[t]) for n, t in (c.split() for c in _LAID.split(", "))])

        def emit(held: list, leftover: bool = False) -> list:
            nonlocal used
            used += 1
            return [(*item, base + used - 1, at, leftover) for at, item in held]

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            for part in batches_of(batch.column(1), BATCH_BYTES):
                some = batch.slice(part.start, part.stop - part.start)
                rows: list = []
                for doc, ids in zip(some.column(0).to_pylist(), tokenizer.batch(some.column(1)), strict=True):
                    ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                    full = len(ids) // window * window
                    for start in range(0, full, window):
                        rows += emit([(0, (doc, start, window, ids[start : start + window].tobytes(), len(ids)))])
                    if full < len(ids):
                        rest = len(ids) - full
                        if held := spaces.add(rest, (doc, full, rest, ids[full:].tobytes(), len(ids))):
                            rows += emit(held)
                del some
                if rows:
                    yield batch_of(rows)
            del batch  # before the next one is read
        if spaces.held:
            yield batch_of([row for held in spaces.held for row in emit(held, leftover=True)])

    return run


def _merge(window: int):
    """Pandas function: the leftover windows of one group of partitions -> their new places."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        spaces = OpenWindows(window, len(group) + 1)
        filled = group.sort_values(["filled", "sequence_id"], ascending=[False, True])
        placed: list = []
        for seq, n in zip(filled["sequence_id"].tolist(), filled["filled"].tolist(), strict=True):
            if held := spaces.add(n, (seq, n)):
                placed.append(held)
        rows = [(item[0], held[0][1][0], at) for held in [*placed, *spaces.held] for at, item in held]
        return pd.DataFrame(rows, columns=["sequence_id", "into", "shift"])

    return run


def pack(
    docs: DataFrame,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    merge_partitions: int = MERGE_PARTITIONS,
    tokenizer_path: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``docs`` has ``doc_id`` and ``text``. Pieces of one ``sequence_id`` fill it from offset 0 without gaps.
    """
    laid = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _layout(window, open_windows, tokenizer_path), _LAID
    )
    pieces = stored(laid, "packing", compression="zstd")
    left = pieces.filter("leftover").groupBy("sequence_id").agg(F.sum("length").alias("filled"))
    # At most open_windows rows for each of merge_partitions partitions meet in a task.
    group = F.floor(F.shiftright("sequence_id", 32) / F.lit(merge_partitions)).cast("long")
    moves = left.withColumn("grp", group).groupBy("grp").applyInPandas(_merge(window), "sequence_id bigint, into bigint, shift bigint")
    same = [c.split()[0] for c in PIECES.split(", ")]
    moved = (
        pieces.filter("leftover")
        .join(moves, "sequence_id")
        .withColumns({"offset": F.col("offset") + F.col("shift"), "sequence_id": F.col("into")})
        .select(*same)
    )
    return pieces.filter("NOT leftover").select(*same).unionByName(moved)
