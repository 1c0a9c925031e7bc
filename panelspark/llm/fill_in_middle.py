"""Fill-in-the-middle: a text cut at two places between its units and put together in another order.

A unit is a word with the blanks before it, or the blanks at the end of the text. The two cuts are ranks of units; an
indexable skip list over the units turns a rank into a place in code points. Each of its lanes holds, for every link,
how many units and how many code points the link passes over; a lane keeps about half of the stops of the lane below.
Descending from the sparsest lane by accumulated widths reaches a rank in about log2(n) steps.

Forms: ``plain`` (the text as it is), ``psm`` (prefix, suffix, middle) and ``spm`` (suffix, prefix, middle), each part behind
its sentinel. A text that is empty or holds a sentinel stays plain, so that every output can be taken apart again.

Defined cases: a null text is an empty one; without units the form is plain; a null id is drawn for like an empty one; repeated rows
get the same cuts; an empty table gives an empty result; other columns than the id and the text are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.runs import batches_of

SEED = 42
RATE, SPM_RATE = 50, 80  # per cent of the texts that are cut, and of these that get the form spm
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
RESULT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


class SkipList:
    """Indexable skip list over units: ``chars_before(rank)`` is the number of code points of the first ``rank`` units.

    Lane 0 links each unit to the next. A stop of a lane is also one of the lane above if a coin says so; the coin is a
    bit of a scattered number of the unit's rank, so lists of one length are built alike.
    """

    def __init__(self, widths: np.ndarray) -> None:
        n = len(widths)
        self.n = n
        # Stop i of lane 0 stands before unit i; link i leads to the next stop, over one unit.
        stops = np.arange(n, dtype=np.int64)
        units, chars = np.ones(n, np.int64), widths.astype(np.int64)
        below = stops
        coins = (stops.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        lane = 0
        while n:
            self.lanes.append((units, chars, below))
            up = (coins >> np.uint64(lane)) & np.uint64(1) == 1
            up[0] = True  # the head stands in every lane
            at = np.flatnonzero(up)
            if len(at) == 1 or lane == 39:
                break
            # A link of the lane above is as wide as the links below it together.
            units, chars = np.add.reduceat(units, at), np.add.reduceat(chars, at)
            below, coins, lane = at, coins[at], lane + 1

    def chars_before(self, rank: int) -> int:
        if not 0 <= rank <= self.n:
            raise IndexError(rank)
        left, passed, at = rank, 0, 0
        for units, chars, below in reversed(self.lanes):
            while left and at < len(units) and units[at] <= left:
                left -= int(units[at])
                passed += int(chars[at])
                at += 1
            if not left:
                break
            at = int(below[at])
        return passed


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers below 2**32 of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in range(0, 32, 8))


def transform(doc_id: int | None, text: str | None, seed: int, rate: int, spm_rate: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    first, second, cut, form = draws(doc_id, seed)
    if not text or cut % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    a, b = sorted((first % (n + 1), second % (n + 1)))
    skip = SkipList(np.fromiter(map(len, units), np.int64, n))
    a, b = skip.chars_before(a), skip.chars_before(b)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if form % 100 < spm_rate:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): doc_id, n (units), form, prefix_chars, middle_chars (null if plain), output."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        names = [c.split()[0] for c in RESULT.split(", ")]
        for batch in batches:
            for part in batches_of(batch.column(1)):
                some = batch.slice(part.start, part.stop - part.start)
                rows = [
                    transform(doc, text, seed, rate, spm_rate)
                    for doc, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True)
                ]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([some.column(0), *columns], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)


def restored(output: Column, form: Column) -> Column:
    """The text of an output: its parts, found by their sentinels, in the text's order (null for an unknown form)."""

    def between(opens: str, closes: str | None) -> Column:
        tail = F.substring_index(output, opens, -1)
        return tail if closes is None else F.substring_index(tail, closes, 1)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).when(form == "spm", spm)
