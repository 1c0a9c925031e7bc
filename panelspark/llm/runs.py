"""Periodic runs of words, found on a grammar of the text, and texts without the repetitions.

A run is a stretch of words with smallest period q and a length of at least ``max(min_length, min_power * q)`` that no
neighbouring word extends. The words of many texts are numbered and compressed together:

1. Re-Pair: a repeated pair of neighbouring symbols becomes a new symbol. A round replaces every pair that is more
   frequent than the pairs it overlaps; rounds go on until no text holds a pair twice. Symbols are kept apart by text. What
   is left of a text is joined by a balanced tree, so that every place between two words is the boundary of one node.
2. For each nonterminal once, the runs of its expansion that cross its boundary: a run of four periods holds two of
   them, a square, on one side of the boundary, so the candidate periods are the distances to the next places with the two words
   at the boundary. A candidate is compared word by word, then extended both ways within the expansion.
3. Every replacement noted its place, so the runs of a nonterminal are carried to all its places; intervals of one period
   that overlap by a period or more are one run. A run is found whole at the smallest node that holds it.

Defined cases: a null, empty or blank text has no words and no runs; repeated rows get a row each; an empty table gives an empty
result; other columns than the id and the text are left out. Memory is bounded by ``BATCH_BYTES`` of text, or the longest
text (some 250 bytes a word).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH, MIN_POWER = 6, 4
BATCH_BYTES = 1 << 20
COMPARE = 1 << 22  # words compared at once
SCATTER = 2654435761  # odd, so that it maps the numbers below 2**32 onto themselves

RUN = "struct<start:bigint,length:bigint,period:bigint>"
RESULT = f"n_words bigint, runs array<{RUN}>, strongest {RUN}, collapsed string"
_RUN = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])


# ---------------------------------------------------------------- Re-Pair


class Grammar:
    """Nodes of the texts' derivations.

    ``start``, ``middle``, ``end``: words of one place of each distinct node and its boundary. ``rule_of`` and ``place``: the rule
    (index of a node) and first word of every replacement.
    """

    def __init__(self, symbols: np.ndarray, doc: np.ndarray) -> None:
        self.start, self.middle, self.end, self.rule_of, self.place = ([] for _ in range(5))
        self.rules = 0
        n = len(symbols)
        at, size = np.arange(n), np.ones(n, np.int64)
        self.next_symbol = int(symbols.max(initial=-1)) + 1
        done = []
        while len(symbols) > 1:
            pair, times = pair_numbers(symbols)
            repeated = times[pair] > 1
            if not repeated.any():
                break
            open_doc = np.zeros(doc[-1] + 1, bool)
            open_doc[doc[:-1][repeated]] = True
            stays = open_doc[doc]
            if stays.mean() < 0.7:  # texts without a repeated pair are finished
                done.append((at[~stays], size[~stays], doc[~stays]))
                symbols, at, size, doc = symbols[stays], at[stays], size[stays], doc[stays]
                continue
            chosen = winners(pair, times)
            names, number = np.unique(pair[chosen], return_inverse=True)
            self._note(at, size, chosen, number, len(names))
            symbols, at, size, doc = self._join(symbols, at, size, doc, chosen, self.next_symbol + number)
            self.next_symbol += len(names)
        done.append((at, size, doc))
        at, size, doc = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(at, kind="stable")
        self._tree(at[order], size[order], doc[order])
        self.start, self.middle, self.end, self.rule_of, self.place = (
            np.concatenate(x) if x else np.zeros(0, np.int64) for x in (self.start, self.middle, self.end, self.rule_of, self.place)
        )

    def _note(self, at, size, chosen, number, count) -> None:
        first = np.empty(count, np.int64)
        first[number[::-1]] = chosen[::-1]
        self.start.append(at[first])
        self.middle.append(at[first] + size[first])
        self.end.append(at[first] + size[first] + size[first + 1])
        self.rule_of.append(self.rules + number)
        self.place.append(at[chosen])
        self.rules += count

    @staticmethod
    def _join(symbols, at, size, doc, chosen, names):
        symbols, size = symbols.copy(), size.copy()
        if names is not None:
            symbols[chosen] = names
        size[chosen] += size[chosen + 1]
        keep = np.ones(len(at), bool)
        keep[chosen + 1] = False
        return symbols[keep], at[keep], size[keep], doc[keep]

    def _tree(self, at, size, doc) -> None:
        """Neighbours joined two by two until every text is one node."""
        symbols = at
        while len(at):
            opens = np.concatenate([[True], doc[1:] != doc[:-1]])
            first = np.flatnonzero(opens)
            rank = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
            chosen = np.flatnonzero((rank[:-1] % 2 == 0) & (doc[1:] == doc[:-1]))
            if not len(chosen):
                break
            self._note(at, size, chosen, np.arange(len(chosen)), len(chosen))
            symbols, at, size, doc = self._join(symbols, at, size, doc, chosen, None)


def pair_numbers(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each pair of neighbours, and how often each number occurs."""
    pair = pa.array((symbols[:-1].astype(np.int64) << 32) | symbols[1:]).dictionary_encode().indices.to_numpy().astype(np.int64)
    return pair, np.bincount(pair)


def winners(pair: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Places of the repeated pairs that beat the pairs overlapping them; within ``aaaa`` every second place from the left."""
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    # Ties in frequency are broken by scattered numbers: in order of the text only one pair in a row of them would win.
    strength = (times[pair[first]] << 32) | (pair[first] * SCATTER & 0xFFFFFFFF)
    edged = np.concatenate([[-1], strength, [-1]])
    wins = (times[pair[first]] > 1) & (strength > edged[:-2]) & (strength > edged[2:])
    some = (np.diff(np.append(first, len(pair)))[wins] + 1) // 2
    return np.repeat(first[wins], some) + 2 * within(some)


def within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. for each of the sizes, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


# ---------------------------------------------------------------- runs across boundaries


def equal_ahead(words: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many words from ``a`` on equal those from ``b`` on, at most ``most``."""
    found = np.zeros(len(a), np.int64)
    open_, block = np.flatnonzero(most > 0), 4
    while len(open_):
        later = []
        for part in np.array_split(open_, -(-len(open_) * block // COMPARE)):
            ahead = found[part, None] + np.arange(block)
            inside = ahead < most[part, None]
            ahead = np.minimum(ahead, most[part, None] - 1)
            same = (words[a[part, None] + ahead] == words[b[part, None] + ahead]) & inside
            whole = same.all(axis=1)
            found[part] += np.where(whole, block, same.argmin(axis=1))
            later.append(part[whole & (found[part] < most[part])])
        open_, block = np.concatenate(later), min(block * 2, COMPARE)
    return found


def squares_ahead(words: np.ndarray, twins: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, least: int, power: int):
    """(node, first word, words, period) of the runs whose part from the boundary on holds two periods.

    ``twins``: a number of each two neighbouring words (one less than words), equal where both words are equal.
    """
    n = len(words)
    node = np.flatnonzero((end - start >= least) & (end - middle >= 3))
    node = node[np.bincount(twins)[twins[middle[node]]] > 1] if len(node) else node
    if not len(node):
        return (np.zeros(0, np.int64),) * 4
    # Places of each two words in order, as one sorted list of number * n + place.
    often = np.flatnonzero((np.bincount(twins) > 1)[twins])
    places = np.sort(twins[often] * n + often)
    found = []
    key = twins[middle[node]] * n
    least_q = np.ones(len(node), np.int64)
    while len(node):
        next_ = np.searchsorted(places, key + middle[node] + least_q)
        next_place = places[np.minimum(next_, len(places) - 1)] - key
        q = next_place - middle[node]
        fits = (next_ < len(places)) & (next_place < n) & (middle[node] + np.maximum(2 * q, 3) <= end[node])
        node, key, q = node[fits], key[fits], q[fits]
        ahead = q + equal_ahead(words, middle[node], middle[node] + q, end[node] - middle[node] - q)
        square = ahead >= np.maximum(2 * q, 3)
        found.append((node[square], q[square], ahead[square]))
        # A longer period of a square at this place is longer than what the shorter one covers.
        least_q = np.where(square, np.maximum(ahead - q, q), q) + 1
    node, q, ahead = (np.concatenate(x) for x in zip(*found, strict=True))
    back = words[::-1]
    behind = equal_ahead(back, n - middle[node], n - middle[node] - q, middle[node] - start[node])
    long_ = behind + ahead >= np.maximum(least, power * q)
    return node[long_], (middle[node] - behind)[long_], (behind + ahead)[long_], q[long_]


def crossing_runs(words: np.ndarray, twins: np.ndarray, start, middle, end, least: int, power: int):
    """(node, first word, words, period): runs across the boundary of each node, within it."""
    n = len(words)
    node, first, length, q = squares_ahead(words, twins, start, middle, end, least, power)
    # The same on the words read backwards.
    back = squares_ahead(words[::-1], twins[::-1], n - end, n - middle, n - start, least, power)
    return (
        np.concatenate([node, back[0]]),
        np.concatenate([first, n - back[1] - back[2]]),
        np.concatenate([length, back[2]]),
        np.concatenate([q, back[3]]),
    )


def merged(first: np.ndarray, length: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal intervals: those of one period that overlap by a period or more become one; by first word, then period."""
    if not len(first):
        return first, length, q
    order = np.lexsort((first, q))
    first, last, q = first[order], (first + length)[order], q[order]
    lane = q * (last.max() + 1)
    reach = np.maximum.accumulate(last + lane)
    opens = np.concatenate([[True], first[1:] + lane[1:] + q[1:] > reach[:-1]])
    at = np.flatnonzero(opens)
    last = np.maximum.reduceat(last, at)
    first, q = first[at], q[at]
    order = np.lexsort((q, first))
    return first[order], (last - first)[order], q[order]


def find_runs(words: np.ndarray, doc: np.ndarray, least: int = MIN_LENGTH, power: int = MIN_POWER):
    """(first word, words, period) of all runs; ``words`` are numbers, ``doc`` the texts that they lie in, in order."""
    if power < MIN_POWER or least < MIN_LENGTH:
        raise ValueError(f"runs of at least {MIN_LENGTH} words and {MIN_POWER} periods are found")
    if len(words) < least:
        return (np.zeros(0, np.int64),) * 3
    own = doc.astype(np.int64) * (int(words.max()) + 1) + words
    symbols = pa.array(own).dictionary_encode().indices.to_numpy().astype(np.int64)
    grammar = Grammar(symbols, doc)
    twins, _ = pair_numbers(symbols)
    node, first, length, q = crossing_runs(symbols, twins, grammar.start, grammar.middle, grammar.end, least, power)
    # From the one place of each nonterminal to all its places.
    offset = first - grammar.start[node]
    has = np.zeros(len(grammar.start), bool)
    has[node] = True
    here = np.flatnonzero(has[grammar.rule_of])
    here = here[np.argsort(grammar.rule_of[here], kind="stable")]
    rules = grammar.rule_of[here]
    low, high = np.searchsorted(rules, node), np.searchsorted(rules, node, "right")
    many = high - low
    place = grammar.place[here[np.repeat(low, many) + within(many)]]
    return merged(place + np.repeat(offset, many), np.repeat(length, many), np.repeat(q, many))


# ---------------------------------------------------------------- texts


def _results(texts: pa.Array, least: int, power: int) -> list[pa.Array]:
    """n_words, runs, strongest run, collapsed text of each text."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    values, offsets = lists.flatten(), lists.offsets.to_numpy()
    filled = pc.greater(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(filled)])
    ends = before[offsets - offsets[0]]
    values = values.filter(pa.array(filled))
    counts = np.diff(ends)
    doc = np.repeat(np.arange(len(counts)), counts)
    first, length, q = find_runs(values.dictionary_encode().indices.to_numpy().astype(np.int64), doc, least, power)

    steps = np.zeros(len(values) + 1, np.int64)
    np.add.at(steps, first + q, 1)
    np.add.at(steps, first + length, -1)
    kept = np.cumsum(steps[:-1]) == 0
    kept_before = np.concatenate([[0], np.cumsum(kept)])
    kept_lists = pa.ListArray.from_arrays(pa.array(kept_before[ends].astype(np.int32)), values.filter(pa.array(kept)))
    collapsed = pc.binary_join(kept_lists, " ")

    start = first - ends[:-1][doc[first]] if len(first) else first
    per_doc = np.searchsorted(first, ends)
    runs = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in (start, length, q)], fields=list(_RUN))
    strongest = []
    for a, b in zip(per_doc[:-1].tolist(), per_doc[1:].tolist(), strict=True):
        best = None
        for s, n, p in zip(start[a:b].tolist(), length[a:b].tolist(), q[a:b].tolist(), strict=True):
            if best is None or n * best[2] > best[1] * p:  # ordered by start, then period: the first of equals stays
                best = (s, n, p)
        strongest.append(best and dict(zip(("start", "length", "period"), best, strict=True)))
    return [pa.array(counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(per_doc.astype(np.int32)), runs), pa.array(strongest, _RUN), collapsed]


def batches_of(texts: pa.Array, most: int = BATCH_BYTES) -> Iterator[slice]:
    """Neighbouring texts of at most ``most`` bytes together, or one longer text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > at and held + size > most:
            yield slice(at, i)
            at, held = i, 0
        held += size
    if at < len(sizes):
        yield slice(at, len(sizes))


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_power: int = MIN_POWER) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): doc_id, n_words, runs, strongest, collapsed.

    ``runs``: (start, length, period) in words from 0, by start, then period; ``strongest``: the run with the greatest exact
    length / period, ties to the smallest start, then period (null without a run); ``collapsed``: the words outside every run and
    those of each run's first period only, joined by one space.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_words", "runs", "strongest", "collapsed"]
        for batch in batches:
            for part in batches_of(batch.column(1)):
                some = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([some.column(0), *_results(some.column(1), min_length, min_power)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, f"doc_id bigint, {RESULT}")
