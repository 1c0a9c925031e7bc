"""Secret scans: fixed patterns plus sliding-window entropy over candidate strings.

Fixed kinds (``assign``, ``access``, ``hex``) are regular expressions with a least length. The method adds
kinds by entropy: for each character class a candidate is a long run of the class; a window of ``WINDOW``
characters slides over it, and the Shannon entropy of the window is kept up by changing two counts per
step. The allow-list cuts harmless pieces (between ``/``, ``_`` and ``-``) out of a candidate; it is a secret if a
stretch that is left has what the class asks for and a window whose entropy reaches the class's threshold, unless it
lies inside a fixed finding. The finding is the whole candidate.

Entropy of a window of W characters with counts c is ``log2 W - (sum c log2 c) / W``; the sum is held in
millionths as an integer, so the result does not depend on the order of the steps.

All of it is built-in functions on one row at a time: no shuffle, no state between documents.

Defined cases: a null text is scanned as empty (:func:`redact` leaves it null); repeated rows are scanned
alike; an empty table gives an empty result; a candidate shorter than the window is not scored; kinds may overlap each
other, matches of one kind never do.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import furthest, indices, let, matches, pieces, stretch, unused

# ---------------------------------------------------------------- fixed values
# (kind, pattern, group whose length counts, least length). The last two patterns are runs of one class, so
# asking for the least length in the pattern finds the same matches as dropping short ones afterwards.
FIXED_KINDS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
# ---------------------------------------------------------------- end of fixed values


@dataclass(frozen=True)
class CharClass:
    """``candidate`` finds runs of the class; ``must`` are patterns a stretch of it needs; bits is the threshold."""

    kind: str
    candidate: str
    must: tuple[str, ...]
    bits: float


WINDOW = 20
CLASSES = (
    CharClass("entropy_hex", r"(?<![0-9A-Za-z])[0-9A-Fa-f]{20,}(?![0-9A-Za-z])", (r"[0-9]", r"[A-Fa-f]"), 3.0),
    CharClass("entropy_base64", r"[A-Za-z0-9+/_-]{20,}={0,2}", (r"[0-9]", r"[A-Z]", r"[a-z]"), 3.9),
    CharClass("entropy_lower", r"(?<![0-9A-Za-z])[0-9a-z]{20,}(?![0-9A-Za-z])", (r"(?:[0-9][a-z]*){3}", r"[0-9][a-z]+[0-9]", r"[g-z]"), 3.5),
)
# Well-known harmless pieces: documentation samples, runs of the alphabet, digests of nothing, UUIDs. A piece starts where
# the candidate or a piece starts, so a long candidate is searched once.
_IN_PIECE = r"[^/_-]"
ALLOWED = (
    rf"(?i)(?<!{_IN_PIECE})(?:"
    r"wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY|your"
    r"|da39a3ee5e6b4b0d3255bfef95601890afd80709|d41d8cd98f00b204e9800998ecf8427e"
    r"|e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    r"|[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
    rf"|{_IN_PIECE}*?(?:example|sample|placeholder|changeme|0123456789|abcdefghij|1234567890|deadbeef|({_IN_PIECE})\1{{7}}){_IN_PIECE}*+"
    rf")(?!{_IN_PIECE})"
)

SPAN = "array<struct<start:int,ord:int,end:int,kind:string>>"
_UNIT = 1_000_000


def _c_log_c(window: int) -> Column:
    """``c * log2(c)`` in millionths for c = 0 .. window."""
    return F.array(*[F.lit(round(c * math.log2(c) * _UNIT) if c else 0) for c in range(window + 1)])


def lowest_sum(candidate: Column, window: int = WINDOW) -> Column:
    """Least ``sum c log2 c`` (millionths) over all windows of the candidate; null if it is shorter.

    The state is (counts per distinct character, their sum, the least sum so far); a step changes the
    counts of the character that leaves and the one that enters.
    """
    f = _c_log_c(window)

    def cost(c: Column) -> Column:
        return F.get(f, c)

    def slide(idx: Column, n_chars: Column) -> Column:
        first = F.filter(idx, lambda _, i: i < window)
        counts = F.transform(indices(n_chars), lambda a: F.size(F.filter(first, lambda x: x == a)))

        def start(c: Column) -> Column:
            s = F.aggregate(c, F.lit(0), lambda acc, x: acc + cost(x))
            return let(s, lambda v: F.struct(c.alias("c"), v.alias("s"), v.alias("low")))

        def step(state: Column, j: Column) -> Column:
            gone, came = F.get(idx, j - window), F.get(idx, j)
            n_gone, n_came = F.get(state["c"], gone), F.get(state["c"], came)
            s = state["s"] + cost(n_gone - 1) - cost(n_gone) + cost(n_came + 1) - cost(n_came)
            c = F.transform(state["c"], lambda n, a: n + F.when(a == came, 1).when(a == gone, -1).otherwise(0))
            moved = let(s, lambda v: F.struct(c.alias("c"), v.alias("s"), F.least(state["low"], v).alias("low")))
            return F.when(gone == came, state).otherwise(moved)

        steps = F.filter(indices(F.size(idx)), lambda j: j >= window)
        return let(let(counts, start), lambda st: F.aggregate(steps, st, step, lambda z: z["low"]))

    def coded(chars: Column) -> Column:
        alphabet = F.array_distinct(chars)
        return let(
            alphabet,
            lambda a: let(
                F.transform(chars, lambda c: (F.array_position(a, c) - 1).cast("int")), lambda idx: slide(idx, F.size(a))
            ),
        )

    return F.when(F.length(candidate) >= window, let(F.split(candidate, ""), coded))


def window_entropy(candidate: Column, window: int = WINDOW) -> Column:
    """Highest entropy, in bits a character, of any window of the candidate."""
    return F.lit(math.log2(window)) - lowest_sum(candidate, window) / F.lit(float(window * _UNIT))


def base_spans(text: Column) -> Column:
    def spans(order: int, kind: str, pattern: str, group: int, least: int) -> Column:
        return _spans(F.filter(matches(text, pattern, group), lambda m: F.length(m["hit"]) >= least), order, kind)

    return F.sort_array(F.concat(*[spans(order, *fixed) for order, fixed in enumerate(FIXED_KINDS)])).cast(SPAN)


def _spans(found: Column, order: int, kind: str) -> Column:
    return F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(order).alias("ord"), m["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def outside(found: Column, base: Column) -> Column:
    """The matches that lie inside none of the base spans: one sweep over both, by start, base spans first."""
    marks = F.transform(base, lambda b: F.struct(b["start"].alias("start"), F.lit(0).alias("own"), b["end"].alias("end"), F.lit("").alias("hit")))
    own = F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(1).alias("own"), m["end"].alias("end"), m["hit"].alias("hit")))

    def sweep(items: Column) -> Column:
        reach = furthest(F.transform(items, lambda x: F.when(x["own"] == 0, x["end"]).otherwise(-1)))
        left = let(reach, lambda r: F.filter(items, lambda x, i: (x["own"] == 1) & (F.get(r, i) < x["end"])))
        return F.transform(left, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["hit"].alias("hit")))

    return F.when((F.size(found) == 0) | (F.size(base) == 0), found).otherwise(let(F.sort_array(F.concat(marks, own)), sweep))


def entropy_spans(text: Column, base: Column, classes=CLASSES, allowed: str = ALLOWED, window: int = WINDOW) -> Column:
    def spans(order: int, cls: CharClass) -> Column:
        def secret(stretch: Column) -> Column:
            ok = F.length(stretch) >= window
            for p in cls.must:
                ok = ok & F.regexp_like(stretch, F.lit(p))
            # Conditions are evaluated left to right, so the entropy is taken of few strings only.
            return F.when(ok, window_entropy(stretch, window) >= cls.bits).otherwise(False)

        def usable(m: Column) -> Column:
            ok = F.lit(True)
            for p in cls.must:
                ok = ok & F.regexp_like(m["hit"], F.lit(p))
            return ok

        found = let(F.filter(matches(text, cls.candidate), usable), lambda f: outside(f, base))
        return _spans(F.filter(found, lambda m: F.exists(F.split(m["hit"], allowed, -1), secret)), order, cls.kind)

    return F.concat(*[spans(order, cls) for order, cls in enumerate(classes, start=len(FIXED_KINDS))]).cast(SPAN)


def scan(docs: DataFrame, text: str = "text", base: str = "base_spans", spans: str = "spans") -> DataFrame:
    """``docs`` with two arrays of (start, ord, end, kind): the fixed findings, and all of them, by start then kind."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn(base, base_spans(t)).withColumn(
        spans, F.sort_array(F.concat(F.col(base), entropy_spans(t, F.col(base)))).cast(SPAN)
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by ``mark``; overlapping findings are one.

    All columns stay as they are but the text, and ``n_chars`` where a text with a finding has one.
    Internal columns use names that the input does not have.
    """
    taken = set(docs.columns)
    base, spans = unused(docs, "base"), unused(docs, "spans")
    found = scan(docs, text, base, spans)
    t = F.col(text)

    ends = F.transform(F.col(spans), lambda s: s["end"])

    def cleaned(parts: Column, before: Column) -> Column:
        # What lies between the findings; one that starts before an earlier one ended only extends that.
        def head(s: Column, i: Column) -> Column:
            at = F.greatest(F.get(before, i), F.lit(0))
            return F.when(s["start"] >= at, F.concat(stretch(parts, at, s["start"]), F.lit(mark))).otherwise("")

        return F.concat(F.array_join(F.transform(F.col(spans), head), ""), stretch(parts, F.array_max(ends), F.length(t)))

    clean = let(pieces(t), lambda parts: let(furthest(ends), lambda before: cleaned(parts, before)))
    changed = F.when(F.size(spans) > 0, clean).otherwise(t)
    out = {c: F.col(f"`{c}`") for c in docs.columns}
    out[text] = changed
    cut = found.select(*[v.alias(c) for c, v in out.items()], F.size(spans).alias(base))
    if "n_chars" in taken:
        length = F.when((F.col(base) > 0) & F.col("n_chars").isNotNull(), F.length(text)).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return cut.select(*[f"`{c}`" for c in docs.columns])
