"""Quality rules by weak supervision.

Each rule looks at counts of one text and votes good (1), bad (-1) or abstains (0). The votes of all
documents are counted by pattern; with k rules there are at most 3**k patterns, so this table is small
whatever the corpus. Expectation-maximisation over the pattern counts estimates, for each rule, how often
it votes each way on good and on bad documents, and the share of good documents; the posterior probability of
good then replaces all-must-pass filtering.

The texts are read once: counts and votes of every document go to the shared scratch folder (no text),
and both the pattern counts and the result come from there. Everything per row is built-in functions.

Defined cases: a null text has no words; a text without words fails the base test; repeated rows are
counted and returned as often as they occur; an empty table gives an empty result; other columns of the
input are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import indices, stored, words

WINDOW = 5  # words in a repeated passage


@dataclass(frozen=True)
class Rule:
    """``good`` and ``bad`` are conditions on the count columns; ``bad`` wins; neither true is an abstention."""

    name: str
    bad: str
    good: str


RULES = (
    Rule("length", "n_words < 20", "n_words >= 50"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 14 * n_words", "word_chars BETWEEN 3 * n_words AND 10 * n_words"),
    Rule("symbols", "n_symbols * 10 > n_words", "n_symbols * 50 <= n_words"),
    Rule("repeated_lines", "n_dup_lines * 10 > 3 * n_lines", "n_dup_lines * 20 <= n_lines"),
    Rule("repeated_words", "n_repeat_words * 5 > n_words", "n_repeat_words * 20 <= n_words"),
    Rule("capitals", "n_upper * 10 > 3 * word_chars", "n_upper * 10 <= word_chars"),
    Rule("digits", "n_digits * 10 > 3 * word_chars", "n_digits * 20 <= word_chars"),
    Rule("exclaims", "n_exclaims * 10 > n_words", "n_exclaims * 100 <= n_words"),
    Rule("sentences", "n_stops * 100 < n_words", "n_stops * 40 >= n_words"),
    Rule("decorations", "n_marks * 10 > n_words", "n_marks * 50 <= n_words"),
)


def text_counts(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The counts the rules look at, one row per input row.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_lines`` (lines with a word),
    ``n_dup_lines`` (of these, equal to an earlier line), ``n_repeat_words`` (words inside five-word
    windows that occur twice or more), ``n_upper``, ``n_digits``, ``n_exclaims``, ``n_stops``
    (full stops and question marks), ``n_marks`` (symbols, exclamation marks and rules).
    """
    t = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(*[F.col(k) for k in keep], t.alias("t"), words(t).alias("w"))

    def count_of(chars: str) -> Column:
        return F.length(F.regexp_replace("t", f"[^{chars}]+", "")).cast("long")

    lines = F.filter(F.split("t", "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    w, n = F.col("w"), F.size("w")
    hashed = F.transform(indices(n - (WINDOW - 1)), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW)]))
    counted = base.select(
        *keep,
        "w",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        count_of(r"#*$%&|<>").alias("n_symbols"),
        count_of(r"\p{Lu}").alias("n_upper"),
        count_of("0-9").alias("n_digits"),
        count_of("!").alias("n_exclaims"),
        count_of(".?").alias("n_stops"),
        count_of(r"#*$%&|<>_~=!").alias("n_marks"),
        lines.alias("lines"),
        hashed.alias("hashed"),
    )
    # Windows with different hashes differ, so texts without equal hashes are done; in the others, windows of
    # equal hash are compared word by word.
    suspect = F.size(F.array_distinct("hashed")) < F.size("hashed")
    again = F.transform("hashed", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    doubtful = counted.select(
        *[c for c in counted.columns if c not in ("lines", "hashed")],
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(suspect, F.sort_array(again)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("s"),
    )
    s = F.col("s")
    same = F.filter(s, lambda x, k: F.get(s, k - 1)["h"].eqNullSafe(x["h"]) | F.get(s, k + 1)["h"].eqNullSafe(x["h"]))
    passage = F.transform(
        same, lambda x: F.struct(F.concat_ws(" ", *[F.get(w, x["i"] + j) for j in range(WINDOW)]).alias("p"), x["i"].alias("i"))
    )
    compared = doubtful.select(*[c for c in doubtful.columns if c not in ("w", "s")], F.sort_array(passage).alias("s"))
    twice = F.filter(s, lambda x, k: F.get(s, k - 1)["p"].eqNullSafe(x["p"]) | F.get(s, k + 1)["p"].eqNullSafe(x["p"]))
    placed = compared.select(*[c for c in compared.columns if c != "s"], F.sort_array(F.transform(twice, lambda x: x["i"])).alias("p"))
    p = F.col("p")
    covered = F.aggregate(
        indices(F.size(p) - 1), F.lit(0), lambda acc, k: acc + F.least(F.lit(WINDOW), F.get(p, k + 1) - F.get(p, k))
    )
    return placed.select(
        *[c for c in placed.columns if c != "p"],
        F.when(F.size(p) > 0, covered + WINDOW).otherwise(0).cast("long").alias("n_repeat_words"),
    )


def vote(rule: Rule) -> Column:
    return F.when(F.expr(rule.bad), -1).when(F.expr(rule.good), 1).otherwise(0).cast("int")


@dataclass(frozen=True)
class VoteModel:
    """Share of good documents, and per rule the log of P(vote | good) / P(vote | bad) for each vote."""

    prior: float
    log_ratios: tuple[dict[int, float], ...]

    def posterior(self, votes: list[str]) -> Column:
        logit: Column = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, ratio in zip(votes, self.log_ratios, strict=True):
            logit = logit + F.when(F.col(name) == 1, ratio[1]).when(F.col(name) == -1, ratio[-1]).otherwise(ratio[0])
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def fit_votes(patterns: list[tuple[tuple[int, ...], int]], n_rules: int, rounds: int = 100, smooth: float = 1.0) -> VoteModel:
    """EM over (votes, count) patterns.

    Starts from all-must-pass: one bad vote makes a document doubtful. A vote never counts against its own meaning: a rule whose
    estimated ratio has the wrong sign is taken as uninformative, which also keeps the two classes from
    changing places. Without patterns every rule is uninformative.
    """
    patterns = sorted(patterns)  # the sums below, and so the result, do not depend on the order of arrival
    good = [0.25 if -1 in v else 0.95 for v, _ in patterns]
    prior, ratios = 0.5, tuple({1: 0.0, 0: 0.0, -1: 0.0} for _ in range(n_rules))
    for _ in range(rounds if patterns else 0):
        mass = [sum(c * g for (_, c), g in zip(patterns, good, strict=True))]
        mass.append(sum(c for _, c in patterns) - mass[0])
        prior = min(max((mass[0] + smooth) / (mass[0] + mass[1] + 2 * smooth), 1e-3), 1 - 1e-3)
        fitted = []
        for j in range(n_rules):
            n = {(y, x): smooth for y in (0, 1) for x in (-1, 0, 1)}
            for (v, c), g in zip(patterns, good, strict=True):
                n[0, v[j]] += c * g
                n[1, v[j]] += c * (1 - g)
            r = {x: math.log(n[0, x] / (mass[0] + 3 * smooth)) - math.log(n[1, x] / (mass[1] + 3 * smooth)) for x in (-1, 0, 1)}
            fitted.append({1: max(r[1], 0.0), 0: 0.0, -1: min(r[-1], 0.0)})
        ratios = tuple(fitted)
        start = math.log(prior / (1 - prior))
        after = [1 / (1 + math.exp(-max(-700.0, min(700.0, start + sum(r[x] for r, x in zip(ratios, v, strict=True)))))) for v, _ in patterns]
        moved = max(abs(a - b) for a, b in zip(after, good, strict=True))
        good = after
        if moved < 1e-9:
            break
    return VoteModel(prior, ratios)


def quality_rules(
    docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), rules: tuple[Rule, ...] = RULES, threshold: float = 0.5
) -> DataFrame:
    """Counts, votes, ``base_failed``, posterior ``quality`` and ``kept`` for every row of ``docs``.

    ``base_failed``: fewer than 10 words, or over a fifth of the words in repeated windows. ``kept``:
    not ``base_failed`` and posterior at least ``threshold``.
    """
    names = [f"vote_{r.name}" for r in rules]
    counts = text_counts(docs, text, keep)
    voted = stored(counts.select("*", *[vote(r).alias(n) for r, n in zip(rules, names, strict=True)]), "quality_rules")
    # At most 3 ** len(rules) rows, whatever the corpus.
    patterns = [(tuple(row[n] for n in names), row["count"]) for row in voted.groupBy(*names).count().collect()]
    model = fit_votes(patterns, len(rules))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    scored = voted.withColumns({"base_failed": failed, "quality": model.posterior(names)})
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
