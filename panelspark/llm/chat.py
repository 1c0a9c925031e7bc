"""Multi-party chat formatting by perspective rotation.

For every participant of a conversation the dialogue is rendered with that speaker as the assistant and
all others as named users; the mask marks the text the assistant writes. A rendered message is

    <|assistant|>\\n{text}<|end|>\\n      or      <|user name={speaker}|>\\n{text}<|end|>\\n

and the mask is the spans (code points, end exclusive) of ``{text}<|end|>`` in the assistant's messages.

A dialogue is rendered in parts of ``PART`` turns (turn numbers, not ranks), so a conversation that holds
a third of all rows is spread over tasks. A part has all messages of its turns, however many they are: the text of one
part is one value of the result. Who wants smaller parts gives ``piece``: a part of more messages is then cut every
``piece`` messages of the same order, repeated rows too. Each part says where it starts in the whole rendering, from the
lengths of the parts before (sums that combine map-side).

Defined cases: a null role is the speaker ``unknown``, a null text is empty, a null turn comes after all
others; messages of equal turn go by speaker, then text, in parts of any size;
repeated rows are rendered as often as they occur;
a null conversation id is a conversation of its own; an empty table gives an empty result; other columns
are ignored. Markers inside texts are not special: the mask tells them apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import let, prefix_sums

PART = 64
UNKNOWN = "unknown"
OPEN_ASSISTANT = "<|assistant|>\n"
END = "<|end|>"


def open_user(speaker: Column) -> Column:
    return F.concat(F.lit("<|user name="), speaker, F.lit("|>\n"))


PLACE = ["block", "slice"]  # a part of a conversation, in this order
LINE = ["turn", "speaker", "text"]  # the order of messages


def in_parts(messages: DataFrame, part: int, piece: int | None) -> DataFrame:
    """(conv_id, block, slice, turn, speaker, text): the messages with the part they belong to."""
    said = messages.select(
        "conv_id",
        F.floor(F.col("turn") / F.lit(part)).cast("long").alias("block"),
        "turn",
        F.coalesce("role", F.lit(UNKNOWN)).alias("speaker"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    if piece is None:
        return said.withColumn("slice", F.lit(0).cast("long"))
    large = said.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("all")).filter(F.col("all") > piece)
    known = _same(said, large, ["conv_id", "block"], "left")
    # Equal lines of a large part are one row with their number; they take the ranks from ``before`` on.
    lines = known.filter("all IS NOT NULL").groupBy("conv_id", "block", *LINE).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_last(), "speaker", "text")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = lines.withColumn("rank", before).withColumn("rank", F.explode(F.expr("sequence(rank, rank + n - 1)")))
    cut = ranked.withColumn("slice", F.floor(F.col("rank") / F.lit(piece)).cast("long"))
    columns = ["conv_id", *PLACE, *LINE]
    small = known.filter("all IS NULL").withColumn("slice", F.lit(0).cast("long"))
    return small.select(*columns).unionByName(cut.select(*columns))


def rotate(messages: DataFrame, part: int = PART, piece: int | None = None) -> DataFrame:
    """(conv_id, participant, part, start, text, mask, n_messages, n_trained) for every participant and part.

    ``part`` counts a participant's parts from 0; ``start`` is the part's offset in the whole rendering; ``mask``
    holds (start, end) spans within the part's text.
    """
    said = in_parts(messages, part, piece)
    as_user = F.length(open_user(F.col("speaker"))) + F.length("text") + len(END) + 1
    as_assistant = F.lit(len(OPEN_ASSISTANT) + len(END) + 1) + F.length("text")
    # Length of a part for everybody, and what it differs by for one speaker.
    sizes = said.groupBy("conv_id", *PLACE, "speaker").agg(F.sum(as_user).alias("users"), F.sum(as_assistant - as_user).alias("less"))
    per_part = sizes.groupBy("conv_id", *PLACE).agg(F.sum("users").alias("users"))
    speakers = sizes.select("conv_id", F.col("speaker").alias("participant")).distinct()
    # One row per participant and part of the conversation.
    own = sizes.select("conv_id", *PLACE, F.col("speaker").alias("participant"), "less")
    shaped = _same(_same(per_part, speakers, ["conv_id"], "inner"), own, ["conv_id", *PLACE, "participant"], "left")
    order = Window.partitionBy("conv_id", "participant").orderBy(*[F.col(c).asc_nulls_last() for c in PLACE])
    length = F.col("users") + F.coalesce("less", F.lit(0))
    before = F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = shaped.select(
        "conv_id", *PLACE, "participant", (F.row_number().over(order) - 1).cast("long").alias("part"),
        F.coalesce(before, F.lit(0)).cast("long").alias("start"),
    )
    # The messages of a part in order, once; every participant renders them.
    line = F.struct(F.col("turn").isNull().alias("late"), "turn", "speaker", "text")
    parts = said.groupBy("conv_id", *PLACE).agg(F.sort_array(F.collect_list(line)).alias("lines"))
    return _same(parts, placed, ["conv_id", *PLACE], "inner").select(
        "conv_id", "participant", "part", "start", *rendered(F.col("lines"), F.col("participant"))
    )


def rendered(lines: Column, participant: Column) -> list[Column]:
    """text, mask, n_messages, n_trained of one part for one participant."""

    def opening(m: Column) -> Column:
        return F.when(m["speaker"] == participant, F.lit(OPEN_ASSISTANT)).otherwise(open_user(m["speaker"]))

    texts = F.transform(lines, lambda m: F.concat(opening(m), m["text"], F.lit(END + "\n")))
    def span(m: Column, at: Column) -> Column:
        begin = at + F.length(opening(m))
        return F.struct(begin.alias("start"), (begin + F.length(m["text"]) + len(END)).alias("end"), (m["speaker"] == participant).alias("own"))

    # By prefix sums: a list of spans that grows by appending costs the square of a part's messages.
    lengths = F.transform(lines, lambda m: F.length(opening(m)) + F.length(m["text"]) + len(END) + 1)
    spans = let(prefix_sums(lengths), lambda at: F.transform(lines, lambda m, i: span(m, F.get(at, i))))
    mask = F.transform(F.filter(spans, lambda s: s["own"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    own = F.filter(lines, lambda m: m["speaker"] == participant)
    return [
        F.array_join(texts, "").alias("text"),
        mask.alias("mask"),
        F.size(lines).cast("long").alias("n_messages"),
        F.size(own).cast("long").alias("n_trained"),
    ]


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on equal keys, null equal to null; the right side's keys are dropped."""
    named = right.select(*[F.col(c).alias(f"right_{c}") if c in keys else F.col(c) for c in right.columns])
    on = [F.col(c).eqNullSafe(F.col(f"right_{c}")) for c in keys]
    return left.join(named, on, how).drop(*[f"right_{c}" for c in keys])
