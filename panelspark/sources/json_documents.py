"""Records of JSON documents -- arrays of objects over any number of lines -- read by many tasks.

A document is cut at every ``}``, wherever Spark splits the file, so no array value is ever built. What a split does to a reader
depends on how the reader enters it: within a string or not, and how deep in objects. So each split is summed up for both string
states (does the state flip, by how much the depth changes, the lowest depth and where it was reached first and last), and the
summaries are put together in order: one row per split. After that it is known which pieces of a split end its first and last record: a ``}``
outside strings that takes the depth to 0 ends one. The records between these are joined in the task that reads them. Only the
pieces of a record that began in an earlier split, and those behind a split's last record, are shuffled, and put together by record.

So the files are read three times, and what is shuffled goes by the number of splits, not by the records.

Texts are valid JSON: a quote within a string is escaped, and a backslash stands in strings only. Arrays around the records, commas and blanks
between them are skipped; anything else there, or an end within a record, raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BETWEEN = " \t\r\n,[]\ufeff"  # what may stand between records
SPLIT = ["file", "block"]
COUNTS = ["flips", "opens_out", "opens_in"]
STATES = (0, 1)  # a split is entered outside / inside of a string
OF_STATE = ("step", "low", "first", "last", "closes")


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The files cut at every ``}``: file, block (where the split starts), at (order within it), value (without the ``}``).

    ``flips``: whether the piece changes between inside and outside of a string; ``opens_out`` / ``opens_in``: objects opened in it if it
    begins outside / inside of a string.
    """
    raw = spark.read.option("lineSep", "}").text(paths)
    raw = raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    raw = raw.withColumn("bare", F.regexp_replace("value", r"(?s)\\.", ""))
    # What is outside of strings if the piece begins outside; if it begins inside, the rest of it is.
    outside = F.regexp_replace("bare", r'"[^"]*("|$)', "")
    raw = raw.withColumns({"flips": _count(F.col("bare"), '"') % 2, "opens_out": _count(outside, "{"), "opens_all": _count(F.col("bare"), "{")})
    return raw.withColumn("opens_in", F.col("opens_all") - F.col("opens_out")).drop("bare", "opens_all")


def split_summaries(found: DataFrame) -> DataFrame:
    """One row per split, in one pass over its pieces in the order of the file: file, block, from_at / to_at (its first and last piece), flips, and for each state s

    * ``step{s}``: change of depth; ``closes{s}``: whether the ``}`` behind the last piece is outside of strings;
    * ``low{s}``: lowest depth behind a ``}`` outside of strings, the last piece not counted (it may be the rest of a file);
      ``first{s}`` / ``last{s}``: the first and last piece that reach it. Null if there is none.
    """
    fields = [f"{n}{s} {'boolean' if n == 'closes' else 'bigint'}" for s in STATES for n in OF_STATE]
    schema = ", ".join(["file string, block bigint, from_at bigint, to_at bigint, flips bigint", *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sums, held = None, {}, None  # the last piece is held back until the next one comes

        def count(rows: np.ndarray) -> None:
            at, flips, *opens = rows
            before = sums["flips"] + np.cumsum(flips) - flips
            for s in (0, 1):
                inside = (before + s) % 2
                closes = (inside + flips) % 2 == 0
                depth = sums[f"step{s}"] + np.cumsum(np.where(inside == 1, opens[1], opens[0]) - closes)
                sums[f"step{s}"], sums[f"closes{s}"] = int(depth[-1]), bool(closes[-1])
                if closes.any():
                    low, there = int(depth[closes].min()), at[closes]
                    there = there[depth[closes] == low]
                    if sums[f"low{s}"] is None or low < sums[f"low{s}"]:
                        sums[f"low{s}"], sums[f"first{s}"] = low, int(there[0])
                    if low == sums[f"low{s}"]:
                        sums[f"last{s}"] = int(there[-1])
            sums["flips"] = int(sums["flips"] + flips.sum()) % 2

        def summary() -> dict:
            low = {f"{n}{s}": sums[f"{n}{s}"] for s in (0, 1) for n in ("low", "first", "last")}
            count(held)
            return {**sums, **low, "file": key[0], "block": key[1], "to_at": int(held[0, 0])}

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            kinds = [(f.split()[0], {"string": pa.string(), "boolean": pa.bool_()}.get(f.split()[1], pa.int64())) for f in schema.split(", ")]
            return pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))

        for batch in batches:
            if not batch.num_rows:
                continue
            files, blocks = batch.column(0), batch.column(1).to_numpy()
            numbers = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(2, 6)])
            changes = (blocks[1:] != blocks[:-1]) | pc.not_equal(files.slice(1), files.slice(0, len(files) - 1)).to_numpy(zero_copy_only=False)
            ends = [*(np.flatnonzero(changes) + 1), len(blocks)]
            done = []
            for start, end in zip([0, *ends], ends):
                rows, now = numbers[:, start:end], (files[start].as_py(), int(blocks[start]))
                if now == key:
                    rows = np.concatenate([held, rows], axis=1)
                else:
                    if key is not None:
                        done.append(summary())
                    key, sums = now, {"flips": 0, "from_at": int(rows[0, 0])}
                    for s in (0, 1):
                        sums |= {f"step{s}": 0, f"low{s}": None, f"first{s}": None, f"last{s}": None, f"closes{s}": False}
                held = rows[:, -1:]
                if rows.shape[1] > 1:
                    count(rows[:, :-1])
            if done:
                yield batch_of(done)
        if key is not None:
            yield batch_of([summary()])

    return found.select(*SPLIT, "at", *COUNTS).mapInArrow(run, schema)


def split_entries(found: DataFrame) -> DataFrame:
    """How each split is entered, and which of its pieces are whole records.

    ``open_record``: the record that its first piece goes on with, named by the split where the one before it ended (-1: none did);
    ``first_end`` / ``last_end``: the first and last piece that end a record (null: none); ``begin``: the first piece of a record
    that begins in the split; ``rest_at``: the piece that is the rest of the file, without a ``}``.
    """
    splits = split_summaries(found)
    files = Window.partitionBy("file").orderBy("block")
    before = files.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("inside", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2)
    splits = splits.withColumns({n: F.when(F.col("inside") == 1, F.col(f"{n}1")).otherwise(F.col(f"{n}0")) for n in OF_STATE})
    depth = F.coalesce(F.sum("step").over(before), F.lit(0))
    splits = splits.withColumns({"lowest": depth + F.col("low"), "leaves": depth + F.col("step")})
    splits = splits.withColumns({"is_first": F.lag("block").over(files).isNull(), "is_last": F.lead("block").over(files).isNull()})
    # Behind the last piece of a file there need not be a }: there was none if one would be too many.
    splits = splits.withColumn("rest_at", F.when(F.col("is_last") & (F.col("leaves") == -1), F.col("to_at")))
    # Depths below 0 do not occur, so depth 0 is the lowest one where the split reaches it.
    below = (F.coalesce("lowest", F.lit(0)) < 0) | ((F.col("leaves") < 0) & F.col("rest_at").isNull())
    told = F.concat(F.col("file"), F.lit(": not an array of objects, or not whole, behind byte "), F.col("block").cast("string"))
    here, at_last = F.col("lowest") == 0, F.col("closes") & (F.col("leaves") == 0)
    first_end = F.when(below, F.raise_error(told).cast("long")).when(here, F.col("first")).when(at_last, F.col("to_at"))
    splits = splits.withColumns({"first_end": first_end, "last_end": F.when(at_last, F.col("to_at")).when(here, F.col("last"))})
    ended = F.when(F.col("first_end").isNotNull(), F.col("block"))
    carried = F.coalesce(F.last(ended, ignorenulls=True).over(before), F.lit(-1).cast("long"))
    begin = F.when(F.col("is_first"), F.col("from_at")).otherwise(F.col("first_end") + 1)
    return splits.select(*SPLIT, carried.alias("open_record"), "first_end", "last_end", begin.alias("begin"), "rest_at")


def _joined_within(placed: DataFrame) -> DataFrame:
    """Records (file, text) that lie within one split, joined in the task that reads it. Pieces of such records follow each other, whichever split they are of."""
    file = F.when(F.col("at") == F.col("begin"), F.col("file"))  # told once a split

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, depth, waiting, file = 0, 0, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            files, values = batch.column(0), batch.column(1)
            flips, *opens = (batch.column(i).to_numpy().astype(np.int64) for i in range(2, 5))
            states = (inside + np.cumsum(flips) - flips) % 2
            after = (states + flips) % 2
            depths = depth + np.cumsum(np.where(states == 1, opens[1], opens[0]) - (after == 0))
            inside, depth = int(after[-1]), int(depths[-1])
            ends = np.flatnonzero((depths == 0) & (after == 0))
            if len(ends):
                n = sum(map(len, waiting))
                parts = pa.concat_arrays([*waiting, values.slice(0, ends[-1] + 1)])
                texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(0, ends + 1 + n), pa.int32()), parts), "}")
                told = np.flatnonzero(files.is_valid().to_numpy(zero_copy_only=False))
                names = pa.concat_arrays([pa.array([file], files.type), files.take(pa.array(told))])
                yield pa.RecordBatch.from_arrays([names.take(pa.array(np.searchsorted(told, ends, side="right"))), texts], names=["file", "text"])
                waiting, file = [], names[len(names) - 1].as_py()
                values = values.slice(ends[-1] + 1)
            if len(values):
                waiting.append(values)
        if waiting:
            raise RuntimeError(f"{file}: pieces of a file out of order")

    within = placed.filter(F.col("at").between(F.col("begin"), F.col("last_end")))
    joined = within.select(file.alias("file"), "value", *COUNTS).mapInArrow(run, "file string, text string")
    return joined.withColumn("text", F.concat("text", F.lit("}")))


def _joined_across(placed: DataFrame) -> DataFrame:
    """What does not lie within one split: file, text, whether it ends (``whole``), whether it is behind the last ``}`` (``rest``)."""
    others = placed.filter(F.col("last_end").isNull() | ~F.col("at").between(F.col("begin"), F.col("last_end")))
    record = F.when(F.col("at") > F.col("last_end"), F.col("block")).otherwise(F.col("open_record"))
    is_rest, is_end = (F.coalesce(F.col("at") == F.col(c), F.lit(False)) for c in ("rest_at", "first_end"))
    text = F.when(is_rest, F.col("value")).otherwise(F.concat("value", F.lit("}")))
    part = F.struct(F.col("block"), F.col("at"), text.alias("text"))
    # Bounded: the pieces of one record.
    records = others.groupBy("file", record.alias("record")).agg(F.array_sort(F.collect_list(part)).alias("parts"), F.max(is_end).alias("whole"), F.max(is_rest).alias("rest"))
    return records.select("file", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"), "whole", "rest")


def record_texts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row (``text``) for every record of the documents."""
    found = pieces(spark, paths)
    placed = found.join(F.broadcast(split_entries(found)), SPLIT)  # a row a split; pieces stay in their order
    within = _joined_within(placed).withColumns({"whole": F.lit(True), "rest": F.lit(False)})
    records = within.unionByName(_joined_across(placed)).withColumn("text", F.ltrim("text", F.lit(BETWEEN)))
    is_record = F.col("whole") & F.startswith("text", F.lit("{"))
    is_nothing = ~F.col("whole") & F.col("rest") & (F.col("text") == "")
    told = F.concat(F.col("file"), F.lit(": not an array of objects, or not whole, at "), F.substring("text", 1, 80))
    checked = F.when(is_record, F.col("text")).when(is_nothing, F.lit(None).cast("string")).otherwise(F.raise_error(told).cast("string"))
    return records.select(checked.alias("text")).filter(F.col("text").isNotNull())


def on_one_line(text: Column) -> Column:
    """Line breaks stand between the parts of a record only (in strings they are escaped), so blanks can take their place."""
    return F.regexp_replace(text, r"[\r\n]+", " ")
