"""Exact top-k by inner product with multi-resolution segment statistics.

A vector is cut into segments; a segment is described by its mean and its deviation (the length of what is
left after the mean). For two vectors x and y of equal dimension and a segment of d components,

    sum x*y  <=  d * mean(x) * mean(y) + dev(x) * dev(y),

and as ``|x - y|^2 = |x|^2 + |y|^2 - 2 x.y`` the same statistics bound the distance from below. The sum over segments
is the inner product of the statistics themselves, so one matrix product bounds a block of queries against
a block of candidates. Coarse segments are tried first, then finer ones for what is left, then exact integer
scores for the survivors.

Queries are packed into blocks and every block meets every block of candidates once, as a stated query set has to:
a join on the candidate's group, to which the query blocks are repeated. A pair of blocks sends on at most
k rows a query, and the final ranking cuts to k rows in each task before it shuffles.

A query's threshold in a pair of blocks is the k-th best exact score of its most promising candidates, so no
candidate that could be among the k best is dropped; ties go to the smaller id.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no part, nor do rows
without an id; vectors of different dimensions are not compared; a candidate with the query's own id is the
query itself; a repeated row is a candidate each time it occurs, and a repeated query is answered each time; with fewer than
k candidates all are returned; an empty table gives an empty result; other columns are ignored. Scores
must fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 10
SCALE = 1024
QUERY_BLOCK, ROW_BLOCK = 256, 4096
SEGMENTS = (4, 16)  # per vector, coarse to fine


def packed(rows: DataFrame, most: int) -> DataFrame:
    """Rows (row_id, vec_id, vec array<double>) -> blocks (dim, n, row_ids, ids, data), at most ``most`` rows each.

    Blocks form within the partitions, so nothing is shuffled.
    """
    names = ["dim", "n", "row_ids", "ids", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}

        def emit(dim: int) -> pa.RecordBatch:
            parts = waiting.pop(dim)
            values = [len(parts), *[b"".join(p[i] for p in parts) for i in range(3)]]
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([values[0]], pa.int32()), *[pa.array([v], pa.binary()) for v in values[1:]]], names=names
            )

        for batch in batches:
            for row, i, vec in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                v = vec.values.to_numpy(zero_copy_only=False)
                part = (np.int64(row).tobytes(), np.int64(i).tobytes(), np.floor(v * SCALE).astype(np.float64).tobytes())
                waiting.setdefault(len(v), []).append(part)
                if len(waiting[len(v)]) == most:
                    yield emit(len(v))
        for dim in list(waiting):
            yield emit(dim)

    return rows.select("row_id", "vec_id", "vec").mapInArrow(run, "dim int, n int, row_ids binary, ids binary, data binary")


def segment_statistics(data: np.ndarray, segments: int) -> np.ndarray:
    """Rows of (sqrt(d) * mean, deviation) per segment; their inner product bounds the vectors' own."""
    cuts = np.linspace(0, data.shape[1], min(segments, data.shape[1]) + 1).astype(int)
    out = []
    for s, e in zip(cuts[:-1], cuts[1:], strict=True):
        part = data[:, s:e]
        mean = part.mean(axis=1)
        out += [mean * np.sqrt(e - s), np.sqrt(np.maximum(((part - mean[:, None]) ** 2).sum(axis=1), 0))]
    return np.column_stack(out)


def best_of_block(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query position, row position, score) of each query's k best rows, ties to the smaller id."""
    # Slack for rounding: the bounds are doubles, scores are exact integers.
    slack = 1e-9 * np.outer(np.abs(queries).max(axis=1) + 1, np.abs(rows).max(axis=1) + 1) * queries.shape[1] + 1e-6
    own = query_ids[:, None] == row_ids[None, :]
    bound = segment_statistics(queries, SEGMENTS[0]) @ segment_statistics(rows, SEGMENTS[0]).T + slack
    bound[own] = -np.inf
    exact_q, exact_r = queries.astype(np.int64), rows.astype(np.int64)
    seeds = min(len(rows), 4 * k)
    out_q, out_r, out_s = [], [], []
    alive = np.ones_like(own)
    if len(rows) > seeds:
        # The k-th best exact score of the rows with the highest coarse bounds is a threshold.
        top = np.argpartition(-bound, seeds - 1, axis=1)[:, :seeds]
        score = np.einsum("qd,qsd->qs", exact_q, exact_r[top])
        score = np.where(np.take_along_axis(own, top, axis=1), np.iinfo(np.int64).min, score)
        least = np.sort(score, axis=1)[:, -k] if seeds >= k else np.full(len(queries), np.iinfo(np.int64).min)
        alive = bound >= least[:, None]
        for segments in SEGMENTS[1:]:
            fine = segment_statistics(queries, segments) @ segment_statistics(rows, segments).T + slack
            alive &= fine >= least[:, None]
    alive &= ~own
    for q in range(len(queries)):
        r = np.flatnonzero(alive[q])
        score = exact_r[r] @ exact_q[q]
        order = np.lexsort((row_ids[r], -score))[:k]
        out_q.append(np.full(len(order), q))
        out_r.append(r[order])
        out_s.append(score[order])
    return np.concatenate(out_q), np.concatenate(out_r), np.concatenate(out_s)


def usable(vec: Column) -> Column:
    ok = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vec) > 0) & ok, F.lit(False))


def top_k(
    vectors: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding", query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k rows of highest integer inner product."""
    vec = F.transform(embedding, lambda x: x.cast("double"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), vec.alias("vec"), is_query.alias("q"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vec"))).withColumn("row_id", F.monotonically_increasing_id())
    groups = max(1, vectors.sparkSession.sparkContext.defaultParallelism)
    blocks = packed(rows, row_block).withColumn("grp", F.pmod(F.xxhash64("row_ids"), F.lit(groups)))
    queries = packed(rows.filter("q").coalesce(groups), query_block)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("grp")
    asked = queries.select("dim", *[F.col(c).alias(f"q_{c}") for c in ("row_ids", "ids", "data")], every)
    met = blocks.join(asked, ["grp", "dim"]).select("dim", "ids", "data", "q_row_ids", "q_ids", "q_data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim, ids, data, q_rows, q_ids, q_data = (batch.column(j)[i].as_py() for j in range(6))
                ids, q_ids, q_rows = (np.frombuffer(x, np.int64) for x in (ids, q_ids, q_rows))
                q, r, score = best_of_block(np.frombuffer(q_data).reshape(-1, dim), q_ids, np.frombuffer(data).reshape(-1, dim), ids, k)
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (q_rows[q], q_ids[q], ids[r], score)], names=["query_row", "query_id", "vec_id", "score"])

    near = met.mapInArrow(run, "query_row bigint, query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
