"""Exact top-k search by inner product: columnar branch and bound.

Vectors lie in vertical layout, one array per dimension. Scores are accumulated one block of dimensions at
a time; after each block a candidate's remaining mass bounds what it can still gain, candidates that cannot
reach the k-th best score are dropped, and the survivors are compacted. A few queries are scored together, by
matrix products of floats where these are exact. Queries are split into blocks and candidates into shards; a
task meets one query block and one shard, and only its k best rows leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import ready, store
from corpusloom.operators.tiles import by_group

K = 20
DIMENSIONS = 8  # of a block
QUERY_ROWS = 1024  # of a query block
SHARD_ROWS = 16_384  # of a candidate shard
STEP_ROWS = 4096  # candidates laid out at a time
QUERY_GROUP = 16  # queries scored at a time: their scores of a layout step take 0.5 MB
COMPACT = 0.9  # share of candidates still of use to some query at which the others are moved out
EXACT = 2.0 ** 53  # integers below this are exact in floats, whatever the order of a sum
SCALE = 64


def quantised(vectors: pa.Array, scale: int = SCALE) -> pa.Array:
    """``floor(scale * x)`` of every component, as bytes; null for null vectors and null or non-finite components."""
    at = vectors.offsets.to_numpy()
    x = vectors.values[at[0]:at[-1]].to_numpy(zero_copy_only=False).astype(np.float64)  # a slice of a column: only its own values
    at = at - at[0]
    finite = np.isfinite(x)
    whole = np.floor(scale * np.where(finite, x, 0)).astype("<i8")
    bad = np.concatenate([[0], np.cumsum(~finite)])
    good = vectors.is_valid().to_numpy(zero_copy_only=False) & (bad[at[1:]] == bad[at[:-1]])
    return pa.array([whole[a:b].tobytes() if ok else None for a, b, ok in zip(at[:-1].tolist(), at[1:].tolist(), good.tolist())], pa.binary())


def vertical(raw: list[bytes], width: int) -> np.ndarray:
    """Dimension by row; shorter vectors are filled with zeros."""
    out = np.zeros((width, len(raw)), np.int64)
    for r, b in enumerate(raw):
        x = np.frombuffer(b, "<i8")
        out[: len(x), r] = x
    return out


def tail_mass(columns: np.ndarray) -> np.ndarray:
    """Euclidean norm of what lies at and after the start of each dimension block, rounded up; blocks by rows."""
    squares = columns.astype(np.float64) ** 2
    blocks = np.add.reduceat(squares, np.arange(0, len(columns), DIMENSIONS), axis=0)
    tails = np.cumsum(blocks[::-1], axis=0)[::-1]
    return np.sqrt(tails) * (1 + 1e-12)


class Best:
    """The k best (score, id) of one query: larger scores first, then smaller ids."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def floor(self) -> float:
        return float(self.scores[-1]) if len(self.scores) >= self.k else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        s, i = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        if len(s) > 2 * self.k:  # only what ties with the k-th or lies above is sorted
            top = s >= np.partition(s, -self.k)[-self.k]
            s, i = s[top], i[top]
        order = np.lexsort((i, -s))[: self.k]
        self.scores, self.ids = s[order], i[order]


def search(queries: np.ndarray, asked: np.ndarray, mass: np.ndarray, columns: np.ndarray, masses: np.ndarray, ids: np.ndarray, bests: list[Best]) -> None:
    """Enter the candidates (a column each) of one layout step into the bests of a few queries (a row each, with ids ``asked``)."""
    floors = np.array([best.floor() for best in bests])[:, None]
    alive = asked[:, None] != ids
    scores = np.zeros(alive.shape, columns.dtype)
    for b, d in enumerate(range(0, len(columns), DIMENSIONS)):
        if floors.max() > -np.inf:
            alive &= scores + mass[b][:, None] * masses[b] >= floors - 0.5
            used = alive.any(axis=0)
            if not used.any():
                return
            if used.mean() < COMPACT:
                alive, scores, columns, masses, ids = alive[:, used], scores[:, used], columns[:, used], masses[:, used], ids[used]
        scores += queries[:, d:d + DIMENSIONS] @ columns[d:d + DIMENSIONS]
    alive &= scores >= floors
    for q in np.flatnonzero(alive.any(axis=1)).tolist():
        bests[q].add(scores[q, alive[q]].astype(np.int64), ids[alive[q]])


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, id_col: str = "vec_id",
                vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, id, score``: each query's ``k`` rows with the largest integer inner product.

    Queries are the rows for which ``is_query`` holds, candidates all rows but the query's own; ties go to
    the smaller id. Vectors that are null or hold null or non-finite components, and rows with a null id,
    take no part. Missing components of shorter vectors count as zero. Rows that repeat an id are candidates
    of their own but no partners of that id. Fewer candidates than ``k`` give fewer rows, an empty table
    none. Other columns are left out, whatever their names.
    """
    ready(vectors)

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), quantised(batch.column(2), scale)], ["id", "q", "raw"])

    rows = store(vectors.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("q"), vector_col,
    ).mapInArrow(quantise, "id long, q boolean, raw binary").where("raw is not null"), "quantised")
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("q").alias("q"), F.max(F.length("raw")).alias("bytes")).first()
    width = max(DIMENSIONS, -(-(sizes["bytes"] or 0) // 8))
    query_blocks, shards = max(1, -(-sizes["q"] // QUERY_ROWS)), max(1, -(-sizes["n"] // SHARD_ROWS))
    spread = F.xxhash64("id")
    asking = rows.where("q").select(
        F.pmod(spread, F.lit(query_blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(0).alias("side"), "id", "raw")
    offered = rows.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))).alias("block"),
        F.pmod(spread, F.lit(shards)).cast("int").alias("shard"), F.lit(1).alias("side"), "id", "raw")
    met = asking.unionByName(offered).repartition(F.col("block"), F.col("shard")).sortWithinPartitions("block", "shard", "side", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in by_group(batches, ["block", "shard"]):
            side, ids, raw = group["side"].to_numpy(), group["id"].to_numpy(), group["raw"]
            n = int((side == 0).sum())
            queries = np.ascontiguousarray(vertical(raw[:n].to_pylist(), width).T)
            bests = [Best(k) for _ in range(n)]
            query_mass = tail_mass(queries.T)
            for a in range(n, len(ids) if n else 0, STEP_ROWS):
                columns = vertical(raw[a:a + STEP_ROWS].to_pylist(), width)
                masses = tail_mass(columns)
                kind = np.float64 if masses[0].max() * query_mass[0].max() < EXACT else np.int64
                columns = columns.astype(kind)
                for q in range(0, n, QUERY_GROUP):
                    some = slice(q, min(n, q + QUERY_GROUP))
                    search(queries[some].astype(kind), ids[some], query_mass[:, some], columns, masses, ids[a:a + STEP_ROWS], bests[some])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(ids[:n], [len(b.ids) for b in bests]), pa.int64()),
                pa.array(np.concatenate([b.ids for b in bests]) if n else np.zeros(0, np.int64), pa.int64()),
                pa.array(np.concatenate([b.scores for b in bests]) if n else np.zeros(0, np.int64), pa.int64()),
            ], ["query_id", "id", "score"])

    partial = met.mapInArrow(run, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
