"""Hard negatives for contrastive training, by a secondary-sort shuffle.

A bounded block of anchors is sent to all tasks, which score it against the rows they read; vectors are never
shuffled. Pair scores travel as keys ``(anchor, -score, side, id)``: partitioned by the anchor, sorted by the
whole key. A streaming pass over each partition then meets every anchor's pairs best first, opens a window at
each positive and hands out negatives to the windows that are open, holding nothing but these windows.

Before the shuffle a task keeps, of an anchor's pairs, only those that could be among the first of a window.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from corpusloom.llm.common import ready, store, tidy
from corpusloom.llm.topk import Best, quantised

POSITIVES, NEGATIVES = 5, 5
LOWEST, HIGHEST = 80, 100  # a negative's score in percent of the positive's
SCALE = 256
BLOCK_BYTES = 8 << 20  # of the anchors that one round sends to the tasks
STEP_ROWS = 4096  # candidates scored at a time
EXACT = float(1 << 53)

Pair = tuple[int, int, int, int]  # anchor, -score, side (0: positive), id


def matrix(raw: list[bytes], width: int) -> np.ndarray:
    """One row per vector; shorter vectors are filled with zeros."""
    if all(len(b) == 8 * width for b in raw):
        return np.frombuffer(b"".join(raw), "<i8").reshape(len(raw), width)
    out = np.zeros((len(raw), width), np.int64)
    for r, b in enumerate(raw):
        out[r, : len(b) // 8] = np.frombuffer(b, "<i8")
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows; in floating point where that is exact."""
    x, y = a.astype(np.float64), b.astype(np.float64)
    norms = [np.sqrt((v * v).sum(axis=1).max(initial=0)) for v in (x, y)]
    return (x @ y.T).astype(np.int64) if norms[0] * norms[1] < EXACT / 2 else a @ b.T


class Block:
    """Anchors of one round, as the tasks hold them."""

    def __init__(self, rows: list[tuple[int, int, bytes]], width: int):
        self.ids = np.array([r[0] for r in rows], np.int64)
        self.labels = np.array([r[1] for r in rows], np.int64)
        self.vectors = matrix([r[2] for r in rows], width)

    def scored(self, ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Scores of the anchors ``rows`` with all candidates; the smallest integer for an anchor's own id."""
        out = products(self.vectors[rows], vectors)
        out[self.ids[rows][:, None] == ids[None, :]] = np.iinfo(np.int64).min
        return out


def steps(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and vectors of about STEP_ROWS candidates at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= STEP_ROWS:
            yield unpacked(held, width)
            held, rows = [], 0
    if rows:
        yield unpacked(held, width)


def unpacked(held: list[pa.RecordBatch], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    t = pa.Table.from_batches(held)
    return t["id"].to_numpy(), t["label"].to_numpy(), matrix(t["raw"].to_pylist(), width)


def batch_of(rows: list[Pair]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "down", "side", "id"])


PAIRS = "anchor long, down long, side long, id long"


def best_positives(block: Block, batches: Iterable[pa.RecordBatch], width: int, k: int) -> list[Pair]:
    """Each anchor's ``k`` best rows of its own label, of the rows that this task reads."""
    bests = [Best(k) for _ in block.ids]
    floors = np.full(len(bests), np.iinfo(np.int64).min + 1)
    for ids, labels, vectors in steps(batches, width):
        for label in np.intersect1d(labels, block.labels):
            rows, same = np.flatnonzero(block.labels == label), labels == label
            scores = block.scored(ids[same], vectors[same], rows)
            good = scores >= floors[rows][:, None]
            for r in np.flatnonzero(good.any(axis=1)).tolist():
                best = bests[rows[r]]
                best.add(scores[r, good[r]], ids[same][good[r]])
                if len(best.scores) >= k:
                    floors[rows[r]] = best.scores[-1]
    return [(a, -s, 0, i) for a, b in enumerate(bests) for s, i in zip(b.scores.tolist(), b.ids.tolist())]


class Windows:
    """The score windows of one anchor, each with the best negatives met so far."""

    def __init__(self, positives: list[int], k: int, low: int, high: int):
        kept = {(-(-low * p // 100), high * p // 100) for p in positives}
        self.spans = sorted(w for w in kept if w[0] <= w[1])
        self.bests = [Best(k) for _ in self.spans]
        self.top = max((b for _, b in self.spans), default=np.iinfo(np.int64).min)
        self.least = min((a for a, _ in self.spans), default=np.iinfo(np.int64).max)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for (a, b), best in zip(self.spans, self.bests):
            inside = (scores >= max(a, best.floor())) & (scores <= b)
            if inside.any():
                best.add(scores[inside], ids[inside])
        self.least = min(max(a, int(best.scores[-1])) if len(best.scores) >= best.k else a for (a, _), best in zip(self.spans, self.bests))

    def pairs(self) -> set[tuple[int, int]]:
        """(score, id) of all that is among the best of a window; a row's copies stay apart below."""
        return {(s, i) for b in self.bests for s, i in zip(b.scores.tolist(), b.ids.tolist())}


def window_negatives(block: Block, positives: list[list[int]], batches: Iterable[pa.RecordBatch], width: int, k: int,
                     low: int, high: int) -> list[Pair]:
    """Each anchor's rows of other labels that are among the first ``k`` of a window, of the rows that this task reads."""
    windows = [Windows(p, k, low, high) for p in positives]
    rows = np.array([a for a, w in enumerate(windows) if w.spans], np.int64)
    least = np.array([windows[a].least for a in rows], np.int64)
    top = np.array([windows[a].top for a in rows], np.int64)
    for ids, labels, vectors in steps(batches, width) if len(rows) else ():
        scores = block.scored(ids, vectors, rows)
        good = (scores >= least[:, None]) & (scores <= top[:, None]) & (block.labels[rows][:, None] != labels[None, :])
        for r in np.flatnonzero(good.any(axis=1)).tolist():
            w = windows[rows[r]]
            w.add(scores[r, good[r]], ids[good[r]])
            least[r] = w.least
    out: list[Pair] = []
    for a in rows.tolist():
        for s, i in windows[a].pairs():
            copies = max(int(((b.scores == s) & (b.ids == i)).sum()) for b in windows[a].bests)
            out += [(a, -s, 1, i)] * copies
    return out


def open_windows(pairs: Iterable[Pair], k_positives: int, k_negatives: int, low: int, high: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """``anchor, positive, rank, negative, positive score, negative score`` from pairs in key order.

    A positive comes before negatives of its score and opens a window; a window is closed when it is full or
    the scores have fallen below it. Nothing else of an anchor is held.
    """
    current, windows, opened = None, [], 0
    for anchor, down, side, other in pairs:
        score = -down
        if anchor != current:
            current, windows, opened = anchor, [], 0
        if side == 0:
            if opened < k_positives:
                windows.append([other, score, 0])
                opened += 1
            continue
        windows = [w for w in windows if w[2] < k_negatives and low * w[1] <= 100 * score]
        for w in windows:
            if 100 * score <= high * w[1]:
                w[2] += 1
                yield anchor, w[0], w[2], other, w[1], score


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: int = LOWEST,
    highest: int = HIGHEST, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A score is the integer inner product of ``floor(scale * x)``; higher scores come first, ties by smaller id.
    An anchor's positives are its ``positives`` best other rows of the same label. For each, the first
    ``negatives`` rows of other labels are returned whose score lies between ``lowest`` and ``highest`` percent
    of the positive's (at most 100, so that a window opens at its positive).

    Rows with a null id, label or vector, or with a null or non-finite component, take no part. Rows with the
    anchor's id are no partners of it; rows that repeat an id count each, as positives and as negatives. Anchors
    that are alike in id, label and vector count once. Missing components of shorter vectors count as zero, an
    empty vector scores 0. Fewer partners give fewer rows, an empty table none. Other columns are left out.
    """
    if highest > 100:
        raise ValueError("windows open at their positive: highest is at most 100")
    spark = ready(vectors)

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), quantised(batch.column(3), scale)], ["id", "label", "anchor", "raw"])

    rows = store(vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"), vector_col,
    ).mapInArrow(tidy(quantise), "id long, label long, anchor boolean, raw binary").where("raw is not null"), "quantised")
    sizes = rows.agg(F.max(F.length("raw")).alias("bytes"), F.sum(F.when(F.col("anchor"), F.length("raw") + 64)).alias("anchors")).first()
    width, rounds = (sizes["bytes"] or 0) // 8, -(-(sizes["anchors"] or 0) // BLOCK_BYTES)
    anchors = rows.where("anchor").select("id", "label", "raw").distinct()
    candidates = rows.select("id", "label", "raw")
    schema = StructType([StructField("anchor_id", LongType()), StructField("positive_id", LongType()), StructField("rank", IntegerType()),
                         StructField("negative_id", LongType()), StructField("positive_score", LongType()), StructField("negative_score", LongType())])
    found: list[DataFrame] = []
    for number in range(rounds):
        mine = F.pmod(F.xxhash64("id", "label", "raw"), F.lit(rounds)) == number
        block = Block(sorted(tuple(r) for r in anchors.where(mine).collect()), width)
        if len(block.ids):
            found.append(store(_round(candidates, block, width, positives, negatives, lowest, highest, schema), "negatives"))
    if not found:
        return spark.createDataFrame([], schema)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _round(candidates: DataFrame, block: Block, width: int, k_positives: int, k_negatives: int, low: int, high: int, schema: StructType) -> DataFrame:
    """All rows of one block of anchors."""
    spark = candidates.sparkSession
    shared = spark.sparkContext.broadcast(block)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield batch_of(best_positives(shared.value, batches, width, k_positives))

    order = Window.partitionBy("anchor").orderBy("down", "id")
    first = store(candidates.mapInArrow(tidy(find), PAIRS).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k_positives).drop("_n"), "positives")
    scores: list[list[int]] = [[] for _ in block.ids]
    for r in first.select("anchor", "down").collect():  # k_positives rows an anchor of a bounded block
        scores[r.anchor].append(-r.down)

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield batch_of(window_negatives(shared.value, scores, batches, width, k_negatives, low, high))

    pairs = first.unionByName(candidates.mapInArrow(tidy(mine), PAIRS))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = pairs.rdd.map(lambda r: (tuple(r), None)).repartitionAndSortWithinPartitions(tasks, lambda key: key[0])
    ids = block.ids.tolist()

    def stream(part: Iterator[tuple[Pair, None]]) -> Iterator[tuple[int, int, int, int, int, int]]:
        for anchor, *rest in open_windows((key for key, _ in part), k_positives, k_negatives, low, high):
            yield ids[anchor], *rest

    return spark.createDataFrame(ordered.mapPartitions(stream), schema)
