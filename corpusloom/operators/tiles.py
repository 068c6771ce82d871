"""All pairs inside groups of any size, in tiles of bounded size, with one output row per member and tile.

A group with more members than a tile holds is cut into blocks by hash; each pair of blocks is a tile of its
own task share. Pairs are counted where they meet, never written out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.packaging import ship

TILE = 1024  # members of a block
KEY = ["_group", "_i", "_j"]


def spread(members: DataFrame, weight: str | None = None, weight_per_block: int = 2_000_000) -> DataFrame:
    """``members`` (with ``_group`` and ``_id``) once per tile, with ``_i <= _j`` and the member's own ``_block``.

    ``weight``: a size column whose sum per block stays near ``weight_per_block`` as well.
    """
    need = F.ceil(F.count("*") / TILE)
    if weight:
        need = F.greatest(need, F.ceil(F.sum(weight) / weight_per_block))
    blocks = members.groupBy("_group").agg(need.cast("int").alias("_blocks"))
    return (members.join(blocks, "_group")
            .withColumn("_block", F.pmod(F.xxhash64("_id"), F.col("_blocks")).cast("int"))
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
            .withColumn("_i", F.least("_block", "_other")).withColumn("_j", F.greatest("_block", "_other"))
            .drop("_other", "_blocks"))


def by_group(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys in rows sorted by them, as one table each; a run may span batches."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist()]
        for a, b in zip(starts, [*starts[1:], batch.num_rows]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def roots(linked: np.ndarray) -> np.ndarray:
    """Smallest member number reachable in a symmetric boolean matrix."""
    label = np.arange(len(linked))
    while True:
        best = np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label))
        new = np.minimum(label, best)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def intersections(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact intersection sizes of pairs of sorted sets: one by one if they are few, else by products of
    incidence columns."""
    if len(i) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i.tolist(), j.tolist())], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    renumber = np.cumsum(count > 1) - 1
    column, owner = renumber[column[shared]], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    last = int(column[-1]) + 1 if len(column) else 0
    for a in range(0, last, width):
        lo, hi = np.searchsorted(column, [a, a + width])
        x = np.zeros((len(sets), min(width, last - a)), np.float32)
        x[owner[lo:hi], column[lo:hi] - a] = 1
        total += x @ x.T
    return total[i, j].astype(np.int64)


def run_tiles(spread_rows: DataFrame, columns: list[str], work: Callable[[pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` on every tile; tiles share tasks by hash."""
    ship(spread_rows.sparkSession)
    rows = spread_rows.select(*KEY, "_block", *columns)
    ordered = rows.repartition(*KEY).sortWithinPartitions(*KEY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in by_group(batches, KEY):
            yield work(tile)

    return ordered.mapInArrow(run, schema)
