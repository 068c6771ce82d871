"""Near-duplicate vectors by a forest of random-projection trees with spill overlap.

Trees are fitted on a bounded sample: random directions, cuts at the median of the projections, and a margin
on either side of a cut whose vectors go both ways. Every vector runs down every tree; vectors are compared
within leaves only, and similar ones are united. The sample bounds the depth of the planted trees: leaves that hold too
much go on splitting at quantiles of their own vectors, found by Spark over all of them, and what cannot be split is
compared in tiles. Inside the united groups all pairs are then verified in tiles, so that the number of links of a vector
does not depend on the leaves that it met its partners in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import ready, store
from corpusloom.operators import tiles
from corpusloom.operators.components import connected_components

THRESHOLD = 0.9
TREES = 6
SPILL = 0.1  # share of a node's vectors on either side of its cut that go both ways
LEAF = 1024  # vectors that a leaf is planned for, before spill
SAMPLE = 32_768  # bound of the vectors that the cuts are taken from
SAMPLE_PER_LEAF = 16
ROWS = 1024  # rows compared with a leaf at a time
OVERSIZE = 8  # leaves with more than so many times LEAF vectors are split further; one task compares no more than that
ROUNDS = 40  # of further splits; what is large then is compared in tiles
MOST_BOTH = 0.5  # a cut that sends a larger share of a leaf both ways does not split it
SPARSE = 4  # links per vector that are united one by one


@dataclass
class Tree:
    """A complete binary tree in heap order: unit directions, and the margin (low, high) of each inner node."""

    directions: np.ndarray
    low: np.ndarray
    high: np.ndarray
    depth: int

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(row, leaf)`` pairs; a row in a margin continues on both sides."""
        rows, nodes = np.arange(len(x)), np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            p = np.einsum("ij,ij->i", x[rows], self.directions[nodes])
            left, right = p <= self.high[nodes], p >= self.low[nodes]
            rows, nodes = np.concatenate([rows[left], rows[right]]), np.concatenate([2 * nodes[left] + 1, 2 * nodes[right] + 2])
        return rows, nodes - ((1 << self.depth) - 1)


def plant(sample: np.ndarray, depth: int, seed: int, spill: float = SPILL) -> Tree:
    """A tree whose cuts halve the sample at every node."""
    g = np.random.default_rng(seed)
    inner = (1 << depth) - 1
    directions = g.standard_normal((inner, sample.shape[1]))
    directions /= np.linalg.norm(directions, axis=1, keepdims=True)
    low, high = np.zeros(inner), np.zeros(inner)
    members: dict[int, np.ndarray] = {0: np.arange(len(sample))}
    for node in range(inner):
        rows = members.pop(node, np.zeros(0, np.int64))
        p = sample[rows] @ directions[node]
        if len(p):
            low[node], high[node] = np.quantile(p, [0.5 - spill, 0.5 + spill])
        members[2 * node + 1], members[2 * node + 2] = rows[p <= high[node]], rows[p >= low[node]]
    return Tree(directions, low, high, depth)


def vector(column: pa.Array) -> list[np.ndarray | None]:
    """Double vectors of a list column; None if null, empty, zero, or with a null or non-finite component."""
    out: list[np.ndarray | None] = []
    for value in column.to_pylist():
        x = None if not value or None in value else np.array(value, np.float64)
        out.append(x if x is not None and np.isfinite(x).all() and x.any() else None)
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """Scaled to length one, safely for components of any size."""
    x = x / np.abs(x).max()
    return x / np.linalg.norm(x)


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)


def similar(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    return x @ y.T >= threshold


def united(x: np.ndarray, threshold: float, first: np.ndarray | None = None) -> np.ndarray:
    """For every row the smallest row number reachable by links; with ``first`` (a mask) only links between its rows and
    the others count. A slab of rows at a time, so memory is bounded by ``ROWS`` times the rows."""
    label = np.arange(len(x))
    rows, columns = (label.copy(), label.copy()) if first is None else (np.flatnonzero(first), np.flatnonzero(~first))
    for a in range(0, len(rows), ROWS):
        slab = rows[a:a + ROWS]
        linked = similar(x[slab], x[columns], threshold)
        while True:
            apart = linked & (label[slab][:, None] != label[columns][None, :])
            counts = apart.sum(axis=1)
            if counts.sum() <= SPARSE * len(x):
                break
            hub = counts.argmax()  # a crowd is united at once
            names = np.unique(label[np.append(columns[apart[hub]], slab[hub])])
            label[np.isin(label, names)] = names[0]
        i, j = np.nonzero(apart)
        for p, q in zip(slab[i].tolist(), columns[j].tolist()):
            while label[p] != p:
                label[p] = p = label[label[p]]
            while label[q] != q:
                label[q] = q = label[label[q]]
            label[max(p, q)] = min(p, q)
        while (label[label] != label).any():
            label = label[label]
    return label


def links_of(group: pa.Table, key: str, threshold: float, first: np.ndarray | None = None) -> pa.RecordBatch:
    """``a, b``: links that connect what is similar among the vectors of a leaf or tile."""
    label, keys = united(matrix(group["_raw"]), threshold, first), group[key].combine_chunks()
    joined = np.flatnonzero(label != np.arange(len(label)))
    return pa.RecordBatch.from_arrays([keys.take(pa.array(joined)), keys.take(pa.array(label[joined]))], ["a", "b"])


def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``_p``, the projection on the direction that belongs to the row's leaf."""
    for batch in batches:
        names, raw = batch.column(0).to_numpy(), batch.column(2).to_pylist()
        p = np.zeros(len(names))
        for name in np.unique(names).tolist():
            at = np.flatnonzero(names == name)
            x = np.frombuffer(b"".join(raw[k] for k in at.tolist()), "<f8").reshape(len(at), -1)
            p[at] = x @ np.random.default_rng(name & ((1 << 64) - 1)).standard_normal(x.shape[1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], ["_leaf", "_member", "_raw", "_p"])


def deepen(rows: DataFrame, bound: int, spill: float) -> tuple[list[DataFrame], DataFrame | None]:
    """Splits leaves of more than ``bound`` rows (``_leaf, _member, _raw``) until none is left or none can be split:
    the leaves within the bound, and the rows of the others (None if there are none).

    The cuts are quantiles over all rows of a leaf, aggregated on the map side; no leaf is gathered. A leaf that would
    send more than ``MOST_BOTH`` of its rows both ways, as ties do, is not split.
    """
    small, stuck = [], None
    for turn in range(ROUNDS + 1):
        large = store(rows.groupBy("_leaf").agg(F.count("*").alias("_n")).where(F.col("_n") > bound).select("_leaf"), "large-leaves")
        if large.isEmpty():
            return [*small, rows], stuck
        small.append(rows.join(large, "_leaf", "left_anti"))
        whole = rows.join(large, "_leaf", "left_semi").select("_leaf", "_member", "_raw")
        if turn == ROUNDS:
            return small, whole if stuck is None else stuck.unionByName(whole)
        moving = store(whole.mapInArrow(project, "_leaf long, _member binary, _raw binary, _p double"), "large")
        quantiles = F.percentile_approx("_p", [0.5 - spill, 0.5 + spill], 1000)
        cuts = store(moving.groupBy("_leaf").agg(quantiles.alias("_q")).select("_leaf", F.col("_q")[0].alias("_low"), F.col("_q")[1].alias("_high")), "cuts")
        cut = moving.join(cuts, "_leaf")
        left, right = F.col("_p") <= F.col("_high"), F.col("_p") >= F.col("_low")
        shares = store(cut.groupBy("_leaf").agg((F.count_if(left & right) > MOST_BOTH * F.count("*")).alias("_tied")), "shares")
        if not shares.where("_tied").isEmpty():
            kept = moving.join(shares.where("_tied"), "_leaf", "left_semi").drop("_p")
            stuck = kept if stuck is None else stuck.unionByName(kept)
            cut = cut.join(shares.where("not _tied"), "_leaf", "left_semi")
        sides = F.filter(F.array(F.when(left, F.xxhash64("_leaf", F.lit(0))), F.when(right, F.xxhash64("_leaf", F.lit(1)))), lambda c: c.isNotNull())
        rows = store(cut.select(F.explode(sides).alias("_leaf"), "_member", "_raw"), "leaves")
    return small, stuck


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, spill: float = SPILL,
                    leaf: int = LEAF, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, n_links, component_id, kept`` for every row: vectors with a cosine of ``threshold`` or more are
    linked; ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id reachable.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing. Vectors of
    different length are never compared. Equal directions in equal storage are one member with a weight, so
    repeated rows count like copies. Ids must be integers; a row with a null id links with nothing and is
    kept. Other columns are left out, whatever their names; an empty table gives an empty result.
    """
    spark = ready(vectors)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found = [unit(x) if x is not None and key is not None else None for key, x in zip(ids, vector(batch.column(1)))]
            raw = [None if x is None else x.astype("<f8").tobytes() for x in found]
            keys = [None if r is None else xxhash.xxh3_128_digest(r) for r in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array([None if x is None else len(x) for x in found], pa.int32()), pa.array(raw, pa.binary())],
                ["_id", "_member", "_size", "_raw"])

    rows = store(vectors.select(F.col(id_col).cast("long").alias("_id"), vector_col).mapInArrow(
        clean, "_id long, _member binary, _size int, _raw binary"), "vectors")
    members = store(rows.where("_member is not null").groupBy("_member").agg(
        F.min("_id").alias("_head"), F.count("*").alias("_copies"), F.first("_size").alias("_size"), F.first("_raw").alias("_raw")), "members")
    # trees per vector length; lengths are few, each gets a bounded sample
    routed = None
    for size, n in sorted((r["_size"], r["n"]) for r in members.groupBy("_size").agg(F.count("*").alias("n")).collect()):
        part = members.where(F.col("_size") == size)
        fraction = SAMPLE / n
        key = F.pmod(F.xxhash64("_member", F.lit("sample")), F.lit(1 << 30))
        sample = part if fraction >= 1 else part.where(key < int(fraction * (1 << 30)))
        drawn = np.frombuffer(b"".join(r["_raw"] for r in sample.orderBy("_member").select("_raw").limit(SAMPLE).collect()), "<f8").reshape(-1, size)
        depth = max(0, int(np.ceil(np.log2(max(1, n / leaf)))))
        depth = min(depth, max(0, int(np.log2(max(1, len(drawn) / SAMPLE_PER_LEAF)))))
        shared = spark.sparkContext.broadcast([plant(drawn, depth, 1000 * size + t, spill) for t in range(trees)])

        def route(batches: Iterator[pa.RecordBatch], shared=shared, size=size) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = matrix(batch.column(1))
                    for t, tree in enumerate(shared.value):
                        at, leaves = tree.leaves(x)
                        chosen = batch.take(pa.array(at))
                        names = np.full(len(at), size, np.int64) << 40 | t << 32 | leaves
                        yield pa.RecordBatch.from_arrays([pa.array(names), chosen.column(0), chosen.column(1)], ["_leaf", "_member", "_raw"])

        leaves = part.select("_member", "_raw").mapInArrow(route, "_leaf long, _member binary, _raw binary")
        routed = leaves if routed is None else routed.unionByName(leaves)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in tiles.by_group(batches, ["_leaf"]):
            yield links_of(group, "_member", threshold)

    def compare_tile(tile: pa.Table) -> pa.RecordBatch:
        block = tile["_block"].to_numpy()
        return links_of(tile, "_id", threshold, None if tile["_i"][0].as_py() == tile["_j"][0].as_py() else block == block[0])

    pairs = None
    if routed is not None:
        small, stuck = deepen(routed, OVERSIZE * leaf, spill)
        for leaves in small:
            spread = leaves.repartition("_leaf").sortWithinPartitions("_leaf")
            found = spread.mapInArrow(compare, "a binary, b binary")
            pairs = found if pairs is None else pairs.unionByName(found)
        if stuck is not None:
            spread = tiles.spread(stuck.withColumnsRenamed({"_leaf": "_group", "_member": "_id"}))
            pairs = pairs.unionByName(tiles.run_tiles(spread, ["_id", "_raw"], compare_tile, "a binary, b binary"))
    if pairs is None:
        pairs = members.select(F.col("_member").alias("a"), F.col("_member").alias("b"))
    groups = connected_components(pairs).withColumnsRenamed({"id": "_member", "component": "_group"})

    def count(tile: pa.Table) -> pa.RecordBatch:
        block, weight = (tile[c].to_numpy() for c in ("_block", "_copies"))
        x = matrix(tile["_raw"])
        links = np.zeros(len(block), np.int64)
        if tile["_i"][0].as_py() == tile["_j"][0].as_py():
            close = similar(x, x, threshold)
            np.fill_diagonal(close, False)
            links = close @ weight
        else:
            first = block == block[0]
            close = similar(x[first], x[~first], threshold)
            links[first], links[~first] = close @ weight[~first], close.T @ weight[first]
        return pa.RecordBatch.from_arrays([tile["_id"].combine_chunks(), pa.array(links.astype(np.int64))], ["_member", "_links"])

    spread = tiles.spread(groups.join(members, "_member").withColumnRenamed("_member", "_id"))
    counted = tiles.run_tiles(spread, ["_id", "_copies", "_raw"], count, "_member binary, _links long")
    per_member = counted.groupBy("_member").agg(F.sum("_links").alias("_links"))
    smallest = groups.join(members.select("_member", "_head"), "_member").groupBy("_group").agg(F.min("_head").alias("_least"))
    info = (members.select("_member", "_head", "_copies").join(per_member, "_member", "left")
            .join(groups, "_member", "left").join(smallest, "_group", "left")
            .select("_member", (F.col("_copies") - 1 + F.coalesce("_links", F.lit(0))).alias("n_links"), F.coalesce("_least", "_head").alias("component_id")))
    return rows.select("_id", "_member").join(info, "_member", "left").select(
        F.col("_id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "_id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("_id"), F.lit(True)).alias("kept"))
