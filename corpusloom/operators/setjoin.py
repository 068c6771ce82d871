"""Exact set-similarity self join: prefix filter over a rare-first order, positional bound, split posting lists.

Two sets with a Jaccard similarity of ``t`` or more share an element among the first ``n - ceil(t * n) + 1`` of either,
whatever the order of the elements. With the rarest first (by levels of frequency), elements of one set alone come first and need no posting:
a text with enough of its own has none at all. What two sets can still share from a common element on bounds
their similarity before they are compared.

A posting list is first linked to one hub, so that a group of copies costs a comparison per member and not per pair.
Only lists that still hold unconnected members are compared pair by pair, in tiles of bounded size, and only those pairs
that are not connected yet, that the bounds admit, and that have no earlier element in common.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import tiles
from corpusloom.operators.components import connected_components
from corpusloom.packaging import ship
from corpusloom.session import scratch_path

WORDS, THRESHOLD = 5, 0.8
BROADCAST_IDS = 1_000_000  # ids that are broadcast, about 32 MB as a hash table; more are joined by a shuffle
BLOCK_BITS = 22  # a block of sets has at most 2^22 elements, unless it is one set
PIECE = 1 << 20  # elements of a block that are dealt out at a time
BUCKET, MOST_BUCKETS = 1 << 22, 4096  # elements that a bucket is meant for, and the most buckets
_ROUNDING = 1e-9  # bounds are loosened by it: only the comparison itself decides


def word_shingles(text: Column | str, words: int = WORDS) -> Column:
    """Distinct 64-bit hashes of the runs of ``words`` lower-case words; a shorter text is one run."""
    c = F.col(text) if isinstance(text, str) else text
    split = F.filter(F.split(F.lower(c), r"\s+"), lambda w: w != "")

    def runs(w: Column) -> Column:
        last = F.greatest(F.size(w) - F.lit(words), F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.array_join(F.slice(w, i + 1, words), " ")))

    # the outer lambda binds the words once; spelled out, the text would be split again for every run
    hashed = F.transform(F.array(split), lambda w: F.when(F.size(w) > 0, F.array_distinct(runs(w))))
    return F.when(c.isNotNull(), hashed[0])


def stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass
class SimilarSets:
    """``groups``: ``_id, _group`` of every set with a link, the smallest id reachable; the tables of what was compared."""

    groups: DataFrame
    hub_pairs: DataFrame
    tile_members: DataFrame

    def compared(self) -> int:
        """How many pairs of sets were compared element by element."""
        return self.hub_pairs.count() + (self.tile_members.agg(F.sum("_compared")).first()[0] or 0)


def element_cells(sets: DataFrame, buckets: int) -> DataFrame:
    """``_bucket, _block, _owners, _keys``: the elements of each block of sets, dealt to buckets by their upper half.

    An element takes six bytes: its lower half, and the place of its set in the block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}  # by size class: the open block, its owners and sets, and how many elements they hold

        def cells(block: int, owners: list, found: list, _: int) -> pa.RecordBatch:
            flat = np.concatenate(found).view(np.uint64)
            owner = np.repeat(np.array(owners, "<u2"), [len(e) for e in found])
            bucket = (flat >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            order = np.argsort(bucket, kind="stable")
            owner, key = owner[order], flat[order].astype("<u4")
            names, starts = np.unique(bucket[order], return_index=True)
            ends = [*starts[1:].tolist(), len(flat)]
            part = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(starts.tolist(), ends)], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), pa.array(np.full(len(names), block)), part(owner), part(key)],
                                              ["_bucket", "_block", "_owners", "_keys"])

        for batch in batches:
            blocks, ids = batch["_block"].to_pylist(), batch["_id"].to_pylist()
            for k, (block, key) in enumerate(zip(blocks, ids)):
                kind = block & 63
                if kind in held and (held[kind][0] != block or held[kind][3] >= PIECE):
                    yield cells(*held.pop(kind))
                mine = held.setdefault(kind, [block, [], [], 0])
                mine[1].append(key - block_start(block))
                mine[2].append(np.array(batch["_set"][k].values))  # a copy: the batch can go
                mine[3] += len(mine[2][-1])
        for found in held.values():
            yield cells(*found)

    return sets.select("_block", "_id", "_set").mapInArrow(run, "_bucket int, _block long, _owners binary, _keys binary")


def block_start(block: int) -> int:
    """Smallest id that may stand in a block."""
    return (block >> 6) << max(0, min(16, BLOCK_BITS - (block & 63)))


def with_block(sets: DataFrame) -> DataFrame:
    """``_block``: sets of one size class with ids close together, see ``BLOCK_BITS``."""
    bits = F.length(F.bin("_n"))
    span = F.greatest(F.lit(0), F.least(F.lit(16), F.lit(BLOCK_BITS) - bits))
    return sets.withColumn("_block", F.call_function("shiftright", F.col("_id"), span) * 64 + bits)


def shared_elements(bucket: pa.Table) -> pa.Table:
    """The cells of a bucket with only those elements that occur more than once in it, and a level by how often they do."""
    keys = [np.frombuffer(k, "<u4") for k in bucket["_keys"].to_pylist()]
    _, place, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    level = np.where(count <= 32, count, 32 + 8 * np.log2(count / 32)).astype(np.uint8)
    out, at = [], 0
    for block, name, owners, key in zip(bucket["_block"].to_pylist(), bucket["_bucket"].to_pylist(), bucket["_owners"].to_pylist(), keys):
        here = place[at:at + len(key)]
        at += len(key)
        shared = count[here] > 1
        if shared.any():
            out.append((block, name, np.frombuffer(owners, "<u2")[shared].tobytes(), key[shared].tobytes(), level[here[shared]].tobytes()))
    return pa.Table.from_pylist([dict(zip(_SHARED.names, row)) for row in out], _SHARED)


_SHARED = pa.schema([("_block", pa.int64()), ("_bucket", pa.int32()), ("_owners", pa.binary()), ("_keys", pa.binary()), ("_levels", pa.binary())])
_PREFIX = pa.schema([("_id", pa.int64()), ("_n", pa.int32()), ("_own", pa.int32()), ("_prefix", pa.list_(pa.int64()))])


def block_prefixes(shared: pa.Table, sizes: pa.Table, threshold: float) -> pa.Table:
    """``_id, _n, _own, _prefix`` of the sets of a block that list shared elements in their prefix."""
    if not shared.num_rows or not sizes.num_rows:
        return _PREFIX.empty_table()
    join = lambda name, kind: np.frombuffer(b"".join(shared[name].to_pylist()), kind)
    owner, key, level = join("_owners", "<u2").astype(np.int64), join("_keys", "<u4").astype(np.int64), join("_levels", np.uint8)
    lengths = [len(k) // 4 for k in shared["_keys"].to_pylist()]
    token = np.repeat(shared["_bucket"].to_numpy().astype(np.int64) << 32, lengths) | key
    ids = np.sort(sizes["_id"].to_numpy())
    n = sizes["_n"].to_numpy()[np.argsort(sizes["_id"].to_numpy())].astype(np.int64)
    row = np.searchsorted(ids, owner + block_start(shared["_block"][0].as_py()))
    order = np.lexsort((token, level, row))
    row, token = row[order], token[order]
    count = np.bincount(row, minlength=len(ids))
    own = n - count
    listed = np.clip(n - np.ceil(n * threshold - _ROUNDING).astype(np.int64) + 1 - own, 0, count)
    rank = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    token = token[rank < listed[row]]
    some = listed > 0
    offsets = np.concatenate([[0], np.cumsum(listed[some])]).astype(np.int32)
    return pa.Table.from_arrays([pa.array(ids[some]), pa.array(n[some].astype(np.int32)), pa.array(own[some].astype(np.int32)),
                                 pa.ListArray.from_arrays(offsets, pa.array(token))], schema=_PREFIX)


def prefixes(sets: DataFrame, threshold: float) -> DataFrame:
    """``_id, _n, _own, _prefix``: the shared elements in the prefix of every set that has some; ``sets`` has ``_id, _n, _set``.

    An element is known here by its bucket and its lower half. Those of one set alone are counted in ``_own``, not listed. Blocks of
    sets send their elements to buckets, where they are counted, and get back the shared ones: no set is shuffled. Different
    elements that look alike only count as more frequent: the order stays one for all sets, and what is alike meets.
    """
    ship(sets.sparkSession)
    total = sets.agg(F.sum(F.col("_n").cast("long"))).first()[0] or 0
    blocked = with_block(sets)
    shared = element_cells(blocked, min(MOST_BUCKETS, max(16, -(-total // BUCKET)))).groupBy("_bucket").applyInArrow(
        shared_elements, "_block long, _bucket int, _owners binary, _keys binary, _levels binary")
    sizes = blocked.select("_block", "_id", "_n")

    def listed(a: pa.Table, b: pa.Table) -> pa.Table:
        return block_prefixes(a, b, threshold)

    return shared.groupBy("_block").cogroup(sizes.groupBy("_block")).applyInArrow(listed, "_id long, _n int, _own int, _prefix array<long>")


def postings(prefixed: DataFrame) -> DataFrame:
    """``_token, _id, _n, _pos`` of the elements in :func:`prefixes`."""
    return prefixed.select("_id", "_n", "_own", F.posexplode("_prefix").alias("_k", "_token")).select("_token", "_id", "_n", (F.col("_own") + F.col("_k")).alias("_pos"))


def most_shared(n: Column, pos: Column, other_n: Column, other_pos: Column) -> Column:
    """Most that two sets can share if their first common element is the one at these positions."""
    return F.least(n - pos, other_n - other_pos)


def least_shared(n: Column, other_n: Column, threshold: float) -> Column:
    return (n + other_n) * F.lit(threshold / (1 + threshold)) - F.lit(_ROUNDING)


def compared_pairs(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those of ``pairs`` (``_a, _b``) whose sets are similar enough."""
    a = sets.select(F.col("_id").alias("_a"), F.col("_set").alias("_sa"))
    b = sets.select(F.col("_id").alias("_b"), F.col("_set").alias("_sb"))
    common = F.size(F.array_intersect("_sa", "_sb"))
    alike = common / (F.size("_sa") + F.size("_sb") - common) >= F.lit(threshold)
    return pairs.join(a, "_a").join(b, "_b").where(alike).select("_a", "_b")


def open_pairs(tile: pa.Table, threshold: float) -> np.ndarray:
    """Which members of a tile (by row) are unconnected and may be similar by size and position; the upper half of the matrix."""
    label = np.unique(tile["_label"].to_numpy(), return_inverse=True)[1]
    n, pos = (tile[c].to_numpy().astype(np.int64) for c in ("_n", "_pos"))
    ok = np.triu(label[:, None] != label[None, :], 1)
    if tile["_i"][0].as_py() != tile["_j"][0].as_py():
        block = tile["_block"].to_numpy()
        ok &= block[:, None] != block[None, :]
    left = n - pos
    ok &= np.minimum(left[:, None], left[None, :]) >= (n[:, None] + n[None, :]) * (threshold / (1 + threshold)) - _ROUNDING
    return ok


def open_members(tile: pa.Table, threshold: float) -> pa.RecordBatch:
    """The members of a tile that have a pair left to compare."""
    ok = open_pairs(tile, threshold)
    found = tile.filter(pa.array(ok.any(axis=0) | ok.any(axis=1)))
    return pa.RecordBatch.from_arrays([c.combine_chunks() for c in found.columns], found.column_names)


def compare_tile(tile: pa.Table, threshold: float) -> pa.RecordBatch:
    """``_id, _root, _compared`` of a tile's members: unconnected pairs that pass the bounds are compared, unless they have an
    element before these positions in common."""
    ids = tile["_id"].to_numpy()
    i, j = np.nonzero(open_pairs(tile, threshold))
    before = [set(p[:max(k, 0)]) for p, k in zip(tile["_prefix"].to_pylist(), (tile["_pos"].to_numpy() - tile["_own"].to_numpy()).tolist())]
    first = np.fromiter((before[a].isdisjoint(before[b]) for a, b in zip(i.tolist(), j.tolist())), bool, len(i))
    i, j = i[first], j[first]
    compared = np.bincount(i, minlength=len(ids))
    linked = np.zeros((len(ids), len(ids)), bool)
    if len(i):
        sets = [s.values.to_numpy() for s in tile["_set"]]
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        common = tiles.intersections(sets, i, j)
        good = common / (sizes[i] + sizes[j] - common) >= threshold
        linked[i[good], j[good]] = linked[j[good], i[good]] = True
    root = tiles.roots(linked)
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[root]), pa.array(compared, pa.int64())], ["_id", "_root", "_compared"])


def _few(ids: DataFrame) -> DataFrame:
    """``ids`` (stored), broadcast unless there are many."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def similar_sets(sets: DataFrame, threshold: float = THRESHOLD, lists: DataFrame | None = None) -> SimilarSets:
    """Groups of sets that are connected by a Jaccard similarity of ``threshold`` or more, exactly.

    ``sets``: ``_id`` (unique, long), ``_n`` (size, at least 1), ``_set`` (sorted distinct longs); ids close together are best, as
    those of :func:`text_sets` are. ``lists``: other postings than :func:`postings`, if two similar sets are known to meet
    in one of them; with ``_pos`` 0 they only block. Sets are shuffled only once they stand in a list with others.
    """
    prefixed = None
    if lists is None:
        prefixed = stored(prefixes(sets, threshold), "prefixes")
        lists = postings(prefixed)
    # the smallest id of a list is its hub; a pair of sets is compared once, in however many lists it stands
    hubs = lists.groupBy("_token").agg(F.min(F.struct("_id", "_n", "_pos")).alias("_hub"), F.max("_id").alias("_last")).where("_hub._id <> _last")
    listed = stored(lists.join(hubs.select("_token", "_hub"), "_token"), "lists")
    near = listed.where(F.col("_id") != F.col("_hub._id")).where(F.least("_n", "_hub._n") >= F.greatest("_n", "_hub._n") * F.lit(threshold) - F.lit(_ROUNDING))
    hub_pairs = stored(near.select(F.col("_hub._id").alias("_a"), F.col("_id").alias("_b")).distinct(), "hub-pairs")
    met = _few(stored(listed.select("_id").distinct(), "met"))
    near_sets = stored(sets.select("_id", "_set").join(met, "_id", "left_semi"), "near-sets")
    links = stored(compared_pairs(hub_pairs, near_sets, threshold), "links")
    known = stored(connected_components(links, "_a", "_b").withColumnsRenamed({"id": "_id", "component": "_label"}), "connected")

    labelled = stored(listed.drop("_hub").join(known, "_id", "left").withColumn("_label", F.coalesce("_label", "_id")), "labelled")
    mixed = labelled.groupBy("_token").agg(F.min("_label").alias("_least"), F.max("_label").alias("_most"), F.min("_n").alias("_small")).where("_least <> _most")
    # the largest partner that the bounds leave to a member must not be smaller than the smallest of the list
    largest = (F.col("_n") - F.col("_pos")) * F.lit((1 + threshold) / threshold) - F.col("_n") + F.lit(1e-6)
    left = labelled.join(mixed, "_token").where((largest >= F.col("_small")) | (F.col("_pos") == 0)).select(F.col("_token").alias("_group"), "_id", "_n", "_pos", "_label")
    # tiles of narrow rows first: only members with a pair left to compare take their sets along
    narrow = ["_id", "_n", "_pos", "_label"]
    still = stored(tiles.run_tiles(tiles.spread(left, "_n"), narrow, lambda t: open_members(t, threshold),
                                    "_group long, _i int, _j int, _block int, _id long, _n int, _pos int, _label long"), "open")
    if prefixed is None:
        members = still.withColumns({"_own": F.lit(0), "_prefix": F.array().cast("array<long>")})
    else:
        members = still.join(prefixed.select("_id", "_own", "_prefix"), "_id")
    tile_members = stored(tiles.run_tiles(members.join(near_sets, "_id"), [*narrow, "_own", "_prefix", "_set"], lambda t: compare_tile(t, threshold),
                                           "_id long, _root long, _compared long"), "tiles")
    every = links.unionByName(tile_members.where("_id <> _root").select(F.col("_root").alias("_a"), F.col("_id").alias("_b")))
    groups = connected_components(every, "_a", "_b").withColumnsRenamed({"id": "_id", "component": "_group"})
    return SimilarSets(groups, hub_pairs, tile_members)


def text_sets(df: DataFrame, text_col: str, id_col: str, words: int) -> tuple[DataFrame, DataFrame]:
    """``_key, _id`` of every row, and ``_id, _n, _set`` of every distinct set of shingles; the id is the number of the first row
    that has it. Rows are stored with their sets once; equal ones are found by digest, without moving a set, while there
    are at most ``BROADCAST_IDS`` rows to leave out."""
    shingled = df.select(F.col(id_col).alias("_key"), F.array_sort(word_shingles(text_col, words)).alias("_set"))
    digest = F.when(F.col("_set").isNotNull(), F.unhex(F.md5(F.array_join(F.col("_set").cast("array<string>"), ","))))
    kept = stored(shingled.select("_key", F.monotonically_increasing_id().alias("_row"), digest.alias("_digest"), F.size("_set").alias("_n"), "_set"), "shingles")
    named = kept.where("_digest is not null")
    heads = stored(named.groupBy("_digest").agg(F.min("_row").alias("_id"), F.count(F.lit(1)).alias("_copies")), "heads")
    copied = heads.where("_copies > 1")
    copies = stored(named.select("_digest", "_row").join(copied, "_digest").where("_row <> _id").select(F.col("_row").alias("_id")), "copies")
    left_out = _few(copies)
    sets = named.select(F.col("_row").alias("_id"), "_n", "_set").join(left_out, "_id", "left_anti")
    rows = kept.select("_key", "_digest").join(heads.select("_digest", "_id"), "_digest", "left").select("_key", "_id")
    return rows, sets if left_out is not copies else stored(sets, "sets")


def named_groups(rows: DataFrame, groups: DataFrame, id_col: str) -> DataFrame:
    """``id, group_id`` of every row from the groups of its set; rows without a set are groups of their own."""
    named = rows.join(groups, "_id", "left").withColumn("_group", F.coalesce("_group", "_id"))
    least = named.where("_group is not null").groupBy("_group").agg(F.min("_key").alias("group_id"))
    return named.join(least, "_group", "left").select(F.col("_key").alias(id_col), F.coalesce("group_id", "_key").alias("group_id"))


def similar_text_groups(df: DataFrame, text_col: str = "text", id_col: str = "id", words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """``(id, group_id)`` of every row: texts whose sets of word shingles have a Jaccard similarity of ``threshold`` or more
    are in one group, directly or through others; ``group_id`` is its smallest id. No link is missed.

    Null and blank texts, and their repeats, are groups of their own. Equal sets are one member. Repeated rows are in one
    group; an id on several texts stands in the group of each. Texts are read whole; other columns are left out.
    """
    rows, sets = text_sets(df, text_col, id_col, words)
    return named_groups(rows, similar_sets(sets, threshold).groups, id_col)
