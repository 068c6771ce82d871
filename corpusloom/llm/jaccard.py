"""N-gram Jaccard self join with Bayesian pruning of candidates.

MinHash bands propose pairs. MinHash values of a pair are compared a few at a time, and it is dropped as soon as the
posterior probability that it reaches the threshold falls below a tolerance. What is left is verified exactly on the
shingle sets. Members of a band meet its hub first; only bands that then still hold unconnected members are compared
pair by pair, so that texts which merely share bands are never united. The links of the verified groups are counted
inside tiles: the output has one row per document, and no list of all pairs exists anywhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import ready, small_batches, store, tidy
from corpusloom.operators import tiles
from corpusloom.operators.components import connected_components
from corpusloom.operators.joins import maybe_joins

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 6  # a pair at 0.8 shares no band with probability 5e-6, one at 0.3 shares one with 0.03
STEP, STEPS = 32, 5  # values compared at a time, and how often
TOLERANCE = 1e-6  # posterior probability below which a pair is dropped
BROADCAST_IDS = 100_000  # ids with digests, about 20 MB as a hash table
CHUNK = 16_384  # shingles hashed at a time
PAIR_ROWS = 64  # pairs in a batch, each with two whole sets


class WordHash(dict):
    def __missing__(self, word: str) -> int:
        h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) > 200_000:
            self.clear()
        self[word] = h
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_PLACES = mixed(np.arange(1, SHINGLE_WORDS + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(words: list[str], hashes: WordHash) -> np.ndarray:
    """Hashes of all runs of five words; a shorter text is one shingle of all its words, none without a word."""
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if 0 < len(h) < SHINGLE_WORDS:
        h = np.concatenate([h, np.full(SHINGLE_WORDS - len(h), len(h), np.uint64)])
    if not len(h):
        return h
    n = len(h) - SHINGLE_WORDS + 1
    out = np.zeros(n, np.uint64)
    for k in range(SHINGLE_WORDS):
        out += h[k:k + n] * _PLACES[k]
    return mixed(out)


def hash_family(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    g = np.random.default_rng(seed)
    return g.integers(0, 1 << 32, n, dtype=np.uint32), g.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1)


def minhashes(sets: list[np.ndarray], n: int, seed: int) -> np.ndarray:
    """MinHash values, one row of ``n`` per non-empty set."""
    flips, factors = hash_family(n, seed)
    out = np.full((len(sets), n), 0xFFFFFFFF, np.uint32)
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= CHUNK):
            size += len(sets[end])
            end += 1
        whole = (np.concatenate(sets[at:end]) >> np.uint64(32)).astype(np.uint32)
        sizes = np.fromiter(map(len, sets[at:end]), np.int64, end - at)
        for a in range(0, len(whole), 16 * CHUNK) if end - at == 1 else [0]:
            x = whole[a:a + 16 * CHUNK] if end - at == 1 else whole
            starts = np.zeros(1, np.int64) if end - at == 1 else np.cumsum(sizes) - sizes
            for k in range(n):
                found = np.minimum.reduceat((x ^ flips[k]) * factors[k], starts)
                out[at:end, k] = np.minimum(out[at:end, k], found)
        at = end
    return out


def bands(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, different between bands."""
    rows = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(mixed(np.arange(1, BANDS + 1, dtype=np.uint64)), rows.shape[:2]).copy()
    for k in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, k])
    return key.view(np.int64)


def fewest_matches(n: int, threshold: float, tolerance: float) -> int:
    """Fewest of ``n`` equal values with which a pair stays.

    With a uniform prior, P(J >= t | m of n equal) = P(Binomial(n + 1, t) <= m).
    """
    total, m = 0.0, -1
    while total < tolerance:
        m += 1
        total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
    return m


def survivors(left: np.ndarray, right: np.ndarray, threshold: float, tolerance: float, allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs (the ``allowed`` ones) whose MinHash values never fall below the bound, compared step by step."""
    equal = np.zeros((len(left), len(right)), np.int16)
    for k in range(STEP):
        equal += left[:, k][:, None] == right[:, k][None, :]
    enough = equal >= fewest_matches(STEP, threshold, tolerance)
    i, j = np.nonzero(enough if allowed is None else enough & allowed)
    return later_steps(left, right, i, j, equal[i, j].astype(np.int64), 1, threshold, tolerance)


def later_steps(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, m: np.ndarray, first: int, threshold: float,
                tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs ``(i, j)`` with ``m`` equal values so far, those that stay above the bound from step ``first`` on."""
    for s in range(first, STEPS):
        part = slice(s * STEP, (s + 1) * STEP)
        keep = np.zeros(len(i), bool)
        for a in range(0, len(i), 100_000):
            rows = slice(a, a + 100_000)
            m[rows] += (left[i[rows], part] == right[j[rows], part]).sum(axis=1)
            keep[rows] = m[rows] >= fewest_matches((s + 1) * STEP, threshold, tolerance)
        i, j, m = i[keep], j[keep], m[keep]
    return i, j


def values_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """MinHash values, a row each."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, STEP * STEPS)


def linked_pairs(batch: pa.RecordBatch, threshold: float, tolerance: float) -> np.ndarray:
    """Rows of pairs (``_va, _vb, _sa, _sb``) that are links."""
    left, right = values_of(batch["_va"]), values_of(batch["_vb"])
    at = np.arange(batch.num_rows)
    at, _ = later_steps(left, right, at, at, np.zeros(len(at), np.int64), 0, threshold, tolerance)
    good = []
    for k in at.tolist():
        a, b = (np.frombuffer(batch[c][k].as_buffer(), "<u8") for c in ("_sa", "_sb"))
        common = len(np.intersect1d(a, b, assume_unique=True))
        good.append(common / (len(a) + len(b) - common) >= threshold)
    return at[np.array(good, bool)]


def link_tile(tile: pa.Table, threshold: float, tolerance: float) -> pa.RecordBatch:
    """``_id, links, root`` for the members of one tile; pairs with the same ``_label`` are passed over where there is one."""
    names = tile["_id"].to_pylist()
    first = sorted({n: k for k, n in enumerate(names)}.values())  # repeated rows
    tile = tile.take(pa.array(first))
    across = tile["_i"][0].as_py() != tile["_j"][0].as_py()
    block = tile["_block"].to_numpy()
    if across:
        tile = tile.take(pa.array(np.argsort(block, kind="stable")))
        block = tile["_block"].to_numpy()
    ids, weight, values = tile["_id"].to_pylist(), tile["_copies"].to_numpy(), values_of(tile["_values"])
    sizes = np.fromiter((len(b) // 8 for b in tile["_set"].to_pylist()), np.int64, len(ids))
    cut = int((block == block[0]).sum()) if across else 0
    allowed = np.ones((cut, len(ids) - cut), bool) if across else np.triu(np.ones((len(ids), len(ids)), bool), 1)
    if "_label" in tile.column_names:
        label = np.unique(tile["_label"].to_pylist(), return_inverse=True)[1]
        allowed &= label[:cut or None][:, None] != label[cut:][None, :]
    i, j = survivors(values[:cut or None], values[cut:], threshold, tolerance, allowed)
    j = j + cut
    sets = [np.frombuffer(b, "<u8") for b in tile["_set"].to_pylist()]
    common = tiles.intersections(sets, i, j)
    good = common / np.maximum(sizes[i] + sizes[j] - common, 1) >= threshold
    i, j = i[good], j[good]
    links = np.zeros(len(ids), np.int64)
    np.add.at(links, i, weight[j])
    np.add.at(links, j, weight[i])
    linked = np.zeros((len(ids), len(ids)), bool)
    linked[i, j] = linked[j, i] = True
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array([ids[r] for r in tiles.roots(linked)], pa.binary())], ["_id", "links", "root"])


def digest_of(words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass"))


def shingle_sets(rows: DataFrame) -> DataFrame:
    """Members with ``_set``, the sorted distinct shingle hashes of ``_text``, and ``_values``, their MinHash values.

    An id may stand on rows with other texts: only the text that has the member's digest counts.
    """
    columns = ["_member", "_copies", "_size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in batches:
            keep, sets = [], []
            for k, (text, digest) in enumerate(zip(batch.column(3).to_pylist(), batch.column(0).to_pylist())):
                words = (text or "").lower().split()
                if words and digest_of(words) == digest:
                    keep.append(k)
                    sets.append(np.unique(shingles(words, hashes)))
            chosen = batch.take(pa.array(keep, pa.int64()))
            values = minhashes(sets, STEP * STEPS, seed=2).astype("<u4") if sets else []
            yield pa.RecordBatch.from_arrays([*(chosen.column(k) for k in range(3)), pa.array([x.tobytes() for x in sets], pa.binary()),
                                              pa.array([v.tobytes() for v in values], pa.binary())], [*columns, "_set", "_values"])

    return rows.select(*columns, "_text").mapInArrow(tidy(run), "_member binary, _copies long, _size long, _set binary, _values binary")


def in_tiles(members: DataFrame, sets: DataFrame, columns: list[str], threshold: float, tolerance: float) -> DataFrame:
    """``link_tile`` on every tile of ``members``: narrow rows are spread first, then each takes its set to its tile."""
    placed = store(tiles.spread(members, "_size"), "placed")
    own = maybe_joins(sets.select(F.col("_member").alias("_id"), "_set", "_values"), placed, "_id")
    return tiles.run_tiles(placed.join(own, "_id"), ["_id", *columns, "_set", "_values"], lambda t: link_tile(t, threshold, tolerance),
                           "_id binary, links long, root binary")


def same_members() -> list[Column]:
    """``_n, _x, _y``: equal for groups of the same members, by 128 bits of hash."""
    return [F.count("*").alias("_n"), *(F.bit_xor(F.xxhash64("_member", F.lit(k))).alias(x) for k, x in enumerate(("_x", "_y")))]


def verified_links(banded: DataFrame, near: DataFrame, sets: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """``_a, _b``: links that connect all similar members of the bands (``_member, _key``), not all links there are.

    ``near`` pairs members with the hubs of their bands: a crowd of copies costs a comparison each. Bands whose members are
    connected by then are done; in the others the pairs that are not are compared in tiles.
    """
    side = lambda name, x: sets.select(F.col("_member").alias(name), F.col("_values").alias(f"_v{x}"), F.col("_set").alias(f"_s{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = linked_pairs(batch, threshold, tolerance)
            yield batch.select(["_a", "_b"]).take(pa.array(at))

    pairs = near.select(F.col("_hub").alias("_a"), F.col("_member").alias("_b")).join(side("_a", "a"), "_a").join(side("_b", "b"), "_b")
    with small_batches(sets.sparkSession, PAIR_ROWS):
        first = store(pairs.select("_a", "_b", "_va", "_vb", "_sa", "_sb").mapInArrow(tidy(run), "_a binary, _b binary"), "hub-links")
    known = store(connected_components(first, "_a", "_b").withColumnsRenamed({"id": "_member", "component": "_label"}), "connected")
    labelled = store(banded.join(known, "_member", "left").withColumn("_label", F.coalesce("_label", "_member")), "labelled")
    mixed = labelled.groupBy("_key").agg(F.min("_label").alias("_least"), F.max("_label").alias("_most"), *same_members()).where("_least <> _most")
    once = mixed.groupBy("_n", "_x", "_y").agg(F.min("_key").alias("_key")).select("_key")  # bands with the same members meet once
    open_ = labelled.join(once, "_key").join(sets.select("_member", "_copies", "_size"), "_member").withColumnsRenamed({"_key": "_group", "_member": "_id"})
    rest = in_tiles(open_, sets, ["_copies", "_label"], threshold, tolerance).where("_id <> root").select(F.col("root").alias("_a"), F.col("_id").alias("_b"))
    return first.unionByName(store(rest, "band-links"))


def similarity_groups(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_links, class_id, kept, text_key, class_key`` for every row: documents whose sets of five-word shingles have a
    Jaccard similarity of ``threshold`` or more are linked; ``n_links`` counts the other rows linked
    directly, ``class_id`` is the smallest id reachable by links, ``kept`` marks the row with that id.

    Words are runs without white space, in lower case. A text of fewer than five words is one shingle of
    all its words. Null, empty and blank texts link with nothing, and so do rows with a null id (their
    class is null, they are kept). Equal texts are one member with a weight; repeated rows count like
    copies. Ids must be integers; other columns are left out, whatever their names. Texts are read whole.
    """
    ready(docs)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            digests, sets, filled = [None] * len(ids), [], []
            for k, (key, text) in enumerate(zip(ids, texts)):
                words = text.lower().split() if text and key is not None else []
                if words:
                    digests[k] = digest_of(words)
                    sets.append(shingles(words, hashes))
                    filled.append(k)
            keys = bands(minhashes(sets, BANDS * ROWS, seed=1)) if sets else np.zeros((0, BANDS), np.int64)
            counts = np.zeros(len(ids), np.int32)
            counts[filled] = BANDS
            sizes = np.zeros(len(ids), np.int64)
            sizes[filled] = [len(s) for s in sets]
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(digests, pa.binary()), pa.array(sizes), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))],
                ["_id", "text_key", "_digest", "_size", "_bands"])

    signed = store(rows.withColumn("text_key", text_key("_text")).mapInArrow(
        tidy(run), "_id long, text_key binary, _digest binary, _size long, _bands array<long>"), "signatures")
    # one member per distinct text, named by its digest: smallest id with its text's key, weight and (alike in all copies) the bands
    heads = store(signed.where("_digest is not null").groupBy(F.col("_digest").alias("_member")).agg(
        F.min(F.struct("_id", "text_key")).alias("_first"), F.count("*").alias("_copies"), F.first("_size").alias("_size"), F.first("_bands").alias("_bands"),
    ).select("_member", F.col("_first._id").alias("_head"), F.col("_first.text_key").alias("_head_key"), "_copies", "_size", "_bands"), "heads")
    band = Window.partitionBy("_key")
    keyed = heads.select("_member", F.explode("_bands").alias("_key")).withColumns({"_hub": F.min("_member").over(band), "_last": F.max("_member").over(band)})
    banded = store(keyed.where("_hub <> _last").drop("_last"), "bands")  # bands of one member alone are left out
    near = store(banded.where("_member <> _hub").select("_member", "_hub").distinct(), "near")

    met = near.select("_member").unionByName(near.select(F.col("_hub").alias("_member"))).distinct()
    candidates = store(heads.drop("_bands").join(met, "_member"), "candidates")
    texts = maybe_joins(rows, candidates.select(F.col("_head").alias("_id")), "_id").withColumn("_key", text_key("_text"))
    found = candidates.join(texts, (F.col("_id") == F.col("_head")) & (F.col("_key") == F.col("_head_key")))
    sets = store(shingle_sets(found.dropDuplicates(["_head", "_head_key"])), "sets")  # repeated rows: joined and reduced by the same keys
    links = verified_links(banded.select("_member", "_key"), near, sets, threshold, tolerance)
    classes = store(connected_components(links, "_a", "_b").withColumnsRenamed({"id": "_member", "component": "_class"}), "classes")

    members = classes.withColumnRenamed("_class", "_group").join(sets.select("_member", "_copies", "_size"), "_member").withColumnRenamed("_member", "_id")
    counted = in_tiles(members, sets, ["_copies"], threshold, tolerance)
    per_member = counted.groupBy(F.col("_id").alias("_member")).agg(F.sum("links").alias("_links"))
    smallest = classes.join(heads.select("_member", "_head"), "_member").groupBy("_class").agg(F.min("_head").alias("class_id"))
    info = (heads.drop("_bands", "_size", "_head_key").join(per_member, "_member", "left").join(classes, "_member", "left").join(smallest, "_class", "left")
            .select(F.col("_member").alias("_digest"), (F.col("_copies") - 1 + F.coalesce("_links", F.lit(0))).alias("n_links"), F.coalesce("class_id", "_head").alias("class_id"),
                    F.coalesce("_class", "_member").alias("class_key")))
    return signed.select("_id", "_digest", "text_key").join(info, "_digest", "left").select(
        F.col("_id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("class_id", "_id").alias("class_id"),
        F.coalesce(F.col("class_id") == F.col("_id"), F.lit(True)).alias("kept"), "text_key", F.coalesce("class_key", "text_key").alias("class_key"))


def text_key(text: str) -> Column:
    """Tells the texts of one id apart."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def keep_one(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` without those that ``groups`` (:func:`similarity_groups`) does not keep.

    A row is known by its id and text: an id that is dropped with one text stays with another. Of rows that repeat an
    id in one class one stays; rows with a null id stay. Up to ``BROADCAST_IDS`` dropped rows are broadcast after they have
    been counted, so that no text moves; more are joined by shuffle.
    """
    keyed = docs.withColumn("_key", text_key(text_col))
    here = (F.col(id_col) == F.col("_id")) & (F.col("_key") == F.col("_other"))

    def side(rows: DataFrame, *more: str) -> DataFrame:
        return rows.select(*[F.col(c).alias(a) for c, a in ((id_col, "_id"), ("text_key", "_other"))], *more).distinct()

    dropped = side(groups.where(~F.col("kept")))
    out = keyed.join(F.broadcast(dropped) if dropped.count() <= BROADCAST_IDS else dropped, here, "left_anti")
    kept = groups.where(F.col("kept") & F.col(id_col).isNotNull())
    twice = kept.groupBy(id_col, "class_key").count().where("count > 1").drop("count")
    if twice.isEmpty():
        return out.select(docs.columns)
    repeated = side(kept.join(twice, [id_col, "class_key"]), F.col("class_key").alias("_class"))
    one = out.join(repeated, here).dropDuplicates(["_id", "_class"]).select(docs.columns)
    return out.join(repeated, here, "left_anti").select(docs.columns).unionByName(one)
