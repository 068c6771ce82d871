"""Hierarchical best-fit packing of token pieces into sequences.

Round one packs each input partition by best fit, largest first, without a shuffle. Nearly full bins are
emitted; the others travel as items, merged into fewer and fewer tasks for further best-fit rounds. The
tasks of a round are counted so that none gets more than ``per_task`` items, so the last round is one
task only when few bins are left; a round that merges next to nothing is the last one.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, IntegerType, LongType, StructField, StructType,
)

from corpusloom.llm.common import ready, store, tidy
from corpusloom.llm.pieces import DEFAULT_TOKENIZER, Splitter, load_spec, printable_bytes, tokenizer_path

CACHE_PIECES = 400_000
SLICE = 100_000  # items that one best-fit pass of round one holds at a time


class PieceIds(dict):
    """Little-endian ids of a text: its pieces one by one, each by the tokenizers library when it is first met.

    A piece goes straight to the library's merge model, in the characters by which the vocabulary writes bytes:
    the texts have been split already. The cache starts anew when it is full.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)  # keeps the model alive
        self.merge = self.tokenizer.model.tokenize
        self.splitter = Splitter(load_spec(path))
        self.written = {b: c for c, b in printable_bytes().items()}

    def __missing__(self, piece: str) -> bytes:
        special = self.splitter.specials.get(piece)
        ids = [special] if special is not None else [t.id for t in self.merge(piece.encode().decode("latin-1").translate(self.written))]
        if len(self) >= CACHE_PIECES:
            self.clear()
        found = self[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def of(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.splitter.pieces(text)))


@lru_cache(maxsize=2)
def piece_ids(path: str) -> PieceIds:
    return PieceIds(path)


def tokenize_pieces(
    docs: DataFrame, capacity: int = 1024, tokenizer: str = DEFAULT_TOKENIZER, end_id: int = 2,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Token pieces of at most ``capacity``: ``id_col, piece, start, length, ids_crc32`` (``ids`` on request).

    A document is its ids and ``end_id``; null and empty texts are ``end_id`` alone. Only a longer document
    is cut, from its end, so that its first piece may be shorter. Repeated rows and null ids are packed
    like any others; other columns are left out.
    """
    ready(docs)
    schema = StructType([
        docs.schema[id_col], StructField("piece", IntegerType()), StructField("start", LongType()),
        StructField("length", LongType()), StructField("ids_crc32", LongType()),
        *([StructField("ids", BinaryType())] if with_ids else []),
    ])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = piece_ids(tokenizer_path(tokenizer))
        for batch in batches:
            row, piece, start, length, crc, kept = [], [], [], [], [], []
            for at, text in enumerate(batch.column(1).to_pylist()):
                raw = engine.of(text or "") + end
                n = len(raw) // 4
                first = n if n <= capacity else n % capacity or capacity
                cuts = [0, *range(first, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    row.append(at)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(raw[4 * a:4 * b]))
                    if with_ids:
                        kept.append(raw[4 * a:4 * b])
            arrays = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                      *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            yield pa.RecordBatch.from_arrays([*arrays, *([pa.array(kept, pa.binary())] if with_ids else [])], schema.fieldNames())

    return docs.select(id_col, text_col).mapInArrow(tidy(run), schema)


def best_fit(sizes: Iterable[int], capacity: int) -> list[tuple[int, list[int]]]:
    """Bins ``(used, item numbers)`` by best fit, largest item first; bins with the least room come first.

    An item larger than the capacity is a bin of its own, one of size 0 goes anywhere. Open bins stand in one list per amount of room; a bit mask over the amounts finds the tightest.
    """
    sizes = list(sizes)
    bins: list[tuple[int, list[int]]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[item]
        if size > capacity:
            bins.append((size, [item]))
            continue
        fitting = mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                mask &= ~(1 << room)
            bins[at][1].append(item)
        else:
            room, at = capacity, len(bins)
            bins.append((0, [item]))
        room -= size
        bins[at] = (capacity - room, bins[at][1])
        if room:
            by_room[room].append(at)
            mask |= 1 << room
    return bins


def pack(
    pieces: DataFrame, capacity: int = 1024, slack: int = 8, per_task: int = 50_000, size_col: str = "length",
) -> DataFrame:
    """Every row of ``pieces`` with ``sequence_id`` and ``offset`` in a sequence of at most ``capacity``.

    ``slack``: a bin with no more room than that counts as nearly full. ``per_task``: items of
    a task from the second round on. A row with a null or negative ``size_col`` takes no room; one
    larger than ``capacity`` is a sequence of its own, the only kind that is longer. Input columns stay (``sequence_id`` and ``offset`` are replaced if they clash). Sequence
    numbers are unique, not dense. An empty table gives an empty result.
    """
    spark = ready(pieces)
    pieces = pieces.drop("sequence_id", "offset")
    item = StructType(pieces.schema.fields)
    placed = StructType([*item.fields, StructField("offset", LongType())])
    bins_schema = StructType([
        StructField("bin", LongType()), StructField("used", IntegerType()), StructField("done", BooleanType()),
        StructField("items", ArrayType(placed)),
    ])

    def packer(number: int, last: bool):
        def emit(used: list[int], groups: pa.Array, counter: int) -> tuple[pa.RecordBatch, int]:
            part = TaskContext.get().partitionId()
            flat = groups.flatten()
            first = np.concatenate([[0], np.cumsum(np.diff(groups.offsets.to_numpy()))])
            bins = best_fit(used, capacity)
            order, shift, ends, n = [], [], [0], 0
            for _, members in bins:
                at = 0
                for m in members:
                    span = range(first[m], first[m + 1])
                    order.extend(span)
                    shift.extend([at] * len(span))
                    at += used[m]
                    n += len(span)
                ends.append(n)
            flat = flat.take(pa.array(order, pa.int64()))
            columns = [flat.field(i) for i in range(flat.type.num_fields)]
            columns[-1] = pa.array(columns[-1].to_numpy(zero_copy_only=False) + np.array(shift, np.int64), pa.int64())
            items = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, [f.name for f in flat.type]))
            filled = np.array([u for u, _ in bins], np.int32)
            ids = (number << 58 | part << 32) + counter + np.arange(len(bins), dtype=np.int64)
            done = np.ones(len(bins), bool) if last else filled >= capacity - slack
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(filled), pa.array(done), items], bins_schema.fieldNames()), len(bins)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            rows = counter = 0

            def flush() -> pa.RecordBatch:
                nonlocal counter
                whole = pa.Table.from_batches(held).combine_chunks()
                groups = whole.column("items").chunk(0)
                batch, n = emit(whole.column("used").to_pylist(), groups, counter)
                counter += n
                return batch

            for batch in batches:
                if batch.num_rows:
                    held.append(batch)
                    rows += batch.num_rows
                if rows >= SLICE:
                    yield flush()
                    held, rows = [], 0
            if held:
                yield flush()

        return run

    single = pieces.select(
        F.greatest(F.coalesce(F.col(size_col).cast("int"), F.lit(0)), F.lit(0)).alias("used"),
        F.array(F.struct(*[F.col(f"`{c}`") for c in pieces.columns], F.lit(0).cast("long").alias("offset"))).alias("items"),
    )
    out: list[DataFrame] = []
    waiting, before, tasks, number = single, None, None, 0
    while True:
        last = tasks == 1
        bins = store(waiting.mapInArrow(tidy(packer(number, last)), bins_schema), f"bins-{number}")
        left = 0 if last else bins.where(~F.col("done")).count()
        stuck = before is not None and left > 0.95 * before
        out.append(bins if last or stuck or not left else bins.where("done"))
        if last or stuck or not left:
            break
        before, number = left, number + 1
        tasks = max(1, -(-left // per_task))
        waiting = bins.where(~F.col("done")).repartition(tasks, "bin").select("used", "items")
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole.select(F.col("bin").alias("sequence_id"), F.inline("items"))


def pack_documents(docs: DataFrame, capacity: int = 1024, tokenizer: str = DEFAULT_TOKENIZER, end_id: int = 2,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenise and pack whole documents: one row per piece (:func:`tokenize_pieces`, :func:`pack`).

    Texts are tokenised once; only narrow rows move afterwards.
    """
    pieces = store(tokenize_pieces(docs, capacity, tokenizer, end_id, id_col, text_col, with_ids), "pieces")
    return pack(pieces, capacity)
