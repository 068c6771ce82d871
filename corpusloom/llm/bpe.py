"""BPE encoding and decoding with an index from each pair to all its positions.

A task gathers the distinct pieces of its batch, lays their symbols out in one array and indexes every
adjacent pair by merge rank: rank -> positions. Ranks are then applied once each in ascending order; a
merge only touches the neighbours of its positions, and the pairs it creates are entered into the index.
Work therefore follows the number of merges, not pieces times merges, and repeated pieces cost a lookup.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from corpusloom.llm.common import ready, tidy
from corpusloom.llm.pieces import DEFAULT_TOKENIZER, Splitter, chunks, load_spec, printable_bytes, tokenizer_path

CHUNK_CHARS = 4_000_000
CACHE_PIECES = 400_000


class PairIndexEncoder:
    """Encoder and decoder of one byte-level BPE vocabulary."""

    def __init__(self, path: str):
        spec = load_spec(path)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        byte_of = printable_bytes()
        self.splitter = Splitter(spec)
        self.token_bytes = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items() if all(c in byte_of for c in t)}
        self.token_bytes |= {i: t.encode() for t, i in self.splitter.specials.items()}
        self.byte_ids = np.zeros(256, np.int64)
        for c, b in byte_of.items():
            self.byte_ids[b] = vocab[c]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.left, self.right = left, right
        self.product = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of_key = keys[order], order
        self.cache: dict[str, tuple[int, ...]] = {}

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, -1 where there is none."""
        keys = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (a >= 0) & (b >= 0), self.rank_of_key[at], -1)

    def encode_pieces(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """Ids of every piece, all pieces merged together rank by rank."""
        raw = [p.encode("utf-8") for p in pieces]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        # a wall (-1) before every piece keeps pairs inside pieces
        starts = np.cumsum(sizes + 1) - sizes
        n = int(sizes.sum() + len(raw)) + 1
        sym = np.full(n, -1, np.int64)
        inside = np.ones(n, bool)
        inside[starts - 1] = False
        inside[-1] = False
        sym[inside] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)

        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(positions: np.ndarray, found: np.ndarray) -> None:
            keep = found >= 0
            positions, found = positions[keep], found[keep]
            if not len(found):
                return
            order = np.argsort(found, kind="stable")
            positions, found = positions[order], found[order]
            cuts = np.flatnonzero(np.diff(found)) + 1
            for rank, group in zip(found[np.r_[0, cuts]].tolist(), np.split(positions, cuts)):
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(active, rank)
                index[rank].append(group)

        everywhere = np.flatnonzero(inside[:-1] & inside[1:])
        enter(everywhere, self.ranks(sym[everywhere], sym[everywhere + 1]))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            at = np.unique(np.concatenate(lists)) if len(lists) > 1 else lists[0]
            a, b = self.left[rank], self.right[rank]
            at = at[sym[at] == a]
            at = at[sym[nxt[at]] == b]
            if a == b:  # runs such as "aaa": the leftmost pair wins, then the next free one
                taken, free = [], -1
                for p in at.tolist():
                    if p != free:
                        taken.append(p)
                        free = int(nxt[p])
                at = np.array(taken, np.int64)
            if not len(at):
                continue
            gone = nxt[at]
            after = nxt[gone]
            sym[at] = self.product[rank]
            sym[gone] = -2
            nxt[at] = after
            prv[after] = at
            before = prv[at]
            where = np.concatenate([before, at])
            enter(where, self.ranks(sym[where], sym[nxt[where]]))
        ids = sym[inside & (sym >= 0)].tolist()
        ends = np.cumsum(np.add.reduceat(sym >= 0, starts - 1)[: len(raw)] if len(raw) else np.zeros(0, np.int64)).tolist()
        return [tuple(ids[s:e]) for s, e in zip([0, *ends], ends)]

    def learn(self, pieces: set[str]) -> None:
        """Put the ids of unseen pieces into the cache; the cache starts anew when it is full."""
        new = [p for p in pieces if p not in self.cache]
        if len(self.cache) + len(new) > CACHE_PIECES:
            self.cache.clear()
            new = list(pieces)
        specials = self.splitter.specials
        self.cache.update((p, (specials[p],)) for p in new if p in specials)
        plain = [p for p in new if p not in specials]
        self.cache.update(zip(plain, self.encode_pieces(plain)))

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        for run in chunks(texts, CHUNK_CHARS):
            split = [self.splitter.pieces(t) for t in run]
            self.learn(set().union(*split))
            look = self.cache.__getitem__
            for pieces in split:
                yield [i for ids in map(look, pieces) for i in ids]

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; special tokens are kept, broken UTF-8 becomes U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> PairIndexEncoder:
    return PairIndexEncoder(path)


def encode(docs: DataFrame, tokenizer: str = DEFAULT_TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids array<int>`` of every whole text; a null or empty text has no ids.

    One output row per input row: repeated rows and null ids are kept, other columns are left out, an
    empty table gives an empty result. Texts of any length are taken whole.
    """
    ready(docs)
    schema = StructType([docs.schema[id_col], StructField("ids", ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = encoder(tokenizer_path(tokenizer))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = pa.array(engine.encode(texts), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], [id_col, "ids"])

    return docs.select(id_col, text_col).mapInArrow(tidy(run), schema)


def decode(encoded: DataFrame, tokenizer: str = DEFAULT_TOKENIZER, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col``, ``text`` of every list of ids; null ids decode to the empty text."""
    ready(encoded)
    schema = StructType([encoded.schema[id_col], StructField("text", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = encoder(tokenizer_path(tokenizer))
        for batch in batches:
            texts = pa.array([engine.decode(ids or []) for ids in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], [id_col, "text"])

    return encoded.select(id_col, ids_col).mapInArrow(tidy(run), schema)


def digests(docs: DataFrame, tokenizer: str = DEFAULT_TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text and keep what proves it: number of ids and two SHA-256 digests.

    The ids never leave the task. Piece by piece the digests take the ids of the encoder's cache and the
    bytes that these ids decode to. Edge cases as in :func:`encode`.
    """
    ready(docs)
    schema = StructType([
        docs.schema[id_col], StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = encoder(tokenizer_path(tokenizer))
        written: dict[str, str] = {}
        decoded: dict[str, bytes] = {}
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for texts in chunks([t or "" for t in batch.column(1).to_pylist()], CHUNK_CHARS):
                split = [engine.splitter.pieces(t) for t in texts]
                seen = set().union(*split)
                new = seen.difference(written)
                if len(written) + len(new) > CACHE_PIECES:
                    written.clear()
                    decoded.clear()
                    new = seen
                engine.learn(new)
                for p in new:
                    ids = engine.cache[p]
                    written[p] = ",".join(map(str, ids))
                    decoded[p] = b"".join(map(engine.token_bytes.__getitem__, ids))
                for pieces in split:
                    ids_text = ",".join(map(written.__getitem__, pieces))
                    text = b"".join(map(decoded.__getitem__, pieces)).decode("utf-8", "replace")
                    counts.append(ids_text.count(",") + 1 if ids_text else 0)
                    ids_sha.append(hashlib.sha256(ids_text.encode()).hexdigest())
                    text_sha.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                schema.fieldNames(),
            )

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(tidy(run), schema)
