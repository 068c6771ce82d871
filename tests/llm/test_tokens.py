"""BPE and packing against the tokenizers library and each other."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import Row
from tokenizers import Tokenizer

from corpusloom.llm import bpe, packing
from corpusloom.llm.pieces import tokenizer_path

ODD = [
    None, "", " ", "a", "aaaaaaaaaaaaaaaa", "hello <|endoftext|> world<|endoftext|>", "  lots   of \n\n spaces \t x  ",
    "It's we'll 'S don't 123,456 ½ ²", "漢字とかな é́   x", "x" * 5000 + " " * 300, "<|endoftext|>", "same", "same",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def frame(spark, texts, extra=True):
    rows = [(i if i != 3 else None, t, "clash", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, n_tokens int") if extra else \
        spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")


def random_texts(n, seed=0):
    r = random.Random(seed)
    return ["".join(r.choice("aabbc  \n'stéß漢<|>endof012 \u0085​　") for _ in range(r.randint(0, 80))) for _ in range(n)]


def test_every_character_splits_as_in_the_library(library):
    engine = bpe.encoder(tokenizer_path())
    texts = [f"x{chr(c)} y{chr(c)}{chr(c)}  {chr(c)}" for c in range(0x3100) if not 0xD800 <= c < 0xE000] + random_texts(3000)
    assert list(engine.encode(texts)) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_encode_decode_and_digests(spark, library):
    texts = ODD + random_texts(200, 1)
    docs = frame(spark, texts)
    ids = bpe.encode(docs)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert sorted(r.ids for r in ids.collect()) == sorted(want)
    assert sorted(r.text for r in bpe.decode(ids).collect()) == sorted(library.decode(w, skip_special_tokens=False) for w in want)
    got = sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs).collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == sorted((len(w), sha(",".join(map(str, w))), sha(library.decode(w, skip_special_tokens=False))) for w in want)


def test_a_full_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 50)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 200)
    engine = bpe.PairIndexEncoder(tokenizer_path())
    texts = random_texts(200, 2)
    assert list(engine.encode(texts)) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_empty_tables(spark):
    none = frame(spark, []).limit(0)
    assert bpe.digests(none).count() == bpe.encode(none).count() == packing.pack_documents(none).count() == 0


def test_pieces_and_packing(spark, library):
    texts = ODD + random_texts(300, 3) + [" ".join(random_texts(400, 4))]
    packed = packing.pack_documents(frame(spark, texts), capacity=64).collect()
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    want = []
    for i, tokens in ids.items():
        first = len(tokens) if len(tokens) <= 64 else len(tokens) % 64 or 64
        cuts = [0, *range(first, len(tokens) + 1, 64)]
        want += [(i if i != 3 else None, k, a, b - a, zlib.crc32(np.array(tokens[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed], key=key) == sorted(want, key=key)
    sequences = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    assert len(sequences) <= 1.02 * sum(map(len, ids.values())) / 64 + 1


def test_rounds_merge_underfull_bins(spark):
    r = random.Random(1)
    pieces = spark.createDataFrame([Row(doc_id=i, length=r.randint(1, 40), offset="clash") for i in range(4000)]).repartition(16)
    packed = packing.pack(pieces, capacity=100, slack=1, per_task=60)
    assert packed.columns == ["sequence_id", "doc_id", "length", "offset"]
    rows = packed.collect()
    assert sorted(x.doc_id for x in rows) == list(range(4000))
    bins = {}
    for x in rows:
        bins[x.sequence_id] = bins.get(x.sequence_id, 0) + x.length
    assert max(bins.values()) <= 100 and len(bins) <= 1.03 * sum(bins.values()) / 100 + 1


def test_unmergeable_items_end_the_rounds(spark):
    pieces = spark.createDataFrame([Row(doc_id=i, length=60) for i in range(500)]).repartition(8)
    packed = packing.pack(pieces, capacity=100, per_task=20)
    assert packed.count() == packed.select("sequence_id").distinct().count() == 500


def test_best_fit_is_never_over():
    r = random.Random(3)
    for _ in range(50):
        sizes = [r.randint(1, 30) for _ in range(r.randint(0, 60))]
        bins = packing.best_fit(sizes, 30)
        assert sorted(i for _, members in bins for i in members) == list(range(len(sizes)))
        assert all(used == sum(sizes[i] for i in members) <= 30 for used, members in bins)


def test_sizes_outside_the_capacity(spark):
    sizes = [None, -5, 0, 10, 11, 1000, 10, 4, 6, None]
    rows = packing.pack(spark.createDataFrame([Row(doc_id=i, length=n) for i, n in enumerate(sizes)]), capacity=10, slack=0).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(sizes)))
    room = {}
    for r in rows:
        room.setdefault(r.sequence_id, []).append(max(r.length or 0, 0))
    assert sorted(sum(b) for b in room.values() if sum(b)) == [10, 10, 10, 11, 1000]
    assert all(len([x for x in b if x]) == 1 for b in room.values() if sum(b) > 10)


def test_pieces_past_a_full_cache(library, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_PIECES", 50)
    engine = packing.PieceIds(tokenizer_path())
    texts = [t or "" for t in ODD] + random_texts(300, 5)
    assert [np.frombuffer(engine.of(t), "<u4").tolist() for t in texts] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(engine) <= 50
