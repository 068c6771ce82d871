"""Archives by round trip; the pipeline stage by stage."""

import base64
import hashlib
import io
import struct

import pytest
import zstandard

import corpus_pipeline
from corpusloom.llm import jaccard, packing, warc
from corpusloom.llm.common import store, table
from corpusloom.session import scratch_path

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, record_type string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_equal_payloads_are_stored_once(spark):
    rows = [(1, "a\nb", "x" * 50), (1, None, "x" * 50), (5, "u", "x" * 50), (3, "u", None), (None, "u", ""), (7, "z", "<p>é漢</p>"), (5, "q", "x" * 50), (8, "l", "long " * 200_000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    found = warc.archive_round_trip(pages).collect()
    assert sorted((r.page_id or 0, r.payload_bytes, r.payload_digest) for r in found) == sorted((i or 0, len((h or "").encode()), digest(h)) for i, _, h in rows)
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in found)
    assert kinds == [(0, "revisit", 3), (1, "revisit", 5), (1, "revisit", 5), (3, "response", 0), (5, "response", 0), (5, "revisit", 5), (7, "response", 0), (8, "response", 0)]


def test_least_bytes(spark):
    pages = spark.createDataFrame([(1, "u", "ab", ""), (2, "u", "ab", ""), (3, "u", "abcd", ""), (4, "u", "abcd", "")], SCHEMA)
    found = {r.page_id: r.record_type for r in warc.archive_round_trip(pages, least_bytes=3).collect()}
    assert found == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_files_open_with_a_plain_reader(spark):
    pages = table(spark, SF, "pages")
    folder = scratch_path(spark, "archives")
    manifest = warc.write_archives(pages, folder)
    want = {r.page_id: (r.url, r.html) for r in pages.collect()}
    seen = {}
    for m in manifest.collect():
        with open(m.path, "rb") as f:
            data = f.read()
        assert len(data) == m.bytes
        magic, size = struct.unpack("<II", data[:8])
        assert magic == 0x184D2A5D
        known = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
        rest, n = data[8 + size:], 0
        while rest:  # every record is a frame of its own
            one = known.decompressobj()
            text = one.decompress(rest)
            rest = one.unused_data
            head, _, block = text.partition(b"\r\n\r\n")
            assert text.endswith(b"\r\n\r\n") and head.startswith(b"WARC/1.1\r\nWARC-Type: response")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            seen[int(fields["Page-ID"])] = (fields["WARC-Target-URI"], block[:-4].partition(b"\r\n\r\n")[2].decode())
            n += 1
        assert n == m.records
    assert seen == want
    read = warc.read_archives(manifest, folder, with_payload=True).collect()
    assert {r.page_id: (r.url, r.payload.decode()) for r in read} == want


def test_small_samples_and_damage():
    assert warc.train_dictionary([b"abc"] * 3) is None
    plain = warc.compressor(None).compress(warc.record(4, "u", b"abc", warc.base32_sha1(b"abc"), False, None))
    assert [h["Page-ID"] for h, _ in warc.records_of(io.BytesIO(plain + plain))] == ["4", "4"]
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(warc.compressor(None).compress(b"no archive\r\n"))))


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = store(stage(spark, docs, SF), "test-stage")
        out.append((name, docs, after))
        docs = after
    return out


def test_stage_order_and_columns(spark, stages):
    columns = table(spark, SF, "documents").columns
    assert [n for n, _, _ in stages] == ["language ID", "quality classifier", "n-gram Jaccard join", "best-fit packing"]
    assert all(after.columns == columns for _, _, after in stages[:-1])
    for _, before, after in stages[:-1]:  # rows pass unchanged
        assert after.join(before, columns, "left_anti").count() == 0


def test_clean_documents_stay(spark, stages):
    labels = table(spark, SF, "labels")
    clean = {r.doc_id for r in labels.where("quality = 1 and toxic = 0").collect()}
    junk = {r.doc_id for r in labels.where("quality = 0").collect()}
    _, _, kept = stages[1]
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert len(clean & ids) > 0.97 * len(clean) and len(junk & ids) < 0.4 * max(1, len(junk))  # 11 documents: the models learn from few trusted ones here


def test_one_of_each_group_stays(spark, stages):
    from tests.llm.test_pairs import brute_links, united

    _, before, after = stages[2]
    items = [(r.doc_id, r.text) for r in before.orderBy("doc_id").collect()]
    classes = united(brute_links(items), range(len(items)))
    assert {r.doc_id for r in after.select("doc_id").collect()} == {items[k][0] for k in set(classes.values())}
    assert jaccard.similarity_groups(after).where("n_links > 0").count() == 0


def test_all_documents_are_packed(spark, stages):
    _, before, packed = stages[3]
    whole = packing.tokenize_pieces(before)
    assert packed.select(*whole.columns).exceptAll(whole).count() == whole.exceptAll(packed.select(*whole.columns)).count() == 0
