"""WARC archives in Zstandard, one frame per record, with a dictionary in a leading skippable frame.

The dictionary is trained on a bounded sample of the records. Each task streams its pages into archives of
its own in the shared folder; a file counts only when its task has returned its name, so that a repeated or
lost attempt leaves at most a file that nothing refers to. Equal payloads are stored once: the other
records revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import hash_sample, ready, store, with_position
from corpusloom.session import scratch_path

# Fixed values of the WARC and WARC-Zstandard formats.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SAMPLE_RECORDS = 500  # bound of what the dictionary is trained on
DICTIONARY_BYTES = 64 * 1024
LEVEL = 3
ARCHIVE_BYTES = 1 << 30  # an archive is closed beyond that
DATE = "1970-01-01T00:00:00Z"  # pages carry no capture time


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def one_line(value: str) -> str:
    """A header value without control characters, which are written as in a URI."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, head: int | None, date: str = DATE) -> bytes:
    """One WARC record; a revisit keeps the HTTP header (with the payload's length) and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {one_line(url)}")
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"Page-ID: {'' if page_id is None else page_id}"]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(head, digest)}", f"Refers-To-Page: {'' if head is None else head}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes | None:
    """A Zstandard dictionary; None if the samples are too few or too small to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes() if len(samples) >= 8 else None
    except zstandard.ZstdError:
        return None


def compressor(dictionary: bytes | None) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_checksum=True)


def leading_frame(dictionary: bytes | None) -> bytes:
    return struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary if dictionary else b""


def records_of(source: io.RawIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(headers, block)`` of every record of an archive, with or without a leading dictionary."""
    head = source.read(8)
    dictionary = None
    if len(head) == 8 and struct.unpack("<II", head)[0] == DICTIONARY_FRAME:
        raw = source.read(struct.unpack("<II", head)[1])
        if raw[:4] == zstandard.FRAME_HEADER:  # the dictionary may be compressed itself
            raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=1 << 28)
        dictionary = zstandard.ZstdCompressionDict(raw)
    else:
        source.seek(0)
    frames = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(source, read_across_frames=True)
    text = io.BufferedReader(frames, 1 << 20)
    while version := text.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        headers = {}
        while line := text.readline().rstrip(b"\r\n"):
            name, _, value = line.decode("utf-8", "surrogatepass").partition(":")
            headers[name] = value.strip()
        block = text.read(int(headers["Content-Length"]))
        if text.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield headers, block


def write_archives(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record per row; returns the manifest ``path, records, bytes``.

    The payload is the whole html in UTF-8, empty for a null. Of the records with equal payloads of at least
    ``least_bytes`` the one with the largest id is the response, the others revisit it; among repeated rows
    of that id one is. Null ids come before all others, null urls are left out. Other columns are ignored.
    ``folder`` (default: a fresh one in the shared folder) must be reachable from all executors by pyarrow.
    An empty table gives an empty manifest.
    """
    spark = ready(pages)
    folder = folder or scratch_path(spark, "warc")
    rows = with_position(pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html")))
    payload = F.encode(F.coalesce("_html", F.lit("")), "UTF-8")
    rows = rows.select("_file", "_row", "_id", "_url", "_html")

    narrow = rows.select("_file", "_row", "_id", F.sha1(payload).alias("_digest"), F.octet_length(payload).alias("_bytes")).where(F.col("_bytes") >= least_bytes)
    repeated = narrow.groupBy("_digest").agg(F.max(F.struct("_id", "_file", "_row")).alias("_head"), F.count("*").alias("_n")).where("_n > 1")
    revisits = narrow.join(repeated, "_digest").where(~((F.col("_file") == F.col("_head._file")) & (F.col("_row") == F.col("_head._row")))).select(
        "_file", "_row", F.lit(True).alias("_revisit"), F.col("_head._id").alias("_refers_to"))

    draw = hash_sample(rows, SAMPLE_RECORDS, "_file", "_row").select("_id", "_url", "_html").collect()
    samples = [(r._id, r._url, (r._html or "").encode("utf-8", "surrogatepass")) for r in draw]
    dictionary = train_dictionary([record(i, u, p, base32_sha1(p), False, None) for i, u, p in samples])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pa.fs.FileSystem.from_uri(folder)
        engine = compressor(dictionary)
        out, path, count, size = None, "", 0, 0

        def close() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count], pa.int64()), pa.array([size], pa.int64())], ["path", "records", "bytes"])

        for batch in batches:
            for page_id, url, html, revisit, head in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    fs.create_dir(base, recursive=True)
                    path, count = f"{base}/{uuid.uuid4().hex}.warc.zst", 0
                    out = fs.open_output_stream(path, compression=None)  # detected from the name otherwise
                    out.write(leading_frame(dictionary))
                    size = len(leading_frame(dictionary))
                body = (html or "").encode("utf-8", "surrogatepass")
                frame = engine.compress(record(page_id, url, body, base32_sha1(body), bool(revisit), head))
                out.write(frame)
                count, size = count + 1, size + len(frame)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    known = rows.join(revisits, ["_file", "_row"], "left").select("_id", "_url", "_html", "_revisit", "_refers_to")
    return store(known.mapInArrow(write, "path string, records long, bytes long"), "manifest")


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Every record of the manifest's archives: ``page_id, url, record_type, payload_bytes, payload_digest,
    refers_to`` and, on request, ``payload`` (null for revisits).

    Length and digest of a response are those of the payload read; a payload that does not match the digest
    in its header fails the job.
    """
    ready(manifest)
    files = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pa.fs.FileSystem.from_uri(folder)
        number = lambda v: int(v) if v else None
        names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", *(["payload"] if with_payload else [])]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), *([pa.binary()] if with_payload else [])]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_file(path) as source:
                    for headers, block in records_of(source):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest, revisit = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"] == "revisit"
                        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        if not revisit:
                            if base32_sha1(payload) != digest or len(payload) != size:
                                raise ValueError(f"{path}: payload of {headers['WARC-Record-ID']} is damaged")
                        row = [number(headers["Page-ID"]), headers.get("WARC-Target-URI"), headers["WARC-Type"], size, digest, number(headers.get("Refers-To-Page"))]
                        rows.append([*row, *([None if revisit else payload] if with_payload else [])])
                        held += len(block) if with_payload else 200
                        if held > 8_000_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long" + (", payload binary" if with_payload else "")
    return manifest.select("path").repartition(files, "path").mapInArrow(read, schema)


def archive_round_trip(pages: DataFrame, folder: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write the archives and read them back (:func:`write_archives`, :func:`read_archives`)."""
    spark = ready(pages)
    folder = folder or scratch_path(spark, "warc")
    return read_archives(write_archives(pages, folder, least_bytes), folder)
