"""Whole files below a folder, hidden names included, as a data source.

Spark's own listing leaves out names that begin with ``.`` or ``_``. This source lists the tree itself and deals the
files out in runs of bounded number and size, one partition each; a file is read by the task that returns it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from corpusloom.packaging import ship

RUN_FILES, RUN_BYTES = 2000, 128 << 20
BATCH_BYTES = 16 << 20
SCHEMA = pa.schema([("path", pa.string()), ("length", pa.int64()), ("content", pa.binary())])


def opened(path: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and plain path of a URI or a local path."""
    uri = re.sub(r"^file:/+", "file:///", path.rstrip("/"))
    return pa.fs.FileSystem.from_uri(uri) if "://" in uri else (pa.fs.LocalFileSystem(), uri)


@dataclass
class Run(InputPartition):
    """Paths below the root."""

    files: list[str]


class TreeReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"]
        self.extension = options.get("extension")
        self.least, self.most = int(options.get("min_bytes", 0)), int(options.get("max_bytes", 1 << 62))
        self.files, self.bytes = int(options.get("run_files", RUN_FILES)), int(options.get("run_bytes", RUN_BYTES))

    def listed(self) -> Iterator[tuple[str, int]]:
        """Path below the root, and size, of every wanted file, in the order of the paths."""
        fs, base = opened(self.root)
        found = fs.get_file_info(pa.fs.FileSelector(base, recursive=True))
        cut = len(base.rstrip("/")) + 1
        for info in sorted(found, key=lambda i: i.path):
            named = self.extension is None or info.base_name.endswith(f".{self.extension}")
            if info.type == pa.fs.FileType.File and named and self.least <= info.size <= self.most:
                yield info.path[cut:], info.size

    def partitions(self) -> list[Run]:
        runs, held, size = [], [], 0
        for path, length in self.listed():
            if held and (len(held) >= self.files or size + length > self.bytes):
                runs.append(Run(held))
                held, size = [], 0
            held.append(path)
            size += length
        return [*runs, Run(held)]

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        fs, base = opened(self.root)
        rows: list[tuple[str, bytes]] = []
        size = 0
        for path in partition.files:
            with fs.open_input_stream(f"{base.rstrip('/')}/{path}", compression=None) as f:
                rows.append((path, f.read()))
            size += len(rows[-1][1])
            if size >= BATCH_BYTES:
                yield batch(rows)
                rows, size = [], 0
        if rows:
            yield batch(rows)


def batch(rows: list[tuple[str, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in rows]), pa.array([len(c) for _, c in rows], pa.int64()), pa.array([c for _, c in rows], pa.binary())], schema=SCHEMA)


class TreeSource(DataSource):
    """``spark.read.format("source_tree")``; options ``extension, min_bytes, max_bytes, run_files, run_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "source_tree"

    def schema(self) -> str:
        return "path string, length long, content binary"

    def reader(self, schema) -> TreeReader:
        return TreeReader(dict(self.options))


def read_whole_tree(spark: SparkSession, root: str, extension: str | None = None, min_bytes: int = 0, max_bytes: int | None = None, **options) -> DataFrame:
    """``(path, length, content)`` of every file below ``root``, paths relative to it, whatever the names begin with.

    Sizes outside the bounds are not read. The listing is one call of pyarrow's file system, which must open ``root`` on the
    driver and the executors alike. An empty tree gives an empty table, a missing one fails.
    """
    ship(spark)
    spark.dataSource.register(TreeSource)
    chosen = {"extension": extension, "min_bytes": min_bytes, "max_bytes": max_bytes, **options}
    reader = spark.read.format("source_tree")
    for key, value in chosen.items():
        if value is not None:
            reader = reader.option(key, str(value))
    return reader.load(root)
