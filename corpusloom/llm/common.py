"""What the operators share: tables, stored intermediates, identity of texts."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.packaging import ship
from corpusloom.session import scratch_path, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def give_back() -> None:
    """Return freed memory to the system: Python workers live on from task to task, and a later stage
    should not find them swollen by an earlier one."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` of a task, giving memory back when it ends."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


BATCH_ROWS = 1000  # rows hold whole documents: this bounds what a Python worker has in hand


def ready(df: DataFrame) -> SparkSession:
    """The frame's session, with the package on its executors, a checkpoint folder, and Python batches of at
    most ``BATCH_ROWS`` rows."""
    spark = df.sparkSession
    ship(spark)
    shared_dir(spark)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))
    return spark


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python batches of at most ``rows`` rows for the jobs that run inside: for rows that hold several long values."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(rows))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_bucket(key: Column, n: int) -> Column:
    """``crc32(key as text) mod n``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(n)


def with_position(df: DataFrame) -> DataFrame:
    """Rows with ``_file`` and ``_row``: where each stands in its Parquet file, the same on every read.

    Rows that do not come from files are stored first.
    """
    position = {"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")}
    try:
        return df.withColumns(position)
    except AnalysisException:
        return store(df, "rows").withColumns(position)


def hash_sample(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """About ``n`` rows, chosen by the hash of ``keys``; all rows if there are no more than that.

    A filter decides row by row, so nothing is ranked or gathered; never more than ``2 * n`` rows.
    """
    rows = df.count()
    if rows <= n:
        return df
    return df.where(F.pmod(F.xxhash64(*keys, F.lit("sample")), F.lit(1 << 30)) < int(n / rows * (1 << 30))).limit(2 * n)
