"""Tables stored by key, for joins and windows that move no row.

Rows are stored in buckets of the key, sorted. Two tables with the same number of buckets join bucket by bucket, and one row
per key is found inside a bucket. A key with so many rows that it would fill a bucket alone is stored apart, in a plain table
that Spark splits among tasks as it likes.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.operators.dedup import latest_per_key


@dataclass(frozen=True)
class Bucketed:
    """A stored table: ``cold`` rows by bucket of ``key``, ``hot`` rows of the keys in ``hot_keys``."""

    spark: SparkSession
    path: str
    key: str
    buckets: int
    schema: StructType
    table: str

    def cold(self) -> DataFrame:
        return self.spark.table(self.table)

    def hot(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/hot")

    def hot_keys(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/hot_keys")

    def rows(self) -> DataFrame:
        return self.cold().unionByName(self.hot())


def _named(spark: SparkSession, path: str, key: str, buckets: int, schema: StructType) -> Bucketed:
    """Makes the files known to the session's catalog under a name of their own."""
    name = f"bucketed_{uuid.uuid4().hex}"
    place = f"{path}/cold".replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {buckets} BUCKETS LOCATION '{place}'")
    return Bucketed(spark, path, key, buckets, schema, name)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, hot_rows: int | None = None) -> Bucketed:
    """Store ``df`` below ``path``, a folder that does not exist yet, one file a bucket.

    Keys with more than ``hot_rows`` rows (default: the mean of a bucket) are stored apart; there are fewer of them than
    rows / ``hot_rows``. They are counted first, on the key column alone. Null keys count like any other key. ``df`` is
    read three times: pass a stored table rather than a long plan.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    schema = StructType([type(f)(f.name, f.dataType, True, f.metadata) for f in df.schema.fields])
    counts = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    if hot_rows is None:
        bound = F.greatest(F.ceil(counts.agg(F.sum("_n")).scalar() / F.lit(buckets)), F.lit(1))
    else:
        bound = F.lit(hot_rows)
    counts.where(F.col("_n") > bound).select("_key").write.parquet(f"{path}/hot_keys")
    hot_keys = spark.read.schema(StructType().add("_key", df.schema[key].dataType)).parquet(f"{path}/hot_keys")
    here = F.col(key).eqNullSafe(F.col("_key"))
    df.join(hot_keys, here, "left_semi").write.option("compression", "zstd").parquet(f"{path}/hot")
    name = f"writing_{uuid.uuid4().hex}"
    (df.join(hot_keys, here, "left_anti").repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
     .option("path", f"{path}/cold").option("compression", "zstd").format("parquet").saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # the files stay: they lie outside the warehouse
    layout = spark.createDataFrame([(key, buckets, schema.json())], "key string, buckets int, schema string")
    layout.coalesce(1).write.parquet(f"{path}/layout")  # written last: a folder without it is not finished
    return _named(spark, path, key, buckets, schema)


def open_bucketed(spark: SparkSession, path: str) -> Bucketed:
    """A table that ``write_bucketed`` stored, in this or another session."""
    path = path.rstrip("/")
    layout = spark.read.parquet(f"{path}/layout").first()
    return _named(spark, path, layout["key"], layout["buckets"], StructType.fromJson(json.loads(layout["schema"])))


def join_co_located(left: Bucketed, right: Bucketed, how: str = "inner") -> DataFrame:
    """Rows of ``left`` with the columns of ``right``, which has one row per key and shares no other column name.

    Rows in buckets meet without an exchange if both have the same number of buckets. The rows of a hot key meet the few
    rows of ``right`` that have one; Spark chooses that join by their size and splits what is skewed. ``how`` is ``inner``,
    ``left``, ``left_semi`` or ``left_anti``. Null keys match nothing.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"no such join here: {how}")
    both = sorted(({*left.schema.fieldNames()} - {left.key}) & ({*right.schema.fieldNames()} - {right.key}))
    if both and how in ("inner", "left"):
        raise ValueError(f"columns on both sides: {both}")
    others = right.cold().withColumnRenamed(right.key, left.key)
    cold = left.cold().join(others, left.key, how)
    wanted = right.rows().withColumnRenamed(right.key, left.key).join(
        left.hot_keys().withColumnRenamed("_key", left.key), left.key, "left_semi")
    return cold.unionByName(left.hot().join(wanted, left.key, how))


def latest_co_located(log: Bucketed, keys: list[str], timestamp: str = "timestamp", tie: str = "request_id") -> DataFrame:
    """``latest_per_key`` inside the buckets; ``keys`` contains the table's key, so no key has rows in two places."""
    if log.key not in keys:
        raise ValueError(f"{log.key} is not among {keys}")
    return latest_per_key(log.cold(), keys, timestamp, tie).unionByName(latest_per_key(log.hot(), keys, timestamp, tie))
