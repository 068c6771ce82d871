"""Line-delimited JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpusloom import schemas


def read_jsonl(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """Typed read; a malformed line keeps its text in ``_corrupt_record``."""
    full = StructType([*schema.fields, StructField(schemas.CORRUPT, StringType(), True)])
    return (
        spark.read.schema(full).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT).json(path)
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path, or any file that the pattern names, is there."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def read_chat_jsonl(spark: SparkSession, path: str | list[str], schema: StructType = schemas.MIXED_RECORD, malformed: str = "fail") -> DataFrame:
    """Chat records with a ``messages`` field. ``path`` may be a pattern or a list; what does not exist adds
    nothing, blank lines are skipped.

    ``malformed`` lines fail the job when they are read, as they would stop any careful reader. With
    ``"keep"`` they stay as rows that hold their text in ``_corrupt_record``.
    """
    if malformed not in ("fail", "keep"):
        raise ValueError(f"malformed: {malformed}")
    paths = [p for p in ([path] if isinstance(path, str) else path) if path_exists(spark, p)]
    if malformed == "keep":
        if not paths:
            return spark.createDataFrame([], StructType([*schema.fields, StructField(schemas.CORRUPT, StringType(), True)]))
        return read_jsonl(spark, paths, schema).filter(F.col("messages").isNotNull() | F.col(schemas.CORRUPT).isNotNull())
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(paths).filter(F.col("messages").isNotNull())


def malformed_lines(spark: SparkSession, path: str | list[str], schema: StructType = schemas.MIXED_RECORD) -> DataFrame:
    """``lines`` and ``malformed``: records read from the paths, and how many of them do not parse."""
    full = StructType([*schema.fields, StructField(schemas.CORRUPT, StringType(), True)])
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT})
    bad = parsed[schemas.CORRUPT].isNotNull()
    return read_raw_lines(spark, path).agg(F.count(F.lit(1)).alias("lines"), F.count_if(bad).alias("malformed"))


def read_raw_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Non-blank lines as text, for checks that must tell a missing key from a null one."""
    return spark.read.text(path).filter(F.length(F.trim("value")) > 0)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Null fields are left out, so optional keys are absent rather than null."""
    df.write.mode(mode).option("ignoreNullFields", "true").json(path)


def append_records(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Add one batch to a log; each call is one committed set of files, never a file per row."""
    df.write.mode("append").option("ignoreNullFields", "true").format(fmt).save(path)
