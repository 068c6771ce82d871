"""Streams over growing corpora and logs. The checkpoint location takes the place of a state file."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from corpusloom import schemas
from corpusloom.functions.keys import content_key
from corpusloom.operators.corpus import Rule, apply_rules, corpus_rules, with_license
from corpusloom.operators.dedup import latest_per_key
from corpusloom.operators.genlog import LOG_KEYS, succeeded


def read_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "json", glob: str | None = None,
                max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_filter_corpus(files: DataFrame, rules: list[Rule] | None = None, **bounds) -> DataFrame:
    """The per-file rules of the funnel; the same code serves batch and streaming frames."""
    if "license" not in files.columns:
        files = with_license(files)
    return apply_rules(files, corpus_rules(**bounds) if rules is None else rules)


def stream_latest(log: DataFrame, keys: list[str] | None = None, timestamp: str = "timestamp",
                  tie: str = "request_id", columns: list[str] | None = None) -> DataFrame:
    """Compaction of a growing log. The state holds one row per key, no watermark is needed.

    Run it in ``update`` mode with ``delta_sink``: a batch then writes the keys it changed, not the
    whole result. ``columns`` keeps the state small.
    """
    keys = keys or LOG_KEYS
    rest = [c for c in (columns or log.columns) if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(timestamp, tie))
    return log.groupBy(*keys).agg(newest.alias("_r")).select(*keys, "_r.*")


def stream_dedup(files: DataFrame, event_time: str, delay: str = "1 hour", code: str = "code") -> DataFrame:
    """First arrival per content within the watermark, handed on at once; ``stream_dedup_best`` waits for the best copy."""
    keyed = files.withColumn("content_sha", content_key(code)).withWatermark(event_time, delay)
    return keyed.dropDuplicatesWithinWatermark(["content_sha"])


def stream_dedup_best(files: DataFrame, event_time: str, delay: str = "1 hour", gap: str | None = None, code: str = "code",
                      stars: str = "stars", id_col: str = "id", columns: list[str] | None = None) -> DataFrame:
    """The most-starred copy per content (ties: smallest id; null stars last), as the batch operator chooses it.

    Copies belong together while each follows another by less than ``gap`` (default: ``delay``). The state holds the best
    row of every open group, however many copies there are; a group is handed on once, in append mode, when the watermark
    has passed its end, and leaves the state. Null contents are one content. Rows without an event time belong to no group
    and are left out. ``columns`` (default: all) keeps the state small.
    """
    keyed = files.withColumn("content_sha", F.coalesce(content_key(code), F.lit(""))).withWatermark(event_time, delay)
    order = F.struct(F.col(stars).isNull().alias("a"), (-F.col(stars)).alias("b"), F.col(id_col).isNull().alias("c"), F.col(id_col).alias("d"))
    best = F.min_by(F.struct(*(columns or files.columns)), order)
    groups = keyed.groupBy(F.session_window(event_time, gap or delay).alias("_w"), "content_sha")
    return groups.agg(best.alias("_r")).select("_r.*", "content_sha")


def stream_progress(log: DataFrame, event_time: str = "timestamp", window: str = "10 minutes", slide: str | None = None,
                    delay: str = "10 minutes") -> DataFrame:
    """Requests, failures and tokens per provider and time window; windows close by the watermark."""
    ok = succeeded()
    span = F.window(event_time, window, slide) if slide else F.window(event_time, window)
    return (
        log.withWatermark(event_time, delay).groupBy(span.alias("w"), "provider")
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_if(~ok).alias("failures"),
            F.coalesce(F.sum(F.when(ok, F.col("input_tokens"))), F.lit(0)).alias("input_tokens"),
            F.coalesce(F.sum(F.when(ok, F.col("output_tokens"))), F.lit(0)).alias("output_tokens"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "provider", "requests", "failures",
                "input_tokens", "output_tokens")
    )


def stream_sessions(log: DataFrame, event_time: str = "timestamp", gap: str = "10 minutes", delay: str = "10 minutes") -> DataFrame:
    """Requests, failures and tokens per provider and run of activity: a session ends after ``gap`` without
    a request. Sessions are final, and leave the state, when the watermark has passed them."""
    ok = succeeded()
    return (
        log.withWatermark(event_time, delay).groupBy(F.session_window(event_time, gap).alias("w"), "provider")
        .agg(F.count(F.lit(1)).alias("requests"), F.count_if(~ok).alias("failures"),
             F.coalesce(F.sum(F.when(ok, F.col("output_tokens"))), F.lit(0)).alias("output_tokens"))
        .select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "provider", "requests", "failures", "output_tokens")
    )


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", fmt: str = "parquet") -> StreamingQuery:
    """Process what is there and stop; a rerun with the same checkpoint takes only what is new."""
    query = (
        stream.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
    return query


def run_each_batch(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update") -> StreamingQuery:
    query = (
        stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def delta_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Sink for ``update`` mode: changed rows in one folder per batch. A repeated batch replaces its
    own folder, so nothing is written twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return write


def read_latest(spark: SparkSession, path: str, keys: list[str] | None = None, timestamp: str = "timestamp",
                tie: str = "request_id") -> DataFrame:
    """Current rows from what ``delta_sink`` wrote."""
    deltas = spark.read.option("basePath", path).parquet(path).drop("batch")
    return latest_per_key(deltas, keys or LOG_KEYS, timestamp, tie)


def overwrite_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Sink for small results in ``complete`` mode: every batch replaces the result."""

    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return write


def stream_resume(spark: SparkSession, source: str, target: str, checkpoint: str,
                  step: Callable[[DataFrame], DataFrame], schema: StructType = schemas.CORPUS_FILE, fmt: str = "json",
                  glob: str | None = None) -> StreamingQuery:
    """Apply ``step`` to files not processed by an earlier run."""
    return run_available(step(read_stream(spark, source, schema, fmt, glob)), target, checkpoint)
