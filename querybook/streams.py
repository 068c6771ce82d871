"""Streaming versions, run over what is available and compared with the batch answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import keys
from corpusloom.session import scratch_path
from corpusloom.streaming import streams
from querybook.fixtures import MAX_CHARS, corpus_from, sql, table
from querybook.registry import query


def place(sf, name):
    """A table's path as a pattern: unlike a plain path it may name a file as well as a folder of files."""
    return f"{sf}/{name}.parque[t]"


def stream_of(spark, sf, name):
    return streams.read_stream(spark, place(sf, name), table(spark, sf, name).schema, "parquet")


def _finish(spark, stream, label, mode="append"):
    out, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-state")
    if mode == "append":
        streams.run_available(stream, out, checkpoint)
    else:
        streams.run_each_batch(stream, streams.overwrite_sink(out), checkpoint, mode)
    return spark.read.parquet(out)


@query("stream_filter_corpus", sql("SELECT id, license, sha256(code) AS digest FROM kept", "kept"))
def _(spark, sf):
    kept = streams.stream_filter_corpus(corpus_from(stream_of(spark, sf, "documents")), max_chars=MAX_CHARS)
    return _finish(spark, kept.select("id", "license", keys.content_key("code").alias("digest")), "filtered")


@query("stream_resume", sql("SELECT id FROM corpus_fx WHERE length(code) >= 20", "corpus_fx"))
def _(spark, sf):
    out, checkpoint = scratch_path(spark, "resumed"), scratch_path(spark, "resumed-state")
    schema = table(spark, sf, "documents").schema
    for _ in range(2):  # the second run finds nothing new
        streams.stream_resume(
            spark, place(sf, "documents"), out, checkpoint,
            lambda s: corpus_from(s).filter(F.length("code") >= 20).select("id"), schema, "parquet",
        )
    return spark.read.parquet(out)


_LOG = """SELECT event_id AS request_id, 'prov_' || (user_id % 2) AS provider, 'file/' || user_id AS source_file_id,
  CASE event_id % 3 WHEN 0 THEN 'code_gen' WHEN 1 THEN 'explanation' ELSE 'completion' END AS task_type, ts,
  CASE WHEN event_type = 'error' THEN 'timeout' END AS error, event_id % 2500 AS input_tokens,
  (event_id * 17) % 4096 AS output_tokens FROM events"""


# the table's timestamps carry no zone; this reads them as UTC whatever the session's zone is
_UTC = """timestamp_micros((date_diff(CAST(ts AS DATE), DATE'1970-01-01') * 86400L + hour(ts) * 3600 + minute(ts) * 60) * 1000000
  + CAST(extract(SECOND FROM ts) * 1000000 AS BIGINT))"""


def _log(spark, sf):
    return stream_of(spark, sf, "events").selectExpr(
        "event_id AS request_id", "concat('prov_', user_id % 2) AS provider", "concat('file/', user_id) AS source_file_id",
        "CASE event_id % 3 WHEN 0 THEN 'code_gen' WHEN 1 THEN 'explanation' ELSE 'completion' END AS task_type",
        f"{_UTC} AS timestamp", "CASE WHEN event_type = 'error' THEN 'timeout' END AS error",
        "event_id % 2500 AS input_tokens", "(event_id * 17) % 4096 AS output_tokens",
    )


@query("stream_latest",
       sql("""SELECT source_file_id, task_type, request_id, error FROM (SELECT *, row_number() OVER (
                PARTITION BY source_file_id, task_type ORDER BY ts DESC, request_id DESC) AS rn FROM lg) WHERE rn = 1""", lg=_LOG))
def _(spark, sf):
    newest = streams.stream_latest(_log(spark, sf), columns=["request_id", "timestamp", "error"])
    out = scratch_path(spark, "latest")
    streams.run_each_batch(newest, streams.delta_sink(out), scratch_path(spark, "latest-state"))
    return streams.read_latest(spark, out).select("source_file_id", "task_type", "request_id", "error")


@query("stream_dedup", "SELECT DISTINCT sha256(text) AS content_sha FROM documents")
def _(spark, sf):
    files = corpus_from(stream_of(spark, sf, "documents")).withColumn(
        "seen_at", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("doc_id") % 600)
    )
    return _finish(spark, streams.stream_dedup(files, "seen_at").select("content_sha"), "distinct")


@query("stream_progress",
       sql("""SELECT epoch_us(ts) // 21600000000 AS window_no, provider, count(*) AS requests, count(error) AS failures,
                CAST(coalesce(sum(input_tokens) FILTER (error IS NULL), 0) AS BIGINT) AS input_tokens,
                CAST(coalesce(sum(output_tokens) FILTER (error IS NULL), 0) AS BIGINT) AS output_tokens
              FROM lg GROUP BY 1, 2""", lg=_LOG))
def _(spark, sf):
    progress = streams.stream_progress(_log(spark, sf), window="6 hours")
    done = _finish(spark, progress, "progress", "complete")
    number = F.floor(F.unix_micros("window_start") / F.lit(21_600_000_000)).cast("long")
    return done.select(number.alias("window_no"), "provider", "requests", "failures", "input_tokens", "output_tokens")


@query("stream_progress_append",
       sql("""SELECT epoch_us(ts) // 21600000000 AS window_no, provider, count(*) AS requests, count(error) AS failures FROM lg
              WHERE (epoch_us(ts) // 21600000000 + 1) * 21600000000 <= (SELECT max(epoch_us(ts)) FROM lg) - 600000000 GROUP BY 1, 2""", lg=_LOG))
def _(spark, sf):
    # append mode: a window is written once, when the watermark has passed it, and leaves the state
    done = _finish(spark, streams.stream_progress(_log(spark, sf), window="6 hours"), "closed")
    number = F.floor(F.unix_micros("window_start") / F.lit(21_600_000_000)).cast("long")
    return done.select(number.alias("window_no"), "provider", "requests", "failures")


@query("stream_sessions",
       sql("""SELECT min(us) AS start_us, provider, count(*) AS requests, count(error) AS failures FROM (
                SELECT *, sum(fresh) OVER (PARTITION BY provider ORDER BY us, request_id) AS s FROM (
                  SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY provider ORDER BY us, request_id) < 1800000000 THEN 0 ELSE 1 END AS fresh
                  FROM (SELECT *, epoch_us(ts) AS us FROM lg)))
              GROUP BY provider, s HAVING max(us) + 1800000000 <= (SELECT max(epoch_us(ts)) FROM lg) - 600000000""", lg=_LOG))
def _(spark, sf):
    done = _finish(spark, streams.stream_sessions(_log(spark, sf), gap="30 minutes"), "sessions")
    return done.select(F.unix_micros("session_start").alias("start_us"), "provider", "requests", "failures")
