"""Buffered shuffles, the best copy in a stream, and tables stored by key."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.keys import hash_number, seeded_hash
from corpusloom.operators import genlog as log_ops
from corpusloom.operators import shuffling
from corpusloom.operators.dedup import first_per_key
from corpusloom.session import scratch_path
from corpusloom.sources import bucketed
from corpusloom.sources.parquet import raw_snapshot
from corpusloom.streaming import buffers, streams
from querybook.chat import training
from querybook.fixtures import corpus_from, corpus_fx, gen_fx, sql, table
from querybook.registry import query
from querybook.streams import stream_of

BUCKETS = 32


def _positions(size: int) -> str:
    """Rows leave when the next row of their slot arrives, the last row of every slot at the end."""
    return f"""
  placed AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS k FROM documents),
  slots AS (SELECT *, CASE WHEN k <= {size} THEN k - 1
    ELSE CAST(('0x' || substr(md5('42|' || k), 1, 8))::BIGINT AS BIGINT) % {size} END AS slot FROM placed),
  following AS (SELECT *, lead(k) OVER (PARTITION BY slot ORDER BY k) AS next FROM slots),
  positions AS (SELECT doc_id, text, next - {size} AS position FROM following WHERE next IS NOT NULL
    UNION ALL SELECT doc_id, text, greatest((SELECT count(*) FROM documents) - {size}, 0)
      + row_number() OVER (ORDER BY md5('42|end|' || k), k) FROM following WHERE next IS NULL)"""


@query("buffer_shuffle", f"WITH {_positions(100)} SELECT doc_id, CAST(position AS BIGINT) AS position FROM positions")
def _(spark, sf):
    return shuffling.buffer_shuffle(table(spark, sf, "documents").select("doc_id"), ["doc_id"], buffer=100)


@query("buffer_shuffle_take",
       f"""WITH {_positions(10_000)} SELECT doc_id, md5(text) AS digest, CAST(position AS BIGINT) AS position FROM positions
           WHERE position <= 500""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    taken = shuffling.buffer_shuffle_take(docs, order=["doc_id"])
    return taken.select("doc_id", F.md5("text").alias("digest"), "position")


@query("stream_buffer_shuffle",
       """SELECT CAST(('0x' || substr(md5('42|' || doc_id), 1, 8))::BIGINT AS BIGINT) % 100 AS slot, count(*) - 1 AS n_left,
            CAST(1 AS BIGINT) AS n_held, CAST(sum(doc_id) AS BIGINT) AS ids FROM documents GROUP BY 1""")
def _(spark, sf):
    # which of a batch's rows is held depends on the order of arrival; their numbers and their union do not
    rows = stream_of(spark, sf, "documents").select("doc_id", "text")
    out, checkpoint = scratch_path(spark, "shuffled"), scratch_path(spark, "shuffled-state")
    streams.run_available(buffers.stream_buffer_shuffle(rows, ["doc_id"], buffer=100), out, checkpoint)
    both = spark.read.schema(rows.schema).parquet(out).withColumn("held", F.lit(0)).unionByName(
        buffers.buffered_rows(spark, checkpoint).withColumn("held", F.lit(1)))
    slot = hash_number(seeded_hash(42, "doc_id")) % F.lit(100)
    return both.groupBy(slot.alias("slot")).agg(F.count_if(F.col("held") == 0).alias("n_left"), F.count_if(F.col("held") == 1).alias("n_held"),
                                                F.sum("doc_id").alias("ids"))


@query("stream_dedup_best",
       sql("""SELECT id, stars, sha256(coalesce(code, '')) AS content_sha FROM (
                SELECT *, row_number() OVER (PARTITION BY coalesce(code, ''), g ORDER BY stars DESC, id) AS rn,
                  max(doc_id) OVER (PARTITION BY coalesce(code, ''), g) AS last FROM (
                    SELECT *, sum(fresh) OVER (PARTITION BY coalesce(code, '') ORDER BY doc_id, id) AS g FROM (
                      SELECT *, CASE WHEN doc_id - lag(doc_id) OVER (PARTITION BY coalesce(code, '') ORDER BY doc_id, id) < 200.25 THEN 0
                        ELSE 1 END AS fresh FROM corpus_fx)))
              WHERE rn = 1 AND last + 200.25 <= (SELECT max(doc_id) FROM corpus_fx) - 200.25""", "corpus_fx"))
def _(spark, sf):
    files = corpus_from(stream_of(spark, sf, "documents")).withColumn(
        "seen_at", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("doc_id")))
    best = streams.stream_dedup_best(files, "seen_at", "200250 milliseconds", columns=["id", "stars"])
    out = scratch_path(spark, "best")
    streams.run_available(best, out, scratch_path(spark, "best-state"))
    return spark.read.schema(best.schema).parquet(out)


@query("join_co_located",
       sql("""SELECT t.source_file_id, t.task_type, t.model, c.repo_url, md5(c.code) AS digest
              FROM train_fx t JOIN corpus_fx c ON c.id = t.source_file_id""", "train_fx"))
def _(spark, sf):
    files = first_per_key(corpus_fx(spark, sf).select("id", "code", "repo_url"), ["id"], [F.desc("repo_url")])
    corpus = bucketed.write_bucketed(raw_snapshot(files, scratch_path(spark, "files")), scratch_path(spark, "by-id"), "id", BUCKETS, 1)
    log = bucketed.write_bucketed(training(spark, sf), scratch_path(spark, "by-file"), "source_file_id", BUCKETS)
    return bucketed.join_co_located(log, corpus).select("source_file_id", "task_type", "model", "repo_url", F.md5("code").alias("digest"))


@query("latest_co_located",
       sql("SELECT source_file_id, task_type, request_seq, finish_reason, md5(content) AS digest FROM latest", "latest"))
def _(spark, sf):
    stored = raw_snapshot(gen_fx(spark, sf), scratch_path(spark, "log"))
    log = bucketed.write_bucketed(stored, scratch_path(spark, "log-by-file"), "source_file_id", BUCKETS, 50)
    newest = bucketed.latest_co_located(log, log_ops.LOG_KEYS, tie="request_seq")
    return newest.select("source_file_id", "task_type", "request_seq", "finish_reason", F.md5("content").alias("digest"))
