"""Sampling, splitting and ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import ranking, sampling
from querybook.fixtures import corpus_fx, sql, table
from querybook.registry import query

_ORDER = "ORDER BY md5('42|' || id), id"
_N5 = "CAST(('0x' || substr(md5('42|' || id), 1, 8))::BIGINT AS BIGINT)"


@query("shuffle_rows", sql("SELECT id, row_number() OVER (ORDER BY md5('42|' || id), id) AS place FROM corpus_fx", "corpus_fx"))
def _(spark, sf):
    # the sorted frame is numbered to show its order in an unordered comparison
    shuffled = sampling.shuffle_rows(corpus_fx(spark, sf).select("id"))
    return ranking.global_row_number(shuffled, [sampling.seeded_hash(42, "id"), F.col("id")], "place")


@query("sample_n", sql(f"SELECT id FROM corpus_fx {_ORDER} LIMIT 100", "corpus_fx"))
def _(spark, sf):
    return sampling.sample_n(corpus_fx(spark, sf), 100).select("id")


@query("sample_n_repeated_ids", "SELECT CAST(25 AS BIGINT) AS n")
def _(spark, sf):
    # a few hundred documents share each of nine ids; exactly 25 rows come out
    docs = table(spark, sf, "documents").select((F.col("doc_id") % 9).alias("id"), F.col("doc_id").alias("row"))
    return sampling.sample_n(docs, 25, exact=True).agg(F.count_distinct("row").alias("n"))


@query("sample_large_n",
       sql(f"SELECT event_id FROM events ORDER BY md5('42|' || CAST(event_id AS STRING)), event_id LIMIT 20000"))
def _(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    return sampling.sample_n(events, 20_000, id_col="event_id").select("event_id")


@query("shuffle_take", sql("SELECT id FROM corpus_fx ORDER BY md5('7|' || id), id LIMIT 30", "corpus_fx"))
def _(spark, sf):
    return sampling.shuffle_take(corpus_fx(spark, sf), 30, seed=7).select("id")


@query("train_eval_split",
       sql(f"SELECT id, CASE WHEN {_N5} < CAST(floor(0.05 * 4294967296) AS BIGINT) THEN 'eval' ELSE 'train' END AS split FROM corpus_fx",
           "corpus_fx"))
def _(spark, sf):
    return sampling.train_eval_split(corpus_fx(spark, sf)).select("id", "split")


@query("train_eval_split_exact",
       sql("""SELECT id, CASE WHEN rn <= ceil(0.05::DOUBLE * n) THEN 'eval' ELSE 'train' END AS split FROM (
                SELECT id, row_number() OVER (ORDER BY md5('42|' || id), id) AS rn, count(*) OVER () AS n FROM corpus_fx)""",
           "corpus_fx"))
def _(spark, sf):
    return sampling.train_eval_split(corpus_fx(spark, sf), exact=True).select("id", "split")


@query("dense_ids",
       sql("""SELECT doc_id, 'sft_' || CASE WHEN rn < 100000 THEN lpad(CAST(rn AS STRING), 5, '0') ELSE CAST(rn AS STRING) END AS id
              FROM (SELECT doc_id, row_number() OVER (ORDER BY repo_name, id) AS rn FROM corpus_fx)""", "corpus_fx"))
def _(spark, sf):
    files = corpus_fx(spark, sf).select("doc_id", "repo_name", F.col("id").alias("file_id"))
    return ranking.dense_ids(files, ["repo_name", "file_id"]).select("doc_id", "id")


_CLASSED = """SELECT id, md5('42|' || id) AS h, is_official,
  CASE WHEN loc < 3 THEN 'simple' WHEN loc < 8 THEN 'medium' ELSE 'complex' END AS cx,
  CASE WHEN split_part(file_path, '/', 1) IN ('src','test','examples') THEN split_part(file_path, '/', 1) ELSE 'other' END AS sc,
  CASE WHEN is_official THEN 'official' WHEN stars >= 10 THEN 'community_top' ELSE 'community' END AS tier
  FROM (SELECT *, len(string_split(code, chr(10))) AS loc FROM corpus_fx)"""
_P1 = "SELECT * FROM cl WHERE is_official ORDER BY h, id LIMIT 4"
_P2 = """SELECT * EXCLUDE (rn, q) FROM (SELECT *, row_number() OVER (PARTITION BY cx ORDER BY h, id) AS rn,
  CASE cx WHEN 'complex' THEN 6 ELSE 7 END - (SELECT count(*) FROM p1 WHERE p1.cx = cl.cx) AS q
  FROM cl WHERE id NOT IN (SELECT id FROM p1)) WHERE rn <= q"""
_P3 = """SELECT * EXCLUDE (rn, q) FROM (SELECT *, row_number() OVER (PARTITION BY sc ORDER BY h, id) AS rn,
  CASE sc WHEN 'src' THEN 10 WHEN 'test' THEN 6 WHEN 'examples' THEN 4 ELSE 0 END
    - (SELECT count(*) FROM (SELECT sc FROM p1 UNION ALL SELECT sc FROM p2) s WHERE s.sc = cl.sc) AS q
  FROM cl WHERE id NOT IN (SELECT id FROM p1) AND id NOT IN (SELECT id FROM p2))
  WHERE rn <= q AND (SELECT count(*) FROM p1) + (SELECT count(*) FROM p2) < 60"""
_P4 = """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (ORDER BY h, id) AS rn FROM cl
  WHERE id NOT IN (SELECT id FROM p1 UNION ALL SELECT id FROM p2 UNION ALL SELECT id FROM p3))
  WHERE rn <= 60 - (SELECT count(*) FROM p1) - (SELECT count(*) FROM p2) - (SELECT count(*) FROM p3)"""
_PICKED = """SELECT *, 1 AS phase FROM p1 UNION ALL SELECT *, 2 FROM p2 UNION ALL SELECT *, 3 FROM p3
  UNION ALL SELECT *, 4 FROM p4"""
_PHASES = {"cl": _CLASSED, "p1": _P1, "p2": _P2, "p3": _P3, "p4": _P4, "pk": _PICKED}


@query("stratified_sample",
       sql("SELECT id, phase, cx AS complexity, sc AS source_class, tier FROM pk", "corpus_fx", **_PHASES))
def _(spark, sf):
    sample = sampling.stratified_sample(corpus_fx(spark, sf), n=60, simple_below=3, medium_below=8)
    return sample.select("id", "phase", "complexity", "source_class", "tier")


_SQL_5000 = {"cl": _CLASSED, "p1": _P1, "p2": _P2, "p3": _P3.replace("< 60", "< 5000"), "p4": _P4.replace("60 -", "5000 -"), "pk": _PICKED}


@query("stratified_sample_large",
       sql("SELECT id, phase, cx AS complexity, sc AS source_class, tier FROM pk", "corpus_fx", **_SQL_5000))
def _(spark, sf):
    sample = sampling.stratified_sample(corpus_fx(spark, sf), n=5_000, simple_below=3, medium_below=8)
    return sample.select("id", "phase", "complexity", "source_class", "tier")


@query("sample_summary",
       sql("""SELECT 'complexity' AS dimension, cx AS value, count(*) AS n FROM cl GROUP BY cx
              UNION ALL SELECT 'source_class', sc, count(*) FROM cl GROUP BY sc
              UNION ALL SELECT 'tier', tier, count(*) FROM cl GROUP BY tier""", "corpus_fx", cl=_CLASSED))
def _(spark, sf):
    return sampling.sample_summary(sampling.classify(corpus_fx(spark, sf), 3, 8))
