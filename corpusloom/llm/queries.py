"""The operators over the given tables, with the columns that their contracts name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import (
    bpe, forest, hmm, htmltext, jaccard, langid, lexical, licenses, negatives, oracles, packing, quality, topk, warc,
)
from corpusloom.llm.common import table
from querybook.registry import query


@query("op1_langid")
def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op2_forest", oracles.NEAR_VECTORS)
def op2_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op3_hmm")
def op3_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.language_model_scores(table(spark, sf_dir, "documents"))


@query("op4_jaccard", oracles.NEAR_TEXTS)
def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_groups(table(spark, sf_dir, "documents")).drop("text_key", "class_key")


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_htmltext")
def op6_htmltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_texts(table(spark, sf_dir, "pages"))


@query("op7_topk", oracles.TOP_K)
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op8_warc", oracles.ARCHIVES)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_bpe")
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op11_negatives", oracles.HARD_NEGATIVES)
def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


@query("op12_lexical", oracles.RANKED_DOCUMENTS)
def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_licenses", licenses.oracle_sql())
def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))
