"""Corpus pipeline: stages over ``documents``, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import jaccard, langid, limits, packing, quality
from corpusloom.llm.common import store, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Share of the held-out documents with a rightly predicted language that score below the threshold of their language
#: and length class; classes take their neighbours along up to so many documents.
LANGUAGE_QUANTILE, LEAST_HELD_OUT = 0.005, 100
#: No threshold is lower. With two classes on both levels every text with a letter scores 0.25 or more.
LEAST_LANGUAGE_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that score like held-out documents of their language; a missing ``lang`` takes the predicted one."""
    model = langid.fit(docs, ~langid.held_out())
    length = F.length("text")
    tried = langid.predict(docs.where(langid.held_out() & F.col("lang").isNotNull()).select("lang", "text", length.alias("length")),
                           model, ["lang", "length"])
    found = limits.limits(tried.where("lang_pred = lang"), F.col("score"), F.col("length"), F.col("lang"), 1000.0,
                          LANGUAGE_QUANTILE, 0.0, LEAST_HELD_OUT)
    least = F.greatest(found.column(F.col("lang_pred"), length, 0), F.lit(LEAST_LANGUAGE_SCORE))
    kept = langid.predict(docs, model, docs.columns).where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= least))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(docs.columns)


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose perplexity lies within what trusted documents of their language show."""
    trusted = quality.trusted_ids(table(spark, sf_dir, "labels"))
    scored = store(quality.score(docs, quality.fit_halves(docs, trusted), docs.columns), "scored-documents")
    *_, kept = quality.accepted(quality.cuts(scored, trusted))
    return scored.where(kept).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return jaccard.keep_one(docs, store(jaccard.similarity_groups(docs), "groups"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document's token pieces placed in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", identify_language),
    ("quality classifier", filter_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("best-fit packing", pack_sequences),
]

# Trained models and MinHash values cannot be written in SQL; tests hold the stages to brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = store(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
