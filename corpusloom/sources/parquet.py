"""Parquet corpora and the published layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import filters
from corpusloom.sources.jsonl import path_exists

CONFIGS = {
    "all": filters.config_all,
    "official": filters.config_official,
    "community_top": filters.config_community_top,
}


def read_corpus_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet_zstd(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def raw_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Save the unfiltered corpus and go on from the saved copy; later steps never redo the parsing."""
    write_parquet_zstd(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_configs(df: DataFrame, path: str) -> dict[str, str]:
    """Write the three overlapping subsets below ``path``; returns their folders."""
    written = {}
    for name, subset in CONFIGS.items():
        written[name] = f"{path.rstrip('/')}/{name}"
        write_parquet_zstd(df.transform(subset), written[name])
    return written


def publish_layout(spark: SparkSession, configs: dict[str, str], path: str, readme: str) -> list[str]:
    """``<config>/data.parquet`` for every subset that exists, with a README beside them."""
    root, published = path.rstrip("/"), []
    for name, folder in configs.items():
        if path_exists(spark, folder):
            write_parquet_zstd(spark.read.parquet(folder), f"{root}/{name}/data.parquet")
            published.append(name)
    if not published:
        raise FileNotFoundError(f"no subset found among {sorted(configs)}")
    spark.range(1).select(F.lit(readme).alias("value")).write.mode("overwrite").text(f"{root}/README")
    return published
