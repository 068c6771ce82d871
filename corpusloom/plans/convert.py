"""Raw records to published subsets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from corpusloom import schemas
from corpusloom.operators import corpus
from corpusloom.sources import jsonl, parquet


@dataclass
class Conversion:
    """Where the results lie, and the (lazy) reports over them."""

    raw_path: str
    corpus_path: str
    config_paths: dict[str, str]
    corpus: DataFrame
    funnel: DataFrame | None
    checks: DataFrame
    summary: DataFrame
    licenses: DataFrame
    ownership: DataFrame


def convert_corpus(
    spark: SparkSession,
    jsonl_path: str,
    out: str,
    rules: list[corpus.Rule] | None = None,
    deduplicate: bool = True,
    skip_filters: bool = False,
    **bounds,
) -> Conversion:
    """Read, snapshot, filter, write and split.

    The two written tables (raw and filtered) also cut the lineage: JSON is parsed once, the raw table is
    scanned once, with the funnel's counts taken in that pass, and the subsets and reports read columns
    of the stored corpus.
    """
    root = out.rstrip("/")
    raw = parquet.raw_snapshot(jsonl.read_jsonl(spark, jsonl_path, schemas.CORPUS_FILE).drop(schemas.CORRUPT), f"{root}/raw")
    observed = None if skip_filters else corpus.observed_funnel(raw, rules, deduplicate, **bounds)
    stored = parquet.raw_snapshot(observed.kept if observed else raw, f"{root}/corpus")
    return Conversion(
        raw_path=f"{root}/raw",
        corpus_path=f"{root}/corpus",
        config_paths=parquet.split_configs(stored, f"{root}/configs"),
        corpus=stored,
        funnel=observed.report() if observed else None,
        checks=corpus.validate_corpus(stored),
        summary=corpus.corpus_summary(stored),
        licenses=corpus.license_distribution(stored),
        ownership=corpus.official_vs_community(stored),
    )
