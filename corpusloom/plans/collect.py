"""Saved search pages and source trees to corpus records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.keys import repo_key
from corpusloom.operators import filters, registry
from corpusloom.operators.dedup import dedup_across_chunks
from corpusloom.session import scratch_path
from corpusloom.sources.jsonl import append_records
from corpusloom.sources.parquet import raw_snapshot
from corpusloom.sources.registry_json import page_items, parse_package_items, parse_repo_items, read_pages
from corpusloom.sources.trees import extract_files


def discover_repos(search_items: DataFrame, package_items: DataFrame) -> DataFrame:
    """Distinct, enriched repositories. ``search_items``: ``item`` JSON, ``chunk_seq``, ``item_seq``;
    ``package_items``: ``item`` JSON, ``seq``."""
    repos = dedup_across_chunks(parse_repo_items(search_items, keep=["chunk_seq", "item_seq"]))
    return registry.enrich_repos(repos.drop("chunk_seq", "item_seq"), parse_package_items(package_items))


def discover_saved(spark: SparkSession, search_pages: str | list[str], package_pages: str | list[str]) -> DataFrame:
    """:func:`discover_repos` from folders of saved pages: search pages hold ``items``, package pages are bare arrays. A page
    is a query slice; packages are read in the order of their pages."""
    found = page_items(read_pages(spark, search_pages)).withColumnRenamed("page_seq", "chunk_seq")
    packages = page_items(read_pages(spark, package_pages, "$"))
    return discover_repos(found, packages.withColumn("seq", F.struct("page_seq", "item_seq")))


def repos_to_process(repos: DataFrame, state: DataFrame, skip_non_permissive: bool = True,
                     done_statuses: list[str] | None = None, force: bool = False) -> DataFrame:
    """The cheap repository filters come before any file is read."""
    wanted = filters.keep_permissive_repos(repos) if skip_non_permissive else repos
    keyed = filters.prefilter_repos(wanted).withColumn("key", repo_key("owner", "name"))
    return registry.resume_remaining(keyed, state, ["key"], done_statuses, force)


def collect_files(repos: DataFrame, tree: DataFrame, extension: str, official_owners: list[str], corpus_path: str | None = None,
                  **bounds) -> DataFrame:
    """Corpus records of the repositories at hand. ``tree``: ``repo_owner, repo_name, path, content``."""
    described = repos.select(
        F.col("owner").alias("repo_owner"), F.col("name").alias("repo_name"), F.col("url").alias("repo_url"),
        F.col("description").alias("repo_description"), "stars", "license_raw", "authors", "package", "package_downloads",
        "fork", "archived",
    )
    records = extract_files(tree.join(described, ["repo_owner", "repo_name"]), extension, official_owners, **bounds)
    if not corpus_path:
        return records
    # one extraction: stored as a batch of its own, then read for the log and for the caller
    spark = repos.sparkSession
    stored = raw_snapshot(records, scratch_path(spark, "batch"))
    append_records(stored, corpus_path)
    return stored


def collection_state(repos: DataFrame, records: DataFrame) -> DataFrame:
    """State rows of a finished batch: how many files every repository gave."""
    files = records.groupBy(repo_key("repo_owner", "repo_name").alias("key")).agg(
        F.count(F.lit(1)).cast("int").alias("files"), F.max("commit_sha").alias("commit_sha")
    )
    found = repos.select("key").join(files, "key", "left")
    return found.select(
        "key", F.when(F.col("files").isNull(), "no_files").otherwise("collected").alias("status"),
        F.lit(None).cast("string").alias("error"), F.coalesce("files", F.lit(0)).alias("files"), "commit_sha",
        F.unix_micros(F.current_timestamp()).cast("double").alias("ts"),
    ).withColumn("ts", F.col("ts") / F.lit(1e6))
