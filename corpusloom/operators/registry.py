"""Repository discovery, enrichment and collection bookkeeping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.keys import owner_repo

SEARCH_RESULT_LIMIT = 1000  # fixed value: most results one search query returns


def enrich_repos(repos: DataFrame, packages: DataFrame) -> DataFrame:
    """Attach package data by link, else by name, and fill empty licenses.

    Both lookups are unique per key before the joins, so no repository is multiplied and neither
    join can explode on a popular name. The match is taken as one struct: fields of a link match
    and a name match never mix. ``packages`` comes from ``parse_package_items``.
    """
    match = F.struct(F.col("name").alias("package"), "package_downloads", F.col("license_raw").alias("package_license"))
    by_link = (
        packages.filter(F.col("github_owner_repo").isNotNull() & (F.col("github_owner_repo") != ""))
        .groupBy(F.col("github_owner_repo").alias("_link")).agg(F.max_by(match, "position").alias("_by_link"))
    )
    by_name = packages.groupBy(F.col("name").alias("_name")).agg(F.max_by(match, "position").alias("_by_name"))
    joined = (
        repos.withColumns({"_link": owner_repo("owner", "name"), "_name": F.lower("name")})
        .join(by_link, "_link", "left").join(by_name, "_name", "left")
        .withColumn("_match", F.coalesce("_by_link", "_by_name"))
    )
    filled = F.coalesce(
        F.nullif("license_raw", F.lit("")), F.nullif(F.col("_match.package_license"), F.lit("")), F.col("license_raw")
    )
    return joined.select(
        *[filled.alias("license_raw") if c == "license_raw" else F.col(c) for c in repos.columns
          if c not in ("package", "package_downloads")],
        F.col("_match.package").alias("package"), F.col("_match.package_downloads").alias("package_downloads"),
    )


def resume_remaining(
    work: DataFrame,
    state: DataFrame,
    keys: list[str],
    done_statuses: list[str] | None = None,
    force: bool = False,
) -> DataFrame:
    """Work that the state table does not list as done. Without ``done_statuses`` any entry counts,
    failed ones too."""
    if force:
        return work
    done = state if done_statuses is None else state.filter(F.col("status").isin(done_statuses))
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def chunk_counts(found: DataFrame, owner: str = "owner", name: str = "name", chunk: str = "chunk_seq",
                 item: str = "item_seq") -> DataFrame:
    """Per query slice: rows found, repositories not seen in an earlier slice, running total.

    The running total orders the slices, of which there are as many as search queries.
    """
    home = found.groupBy(owner, name).agg(F.min(chunk).alias(chunk))
    new = home.groupBy(chunk).agg(F.count(F.lit(1)).alias("new"))
    total = found.groupBy(chunk).agg(F.count(F.lit(1)).alias("found"))
    running = Window.orderBy(chunk).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return total.join(new, chunk, "left").select(
        chunk, "found", F.coalesce("new", F.lit(0)).alias("new"),
        F.sum(F.coalesce("new", F.lit(0))).over(running).alias("cumulative"),
        (F.col("found") > SEARCH_RESULT_LIMIT).alias("over_limit"),
    )


def limit_repos(repos: DataFrame, n: int, order: list[str]) -> DataFrame:
    return repos.orderBy(*order).limit(n)


def enrichment_stats(enriched: DataFrame) -> DataFrame:
    """Discovered, matched and skipped repositories, by reason, in one pass over the enriched set.

    License removal comes first; a repository counts once.
    """
    from corpusloom.functions.licenses import is_permissive

    bad_license = F.col("license_raw").isNotNull() & ~is_permissive("license_raw")
    unknown = F.col("license_raw").isNull() & F.col("package").isNull()
    return enriched.agg(
        F.count(F.lit(1)).alias("discovered"),
        F.count_if(F.col("package").isNotNull()).alias("enriched"),
        F.count_if(bad_license).alias("skipped_license"),
        F.count_if(unknown).alias("skipped_unlicensed"),
        F.count_if(~bad_license & ~unknown).alias("to_process"),
    )


def collection_stats(state: DataFrame, no_files_status: str = "no_files") -> DataFrame:
    """Processed, failed and empty repositories, and files collected, from the state table."""
    return state.agg(
        F.count_if(F.col("status") == "collected").alias("processed"),
        F.count_if(F.col("status") == "error").alias("failed"),
        F.count_if(F.col("status") == no_files_status).alias("no_files"),
        F.coalesce(F.sum(F.when(F.col("status") == "collected", F.col("files"))), F.lit(0)).alias("files_collected"),
    )
