"""The corpus funnel, its reports and the published subsets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.functions.keys import digest
from corpusloom.functions.licenses import normalize_license
from corpusloom.operators import filters
from corpusloom.operators.dedup import dedup_content, first_per_key

Rule = tuple[str, Column]
DEDUP_STEP = "dedup_content"


def with_license(df: DataFrame, strict: bool = False) -> DataFrame:
    return df.withColumn("license", normalize_license("license_raw", strict))


def corpus_rules(
    max_chars: int = filters.MAX_FILE_CHARS,
    min_chars: int = filters.MIN_FILE_CHARS,
    patterns: list[str] | None = None,
    skip: tuple[str, ...] = (),
) -> list[Rule]:
    """The per-file rules in funnel order; ``skip`` leaves some out by name."""
    rules = [
        ("filter_generated", filters.not_generated(max_chars)),
        ("filter_stubs", filters.not_stub(min_chars)),
        ("filter_unlicensed", filters.licensed_or_packaged()),
        ("filter_non_permissive", filters.not_copyleft()),
        ("filter_name_patterns", filters.name_free_of(patterns)),
    ]
    return [(name, rule) for name, rule in rules if name not in skip]


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """All rules at once: Catalyst fuses them into one filter over one scan."""
    for _, rule in rules:
        df = df.filter(rule)
    return df


def filter_corpus(df: DataFrame, rules: list[Rule] | None = None, deduplicate: bool = True, duplicates_only: bool = False,
                  **bounds) -> DataFrame:
    """The funnel. ``duplicates_only`` is the plan of ``dedup_content`` for long, mostly distinct texts."""
    kept = apply_rules(df, corpus_rules(**bounds) if rules is None else rules)
    return dedup_content(kept, duplicates_only=duplicates_only) if deduplicate else kept


def first_failed(rules: list[Rule]) -> Column:
    """Index of the first rule a row fails, null when it passes all."""
    failed = F.when(F.lit(False), F.lit(-1))
    for i, (_, rule) in enumerate(rules):
        failed = failed.when(~F.coalesce(rule, F.lit(False)), F.lit(i))
    return failed


@dataclass
class ObservedFunnel:
    """``kept`` and, once it has been written or collected, the funnel's counts from that same pass."""

    kept: DataFrame
    names: list[str]
    scanned: Observation
    result: Observation

    def report(self) -> DataFrame:
        """Rows as those of :func:`funnel_report`. Waits for the first action on ``kept``."""
        counts, rows = self.scanned.get, []
        before = counts["total"]
        for i, name in enumerate(self.names):
            removed = self.result.get["kept"] if name == DEDUP_STEP else counts[f"r{i}"]
            removed = before - removed if name == DEDUP_STEP else removed
            rows.append((i + 1, name, before, removed, before - removed))
            before -= removed
        return self.kept.sparkSession.createDataFrame(rows, "step int, step_name string, before long, removed long, after long")


def observed_funnel(df: DataFrame, rules: list[Rule] | None = None, deduplicate: bool = True, **bounds) -> ObservedFunnel:
    """:func:`filter_corpus` with its counts taken on the way: metrics of the rows that the job reads anyway.

    Every row's first failing rule decides, so a single filter follows; what the rules leave is counted again behind the
    deduplication. An action on ``kept`` must run before the report, once.
    """
    rules = corpus_rules(**bounds) if rules is None else rules
    scanned, result = Observation(), Observation()
    tagged = df.withColumn("_failed", first_failed(rules)).observe(
        scanned, F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("_failed") == i).alias(f"r{i}") for i in range(len(rules))])
    kept = tagged.where("_failed is null").drop("_failed")
    if deduplicate:
        kept = dedup_content(kept)
    return ObservedFunnel(kept.observe(result, F.count(F.lit(1)).alias("kept")), [name for name, _ in rules] + [DEDUP_STEP] * deduplicate, scanned, result)


def funnel_report(df: DataFrame, rules: list[Rule] | None = None, deduplicate: bool = True, **bounds) -> DataFrame:
    """Rows ``(step, step_name, before, removed, after)`` from one scan.

    Rows are grouped by their first failing rule; distinct contents are counted over digests of the
    surviving rows only. The running subtraction works on the one aggregated row.
    """
    rules = corpus_rules(**bounds) if rules is None else rules
    failed = first_failed(rules)
    survivor_key = F.when(F.col("_failed").isNull(), F.coalesce(digest("code"), F.lit(b"")))
    tagged = df.withColumn("_failed", failed).select("_failed", survivor_key.alias("_key"))
    aggregates = [F.count(F.lit(1)).alias("total")]
    aggregates += [F.count_if(F.col("_failed") == i).alias(f"r{i}") for i in range(len(rules))]
    if deduplicate:
        aggregates.append(F.count_distinct("_key").alias("distinct_kept"))
    totals = tagged.agg(*aggregates)

    steps, before = [], F.col("total")
    for i, (name, _) in enumerate(rules):
        removed = F.col(f"r{i}")
        steps.append((name, before, removed))
        before = before - removed
    if deduplicate:
        steps.append((DEDUP_STEP, before, before - F.col("distinct_kept")))
    rows = [
        F.struct(
            F.lit(i).alias("step"), F.lit(name).alias("step_name"), start.alias("before"),
            removed.alias("removed"), (start - removed).alias("after"),
        )
        for i, (name, start, removed) in enumerate(steps, 1)
    ]
    return totals.select(F.inline(F.array(*rows)))


def corpus_summary(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Files, distinct repositories (null counts as one), lines and characters."""
    distinct = F.approx_count_distinct("repo_url") if approximate else F.count_distinct("repo_url")
    null_repo = F.coalesce(F.max(F.when(F.col("repo_url").isNull(), 1)), F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("files"),
        (distinct + null_repo).alias("repos"),
        F.coalesce(F.sum(text.newline_count("code")), F.lit(0)).alias("newlines"),
        F.coalesce(F.sum(F.length("code")), F.lit(0)).alias("chars"),
    ).select("files", "repos", (F.col("newlines") + F.col("files")).alias("lines"), "chars")


def deduplicated_summary(df: DataFrame, stars: str = "stars", id_col: str = "id") -> DataFrame:
    """``corpus_summary`` of the rows that ``dedup_content`` keeps, without shuffling a text: lines and
    characters are counted first, then one narrow row per content is chosen."""
    narrow = df.select(
        F.coalesce(digest("code"), F.lit(b"")).alias("_digest"), F.col(stars).alias("_stars"), F.col(id_col).alias("_id"), "repo_url",
        text.newline_count("code").alias("_newlines"), F.length("code").alias("_chars"))
    kept = first_per_key(narrow, ["_digest"], [F.desc_nulls_last("_stars"), F.asc_nulls_last("_id")])
    null_repo = F.coalesce(F.max(F.when(F.col("repo_url").isNull(), 1)), F.lit(0))
    return kept.agg(
        F.count(F.lit(1)).alias("files"), (F.count_distinct("repo_url") + null_repo).alias("repos"),
        (F.coalesce(F.sum("_newlines"), F.lit(0)) + F.count(F.lit(1))).alias("lines"), F.coalesce(F.sum("_chars"), F.lit(0)).alias("chars"),
    )


def license_distribution(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("license").isNotNull()).groupBy("license").agg(F.count(F.lit(1)).alias("files"))
        .orderBy(F.desc("files"), "license")
    )


def official_vs_community(df: DataFrame) -> DataFrame:
    """Rows with an unknown flag count as community."""
    return df.agg(
        F.count_if(F.col("is_official")).alias("official"), F.count(F.lit(1)).alias("_total")
    ).select("official", (F.col("_total") - F.col("official")).alias("community"))


def duplicate_ids(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Number of rows whose id occurs more than once (nulls are equal)."""
    return (
        df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("duplicate_rows"))
    )


def validate_corpus(df: DataFrame, large_chars: int = 100_000) -> DataFrame:
    """Failed checks as ``(check_name, n)``; an empty result means a clean corpus.

    Grouping by id lets one shuffle of narrow rows serve all four checks.
    """
    flags = df.select(
        "id",
        (F.length("code") == 0).alias("empty"),
        F.col("license").isNull().alias("unlicensed"),
        (F.length("code") > large_chars).alias("large"),
    )
    per_id = flags.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("empty").alias("empty"),
        F.count_if("unlicensed").alias("unlicensed"), F.count_if("large").alias("large"),
    )
    totals = per_id.agg(
        F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("duplicate_ids"), F.sum("empty").alias("empty_code"),
        F.sum("unlicensed").alias("missing_license"), F.sum("large").alias("large_files"),
    )
    checks = ["duplicate_ids", "empty_code", "missing_license", "large_files"]
    rows = [F.struct(F.lit(c).alias("check_name"), F.coalesce(F.col(c), F.lit(0)).alias("n")) for c in checks]
    return totals.select(F.inline(F.array(*rows))).filter("n > 0")


def config_flags(df: DataFrame) -> DataFrame:
    """Membership of every row in the three published subsets, in one pass."""
    popular = (F.col("stars") >= filters.TOP_STARS) | (F.col("package_downloads") >= filters.TOP_DOWNLOADS)
    return df.withColumns({
        "in_all": F.col("license").isNotNull(),
        "in_official": F.coalesce(F.col("is_official"), F.lit(False)),
        "in_community_top": F.coalesce(~F.col("is_official") & popular, F.lit(False)),
    })
