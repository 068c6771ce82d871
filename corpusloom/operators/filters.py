"""Row predicates. A null predicate drops the row, as in SQL, unless noted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import licenses, text

# Size bounds, name pattern, loop threshold, thresholds of the top subset.
MAX_FILE_CHARS = 50_000
MIN_FILE_CHARS = 20
NAME_PATTERNS = ["exercism"]
MIN_UNIQUE_LINE_RATIO = 0.3
TOP_STARS = 10
TOP_DOWNLOADS = 1000
EXCLUDED_TASK_TYPES = ["explanation"]
FUNCTIONAL_LANGUAGES = ["haskell", "elixir", "erlang", "scala", "clojure", "fsharp", "ocaml", "lisp"]


# --- corpus files -----------------------------------------------------------------------------


def not_generated(max_chars: int = MAX_FILE_CHARS) -> Column:
    return F.length("code") <= max_chars


def not_stub(min_chars: int = MIN_FILE_CHARS) -> Column:
    return F.length("code") >= min_chars


def licensed_or_packaged() -> Column:
    return F.col("license").isNotNull() | F.col("package").isNotNull()


def not_copyleft() -> Column:
    return F.col("license").isNull() | ~F.col("license").isin(licenses.COPYLEFT)


def name_free_of(patterns: list[str] | None = None) -> Column:
    """Neither owner nor name matches, ignoring case; a null owner or name drops the row."""
    pattern = "(?i)" + "|".join(patterns or NAME_PATTERNS)
    return ~F.col("repo_owner").rlike(pattern) & ~F.col("repo_name").rlike(pattern)


def filter_generated(df: DataFrame, max_chars: int = MAX_FILE_CHARS) -> DataFrame:
    return df.filter(not_generated(max_chars))


def filter_stubs(df: DataFrame, min_chars: int = MIN_FILE_CHARS) -> DataFrame:
    return df.filter(not_stub(min_chars))


def filter_unlicensed(df: DataFrame) -> DataFrame:
    return df.filter(licensed_or_packaged())


def filter_non_permissive(df: DataFrame) -> DataFrame:
    return df.filter(not_copyleft())


def filter_name_patterns(df: DataFrame, patterns: list[str] | None = None) -> DataFrame:
    return df.filter(name_free_of(patterns))


def exclude_repos(df: DataFrame, names: list[str]) -> DataFrame:
    names = [n for n in names if n is not None]
    return df.filter(~F.col("repo_name").isin(names)) if names else df


def token_budget_chars(max_tokens: float, template_chars: int, chars_per_token: float = text.CHARS_PER_TOKEN) -> int:
    """Characters of code that fit in a token budget beside the prompt template."""
    return int((max_tokens - template_chars / chars_per_token) * chars_per_token)


def filter_token_budget(df: DataFrame, max_tokens: float | None, template_chars: int) -> DataFrame:
    if not max_tokens or max_tokens <= 0:
        return df
    return df.filter(F.length("code") <= token_budget_chars(max_tokens, template_chars))


# --- published subsets ------------------------------------------------------------------------


def config_all(df: DataFrame) -> DataFrame:
    return df.filter(F.col("license").isNotNull())


def config_permissive(df: DataFrame) -> DataFrame:
    return df.filter(F.col("license").isin(licenses.PERMISSIVE))


def config_official(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_official"))


def config_community_top(df: DataFrame, stars: int = TOP_STARS, downloads: int = TOP_DOWNLOADS) -> DataFrame:
    popular = (F.col("stars") >= stars) | (F.col("package_downloads") >= downloads)
    return df.filter(~F.col("is_official") & popular)


# --- repositories -----------------------------------------------------------------------------


def keep_permissive_repos(df: DataFrame) -> DataFrame:
    """Unknown license strings are removed, missing ones kept."""
    return df.filter(F.col("license_raw").isNull() | licenses.is_permissive("license_raw"))


def prefilter_repos(df: DataFrame) -> DataFrame:
    return df.filter(F.col("license_raw").isNotNull() | F.col("package").isNotNull())


# --- generation log ---------------------------------------------------------------------------


def usable_response() -> Column:
    return (F.col("finish_reason") == "stop") & F.col("content").isNotNull() & (F.length("content") > 0)


def clean_basic(df: DataFrame) -> DataFrame:
    return df.filter(usable_response())


def filter_degenerate(df: DataFrame, min_ratio: float = MIN_UNIQUE_LINE_RATIO) -> DataFrame:
    """Drop responses that loop, i.e. repeat most of their lines."""
    return df.filter(text.unique_line_ratio("content") >= F.lit(min_ratio))


def degenerate_rejects(df: DataFrame, min_ratio: float = MIN_UNIQUE_LINE_RATIO) -> DataFrame:
    """The rows ``filter_degenerate`` drops, with their ratio."""
    return df.withColumn("unique_line_ratio", text.unique_line_ratio("content")).filter(
        F.col("unique_line_ratio") < F.lit(min_ratio)
    )


# --- chat records -----------------------------------------------------------------------------


def exclude_task_types(df: DataFrame, task_types: list[str] | None = None) -> DataFrame:
    """Rows without a task type stay."""
    excluded = EXCLUDED_TASK_TYPES if task_types is None else task_types
    return df.filter(F.col("task_type").isNull() | ~F.col("task_type").isin(excluded)) if excluded else df


def filter_languages(df: DataFrame, languages: list[str] | None = None) -> DataFrame:
    return df.filter(F.col("language").isin(languages or FUNCTIONAL_LANGUAGES))


def require_assistant_last(df: DataFrame) -> DataFrame:
    return df.filter(F.try_element_at("messages", F.lit(-1))["role"] == "assistant")
