"""Counts over increments: one small row of mergeable sketches per load, united without reading old loads again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRECISION = 12  # logarithm of the sketch's size: a relative standard error of 1.6 %


def load_sketch(df: DataFrame, load: str, repo: str = "repo_url", code: str = "code", precision: int = PRECISION) -> DataFrame:
    """``load, files, chars, lines, repos, contents``: exact sums, and sketches of the distinct repositories and contents.

    Null repositories count as one, as in ``corpus_summary``; null contents count as empty. An empty load gives zeros.
    """
    text = F.coalesce(code, F.lit(""))
    return df.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("chars"),
        F.coalesce(F.sum(F.when(text == "", 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)), F.lit(0)).alias("lines"),
        F.hll_sketch_agg(F.coalesce(F.col(repo).cast("string"), F.lit("\u0000")), precision).alias("repos"),
        F.hll_sketch_agg(F.md5(text), precision).alias("contents"),
    ).select(F.lit(load).alias("load"), "*")


def united(sketches: DataFrame) -> DataFrame:
    """``loads, files, chars, lines, repos, contents`` over all loads; the last two are estimates. A load that is stored twice
    counts once."""
    once = sketches.dropDuplicates(["load"])
    return once.agg(
        F.count(F.lit(1)).alias("loads"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("files", "chars", "lines")],
        *[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).alias(c) for c in ("repos", "contents")])


def error_bound(precision: int = PRECISION, deviations: float = 3) -> float:
    """Relative error that an estimate stays below but for about one case in 370."""
    return deviations * 1.04 / 2 ** (precision / 2)


def sketch_loads(loads: dict[str, DataFrame], **columns) -> DataFrame:
    return reduce(DataFrame.unionByName, [load_sketch(df, name, **columns) for name, df in loads.items()])
