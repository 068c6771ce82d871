"""One row per key, chosen by an explicit order.

``row_number() = 1`` plans as a partial and a final group limit: each map task forwards at most one
row per key, so a key that holds a third of the data costs its reducer one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.keys import digest


def first_per_key(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def dedup_content(df: DataFrame, code: str = "code", stars: str = "stars", id_col: str = "id",
                  duplicates_only: bool = False) -> DataFrame:
    """One row per identical content, the most-starred one (ties: smallest id; null stars last).

    ``duplicates_only=True`` first finds the repeated digests with a narrow aggregation. Where Spark
    broadcasts them (few repeated contents), rows with unique content skip the shuffle of full texts;
    otherwise the joins shuffle texts too, and the default plan is the better one. The input is read
    three times; the result is the same. Where only numbers are wanted, as in
    ``corpus.deduplicated_summary``, no text needs to move at all.
    """
    order = [F.desc_nulls_last(stars), F.asc_nulls_last(id_col)]
    keyed = df.withColumn("_digest", F.coalesce(digest(code), F.lit(b"")))
    if not duplicates_only:
        return first_per_key(keyed, ["_digest"], order).drop("_digest")
    repeated = keyed.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_digest")
    unique = keyed.join(repeated, "_digest", "left_anti")
    shared = keyed.join(repeated, "_digest", "left_semi")
    return unique.select(df.columns).unionByName(first_per_key(shared, ["_digest"], order).select(df.columns))


def latest_per_key(
    df: DataFrame,
    keys: list[str],
    timestamp: str = "timestamp",
    tie: str = "request_id",
    prefer_success: bool = False,
) -> DataFrame:
    """Latest row per key. A late failure hides an earlier success unless ``prefer_success``."""
    order = [F.desc_nulls_last(timestamp), F.desc_nulls_last(tie)]
    if prefer_success:
        success = F.coalesce(F.col("finish_reason") == "stop", F.lit(False))
        order = [success.desc(), *order]
    return first_per_key(df, keys, order)


def latest_texts_per_key(
    df: DataFrame,
    keys: list[str],
    timestamp: str = "timestamp",
    tie: str = "request_id",
    prefer_success: bool = False,
) -> DataFrame:
    """``latest_per_key`` of rows that hold texts: the newest moment of every key is found on narrow rows, and only rows of
    that moment go on. The choice is a predicate, so Spark moves it below joins that bring the texts.

    ``df`` is read twice and has to give the same rows each time. Null keys, timestamps and ties count as in ``latest_per_key``.
    """
    moment = [F.col(timestamp), F.col(tie)]
    if prefer_success:
        moment = [F.coalesce(F.col("finish_reason") == "stop", F.lit(False)), *moment]
    moment = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(moment)])
    key = F.struct(*[F.col(k) for k in keys])
    newest = df.groupBy(*keys).agg(F.max(moment).alias("_moment")).select(F.struct(key.alias("_key"), "_moment").alias("_one"))
    # a struct in a struct: compared as one value, in which nulls are equal
    chosen = df.where(F.struct(F.struct(key.alias("_key"), moment.alias("_moment"))).isin(newest))
    return latest_per_key(chosen, keys, timestamp, tie, prefer_success)


def dedup_across_chunks(df: DataFrame, owner: str = "owner", name: str = "name", order: list[str] | None = None) -> DataFrame:
    """First occurrence per ``owner/name`` over overlapping query slices, in slice order."""
    return first_per_key(df, [owner, name], [F.asc_nulls_last(c) for c in (order or ["chunk_seq", "item_seq"])])
