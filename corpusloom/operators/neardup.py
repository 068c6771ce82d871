"""Near duplicates among instructions or other texts, by MinHash bands and exact verification.

Shingles, hashes, signatures and bands are built-in expressions. A band names a list of sets that may be similar; the
lists are compared as those of the exact join are: members with a hub first, then, in tiles, only pairs that are not
connected yet. Sets that merely share bands are never united, so a common passage joins nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.setjoin import THRESHOLD, WORDS, named_groups, similar_sets, stored, text_sets

BANDS, ROWS = 32, 4  # a pair at the threshold shares no band with probability 5e-8


def band_lists(sets: DataFrame) -> DataFrame:
    """``_token, _id, _n, _pos`` of every band of every set, without bounds. Each set's bands are stored."""
    # one row per shingle meets all hash functions in one generated aggregation
    signed = sets.select("_id", "_n", F.explode("_set").alias("_s")).groupBy("_id", "_n").agg(
        *[F.min(F.xxhash64("_s", F.lit(k))).alias(f"h{k}") for k in range(BANDS * ROWS)])
    bands = F.array(*[F.xxhash64(F.lit(b), *[f"h{b * ROWS + r}" for r in range(ROWS)]) for b in range(BANDS)])
    return stored(signed.select("_id", "_n", bands.alias("_bands")), "bands").select(F.explode("_bands").alias("_token"), "_id", "_n", F.lit(0).alias("_pos"))


def near_duplicate_groups(df: DataFrame, text_col: str = "text", id_col: str = "id", words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """``(id, group_id)`` of every row: texts whose shingle sets have a Jaccard similarity of ``threshold``
    or more are in one group, directly or through others; ``group_id`` is its smallest id.

    Null and blank texts are groups of their own. Equal shingle sets are compared once.
    """
    rows, sets = text_sets(df, text_col, id_col, words)
    return named_groups(rows, similar_sets(sets, threshold, band_lists(sets)).groups, id_col)


def near_dedup_minhash(df: DataFrame, text_col: str = "text", id_col: str = "id", words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """The row with the smallest id of every group of near duplicates. Ids are meant to be unique."""
    groups = near_duplicate_groups(df, text_col, id_col, words, threshold)
    dropped = groups.where(F.col(id_col) != F.col("group_id")).select(id_col)
    return df.join(dropped, id_col, "left_anti").select(*df.columns)
