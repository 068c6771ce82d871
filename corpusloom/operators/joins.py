"""Joining a large table with a per-provider sized one; cutting a large table down before a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 10_000
FILTER_BITS = 1 << 24  # of a key filter: at most 262,144 words of 64 bits are broadcast, whatever the number of keys


def small_table(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame | None:
    """``df`` as a local table when it has at most ``max_rows`` rows, else None. Fetches
    ``max_rows + 1`` rows at most."""
    rows = df.limit(max_rows + 1).collect()
    return None if len(rows) > max_rows else df.sparkSession.createDataFrame(rows, df.schema)


def join_small(big: DataFrame, small: DataFrame, on: str | list[str], how: str = "left", max_rows: int = SMALL_ROWS) -> DataFrame:
    """Broadcast ``small`` after checking that it has at most ``max_rows`` rows, else join by shuffle.

    Join keys such as a provider name have few values, each with a large share of the rows, so a
    shuffle on them would be badly skewed.
    """
    local = small_table(small, max_rows)
    return big.join(small if local is None else F.broadcast(local), on, how)


def maybe_joins(big: DataFrame, keys: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """``big`` without most of the rows whose ``key`` is not in ``keys``; an exact join still has to follow.

    The hashes of the keys set bits, and only the words that hold a set bit are broadcast, so the rows that go are gone
    before any shuffle. A table of many more keys than bits lets more rows pass and broadcasts no more. Keys of two types
    have different hashes: then all rows stay.
    """
    if big.schema[key].dataType != keys.schema[key].dataType:
        return big
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    words = keys.select(place.alias("_place")).groupBy(F.shiftright("_place", 6).alias("_filter_word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(_place & 63 AS int)))").alias("_filter_bits"))
    known = (F.shiftright(place, 6) == F.col("_filter_word")) & (F.getbit("_filter_bits", place.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return big.join(F.broadcast(words), known, "left_semi")
