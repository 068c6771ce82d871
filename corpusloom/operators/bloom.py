"""Deduplicating a load against a published corpus without moving the corpus.

The digests of the published contents are entered into a Bloom filter: every task sets bits, and the words of the filter
are merged by OR. A row of the load that the filter does not know is new for certain. The others are joined with the
published rows of their digests, which settles the few that the filter was wrong about.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.keys import digest
from corpusloom.operators.dedup import first_per_key
from corpusloom.packaging import ship
from corpusloom.session import scratch_path

BITS = 1 << 26  # 8 MB: a filter for five million contents with one error in a thousand


def filter_bits(expected: int, error: float = 0.001) -> int:
    """Bits for ``expected`` contents at a share ``error`` of wrong hits, a multiple of 64."""
    return max(64, -(-math.ceil(-expected * math.log(error) / math.log(2) ** 2) // 64) * 64)


def hash_count(bits: int, expected: int) -> int:
    return min(16, max(1, round(bits / max(expected, 1) * math.log(2))))


def positions(key: Column, bits: int, hashes: int) -> Column:
    """Bits of a key, by two hashes of it."""
    first, step = F.pmod(F.xxhash64(key, F.lit(0)), F.lit(bits)), F.pmod(F.xxhash64(key, F.lit(1)), F.lit(bits - 1)) + 1
    return F.transform(F.sequence(F.lit(0), F.lit(hashes - 1)), lambda i: F.pmod(first + i * step, F.lit(bits)))


def bloom_filter(keys: DataFrame, key: str, bits: int, hashes: int) -> np.ndarray:
    """The filter's words. Tasks combine their bits before the shuffle; at most ``bits / 64`` words reach the driver."""
    words = keys.select(F.explode(positions(F.col(key), bits, hashes)).alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias("b"))
    rows = words.toPandas()
    out = np.zeros(bits // 64, np.int64)
    out[rows["w"].to_numpy(np.int64)] = rows["b"].to_numpy(np.int64)
    return out


def maybe_known(df: DataFrame, key: str, words: np.ndarray, hashes: int) -> DataFrame:
    """``df`` with ``_maybe``: false only for keys that were not entered. Only bit positions are sent to Python."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(words)
    bits = 64 * len(words)

    @F.pandas_udf("boolean")
    def look(places: pd.Series) -> pd.Series:
        at = np.stack(places.to_numpy()).astype(np.int64) if len(places) else np.zeros((0, hashes), np.int64)
        return pd.Series(((shared.value[at >> 6] >> (at & 63)) & 1).all(axis=1))

    return df.withColumn("_maybe", look(positions(F.col(key), bits, hashes)))


@dataclass
class LoadDedup:
    """``added``: rows of the load to append. ``replaced``: id and digest of published rows that a better copy replaces.
    ``suspected``: rows of the load that the filter held for known, ``known``: those that are."""

    added: DataFrame
    replaced: DataFrame
    suspected: int
    known: int

    def merged(self, published: DataFrame, code: str = "code", id_col: str = "id") -> DataFrame:
        """The published rows that stay, and the added ones."""
        gone = self.replaced.select(F.col(id_col).alias("_gone"), "_digest")
        kept = published.withColumn("_own", F.coalesce(digest(code), F.lit(b"")))
        kept = kept.join(gone, (F.col("_own") == F.col("_digest")) & F.col(id_col).eqNullSafe(F.col("_gone")), "left_anti").drop("_own")
        return kept.unionByName(self.added, allowMissingColumns=True)


def dedup_load(load: DataFrame, published: DataFrame, bits: int = BITS, code: str = "code", stars: str = "stars", id_col: str = "id") -> LoadDedup:
    """What a load changes in a corpus whose contents are distinct: afterwards the corpus is ``dedup_content`` of both.

    One row per content stays, the most-starred one (ties: smallest id; null stars last); of a published and a loaded row that
    are alike in both the published one. ``bits`` sets the filter's size: it is the bound of what is broadcast, and with
    more contents than it is made for only more rows are joined. The published texts are read to be digested, never shuffled.
    """
    spark = load.sparkSession
    bits = max(64, bits // 64 * 64)
    order = [F.desc_nulls_last(stars), F.asc_nulls_last(id_col), F.asc("_side")]
    known = published.select(F.col(id_col), F.col(stars), F.coalesce(digest(code), F.lit(b"")).alias("_digest"))
    path = scratch_path(spark, "digests")
    known.write.parquet(path)  # narrow: the texts are read and digested once
    known = spark.read.schema(known.schema).parquet(path).withColumn("_side", F.lit(0))
    hashes = hash_count(bits, known.count())
    words = bloom_filter(known, "_digest", bits, hashes)

    keyed = first_per_key(load.withColumns({"_digest": F.coalesce(digest(code), F.lit(b"")), "_side": F.lit(1)}), ["_digest"], order)
    path = scratch_path(spark, "load")
    looked = maybe_known(keyed, "_digest", words, hashes)
    looked.write.partitionBy("_maybe").parquet(path)
    stored = spark.read.schema(looked.schema).parquet(path)
    suspects = stored.where("_maybe").select("_digest", id_col, stars, "_side")
    rivals = known.join(suspects.select("_digest"), "_digest", "left_semi").select("_digest", id_col, stars, "_side")
    contest = suspects.unionByName(rivals)
    place = scratch_path(spark, "contest")
    first_per_key(contest, ["_digest"], order).write.parquet(place)
    winners = spark.read.parquet(place)
    lost = winners.where("_side = 0").select("_digest")
    added = stored.join(lost, "_digest", "left_anti").select(*load.columns)
    replaced = rivals.join(winners.where("_side = 1").select("_digest"), "_digest", "left_semi").select(id_col, "_digest")
    return LoadDedup(added, replaced, suspects.count(), rivals.select("_digest").distinct().count())
