"""A dense global row number without gathering the rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import shared_dir

_ROW_BITS = 33  # monotonically_increasing_id keeps the row index in its low 33 bits


def global_row_number(df: DataFrame, order: list[str | Column], alias: str = "row_number",
                      partitions: int | None = None) -> DataFrame:
    """Number the rows 1..n in ``order`` without gaps.

    Rows are range partitioned and sorted, then checkpointed: partition membership and row order
    have to be the same for the counting pass and the numbering pass, also after an executor is
    lost. What is collected is one count per partition. A hash of the row breaks ties, so that
    equal keys do not all land in one range.
    """
    shared_dir(df.sparkSession)
    keys = [*order, F.md5(F.to_json(F.struct(*df.columns)))]
    by_range = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    placed = by_range.sortWithinPartitions(*keys).checkpoint()
    numbered = placed.withColumn("_mid", F.monotonically_increasing_id())
    part = F.shiftright("_mid", _ROW_BITS).cast("int")
    counts = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).orderBy("_part").collect()
    starts, total = [], 0
    for row in counts:
        starts.append((row["_part"], total))
        total += row["_n"]
    offsets = df.sparkSession.createDataFrame(starts, "_part int, _offset long")
    within = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # one row per partition
    joined = numbered.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return joined.withColumn(alias, F.col("_offset") + within + F.lit(1)).select(*df.columns, alias)


def dense_ids(df: DataFrame, order: list[str | Column], prefix: str = "sft", width: int = 5, alias: str = "id",
              keys: list[str] | None = None) -> DataFrame:
    """Ids such as ``sft_00001`` in ``order``; numbers wider than ``width`` keep all their digits.

    ``keys`` names columns that identify a row and that ``order`` is made of: then only they are sorted and
    stored, and the numbers are joined back to the rows. ``df`` is read twice.
    """
    if keys:
        numbered = df.join(global_row_number(df.select(*keys), order, "_n"), keys)
    else:
        numbered = global_row_number(df, order, "_n")
    return numbered.withColumn(alias, F.format_string(f"{prefix}_%0{width}d", "_n")).drop("_n")
