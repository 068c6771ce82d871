"""Shuffling through a buffer of bounded size, as a whole-table operation.

A buffer of B slots is filled with the first B rows; every later row picks a slot, the row that is in it leaves and the new
one takes its place; what is left at the end leaves in a random order. Which row leaves when follows from two numbers: the
place of the row in the input, and the place of the next row that picks the same slot. So no buffer is kept anywhere: rows are
numbered, and each looks for its successor among the rows of its slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.keys import hash_number, seeded_hash
from corpusloom.operators.ranking import global_row_number
from corpusloom.operators.sampling import SEED

BUFFER, TAKEN = 10_000, 500  # fixed values

_HELPERS = ["_k", "_slot", "_next", "_rest"]


def buffer_positions(df: DataFrame, order: list[str], buffer: int = BUFFER, seed: int = SEED, alias: str = "position") -> DataFrame:
    """Rows with the place (from 1) at which they leave a buffer of ``buffer`` slots that they enter in ``order``.

    Rows alike in ``order`` enter by a hash of their content; nulls enter first. The slots share the rows evenly whatever
    they hold, and only the last row of every slot is ranked in one place: at most ``buffer`` rows. A buffer of one slot
    keeps the order. Columns of ``df`` may not be called ``_k``, ``_slot``, ``_next``, ``_rest`` or like ``alias``.
    """
    if buffer < 1:
        raise ValueError("a buffer has at least one slot")
    clash = [c for c in df.columns if c in _HELPERS or c == alias]
    if clash:
        raise ValueError(f"columns with reserved names: {clash}")
    numbered = global_row_number(df, list(order), "_k")
    drawn = hash_number(seeded_hash(seed, "_k")) % F.lit(buffer)
    slots = numbered.withColumn("_slot", F.when(F.col("_k") <= buffer, F.col("_k") - 1).otherwise(drawn))
    following = slots.withColumn("_next", F.lead("_k").over(Window.partitionBy("_slot").orderBy("_k")))
    left = following.where("_next is not null").withColumn(alias, F.col("_next") - F.lit(buffer))
    # the rows at the end: one a slot
    last = following.where("_next is null").withColumn(
        "_rest", F.row_number().over(Window.orderBy(seeded_hash(seed, F.lit("end"), "_k"), "_k")).cast("long"))
    gone = numbered.agg(F.greatest(F.max("_k") - F.lit(buffer), F.lit(0).cast("long"))).scalar()
    ended = last.withColumn(alias, gone + F.col("_rest"))
    return left.unionByName(ended, allowMissingColumns=True).select(*df.columns, alias)


def buffer_shuffle(df: DataFrame, order: list[str], buffer: int = BUFFER, seed: int = SEED, alias: str = "position",
                   keys: list[str] | None = None) -> DataFrame:
    """``buffer_positions``; with ``keys``, columns that identify a row and contain ``order``, only they are numbered and
    stored, and the places are joined back to the rows. ``df`` is read twice then."""
    if not keys:
        return buffer_positions(df, order, buffer, seed, alias)
    return df.join(buffer_positions(df.select(*keys), order, buffer, seed, alias), keys)


def buffer_shuffle_take(df: DataFrame, n: int = TAKEN, order: list[str] | None = None, buffer: int = BUFFER, seed: int = SEED,
                        alias: str = "position") -> DataFrame:
    """The first ``n`` rows that leave the buffer, with their places; all rows if there are fewer.

    They depend on the first ``n + buffer`` rows of the input only: those are found on the ``order`` columns alone (default:
    ``id``), the rest of the table is never numbered, sorted or moved.
    """
    order = order or ["id"]
    place = F.struct(*order)
    edge = df.select(*order).orderBy(*order).limit(n + buffer).agg(F.max(place)).scalar()
    return buffer_positions(df.where(place <= edge), order, buffer, seed, alias).where(F.col(alias) <= n)
