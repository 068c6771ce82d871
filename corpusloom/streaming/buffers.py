"""A shuffle buffer for streams: one held row per slot, kept in the state store."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from corpusloom.functions.keys import hash_number, seeded_hash
from corpusloom.operators.sampling import SEED
from corpusloom.operators.shuffling import BUFFER
from corpusloom.packaging import ship

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Slot(StatefulProcessor):
    """Holds the newest row of a slot; the row before it leaves."""

    def __init__(self, schema: StructType) -> None:
        self.schema = schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", self.schema)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        names = self.schema.fieldNames()
        held = self.held.get() if self.held.exists() else None
        for row in rows:
            if held is not None:
                yield Row(*names)(*held)
            held = tuple(row[c] for c in names)
        if held is not None:
            self.held.update(held)

    def close(self) -> None:
        pass


def stream_buffer_shuffle(rows: DataFrame, keys: list[str], buffer: int = BUFFER, seed: int = SEED) -> DataFrame:
    """Rows leave in another order than they arrive in: each takes the slot that the hash of ``keys`` names, and the row
    held there leaves. The state never holds more than ``buffer`` rows, whatever the stream's length.

    ``keys`` should tell rows apart: rows alike in them pass through one slot, one after the other, which is slow but
    holds no more. What is still held when a run ends is read with :func:`buffered_rows`; a later run with the same
    checkpoint goes on from there. Append mode.
    """
    spark = rows.sparkSession
    ship(spark)
    if spark.conf.get(_PROVIDER, None) != _ROCKSDB:  # the only store with more than one kind of state
        spark.conf.set(_PROVIDER, _ROCKSDB)
    slot = hash_number(seeded_hash(seed, *keys)) % F.lit(buffer)
    schema = StructType([f for f in rows.schema.fields])
    return rows.withColumn("_slot", slot).groupBy("_slot").transformWithState(Slot(schema), schema, "append", "none")


def buffered_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The rows that the last batch of a finished run left in the buffer."""
    state = spark.read.format("statestore").option("stateVarName", "held").load(checkpoint)
    return state.select("value.*")
