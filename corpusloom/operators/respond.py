"""Prompts to responses through a function the caller brings."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from corpusloom import schemas
from corpusloom.packaging import ship

# Attempts after the first one and the delay before the first of them.
MAX_RETRIES = 3
BASE_DELAY_SECONDS = 5.0

# a responder maps (messages, max_tokens) to the fields of schemas.RESPONSE it knows
Responder = Callable[[list[dict], int | None], dict]


def respond_with_retry(responder: Responder, messages: list[dict], max_tokens: int | None, max_retries: int,
                       base_delay: float) -> dict:
    """Call with exponential back-off; the last failure becomes a record instead of an exception."""
    for attempt in range(max_retries + 1):
        start = time.monotonic()
        try:
            result = dict(responder(messages, max_tokens))
        except Exception as exc:
            result = {"error": str(exc), "error_type": type(exc).__name__, "input_tokens": 0, "output_tokens": 0}
        result.setdefault("wall_time_ms", round((time.monotonic() - start) * 1000))
        if not result.get("error") or attempt == max_retries:
            return result
        time.sleep(base_delay * 2**attempt + random.uniform(0, min(1.0, base_delay)))
    raise AssertionError("unreachable")


def batch_respond(
    prompts: DataFrame,
    factory: Callable[[], Responder],
    keys: list[str],
    partitions: int | None = None,
    max_retries: int = MAX_RETRIES,
    base_delay: float = BASE_DELAY_SECONDS,
    max_tokens_col: str | None = None,
) -> DataFrame:
    """Answer every prompt; ``factory`` builds one responder per partition (a client, a session).

    ``partitions`` bounds the number of concurrent responders. Rows stream through in Arrow batches,
    so a partition never has to fit in memory. A retried task calls the responder again: results
    are keyed by ``keys``, so write them per batch and rerun through ``resume_remaining``.
    """
    fields = schemas.RESPONSE.fieldNames()
    kept = [*keys, "messages", *([max_tokens_col] if max_tokens_col else [])]
    source = prompts.select(*kept)
    if partitions:
        source = source.repartition(partitions)
    out = StructType([*[source.schema[k] for k in keys], *[StructField(f, schemas.RESPONSE[f].dataType) for f in fields]])

    arrow = to_arrow_schema(StructType([schemas.RESPONSE[f] for f in fields]))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        responder = factory()
        for batch in batches:
            if not batch.num_rows:
                continue
            results = []
            for row in batch.select(["messages", *([max_tokens_col] if max_tokens_col else [])]).to_pylist():
                budget = None if not max_tokens_col or row[max_tokens_col] is None else int(row[max_tokens_col])
                messages = [dict(m) for m in row["messages"] or []]
                results.append(respond_with_retry(responder, messages, budget, max_retries, base_delay))
            columns = [pa.array([r.get(f) for r in results], arrow.field(f).type) for f in fields]
            # keys stay the Arrow columns they came in: no integer passes through a float
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], *columns], [*keys, *fields])

    ship(prompts.sparkSession)
    return source.mapInArrow(answer, out)
