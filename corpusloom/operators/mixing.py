"""Mixing chat sets and their statistics."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.chat import tag_source
from corpusloom.operators.filters import exclude_task_types
from corpusloom.functions.keys import seeded_hash
from corpusloom.operators.ranking import global_row_number
from corpusloom.operators.sampling import SEED, assign_subtypes, sample_n
from corpusloom.operators.quantiles import median, with_positions
from corpusloom.operators.validation import quick_valid, quick_valid_messages

SLOT_BLOCK = 65_536
MIXED_COLUMNS = ["messages", "source", "task_type", "language"]


def mix_sources(
    sources: dict[str, DataFrame],
    domain: str | None = None,
    excluded_task_types: list[str] | None = None,
    keep: list[str] | None = None,
    allow_null_content: bool = True,
) -> DataFrame:
    """Union of labelled chat sets, valid records only (``mix_rejections`` counts the others).

    ``domain`` names the set whose narrating task types are dropped. Fields a set lacks are null
    and therefore absent when written as JSON. ``keep`` passes further columns through, such as the
    id that ``shuffle_rows`` orders by.
    """
    union = _union(sources, domain, excluded_task_types, keep)
    return quick_valid_messages(union, allow_null_content).select(*MIXED_COLUMNS, *(keep or []))


def mix_rejections(sources: dict[str, DataFrame], domain: str | None = None, excluded_task_types: list[str] | None = None,
                   allow_null_content: bool = True) -> DataFrame:
    """``(source, records, kept, rejected)``: what the validity check of ``mix_sources`` does to every set."""
    union = _union(sources, domain, excluded_task_types, None)
    return union.groupBy("source").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(quick_valid(allow_null_content=allow_null_content)).alias("kept"),
    ).withColumn("rejected", F.col("records") - F.col("kept"))


def _union(sources: dict[str, DataFrame], domain: str | None, excluded_task_types: list[str] | None, keep: list[str] | None) -> DataFrame:
    parts = []
    for label, df in sources.items():
        part = tag_source(df, label)
        if label == domain and "task_type" in part.columns:
            part = exclude_task_types(part, excluded_task_types)
        parts.append(part.select(*[c for c in [*MIXED_COLUMNS, *(keep or [])] if c in part.columns]))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    for name in ("task_type", "language"):
        if name not in union.columns:
            union = union.withColumn(name, F.lit(None).cast("string"))
    return union


_FACT = "struct<stat:string,key:string,value:bigint>"


def _facts(df: DataFrame, tags: list[str]) -> DataFrame:
    """Counts ``n`` of every ``(stat, key, value)`` fact of the records: messages per record, and per
    message its length and role, and the record's tags.

    One scan and one aggregation, combined on the map side; its size depends on the number of
    different lengths and tags, not on the number of records. All statistics are read from it.
    """

    def fact(stat: str, key: Column | None = None, value: Column | None = None) -> Column:
        return F.struct(
            F.lit(stat), F.lit(None).cast("string") if key is None else key, F.lit(None) if value is None else value
        ).cast(_FACT)

    messages = F.coalesce("messages", F.array().cast("array<struct<role:string,content:string>>"))
    per_record = [fact("messages", value=F.size(messages))] + [fact(t, F.col(t)) for t in tags]
    lengths = F.transform(messages, lambda m: fact("length", value=F.coalesce(F.length(m["content"]), F.lit(0))))
    roles = F.transform(messages, lambda m: fact("role", F.coalesce(m["role"], F.lit("unknown"))))
    facts = df.select(F.inline(F.concat(F.array(*per_record), lengths, roles)))
    counted = facts.groupBy("stat", "key", "value").agg(F.count(F.lit(1)).alias("n"))
    # totals of zero for an empty set
    nothing = df.sparkSession.range(1).select(
        F.lit("messages").alias("stat"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("long").alias("value"),
        F.lit(0).cast("long").alias("n"),
    )
    return counted.unionByName(nothing)


def _summaries(facts: DataFrame) -> DataFrame:
    """One row per (stat, key): count, mean, median and range of the values."""
    weighted = F.col("value") * F.col("n")
    return with_positions(facts, ["stat", "key"], "value").groupBy("stat", "key").agg(
        F.sum("n").alias("n"), (F.sum(weighted) / F.nullif(F.sum("n"), F.lit(0))).alias("mean"), median("value").alias("median"),
        F.max("value").alias("max"), F.min("value").alias("min"),
    )


def _lines(*lines: tuple[str, Column, Column]) -> Column:
    """Array of report rows to inline; entries without a value are dropped."""
    return F.filter(F.array(*[
        F.struct(F.lit(stat).alias("stat"), key.alias("key"), value.cast("double").alias("value")) for stat, key, value in lines
    ]), lambda r: r["value"].isNotNull())


def mix_stats(df: DataFrame) -> DataFrame:
    """Rows ``(stat, key, value)``: totals, content lengths, records and share per source, messages
    per role."""
    none, key, n = F.lit(None).cast("string"), F.col("key"), F.col("n")
    facts = _facts(df.withColumn("source", F.coalesce("source", F.lit("unknown"))), ["source"])
    # one row per source, role and measure from here on
    total = F.sum("n").over(Window.partitionBy("stat"))
    summary = _summaries(facts).withColumn("share", F.lit(100.0) * n / F.nullif(total, F.lit(0)))
    lines = (
        F.when(F.col("stat") == "messages", _lines(("total_records", none, n)))
        .when(F.col("stat") == "length", _lines(
            ("total_messages", none, n), ("avg_content_len", none, F.col("mean")), ("max_content_len", none, F.col("max")),
            ("min_content_len", none, F.col("min")),
        ))
        .when(F.col("stat") == "source", _lines(("source_count", key, n), ("source_percent", key, F.col("share"))))
        .otherwise(_lines(("role_count", key, n)))
    )
    return summary.select(F.inline(lines))


def chat_stats(df: DataFrame) -> DataFrame:
    """Rows ``(stat, key, value)``: messages per entry and content length (mean, median, range),
    counts by role, source, task type and language; absent keys are skipped."""
    none = F.lit(None).cast("string")
    summary = _summaries(_facts(df, [c for c in ("source", "task_type", "language") if c in df.columns]))

    def measures(label: str) -> list[tuple[str, Column, Column]]:
        return [(f"{label}_{m}", none, F.col(m)) for m in ("mean", "median", "max", "min")]

    tag = F.filter(
        F.array(F.struct("stat", "key", F.col("n").cast("double").alias("value"))), lambda r: r["key"].isNotNull()
    )
    lines = (
        F.when(F.col("stat") == "messages", _lines(("total_entries", none, F.col("n")), *measures("messages")))
        .when(F.col("stat") == "length", _lines(*measures("length")))
        .otherwise(tag)
    )
    return summary.select(F.inline(lines))


def mix_to_proportions(sources: dict[str, DataFrame], proportions: dict[str, float], total: int | None = None, seed: int = SEED,
                       id_col: str = "id") -> DataFrame:
    """Exact samples of the sets in the given proportions, labelled in ``source``.

    ``total`` defaults to the largest number that every set can serve. Counting the sets is one small
    job; the rows are chosen without a shuffle.
    """
    share = sum(proportions.values())
    if total is None:
        total = math.floor(min(sources[k].count() * share / p for k, p in proportions.items() if p > 0))
    parts = [sample_n(sources[k], math.floor(total * p / share), seed, id_col, exact=True).withColumn("source", F.lit(k)) for k, p in proportions.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def interleave(sources: dict[str, DataFrame], probabilities: dict[str, float], seed: int = SEED, id_col: str = "id") -> DataFrame:
    """Rows of the sets in random turns until every set is used up: ``slot``, ``source`` and the rows.

    Each output slot draws its set by hash; the k-th slot of a set takes its row ``k mod n`` in hash order,
    so short sets repeat. Slots are numbered per set from counts of fixed blocks, without gathering them.
    An empty set makes the result empty of it.
    """
    spark = next(iter(sources.values())).sparkSession
    names = [k for k in sources if probabilities.get(k, 0) > 0]
    sizes = {k: sources[k].count() for k in names}
    names = [k for k in names if sizes[k]]
    if not names:
        first = next(iter(sources.items()))
        return first[1].limit(0).select(F.lit(0).cast("long").alias("slot"), F.lit(first[0]).alias("source"), *[F.col(c) for c in first[1].columns if c != "source"])
    shares = {k: probabilities[k] for k in names}
    slots = math.ceil(max(sizes[k] * sum(shares.values()) / shares[k] for k in names) * 1.1) + 100
    while True:
        drawn = assign_subtypes(spark.range(slots).withColumnRenamed("id", "slot"), shares, seed, "slot", "source")
        drawn = drawn.withColumn("_block", F.floor(F.col("slot") / SLOT_BLOCK))
        before = Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        starts = drawn.groupBy("_block", "source").agg(F.count(F.lit(1)).alias("_n")).select(
            "_block", "source", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
        within = F.row_number().over(Window.partitionBy("_block", "source").orderBy("slot")) - 1
        turns = drawn.withColumn("_k", within).join(starts, ["_block", "source"]).withColumn("_k", F.col("_k") + F.col("_start"))
        wanted = F.coalesce(*[F.when(F.col("source") == k, F.lit(n)) for k, n in sizes.items() if n])
        ends = turns.where(F.col("_k") == wanted - 1).agg(F.count(F.lit(1)).alias("n"), F.max("slot").alias("last")).first()
        if ends["n"] == len(names):
            break
        slots *= 2
    turns = turns.where(F.col("slot") <= ends["last"]).select("slot", "source", (F.col("_k") % wanted).alias("_k"))
    rows = []
    for k in names:
        ranked = global_row_number(sources[k].select(F.col(id_col).alias("_id")), [seeded_hash(seed, "_id"), F.col("_id")], "_k")
        rows.append(sources[k].drop("source").join(ranked, F.col(id_col) == F.col("_id")).drop("_id")
                    .withColumns({"_k": F.col("_k") - 1, "source": F.lit(k)}))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return turns.join(union, ["source", "_k"]).drop("_k")
