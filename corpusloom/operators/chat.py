"""Chat records: conversion between formats, rendering, masks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.operators.joins import maybe_joins
from corpusloom.operators.prompts import PromptBook, message, user_message

# Default system messages and the license of generated records.
GENERAL_SYSTEM = "You are a helpful assistant."
CODING_SYSTEM = "You are a helpful programming assistant."
RECORD_LICENSE = "Apache-2.0"


def join_training_to_corpus(training: DataFrame, corpus: DataFrame, tie: str | None = None) -> DataFrame:
    """Training rows with the code and repository of their source file. A file id occurring more
    than once in the corpus counts once: its last record by ``tie``.

    The corpus is cut down to the wanted ids before any text is shuffled: a key filter of bounded size
    drops nearly all other rows where they are read. So ``training`` is used twice; pass a stored table
    rather than a long plan. A reader that asks for no column of the file moves ids alone.
    """
    columns = ["code", "repo_name", "repo_url"]
    order = [tie] if tie else ["repo_url", F.sha2("code", 256)]
    ids = training.select(F.col("source_file_id").alias("id")).where("id IS NOT NULL").distinct()
    wanted = maybe_joins(corpus, ids, "id").join(ids, "id", "left_semi")
    files = wanted.groupBy(F.col("id").alias("source_file_id")).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_file"))
    return training.join(files.select("source_file_id", *[F.col(f"_file.{c}") for c in columns]), "source_file_id")


def missing_in_corpus(training: DataFrame, corpus: DataFrame) -> DataFrame:
    return training.join(corpus.select(F.col("id").alias("source_file_id")), "source_file_id", "left_anti")


def to_chat_record(
    joined: DataFrame,
    book: PromptBook,
    license_col: Column | None = None,
    schema_version: int = 1,
) -> DataFrame:
    """Rebuild system, user and assistant messages of joined training rows. Ids come from
    ``dense_ids`` over the result."""
    system = message("system", F.lit(book.system_prompt))
    user = message("user", user_message(book, seed_cols=("source_file_id",)))
    return joined.select(
        "source_file_id", F.col("repo_url").alias("source_repo_url"),
        F.array(system, user, message("assistant", F.col("content"))).alias("messages"), "task_type",
        F.lit(None).cast("string").alias("source_language"), F.col("model").alias("model_used"),
        (F.lit(RECORD_LICENSE) if license_col is None else license_col).alias("license"),
        F.lit(schema_version).alias("schema_version"),
    )


def sharegpt_to_chat(df: DataFrame, system: str = CODING_SYSTEM) -> DataFrame:
    """``from``/``value`` turns to roles; every speaker but ``human`` is the assistant."""
    turns = F.transform("conversations", lambda t: F.struct(
        F.when(t["from"] == "human", "user").otherwise("assistant").alias("role"), t["value"].alias("content"),
    ))
    return df.withColumn("messages", F.concat(F.array(message("system", F.lit(system))), turns)).drop("conversations")


def pair_to_chat(df: DataFrame, system: str = CODING_SYSTEM) -> DataFrame:
    pair = F.array(
        message("system", F.lit(system)), message("user", F.col("input")), message("assistant", F.col("output"))
    )
    return df.withColumn("messages", pair).drop("input", "output")


def ensure_system(df: DataFrame, system: str = GENERAL_SYSTEM) -> DataFrame:
    has_system = F.coalesce(F.exists("messages", lambda m: F.coalesce(m["role"] == "system", F.lit(False))), F.lit(False))
    prefixed = F.concat(F.array(message("system", F.lit(system))), "messages")
    return df.withColumn("messages", F.when(has_system, F.col("messages")).otherwise(prefixed))


def tag_source(df: DataFrame, label: str) -> DataFrame:
    """Set ``source`` where there is none. Typed rows cannot tell an absent key from a null one."""
    present = F.col("source") if "source" in df.columns else F.lit(None).cast("string")
    return df.withColumn("source", F.coalesce(present, F.lit(label)))


@dataclass(frozen=True)
class ChatTemplate:
    """Markers of the rendered text (fixed values by default)."""

    turn_start: str = "<|turn>"
    turn_end: str = "<turn|>\n"
    bos: str = "<bos>"
    assistant: str = "model"

    def role(self, m: Column) -> Column:
        return F.when(m["role"] == "assistant", F.lit(self.assistant)).otherwise(F.coalesce(m["role"], F.lit("")))

    def head(self, m: Column) -> Column:
        return F.concat(F.lit(self.turn_start), self.role(m), F.lit("\n"))

    def body(self, m: Column) -> Column:
        return F.concat(F.coalesce(m["content"], F.lit("")), F.lit(self.turn_end))


def strip_bos(col: Column | str, template: ChatTemplate = ChatTemplate()) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.startswith(template.bos), F.substring(c, len(template.bos) + 1, F.length(c))).otherwise(c)


def render_chat(messages: Column | str = "messages", template: ChatTemplate = ChatTemplate()) -> Column:
    """Messages as one training text, without the begin-of-text marker."""
    parts = F.transform(messages, lambda m: F.concat(template.head(m), template.body(m)))
    return strip_bos(F.array_join(parts, ""), template)


def response_spans(messages: Column | str = "messages", template: ChatTemplate = ChatTemplate()) -> Column:
    """Character ranges ``[start, end)`` of the assistant parts of the rendered text, end marker
    included: the text a loss on responses looks at."""
    span = "array<struct<start:bigint,end:bigint>>"
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(span).alias("spans"))

    def step(acc, m):
        begin = acc["at"] + F.length(template.head(m))
        end = begin + F.length(template.body(m))
        here = F.array(F.struct(begin.alias("start"), end.alias("end")))
        spans = F.when(m["role"] == "assistant", F.concat(acc["spans"], here)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(messages, start, step, lambda acc: acc["spans"])


def language_counts(df: DataFrame) -> DataFrame:
    """Rows per language; run it before records without a final answer are dropped."""
    return df.groupBy("language").agg(F.count(F.lit(1)).alias("n"))


def convert_sharegpt(df: DataFrame, languages: list[str] | None, source: str) -> DataFrame:
    """Language filter, role conversion, final-answer check, source label."""
    from corpusloom.operators.filters import filter_languages, require_assistant_last

    chats = require_assistant_last(sharegpt_to_chat(filter_languages(df, languages)))
    return chats.select("messages", F.lit(source).alias("source"), "language")


CHAT_COLUMNS = schemas.CHAT_RECORD.fieldNames()
