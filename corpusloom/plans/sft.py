"""Corpus to chat data: sample, prompt, answer, clean, convert, mix, split, render."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.keys import pick
from corpusloom.operators import chat, filters, genlog, mixing, prompts, ranking, registry, respond, sampling
from corpusloom.sources.jsonl import append_records
from corpusloom.sources.parquet import raw_snapshot


def load_files(corpus: DataFrame, max_files: int, seed: int = sampling.SEED, excluded_repos: list[str] | None = None,
               max_input_tokens: int | None = None, book: prompts.PromptBook | None = None) -> DataFrame:
    """Files to prompt: repositories left out, oversized files dropped, sampled and shuffled."""
    files = filters.exclude_repos(corpus, excluded_repos or [])
    files = filters.filter_token_budget(files, max_input_tokens, book.template_chars() if book else 0)
    files = files.select("id", "code", "file_path", "repo_name", "repo_url", "stars")
    return sampling.shuffle_rows(sampling.sample_n(files, max_files, seed), seed + 1)


def generate(files: DataFrame, state: DataFrame, book: prompts.PromptBook, factory: Callable[[], respond.Responder],
             provider: str, model: str, log_path: str, tasks: list[str] | None = None,
             done_statuses: list[str] | None = None, force: bool = False, batches: int = 1, **options) -> None:
    """Answer the files the state does not list and append the log. ``state``: ``id``, ``status``.

    Each of the ``batches`` (files split by hash) is committed on its own; after a crash, build the
    state with ``genlog.generation_state`` and run again. The file columns travel with the prompts:
    no shuffle follows the responder, so a lost executor cannot cause answered batches to be asked
    again.
    """
    todo = registry.resume_remaining(files, state, ["id"], done_statuses, force).withColumns({
        "source_file_path": F.col("file_path"), "source_repo": F.col("repo_name"), "source_stars": F.col("stars"),
    })
    described = ["source_file_path", "source_repo", "source_stars"]
    for batch in range(batches):
        part = todo.filter(pick(book.seed, batches, "id") == batch) if batches > 1 else todo
        built = prompts.build_prompts(part, book, tasks, described).withColumn(
            "request_id", F.concat_ws("_", F.lit(provider), F.md5(F.concat_ws("|", "source_file_id", "task_type")))
        )
        answered = respond.batch_respond(
            built, factory, ["request_id", "source_file_id", "task_type", "approach", *described],
            max_tokens_col="max_tokens", **options
        )
        append_records(answered.withColumns({
            "provider": F.lit(provider), "model": F.lit(model),
            "timestamp": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"),
        }), log_path)


def chat_records(log: DataFrame, corpus: DataFrame, book: prompts.PromptBook, training_path: str, tie: str = "request_id",
                 prefix: str = "sft") -> DataFrame:
    """Clean the log into ``training_path``, rebuild the conversations and number them in order."""
    training = raw_snapshot(genlog.clean_log(log, tie=tie), training_path)
    records = chat.to_chat_record(chat.join_training_to_corpus(training, corpus), book)
    return ranking.dense_ids(records, ["task_type", "source_file_id"], prefix).select(chat.CHAT_COLUMNS)


def training_text(sources: dict[str, DataFrame], domain: str | None = None, seed: int = sampling.SEED, id_col: str = "id",
                  template: chat.ChatTemplate = chat.ChatTemplate()) -> DataFrame:
    """Mixed, shuffled, split and rendered: ``id, split, text, spans``."""
    mixed = mixing.mix_sources(sources, domain, keep=[id_col])
    split = sampling.train_eval_split(sampling.shuffle_rows(mixed, seed, id_col), seed=seed, id_col=id_col)
    return split.select(
        id_col, "source", "split", chat.render_chat("messages", template).alias("text"),
        chat.response_spans("messages", template).alias("spans"),
    )
