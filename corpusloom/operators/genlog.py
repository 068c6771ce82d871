"""Generation log: compaction, cleaning, cost and run analytics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.functions import text, usage
from corpusloom.operators import filters
from corpusloom.operators.dedup import latest_texts_per_key
from corpusloom.operators.joins import join_small
from corpusloom.operators.quantiles import median, with_positions

LOG_KEYS = ["source_file_id", "task_type"]
BREAKER_AT = 10  # fixed value: consecutive errors that stop a run


def select_training_columns(df: DataFrame) -> DataFrame:
    return df.select(*schemas.TRAINING_COLUMNS)


def sort_output(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return df.orderBy(*(keys or ["task_type", "source_file_id"]))


def clean_log(df: DataFrame, tie: str = "request_id", prefer_success: bool = False) -> DataFrame:
    """Latest row per file and task, then only complete answers that do not loop. ``df`` is read twice."""
    latest = latest_texts_per_key(df, LOG_KEYS, tie=tie, prefer_success=prefer_success)
    return select_training_columns(filters.filter_degenerate(filters.clean_basic(latest)))


def clean_report(df: DataFrame, tie: str = "request_id", min_ratio: float = filters.MIN_UNIQUE_LINE_RATIO) -> DataFrame:
    """What cleaning keeps and drops, from one pass over the log.

    Every attempt is reduced to its reason, length and loop flag before the keys are grouped, so no text is
    sorted or shuffled; ``max_by`` combines on the map side. A text with so few newlines that even equal lines
    reach ``min_ratio`` is not cut into lines.
    """
    complete = (F.col("finish_reason") == "stop") & (F.length("content") > 0)
    narrow = df.select(
        *LOG_KEYS, "timestamp", F.col(tie).alias("_tie"), "finish_reason", F.length("content").alias("length"),
        F.when(complete, F.when((text.newline_count("content") + 1) * F.lit(min_ratio) <= 1, False)
               .otherwise(text.unique_line_ratio("content") < F.lit(min_ratio))).alias("loops"),
    )
    newest = narrow.groupBy(*LOG_KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.max_by(F.struct("finish_reason", "length", "loops"), F.struct("timestamp", "_tie")).alias("r"),
    ).select("n", "r.*")
    reason, length = F.col("finish_reason"), F.col("length")
    answered = (reason == "stop") & (length > 0)
    loops = answered & F.col("loops")
    return newest.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw"),
        F.count(F.lit(1)).alias("after_dedupe"),
        F.count_if(reason == "length").alias("truncated"),
        F.count_if(reason.isNull()).alias("failed"),
        F.count_if((reason == "stop") & (length == 0)).alias("empty"),
        F.count_if(reason.isNotNull() & ~reason.isin("stop", "length") | (reason == "stop") & length.isNull()).alias("other"),
        F.count_if(loops).alias("degenerate"),
        F.count_if(answered & ~loops).alias("kept"),
    )


def generation_state(df: DataFrame, tasks: list[str]) -> DataFrame:
    """``(id, status)`` per file of the log: ``done`` when every task was tried, ``partial`` before."""
    tried = F.count_distinct(F.when(F.col("task_type").isin(tasks), F.col("task_type")))
    status = F.when(tried == len(tasks), "done").otherwise("partial")
    return df.groupBy(F.col("source_file_id").alias("id")).agg(status.alias("status"))


def count_by_task(df: DataFrame) -> DataFrame:
    return df.groupBy("task_type").agg(F.count(F.lit(1)).alias("n"))


def attach_prices(df: DataFrame, prices: DataFrame) -> DataFrame:
    """Add ``price_in``/``price_out`` per million tokens by provider; unknown providers cost nothing.

    The price table is reduced to one row per provider.
    """
    unique = prices.groupBy("provider").agg(F.max_by(F.struct("price_in", "price_out"), "price_in").alias("_p"))
    zero = F.lit(0.0)
    return join_small(df, unique, "provider").withColumns({
        "price_in": F.coalesce("_p.price_in", zero), "price_out": F.coalesce("_p.price_out", zero),
    }).drop("_p")


def with_costs(df: DataFrame, prices: DataFrame, reported: Column | str = "nw_cost.request_cost_usd") -> DataFrame:
    priced = attach_prices(df, prices)
    estimate = usage.estimated_cost("input_tokens", "output_tokens", "cached_input_tokens", "price_in", "price_out")
    return priced.withColumn("estimated_cost_usd", estimate).withColumn(
        "cost_usd", usage.request_cost(reported, "estimated_cost_usd")
    ).drop("price_in", "price_out")


def succeeded() -> Column:
    return F.col("error").isNull() | (F.col("error") == "")


def provider_summary(df: DataFrame) -> DataFrame:
    """Per provider and approach: requests, tokens and times of the successful ones.

    The middle request time is the upper median. Groups without a success are left out. The log is
    read once, into sums per (provider, approach, outcome, milliseconds); everything else comes
    from that table.
    """
    keys, wall = ["provider", "approach"], F.col("wall_time_ms")
    speed = F.when((wall > 0) & (F.col("output_tokens") > 0), usage.tokens_per_second("output_tokens", wall))
    per_time = df.groupBy(*keys, succeeded().alias("ok"), "wall_time_ms").agg(
        F.count(F.lit(1)).alias("n"), F.sum("input_tokens").alias("i"), F.sum("output_tokens").alias("o"),
        F.sum(speed).alias("speed"), F.count(speed).alias("timed"),
    )
    ok = F.col("ok")
    ms = F.sum(F.when(ok, wall * F.col("n")))
    requests = F.sum(F.when(ok & wall.isNotNull(), F.col("n")))
    return with_positions(per_time, [*keys, "ok"], "wall_time_ms").groupBy(*keys).agg(
        F.sum("n").alias("total"),
        F.coalesce(F.sum(F.when(ok, F.col("n"))), F.lit(0)).alias("completed"),
        F.coalesce(F.sum(F.when(~ok, F.col("n"))), F.lit(0)).alias("failed"),
        (ms / F.lit(1000.0)).alias("elapsed_seconds"),
        F.sum(F.when(ok, F.col("i"))).alias("total_input_tokens"),
        F.sum(F.when(ok, F.col("o"))).alias("total_output_tokens"),
        F.coalesce(F.sum(F.when(ok, F.col("speed"))) / F.nullif(F.sum(F.when(ok, F.col("timed"))), F.lit(0)), F.lit(0.0))
        .alias("avg_tok_per_sec"),
        (median(F.when(ok, wall), upper=True) / F.lit(1000.0)).alias("p50_request_seconds"),
        (ms / F.lit(1000.0) / requests).alias("avg_request_seconds"),
    ).filter("completed > 0")


def generation_totals(
    df: DataFrame,
    cost: Column | str = "cost_usd",
    energy: Column | str = "nw_energy.energy_joules",
    balance: Column | str = "nw_cost.allowance_remaining_usd",
    remaining_pairs: int = 0,
) -> DataFrame:
    """Pairs, errors, cost, energy, speed and the last known balance of a run (one row)."""

    def col(c):
        return F.col(c) if isinstance(c, str) else c

    ok = succeeded()
    seen = F.unix_micros(F.col("timestamp").cast("timestamp"))
    known = ok & col(balance).isNotNull()
    totals = df.agg(
        F.count_if(ok).alias("pairs"),
        F.count_if(~ok).alias("errors"),
        F.coalesce(F.sum(F.when(ok, col(cost))), F.lit(0.0)).alias("cost_usd"),
        F.coalesce(F.sum(F.when(ok, col(energy))), F.lit(0.0)).alias("energy_joules"),
        ((F.max(seen) - F.min(seen)) / F.lit(1e6)).alias("elapsed_seconds"),
        F.max_by(F.when(known, col(balance)), F.when(known, F.col("timestamp"))).alias("last_balance_usd"),
    )
    pairs, elapsed = F.col("pairs"), F.col("elapsed_seconds")
    return totals.withColumns({
        "energy_kwh": F.col("energy_joules") / F.lit(3.6e6),
        "pairs_per_second": F.when(elapsed > 0, pairs / elapsed).otherwise(0.0),
        "eta_seconds": F.when(pairs > 0, elapsed / pairs * F.lit(remaining_pairs)).otherwise(0.0),
    })


def budget_cutoff(df: DataFrame, limit: float, balance: str = "balance", seq: str = "request_seq") -> DataFrame:
    """Rows up to and including the first success whose remaining balance is below ``limit``.

    The stopping point per provider is one ``min`` (combined map-side), not a running sum over all
    rows of a provider.
    """
    position = F.struct("timestamp", seq)
    breach = succeeded() & (F.col(balance) < limit)
    stops = df.filter(breach).groupBy("provider").agg(F.min(position).alias("_stop"))
    return (
        join_small(df, stops, "provider")
        .filter(F.col("_stop").isNull() | (position <= F.col("_stop"))).drop("_stop")
    )


def error_streaks(df: DataFrame, seq: str = "request_seq", breaker: int = BREAKER_AT, slices: int | None = None) -> DataFrame:
    """Per provider: longest run of consecutive errors, number of runs, and runs of ``breaker`` or more.

    A window over a whole provider would put it into one task. The log's narrow rows are range-partitioned
    by provider, time and sequence number; each range finds its own runs, and the runs that touch a border
    are stitched from one summary row per range. ``slices`` sets the number of ranges; by default the
    session's shuffle settings do, so that ranges stay of one size however long the log is.
    """
    order = ["provider", "_ts", "_seq"]
    log = df.select("provider", F.unix_micros(F.col("timestamp").cast("timestamp")).alias("_ts"), F.col(seq).alias("_seq"),
                    (~succeeded()).alias("_err"))
    ranged = log.repartitionByRange(slices, *order) if slices else log.repartitionByRange(*order)
    sliced = ranged.withColumn("_slice", F.spark_partition_id())
    spot = ["_slice"]
    whole = Window.partitionBy("provider", *spot)
    inside = whole.orderBy("_ts", "_seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fine = F.count_if(~F.col("_err"))
    runs = (
        sliced.withColumns({"_island": fine.over(inside), "_top": fine.over(whole)})
        .groupBy("provider", *spot, "_top", "_island").agg(F.count_if("_err").alias("_len"))
    )
    # island 0 touches the left border of its slice, the highest island the right border
    length, island, top = F.col("_len"), F.col("_island"), F.col("_top")
    middle = (island > 0) & (island < top) & (length > 0)
    per_slice = runs.groupBy("provider", *spot, "_top").agg(
        F.max(F.when(middle, length)).alias("longest"), F.count_if(middle).alias("runs"),
        F.count_if(middle & (length >= breaker)).alias("breaks"),
        F.coalesce(F.max(F.when(island == 0, length)), F.lit(0)).alias("_lead"),
        F.coalesce(F.max(F.when(island == top, length)), F.lit(0)).alias("_trail"),
    )
    # the lead of a slice continues the run before it, its trail starts a new one; a slice without any
    # success is one piece that lets a run pass through
    piece = "struct<starts:int,len:bigint>"
    lead, trail = F.struct(F.lit(0), "_lead").cast(piece), F.struct(F.lit(1), "_trail").cast(piece)
    pieces = F.when(top == 0, F.array(lead)).otherwise(F.array(lead, trail))
    chain = Window.partitionBy("provider").orderBy(*spot, "starts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.col("starts") == 0
    stitched = (
        per_slice.select("provider", *spot, "longest", "runs", "breaks", F.inline(pieces))
        .withColumn("_run", F.sum("starts").over(chain)).groupBy("provider", "_run").agg(
            F.sum("len").alias("_len"), F.max(F.when(first, F.col("longest"))).alias("longest"),
            F.sum(F.when(first, F.col("runs"))).alias("runs"), F.sum(F.when(first, F.col("breaks"))).alias("breaks"),
        )
    )
    zero = F.lit(0)
    return stitched.groupBy("provider").agg(
        F.greatest(F.max("_len"), F.coalesce(F.max("longest"), zero)).alias("longest_streak"),
        (F.count_if(F.col("_len") > 0) + F.coalesce(F.sum("runs"), zero)).alias("streaks"),
        (F.count_if(F.col("_len") >= breaker) + F.coalesce(F.sum("breaks"), zero)).alias("breaker_streaks"),
    )


def most_common(df: DataFrame, key: str) -> DataFrame:
    """Counts per value, largest first."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key)
