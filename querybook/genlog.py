"""Generation log."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import usage
from corpusloom.operators import dedup, filters
from corpusloom.operators import genlog as ops
from querybook.fixtures import gen_fx, sql
from querybook.registry import query

PRICES = [("prov_a", 0.35, 0.75), ("prov_c", 0.039, 0.18)]  # prov_b has no price
_COST_SQL = """SELECT *, CASE provider WHEN 'prov_a' THEN
    greatest(0, input_tokens - cached_input_tokens) / 1e6::DOUBLE * 0.35::DOUBLE + output_tokens / 1e6::DOUBLE * 0.75::DOUBLE
    ELSE 0::DOUBLE END AS estimate FROM gen_fx"""


def prices(spark):
    return spark.createDataFrame(PRICES, "provider string, price_in double, price_out double")


def latest(spark, sf):
    return dedup.latest_per_key(gen_fx(spark, sf), ops.LOG_KEYS, tie="request_seq")


@query("latest_per_key",
       sql("""SELECT source_file_id, task_type, request_seq, finish_reason, md5(content) AS digest FROM latest""", "latest"))
def _(spark, sf):
    return latest(spark, sf).select(
        "source_file_id", "task_type", "request_seq", "finish_reason", F.md5("content").alias("digest")
    )


@query("latest_success_per_key",
       sql("""SELECT source_file_id, task_type, request_seq, finish_reason FROM (SELECT *, row_number() OVER (
                PARTITION BY source_file_id, task_type
                ORDER BY coalesce(finish_reason = 'stop', FALSE) DESC, timestamp DESC, request_seq DESC) AS rn FROM gen_fx)
              WHERE rn = 1""", "gen_fx"))
def _(spark, sf):
    best = dedup.latest_per_key(gen_fx(spark, sf), ops.LOG_KEYS, tie="request_seq", prefer_success=True)
    return best.select("source_file_id", "task_type", "request_seq", "finish_reason")


@query("clean_basic", sql("SELECT source_file_id, task_type, request_seq FROM basic", "basic"))
def _(spark, sf):
    return filters.clean_basic(latest(spark, sf)).select("source_file_id", "task_type", "request_seq")


@query("filter_degenerate", sql("SELECT request_seq FROM gen_fx WHERE " + """
         CAST(len(list_distinct(string_split(trim(content, chr(10)||chr(9)||' '), chr(10)))) AS DOUBLE)
         / len(string_split(trim(content, chr(10)||chr(9)||' '), chr(10))) >= 0.3""", "gen_fx"))
def _(spark, sf):
    return filters.filter_degenerate(gen_fx(spark, sf)).select("request_seq")


@query("degenerate_rejects", sql("SELECT request_seq, r AS unique_line_ratio FROM (SELECT request_seq, " + """
         CAST(len(list_distinct(string_split(trim(content, chr(10)||chr(9)||' '), chr(10)))) AS DOUBLE)
         / len(string_split(trim(content, chr(10)||chr(9)||' '), chr(10))) AS r FROM gen_fx) WHERE r < 0.3""", "gen_fx"))
def _(spark, sf):
    return filters.degenerate_rejects(gen_fx(spark, sf)).select("request_seq", "unique_line_ratio")


@query("select_training_columns",
       sql("""SELECT task_type, source_file_id, source_file_path, source_repo, source_stars, content, input_tokens,
                output_tokens, provider, model FROM train_fx""", "train_fx"))
def _(spark, sf):
    return ops.clean_log(gen_fx(spark, sf), tie="request_seq")


@query("sort_output", sql("SELECT task_type, source_file_id, request_seq FROM gen_fx", "gen_fx"))
def _(spark, sf):
    return ops.sort_output(gen_fx(spark, sf).select("task_type", "source_file_id", "request_seq"))


@query("clean_report",
       sql("""SELECT (SELECT count(*) FROM gen_fx) AS raw, count(*) AS after_dedupe,
                count(*) FILTER (finish_reason = 'length') AS truncated, count(*) FILTER (finish_reason IS NULL) AS failed,
                count(*) FILTER (finish_reason = 'stop' AND content = '') AS empty,
                count(*) FILTER (finish_reason = 'content_filter') AS other,
                (SELECT count(*) FROM basic WHERE ratio < 0.3) AS degenerate, (SELECT count(*) FROM train_fx) AS kept
              FROM latest""", "train_fx"))
def _(spark, sf):
    return ops.clean_report(gen_fx(spark, sf), tie="request_seq")


@query("count_by_task", sql("SELECT task_type, count(*) AS n FROM train_fx GROUP BY task_type", "train_fx"))
def _(spark, sf):
    return ops.count_by_task(ops.clean_log(gen_fx(spark, sf), tie="request_seq"))


@query("attach_prices",
       sql("""SELECT request_seq, provider, CASE provider WHEN 'prov_a' THEN 0.35::DOUBLE ELSE 0::DOUBLE END AS price_in,
                CASE provider WHEN 'prov_a' THEN 0.75::DOUBLE ELSE 0::DOUBLE END AS price_out FROM gen_fx""", "gen_fx"))
def _(spark, sf):
    return ops.attach_prices(gen_fx(spark, sf).select("request_seq", "provider"), prices(spark))


@query("request_cost",
       sql("""SELECT request_seq, round(estimate, 9) AS estimate,
                round(CASE WHEN coalesce(reported_cost, 0) <> 0 THEN reported_cost ELSE estimate END, 9) AS cost_usd FROM co""",
           "gen_fx", co=_COST_SQL))
def _(spark, sf):
    costed = ops.with_costs(gen_fx(spark, sf), prices(spark), "reported_cost")
    return costed.select(
        "request_seq", F.round("estimated_cost_usd", 9).alias("estimate"), F.round("cost_usd", 9).alias("cost_usd")
    )


@query("tokens_per_second",
       sql("""SELECT request_seq, CASE WHEN wall_time_ms > 0 THEN output_tokens / (wall_time_ms / 1000::DOUBLE) ELSE 0::DOUBLE END
                AS tps FROM gen_fx""", "gen_fx"))
def _(spark, sf):
    return gen_fx(spark, sf).select("request_seq", usage.tokens_per_second("output_tokens", "wall_time_ms").alias("tps"))


@query("provider_summary",
       sql("""SELECT provider, approach, count(*) AS total, count(*) FILTER (error IS NULL) AS completed,
                count(*) FILTER (error IS NOT NULL) AS failed,
                CAST(sum(wall_time_ms) FILTER (error IS NULL) AS BIGINT) / 1000::DOUBLE AS elapsed_seconds,
                CAST(sum(input_tokens) FILTER (error IS NULL) AS BIGINT) AS total_input_tokens,
                CAST(sum(output_tokens) FILTER (error IS NULL) AS BIGINT) AS total_output_tokens,
                round(avg(output_tokens / (wall_time_ms / 1000::DOUBLE))
                  FILTER (error IS NULL AND wall_time_ms > 0 AND output_tokens > 0), 6) AS avg_tok_per_sec,
                (list_sort(list(wall_time_ms) FILTER (error IS NULL)))[CAST(floor(count(*) FILTER (error IS NULL) / 2) AS BIGINT) + 1]
                  / 1000::DOUBLE AS p50_request_seconds,
                round(CAST(sum(wall_time_ms) FILTER (error IS NULL) AS BIGINT) / 1000::DOUBLE / count(*) FILTER (error IS NULL), 9)
                  AS avg_request_seconds
              FROM gen_fx GROUP BY provider, approach""", "gen_fx"))
def _(spark, sf):
    summary = ops.provider_summary(gen_fx(spark, sf))
    return summary.withColumns({
        "avg_tok_per_sec": F.round("avg_tok_per_sec", 6), "avg_request_seconds": F.round("avg_request_seconds", 9),
    })


@query("generation_totals",
       sql("""SELECT pairs, errors, round(cost, 6) AS cost_usd, energy AS energy_joules, energy / 3600000::DOUBLE AS energy_kwh,
                elapsed AS elapsed_seconds, bal AS last_balance_usd, pairs / elapsed AS pairs_per_second,
                elapsed / pairs * 500 AS eta_seconds FROM (
                SELECT count(*) FILTER (error IS NULL) AS pairs, count(*) FILTER (error IS NOT NULL) AS errors,
                  sum(CASE WHEN coalesce(reported_cost, 0) <> 0 THEN reported_cost ELSE estimate END) FILTER (error IS NULL) AS cost,
                  sum(energy_joules) AS energy, (epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 1e6::DOUBLE AS elapsed,
                  max_by(balance, timestamp) FILTER (balance IS NOT NULL) AS bal FROM co)""", "gen_fx", co=_COST_SQL))
def _(spark, sf):
    costed = ops.with_costs(gen_fx(spark, sf), prices(spark), "reported_cost")
    totals = ops.generation_totals(costed, energy="energy_joules", balance="balance", remaining_pairs=500)
    return totals.withColumn("cost_usd", F.round("cost_usd", 6))


@query("budget_cutoff",
       sql("""SELECT provider, request_seq FROM (SELECT *, coalesce(sum(CASE WHEN balance < 0.2 AND error IS NULL THEN 1 ELSE 0 END)
                OVER (PARTITION BY provider ORDER BY timestamp, request_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS hit
              FROM gen_fx) WHERE hit = 0""", "gen_fx"))
def _(spark, sf):
    return ops.budget_cutoff(gen_fx(spark, sf), 0.2).select("provider", "request_seq")


@query("error_streaks",
       sql("""SELECT provider, CAST(coalesce(max(n), 0) AS BIGINT) AS longest_streak, count(*) FILTER (n > 0) AS streaks,
                count(*) FILTER (n >= 3) AS breaker_streaks FROM (
                SELECT provider, island, count(*) FILTER (error IS NOT NULL) AS n FROM (
                  SELECT provider, error, sum(CASE WHEN error IS NULL THEN 1 ELSE 0 END)
                    OVER (PARTITION BY provider ORDER BY timestamp, request_seq ROWS UNBOUNDED PRECEDING) AS island FROM gen_fx)
                GROUP BY provider, island) GROUP BY provider""", "gen_fx"))
def _(spark, sf):
    return ops.error_streaks(gen_fx(spark, sf), breaker=3)


@query("most_common", sql("SELECT finish_reason, count(*) AS n FROM gen_fx GROUP BY finish_reason", "gen_fx"))
def _(spark, sf):
    return ops.most_common(gen_fx(spark, sf), "finish_reason")
