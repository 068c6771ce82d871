"""Log analytics against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.operators import chat, dedup, genlog
from corpusloom.operators.quantiles import medians

LOG = ("provider string, approach string, timestamp timestamp, request_seq long, error string, wall_time_ms long, "
       "input_tokens long, output_tokens long, balance double")


def log(spark, rows):
    base = dict(provider="a", approach="single", sec=0, request_seq=0, error=None, wall=1000, i=10, o=10, balance=None)
    full = [{**base, "request_seq": n, "sec": n, **r} for n, r in enumerate(rows)]
    df = spark.createDataFrame(
        [(r["provider"], r["approach"], r["sec"], r["request_seq"], r["error"], r["wall"], r["i"], r["o"], r["balance"]) for r in full],
        LOG.replace("timestamp timestamp", "sec long"),
    )
    return df.withColumn("timestamp", F.timestamp_seconds("sec"))


def streaks(spark, df, **options):
    return {r["provider"]: (r["longest_streak"], r["streaks"], r["breaker_streaks"])
            for r in genlog.error_streaks(df, **options).collect()}


@pytest.mark.parametrize("slices", [2, 7, 64])
def test_error_streaks_match_a_plain_scan(spark, slices):
    rng = random.Random(slices)
    flags = [rng.random() < (0.9 if (i // 40) % 2 else 0.2) for i in range(600)]
    df = log(spark, [dict(error="x" if f else None) for f in flags])
    runs, current = [], 0
    for f in [*flags, False]:
        if f:
            current += 1
        elif current:
            runs.append(current)
            current = 0
    expected = (max(runs), len(runs), sum(r >= 10 for r in runs))
    assert streaks(spark, df, slices=slices) == {"a": expected}


@pytest.mark.parametrize("length", [9, 10, 11])
def test_breaker_bound(spark, length):
    df = log(spark, [dict(error="x")] * length + [{}])
    assert streaks(spark, df, slices=4) == {"a": (length, 1, int(length >= 10))}


def test_streaks_of_clean_and_failing_providers(spark):
    df = log(spark, [dict(provider="ok")] * 5 + [dict(provider="bad", error="x")] * 30)
    assert streaks(spark, df) == {"ok": (0, 0, 0), "bad": (30, 1, 1)}


def test_streaks_with_one_timestamp_for_a_third_of_the_rows(spark):
    flags = [i % 5 != 0 for i in range(300)]
    df = log(spark, [dict(error="x" if f else None, sec=100 if 100 <= i < 200 else i) for i, f in enumerate(flags)])
    assert streaks(spark, df, slices=16) == {"a": (4, 60, 0)}


def test_budget_cutoff_keeps_the_breaching_row(spark):
    def kept(balances):
        df = log(spark, [dict(balance=b) for b in balances])
        return sorted(r["request_seq"] for r in genlog.budget_cutoff(df, 0.5).collect())

    assert kept([0.1, 5.0]) == [0]
    assert kept([5.0, 0.4, 5.0]) == [0, 1]
    assert kept([5.0, None, 0.5]) == [0, 1, 2]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10])
def test_medians(spark, n):
    import statistics

    values = [random.Random(n).randrange(50) for _ in range(n)]
    df = spark.createDataFrame([("g", v) for v in values], "g string, v long")
    both = medians(df, ["g"], "v", "m").join(medians(df, ["g"], "v", "u", upper=True), "g").first()
    assert both["m"] == statistics.median(values) and both["u"] == sorted(values)[n // 2]


def test_provider_summary(spark):
    df = log(spark, [dict(wall=1000, o=10), dict(wall=3000, o=0), dict(wall=0, o=10), dict(wall=2000, o=40), dict(error="x", wall=9000),
                     dict(provider="dead", error="x")])
    rows = genlog.provider_summary(df).collect()
    assert [r["provider"] for r in rows] == ["a"]
    r = rows[0]
    assert (r["total"], r["completed"], r["failed"]) == (5, 4, 1)
    assert (r["elapsed_seconds"], r["avg_tok_per_sec"], r["p50_request_seconds"], r["avg_request_seconds"]) == (6.0, 15.0, 2.0, 1.5)


def test_generation_totals_without_rows_or_pairs(spark):
    cols = dict(cost=F.lit(1.0), energy=F.lit(3.6e6), balance="balance")
    empty = genlog.generation_totals(log(spark, [{}]).limit(0), **cols).first()
    assert (empty["pairs"], empty["errors"], empty["cost_usd"], empty["pairs_per_second"]) == (0, 0, 0.0, 0.0)
    one = genlog.generation_totals(log(spark, [dict(balance=3.0), dict(error="x", balance=1.0), dict(balance=2.0)]), remaining_pairs=4, **cols).first()
    assert (one["pairs"], one["energy_kwh"], one["last_balance_usd"], one["eta_seconds"]) == (2, 2.0, 2.0, 4.0)


def test_prices_by_shuffle_beyond_the_size_check(spark):
    from corpusloom.operators.joins import join_small

    big = spark.range(100).selectExpr("id % 5 AS k")
    small = spark.range(4).selectExpr("id AS k", "id * 10 AS v")
    broadcast, shuffled = join_small(big, small, "k"), join_small(big, small, "k", max_rows=2)
    assert sorted(broadcast.collect()) == sorted(shuffled.collect())


ATTEMPT = "source_file_id string, task_type string, timestamp int, request_id int, finish_reason string, content string"


@pytest.mark.parametrize("prefer_success", [False, True])
def test_newest_texts_with_nulls_and_ties(spark, prefer_success):
    rows = [(None, "t", 1, 1, "stop", "a"), (None, "t", 2, None, None, "b"), ("f", None, None, 3, "stop", "c"), ("f", None, None, 2, "stop", "d"),
            ("f", None, 0, None, None, "e"), ("g", "t", 5, None, "stop", "h"), ("g", "t", 5, None, "stop", "h"), ("g", "u", 5, 2, None, None), ("g", "u", 5, 1, "stop", "i")]
    df = spark.createDataFrame(rows, ATTEMPT)
    found = dedup.latest_texts_per_key(df, genlog.LOG_KEYS, prefer_success=prefer_success)
    want = dedup.latest_per_key(df, genlog.LOG_KEYS, prefer_success=prefer_success)
    assert found.columns == df.columns and sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    assert found.count() == 4 and dedup.latest_texts_per_key(df.limit(0), genlog.LOG_KEYS).count() == 0


def test_only_newest_attempts_meet_their_texts(spark):
    """Texts of a log that come from a join are looked up after the choice, so older attempts carry none through a shuffle."""
    attempts = spark.range(400).selectExpr("id AS request_id", "concat('f', id % 7) AS source_file_id", "'t' AS task_type", "id AS timestamp", "id % 50 AS answer")
    texts = spark.range(50).selectExpr("id AS answer_id", "repeat(concat('text', id, chr(10)), 3) AS text")
    log = attempts.join(texts, F.col("answer") == F.col("answer_id"), "left").select(
        *[F.lit("x").alias(c) for c in schemas.TRAINING_COLUMNS if c not in ("source_file_id", "task_type", "content")],
        "request_id", "source_file_id", "task_type", "timestamp", F.lit("stop").alias("finish_reason"),
        F.when(F.col("request_id") % 41 == 0, "").otherwise(F.col("text")).alias("content"))
    cleaned = genlog.clean_log(log)
    lines = cleaned._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = {kind: min(len(x) - len(x.lstrip(" :+-")) for x in lines if f"Join {kind}" in x) for kind in ("LeftOuter", "LeftSemi")}
    assert depth["LeftSemi"] > depth["LeftOuter"]
    newest = {f"f{k % 7}": k for k in range(400)}
    assert {(r.source_file_id, r.content) for r in cleaned.collect()} == {(f, f"text{k % 50}\n" * 3) for f, k in newest.items() if k % 41}


def test_joined_keys_move_no_text(spark):
    """``dense_ids`` reads the joined rows once for their keys: no code is shuffled for that."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        training = spark.createDataFrame([("f", "t"), ("x", "t"), (None, "t")], "source_file_id string, task_type string")
        files = spark.createDataFrame([("f", "one", "r", "u"), ("f", "two", None, "v"), ("f", "six", "s", None), (None, "c", "r", "u")],
                                      "id string, code string, repo_name string, repo_url string")
        joined = chat.join_training_to_corpus(training, files)
        text = joined.select("source_file_id", "task_type")._jdf.queryExecution().optimizedPlan().toString()
        assert "max_by" not in text and "sha2" not in text and "Window" not in text
        assert [tuple(r) for r in joined.collect()] == [("f", "t", "two", None, "v")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
