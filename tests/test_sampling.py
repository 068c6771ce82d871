"""Sampling, ranking and splitting against plain Python."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import ranking, sampling


def order(ids, seed=42):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}|{i}".encode()).hexdigest(), i))


def test_dense_ids_over_many_partitions(spark):
    n = 120_000
    df = spark.range(n).select((F.lit(n) - F.col("id")).alias("k")).repartition(9)
    out = ranking.dense_ids(df, ["k"], "sft").withColumn("number", F.substring_index("id", "_", -1).cast("long"))
    assert out.filter(F.col("number") != F.col("k")).count() == 0 and out.count() == n
    assert out.filter("k = 7").first()["id"] == "sft_00007" and out.filter("k = 110000").first()["id"] == "sft_110000"


def test_ranking_does_not_gather_rows(spark):
    numbered = ranking.global_row_number(spark.range(1000).withColumnRenamed("id", "k"), ["k"], "n", partitions=6)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.replace("Exchange SinglePartition, EXECUTOR_BROADCAST", "")
    assert sorted(r["n"] for r in numbered.collect()) == list(range(1, 1001))
    assert numbered.filter("n <> k + 1").count() == 0


def test_ranking_of_equal_keys_and_empty_input(spark):
    same = spark.range(500).withColumn("k", F.lit(1))
    assert sorted(r["n"] for r in ranking.global_row_number(same, ["k"], "n").collect()) == list(range(1, 501))
    assert ranking.global_row_number(same.limit(0), ["k"], "n").count() == 0


@pytest.mark.parametrize("n", [0, 1, 37, 5000, 20_000, 24_999, 25_000, 30_000])
def test_large_samples_are_exact(spark, n):
    df = spark.range(25_000)
    got = sampling.sample_n(df, n)
    assert sorted(r["id"] for r in got.collect()) == sorted(order(range(25_000))[:n])
    assert "Exchange" not in got._jdf.queryExecution().sparkPlan().toString()


def test_sample_with_a_hot_id_and_null_ids(spark):
    df = spark.range(900).selectExpr("CASE WHEN id < 300 THEN 'hot' WHEN id < 310 THEN NULL ELSE CAST(id AS STRING) END AS id")
    got = sampling.sample_n(df, 450).groupBy("id").count().collect()
    assert {r["id"]: r["count"] for r in got}.get("hot", 0) in (0, 300)
    assert sampling.sample_n(df, 10_000).count() == 900


def test_shuffle_take_is_ordered(spark):
    assert [r["id"] for r in sampling.shuffle_take(spark.range(500), 20, 7).collect()] == order(range(500), 7)[:20]


@pytest.mark.parametrize("exact", [False, True])
def test_split_is_a_disjoint_cover(spark, exact):
    df = spark.range(4321)
    rows = sampling.train_eval_split(df, 0.05, exact=exact).collect()
    held = {r["id"] for r in rows if r["split"] == "eval"}
    assert sorted(r["id"] for r in rows) == list(range(4321))
    if exact:
        assert held == set(order(range(4321))[: math.ceil(0.05 * 4321)])
    else:
        assert 0.03 < len(held) / 4321 < 0.07


def test_shuffle_keeps_the_multiset_and_the_order_is_seeded(spark):
    df = spark.range(200)
    got = [r["id"] for r in sampling.shuffle_rows(df, 7).collect()]
    assert got == order(range(200), 7)
    assert got == [r["id"] for r in sampling.shuffle_rows(df.repartition(13), 7).collect()]


def python_sample(rows, n):
    """Phases over a list, following the quota rules."""
    chosen = []

    def take(pool, count):
        free = [r for r in rows if r["id"] not in {c["id"] for c in chosen} and pool(r)]
        ranked = {i: k for k, i in enumerate(order([r["id"] for r in free]))}
        chosen.extend(sorted(free, key=lambda r: ranked[r["id"]])[: max(0, count)])

    take(lambda r: r["tier"] == "official", sampling.QUOTA_OFFICIAL)
    for name, quota in sampling.QUOTA_COMPLEXITY.items():
        take(lambda r: r["complexity"] == name, quota - sum(c["complexity"] == name for c in chosen))
    if n - len(chosen) > 0:
        for name, quota in sampling.QUOTA_SOURCE.items():
            take(lambda r: r["source_class"] == name, quota - sum(c["source_class"] == name for c in chosen))
    take(lambda r: True, n - len(chosen))
    return [c["id"] for c in chosen[:n]]


@pytest.mark.parametrize("n", [3, 10, 20, 35, 200])
def test_stratified_sample_matches_the_phases(spark, n):
    df = spark.range(400).selectExpr(
        "concat('f', id) AS id", "repeat('x\n', CAST(id * id % 130 AS INT)) AS code",
        "concat(CASE id % 5 WHEN 0 THEN 'test' WHEN 1 THEN 'examples' WHEN 2 THEN 'docs' ELSE 'src' END, '/', id) AS file_path",
        "id % 90 = 0 AS is_official", "id % 20 AS stars",
    )
    sizes = dict(simple_below=40, medium_below=120)
    rows = [r.asDict() for r in sampling.classify(df, **sizes).collect()]
    got = [r["id"] for r in sampling.stratified_sample(df, n, **sizes).collect()]
    assert got == python_sample(rows, n)


def test_small_sample_takes_officials_then_simple_files(spark):
    df = spark.range(100).selectExpr("concat('f', id) AS id", "'x' AS code", "'src/a' AS file_path", "id < 10 AS is_official", "0 AS stars")
    sample = sampling.stratified_sample(df, 10)
    assert [r["tier"] for r in sample.collect()].count("official") >= 4
    summary = {(r["dimension"], r["value"]): r["n"] for r in sampling.sample_summary(sample).collect()}
    assert summary[("complexity", "simple")] == 10 and summary[("source_class", "src")] == 10


def test_candidates_are_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("concat('f', id) AS id", "'x' AS code", "'src/a' AS file_path", "false AS is_official", "0 AS stars")
    plan = sampling.stratified_sample(df, 10)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_rows_of_one_id_and_rows_alike_are_cut_exactly(spark):
    rows = [("hot", "alike", 1)] * 40 + [("hot", f"text {k}", None) for k in range(20)] + [("hot", None, None)] * 5 + [(f"i{k}", "x", k) for k in range(10)] + [(None, "y", 0)] * 3
    df = spark.createDataFrame(rows, "id string, text string, k long").repartition(6)
    for n in (1, 7, 33, 60, 77, 78, 100):
        found = sampling.sample_n(df, n, exact=True)
        assert found.count() == min(n, 78) and found.exceptAll(df).count() == 0
    split = sampling.train_eval_split(df, 0.4, exact=True)
    assert split.where("split = 'eval'").count() == 32 and split.drop("split").exceptAll(df).count() == df.exceptAll(split.drop("split")).count() == 0
    smaller, larger = sampling.sample_n(df, 20, exact=True), sampling.sample_n(df, 50, exact=True)
    assert smaller.exceptAll(larger).count() == 0


def test_large_weights_do_not_fall_into_one_bucket(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("id"), (F.col("id") * 1_000_000 + 1).cast("double").alias("w"))
    seen = {}
    real = sampling._cut
    try:
        sampling._cut = lambda d, hashed, *more: (seen.update(n=d.select(F.substring(hashed, 1, 5)).distinct().count()), real(d, hashed, *more))[1]
        assert sampling.weighted_sample(df, 100, F.col("w")).count() == 100
    finally:
        sampling._cut = real
    assert seen["n"] > 1000
