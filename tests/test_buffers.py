"""Buffered shuffles, the best copy in a stream, tables stored by key."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import chat, dedup, shuffling
from corpusloom.operators.sampling import SEED
from corpusloom.sources import bucketed, jsonl
from corpusloom.streaming import buffers, streams


def drawn(seed, *parts):
    return int(hashlib.md5("|".join([str(seed), *map(str, parts)]).encode()).hexdigest()[:8], 16)


def simulated(rows, size, seed=SEED):
    """A buffer as a loop: fill it, then every row pushes one out, then the rest leave by hash."""
    held, out = {}, []
    for k, row in enumerate(rows, 1):
        if k <= size:
            held[k - 1] = (k, row)
            continue
        slot = drawn(seed, k) % size
        out.append(held[slot][1])
        held[slot] = (k, row)
    rest = sorted(held.values(), key=lambda kr: (hashlib.md5(f"{seed}|end|{kr[0]}".encode()).hexdigest(), kr[0]))
    return out + [row for _, row in rest]


@pytest.mark.parametrize("size", [1, 7, 50, 200, 1000])
@pytest.mark.parametrize("keys", [None, ["id"]])
def test_buffer_shuffle_equals_the_loop(spark, size, keys):
    rows = spark.range(200).select("id", F.concat(F.lit("t"), F.col("id")).alias("text")).repartition(5)
    got = shuffling.buffer_shuffle(rows, ["id"], size, keys=keys).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(1, 201))
    assert [r["id"] for r in got] == simulated(range(200), size) and all(r["text"] == f"t{r['id']}" for r in got)


@pytest.mark.parametrize("n,size", [(1, 5), (20, 30), (20, 500), (500, 30), (0, 5)])
def test_buffer_take_reads_the_start_only(spark, n, size):
    rows = spark.range(200).repartition(5)
    got = shuffling.buffer_shuffle_take(rows, n, ["id"], size).orderBy("position").collect()
    assert [r["id"] for r in got] == simulated(range(200), size)[:n]


def test_buffer_shuffle_of_ties_nulls_and_nothing(spark):
    rows = spark.createDataFrame([(None, "a"), (None, "a"), (3, "b"), (3, "c"), (3, "c"), (4, None)], "id long, text string")
    got = shuffling.buffer_shuffle(rows, ["id"], 2).collect()
    assert sorted(r["position"] for r in got) == list(range(1, 7))
    assert sorted((r["id"] or 0, r["text"] or "") for r in got) == sorted((r["id"] or 0, r["text"] or "") for r in rows.collect())
    again = shuffling.buffer_shuffle(rows.repartition(3), ["id"], 2).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    taken = shuffling.buffer_shuffle_take(rows, 3, ["id"], 2).collect()
    assert sorted(map(str, taken)) == sorted(str(r) for r in got if r["position"] <= 3)
    assert shuffling.buffer_shuffle(rows.limit(0), ["id"], 2).count() == 0
    assert shuffling.buffer_shuffle_take(rows.limit(0), 3, ["id"], 2).count() == 0
    with pytest.raises(ValueError):
        shuffling.buffer_shuffle(rows.withColumnRenamed("text", "position"), ["id"], 2)
    with pytest.raises(ValueError):
        shuffling.buffer_shuffle(rows, ["id"], 0)


def test_stream_buffer_equals_a_simulation_over_batches(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = spark.createDataFrame([], "id long, text string, stars int").schema
    batches = [range(0, 30), range(30, 90), range(90, 91)]
    held, left = {}, []
    for n, ids in enumerate(batches):
        jsonl.append_records(spark.createDataFrame([(i, None if i % 4 else f"t{i}", None if i % 3 else i) for i in ids], schema).coalesce(1), source)
        stream = streams.read_stream(spark, source, schema)
        streams.run_available(buffers.stream_buffer_shuffle(stream, ["id"], buffer=8), out, state)
        for i in ids:
            slot = drawn(SEED, i) % 8
            if slot in held:
                left.append(held[slot])
            held[slot] = i
        emitted = spark.read.schema(schema).parquet(out)
        assert sorted(r["id"] for r in emitted.collect()) == sorted(left)
        rest = buffers.buffered_rows(spark, state)
        assert sorted(r["id"] for r in rest.collect()) == sorted(held.values()) and rest.count() <= 8
    both = {r["id"]: (r["text"], r["stars"]) for r in emitted.unionByName(rest).collect()}
    assert both == {i: (None if i % 4 else f"t{i}", None if i % 3 else i) for i in range(91)}


FILES = "id string, code string, stars long, s long"


def _files(spark, rows):
    return spark.createDataFrame(rows, FILES).withColumn("seen_at", F.timestamp_seconds("s")).drop("s")


def test_stream_keeps_the_most_starred_copy(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    r = random.Random(4)
    rows = [(f"f{i}", r.choice(["a", "b", "", None, "c" * 500, f"own{i}"]), r.choice([None, 1, 1, 5, i]), 1000 + r.randint(0, 50)) for i in range(120)]
    rows += rows[:3]  # repeated rows
    schema = _files(spark, rows[:1]).schema
    step = lambda: streams.stream_dedup_best(streams.read_stream(spark, source, schema), "seen_at", "100 seconds")
    for a in range(0, len(rows), 41):
        jsonl.append_records(_files(spark, rows[a:a + 41]), source)
        streams.run_available(step(), out, state)
    result = lambda: spark.read.schema(step().schema).parquet(out)
    assert result().count() == 0  # groups are still open
    for k in (1, 2):  # far later: the watermark passes everything before
        jsonl.append_records(_files(spark, [("end", "end", 0, 100_000 * k)]), source)
        query = streams.run_available(step(), out, state)
    want = {(r["id"], r["code"] or "", r["stars"]) for r in dedup.dedup_content(_files(spark, rows)).collect()}
    got = [(r["id"], r["code"] or "", r["stars"]) for r in result().collect() if r["id"] != "end"]
    assert len(got) == len(want) and set(got) == want
    states = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    assert states[-1] == 1  # the last file alone


def test_copies_beyond_the_gap_are_groups_of_their_own(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    rows = [("x", "a", 1, 1000), ("y", "a", 9, 1005), ("z", "a", 3, 1030), (None, "a", 3, 1031), ("end", "e", 1, 90_000)]
    jsonl.append_records(_files(spark, rows), source)
    schema = _files(spark, rows).schema
    stream = streams.stream_dedup_best(streams.read_stream(spark, source, schema), "seen_at", "60 seconds", gap="10 seconds", columns=["id", "stars"])
    streams.run_available(stream, out, state)
    got = spark.read.schema(stream.schema).parquet(out)
    assert sorted((r["id"], r["stars"]) for r in got.collect()) == [("y", 9), ("z", 3)]
    assert got.columns == ["id", "stars", "content_sha"]


def _log(spark, rows):
    return spark.createDataFrame(rows, "source_file_id string, task_type string, timestamp long, request_id string, content string")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def log_rows():
    r = random.Random(1)
    rows = [(f"f{r.randint(0, 40)}", r.choice(["t", "u"]), r.randint(0, 9), f"r{i}", None if i % 5 else "x" * i) for i in range(300)]
    rows += [("hot", "t", i, f"h{i}", "y") for i in range(150)] + [(None, "t", i, f"n{i}", "") for i in range(5)]
    return rows


def test_co_located_join_equals_the_plain_one(spark, tmp_path, log_rows):
    log = _log(spark, log_rows)
    corpus = spark.createDataFrame([(f"f{i}", f"code {i}", f"repo {i}") for i in range(5, 60)] + [("hot", "h", "rh"), (None, "n", "rn")],
                                   "id string, code string, repo_name string")
    left = bucketed.write_bucketed(log, str(tmp_path / "log"), "source_file_id", 6)
    right = bucketed.write_bucketed(corpus, str(tmp_path / "corpus"), "id", 6)
    assert [r["_key"] for r in left.hot_keys().collect()] == ["hot"]
    assert left.hot().count() == 150 and left.cold().count() == 305 and right.hot_keys().count() == 0
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = log.join(corpus.withColumnRenamed("id", "source_file_id"), "source_file_id", how)
        got = bucketed.join_co_located(left, right, how)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    by_hand = chat.join_training_to_corpus(log, corpus.withColumn("repo_url", F.lit("u"))).drop("repo_url")
    assert sorted(map(str, bucketed.join_co_located(left, right).collect())) == sorted(map(str, by_hand.collect()))
    with pytest.raises(ValueError):
        bucketed.join_co_located(left, left)
    with pytest.raises(ValueError):
        bucketed.join_co_located(left, right, "full")


def test_buckets_meet_without_an_exchange(spark, tmp_path, log_rows):
    log = _log(spark, log_rows)
    corpus = spark.createDataFrame([(f"f{i}", f"code {i}") for i in range(50)], "id string, code string")
    left = bucketed.write_bucketed(log, str(tmp_path / "log"), "source_file_id", 6, 10_000)
    right = bucketed.write_bucketed(corpus, str(tmp_path / "corpus"), "id", 6)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.cold().join(right.cold().withColumnRenamed("id", "source_file_id"), "source_file_id")
        assert "SortMergeJoin" in _plan(joined) and "Exchange" not in _plan(joined)
        newest = dedup.latest_per_key(left.cold(), ["source_file_id", "task_type"])
        assert "Window" in _plan(newest) and "Exchange" not in _plan(newest)
        assert joined.count() == log.join(corpus.withColumnRenamed("id", "source_file_id"), "source_file_id").count()
        whole = _plan(bucketed.join_co_located(left, right))  # exchanges stand in the part of the hot keys alone
        assert "Exchange" not in whole[whole.index("SortMergeJoin"):whole.index("SortMergeJoin", whole.index("SortMergeJoin") + 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_latest_inside_buckets(spark, tmp_path, log_rows):
    log = _log(spark, log_rows)
    stored = bucketed.write_bucketed(log, str(tmp_path / "log"), "source_file_id", 6)
    again = bucketed.open_bucketed(spark, str(tmp_path / "log"))
    keys = ["source_file_id", "task_type"]
    want = sorted(map(str, dedup.latest_per_key(log, keys).collect()))
    for table in (stored, again):
        assert sorted(map(str, bucketed.latest_co_located(table, keys).collect())) == want
    assert sorted(map(str, again.rows().collect())) == sorted(map(str, log.collect()))
    with pytest.raises(ValueError):
        bucketed.latest_co_located(stored, ["task_type"])


def test_empty_tables_in_buckets(spark, tmp_path):
    none = bucketed.write_bucketed(_log(spark, []), str(tmp_path / "log"), "source_file_id", 4)
    corpus = bucketed.write_bucketed(spark.createDataFrame([("a", "b")], "id string, code string"), str(tmp_path / "corpus"), "id", 4)
    assert bucketed.join_co_located(none, corpus).count() == 0 == bucketed.latest_co_located(none, ["source_file_id"]).count()
    assert none.rows().columns == ["source_file_id", "task_type", "timestamp", "request_id", "content"]


def test_stored_buckets_are_compressed_well(spark, tmp_path):
    import pyarrow.parquet as pq

    bucketed.write_bucketed(spark.range(50).selectExpr("id % 7 AS id", "repeat('text ', 9) AS code"), f"{tmp_path}/t", "id", 2, 7)
    files = [*tmp_path.glob("t/cold/*.parquet"), *tmp_path.glob("t/hot/*.parquet")]
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f).metadata.num_rows} == {"ZSTD"}
