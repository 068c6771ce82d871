"""Files, streams and the end-to-end plans."""

import json

from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.operators import genlog, prompts
from corpusloom.operators.respond import batch_respond
from corpusloom.plans import collect, convert, sft
from corpusloom.sources import jsonl, parquet, trees
from corpusloom.streaming import streams


def test_malformed_lines_are_kept_aside(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text('{"id":"a","stars":3,"authors":["x"]}\nnot json\n{"id":"b","late":1}\n')
    rows = jsonl.read_jsonl(spark, str(path), schemas.CORPUS_FILE).orderBy("id").collect()
    assert [(r["id"], r["stars"], r[schemas.CORRUPT]) for r in rows] == [(None, None, "not json"), ("a", 3, None), ("b", None, None)]


def test_extract_files_from_a_directory(spark, tmp_path):
    body = b"x" * 30
    for name, data in {
        ".hidden/a.x": body, "build/a.x": body, "build/src/a.x": body, "src/bad.x": b"\xff" + body, "src/crlf.x": b"a\r\nb\r" + body,
        "src/empty.x": b"", "src/short.x": "é".encode() * 19, "src/exact.x": "é".encode() * 20, "src/other.y": body,
    }.items():
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(data)
    tree = trees.read_tree(spark, str(tmp_path), "x").withColumns({"repo_owner": F.lit("o"), "repo_name": F.lit("n"), "license_raw": F.lit("mit")})
    records = trees.extract_files(tree, "x", ["o"], collected_at="2024-01-01T00:00:00+00:00")
    got = {r["file_path"]: r for r in records.collect()}
    assert sorted(got) == ["build/src/a.x", "src/bad.x", "src/crlf.x", "src/exact.x"]
    assert got["src/bad.x"]["code"].startswith("�x") and got["src/crlf.x"]["code"].startswith("a\nb\nx")
    first = got["build/src/a.x"]
    assert (first["id"], first["license"], first["is_official"], first["authors"], first["stars"]) == ("o/n/build/src/a.x", "MIT", True, [], 0)
    assert [f.name for f in records.schema] == schemas.CORPUS_FILE.fieldNames()


def test_append_is_additive(spark, tmp_path):
    path = str(tmp_path / "log")
    for i in range(3):
        jsonl.append_records(spark.range(i * 2, i * 2 + 2), path)
    assert sorted(r["id"] for r in spark.read.schema("id long").json(path).collect()) == list(range(6))


def corpus_lines(n=60):
    return "\n".join(json.dumps({
        "id": f"o/n{i % 4}/src/{i}", "code": f"code number {i // 2} " * 3, "file_path": f"src/{i}", "repo_url": f"u{i % 4}",
        "repo_owner": "exercism" if i % 10 == 9 else "o", "repo_name": f"n{i % 4}", "stars": i, "is_official": i % 7 == 0,
        "license": [None, "MIT", "GPL-3.0"][i % 3],
    }) for i in range(n))


def test_convert_end_to_end(spark, tmp_path):
    source = tmp_path / "raw.jsonl"
    source.write_text(corpus_lines())
    done = convert.convert_corpus(spark, str(source), str(tmp_path / "out"))
    steps = done.funnel.orderBy("step").collect()
    assert steps[0]["before"] == 60 and steps[-1]["after"] == done.corpus.count() == done.summary.first()["files"]
    assert {r["check_name"] for r in done.checks.collect()} <= {"missing_license"}
    sizes = {name: spark.read.parquet(p).count() for name, p in done.config_paths.items()}
    assert sizes["all"] == done.corpus.count() and sizes["official"] + sizes["community_top"] <= sizes["all"]
    parts = [f for f in (tmp_path / "out" / "corpus").iterdir() if f.name.endswith(".zstd.parquet")]
    assert parts
    published = parquet.publish_layout(spark, {**done.config_paths, "gone": str(tmp_path / "none")}, str(tmp_path / "pub"), "it's a card")
    assert published == ["all", "official", "community_top"]
    assert spark.read.text(str(tmp_path / "pub" / "README")).first()[0] == "it's a card"
    assert convert.convert_corpus(spark, str(source), str(tmp_path / "plain"), skip_filters=True).corpus.count() == 60


def test_collect_end_to_end(spark, tmp_path):
    search = spark.createDataFrame([
        (json.dumps({"owner": {"login": "o"}, "full_name": f"o/{n}", "html_url": f"h/{n}", "license": lic and {"spdx_id": lic}}), c, i)
        for i, (n, lic, c) in enumerate([("a", "MIT", 0), ("b", "GPL-3.0", 0), ("c", None, 1), ("d", None, 1), ("a", "MIT", 1)])
    ], "item string, chunk_seq int, item_seq int")
    packages = spark.createDataFrame([(json.dumps({"name": "D", "downloads": {"all": 5}}), 0)], "item string, seq long")
    repos = collect.discover_repos(search, packages)
    assert repos.count() == 4
    state = spark.createDataFrame([], "key string, status string")
    todo = collect.repos_to_process(repos, state)
    assert sorted(r["key"] for r in todo.collect()) == ["o/a", "o/d"]
    tree = spark.createDataFrame([("o", "a", "src/m.x", bytearray(b"y" * 40)), ("o", "b", "src/m.x", bytearray(b"y" * 40))],
                                 "repo_owner string, repo_name string, path string, content binary")
    path = str(tmp_path / "corpus")
    records = collect.collect_files(todo, tree, "x", [], path)
    assert [r["id"] for r in records.collect()] == ["o/a/src/m.x"]
    assert spark.read.schema(schemas.CORPUS_FILE).json(path).count() == 1
    done = collect.collection_state(todo, records)
    assert {(r["key"], r["status"]) for r in done.collect()} == {("o/a", "collected"), ("o/d", "no_files")}
    assert collect.repos_to_process(repos, done).count() == 0


def echo():
    def respond(messages, max_tokens):
        user = messages[-1]["content"]
        if "poison" in user:
            raise RuntimeError("no")
        return {"content": f"answer\n{user}\n{max_tokens}", "finish_reason": "stop", "input_tokens": 1, "output_tokens": 2}

    return respond


def test_sft_end_to_end(spark, tmp_path):
    corpus = spark.createDataFrame(
        [(f"o/n/{i}", ("poison " if i == 3 else "") + f"line {i}\n" * 8, f"src/{i}", "n", "u", i) for i in range(20)],
        "id string, code string, file_path string, repo_name string, repo_url string, stars long",
    )
    book = prompts.PromptBook("Lang", "sys")
    files = sft.load_files(corpus, 15, excluded_repos=["other"], max_input_tokens=4000, book=book)
    ids = {r["id"] for r in files.collect()}
    assert len(ids) == 15
    log_path = str(tmp_path / "log")
    state = spark.createDataFrame([(sorted(ids)[0], "done")], "id string, status string")
    options = dict(max_retries=1, base_delay=0.0)
    sft.generate(files, state, book, echo, "p", "m", log_path, batches=3, **options)
    log = jsonl.read_jsonl(spark, log_path, schemas.GENERATION_LOG)
    assert genlog.generation_state(log, prompts.TASK_TYPES).filter("status = 'done'").count() == 14
    assert sorted(r[0] for r in log.select("source_stars").distinct().collect() if r[0] is not None)
    again = genlog.generation_state(log, prompts.TASK_TYPES).unionByName(state)
    sft.generate(files, again, book, echo, "p", "m", log_path, **options)
    assert jsonl.read_jsonl(spark, log_path, schemas.GENERATION_LOG).count() == log.count()
    assert log.count() == 42
    failed = log.filter("error IS NOT NULL").count()
    assert failed == (3 if "o/n/3" in ids and sorted(ids)[0] != "o/n/3" else 0)
    records = sft.chat_records(log, corpus, book, str(tmp_path / "train"))
    assert records.count() == 42 - failed
    assert [f.name for f in records.schema] == schemas.CHAT_RECORD.fieldNames()
    assert sorted(r["id"] for r in records.collect())[0] == "sft_00001"
    texts = sft.training_text({"domain": records}, domain="domain")
    assert texts.count() == records.filter("task_type <> 'explanation'").count()
    assert texts.filter(~F.col("text").startswith("<|turn>system\nsys<turn|>")).count() == 0


def test_responder_retries_and_builds_one_client_per_partition(spark, tmp_path):
    marker = tmp_path / "built"
    marker.mkdir()

    def factory():
        import uuid

        (marker / uuid.uuid4().hex).write_text("")
        seen = {}

        def respond(messages, max_tokens):
            key = messages[0]["content"]
            seen[key] = seen.get(key, 0) + 1
            if seen[key] < 3:
                return {"error": "busy", "error_type": "Busy"}
            return {"content": f"{key} after {seen[key]}", "finish_reason": "stop"}

        return respond

    df = spark.range(12).select("id", F.array(F.struct(F.lit("user").alias("role"), F.col("id").cast("string").alias("content"))).alias("messages"))
    rows = batch_respond(df, factory, ["id"], partitions=3, max_retries=3, base_delay=0.0).collect()
    assert {r["content"] for r in rows} == {f"{i} after 3" for i in range(12)} and len(list(marker.iterdir())) == 3
    few = batch_respond(df, factory, ["id"], partitions=1, max_retries=1, base_delay=0.0).collect()
    assert {(r["content"], r["error"]) for r in few} == {(None, "busy")}


def test_stream_resumes_with_new_files_only(spark, tmp_path):
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    schema = "id long, code string"
    parsed = spark.createDataFrame([], schema).schema
    run = lambda: streams.stream_resume(spark, source, out, state, lambda s: s.filter("length(code) >= 2"), parsed)
    jsonl.append_records(spark.createDataFrame([(1, "aa"), (2, "b")], schema), source)
    run()
    jsonl.append_records(spark.createDataFrame([(3, "cc")], schema), source)
    run()
    run()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 3]


def test_stream_latest_across_batches(spark, tmp_path):
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    columns = "source_file_id string, task_type string, timestamp string, request_id string, content string"
    schema = spark.createDataFrame([], columns).schema
    batch = lambda *rows: jsonl.append_records(spark.createDataFrame(rows, columns), source)
    run = lambda: streams.run_each_batch(streams.stream_latest(streams.read_stream(spark, source, schema)), streams.delta_sink(out), state)
    batch(("f", "t", "2024-01-02", "r2", "x"), ("g", "t", "2024-01-01", "r1", "y"))
    run()
    batch(("f", "t", "2024-01-01", "r0", "late"), ("g", "t", "2024-01-03", "r3", "new"))
    run()
    now = {r["source_file_id"]: r["content"] for r in streams.read_latest(spark, out).collect()}
    assert now == {"f": "x", "g": "new"}


def test_stream_dedup_across_batches(spark, tmp_path):
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    schema = spark.createDataFrame([], "id long, code string, seen_at timestamp").schema
    run = lambda: streams.run_available(streams.stream_dedup(streams.read_stream(spark, source, schema), "seen_at"), out, state)
    batch = lambda *rows: jsonl.append_records(
        spark.createDataFrame(rows, "id long, code string, s long").withColumn("seen_at", F.timestamp_seconds("s")).drop("s"), source)
    batch((1, "a", 100), (2, "b", 110))
    run()
    batch((3, "a", 120), (4, "c", 130))
    run()
    assert sorted(r["code"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_late_rows_fall_out_of_progress(spark, tmp_path):
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    schema = spark.createDataFrame(
        [], "provider string, timestamp timestamp, error string, input_tokens long, output_tokens long").schema

    def batch(*seconds):
        df = spark.createDataFrame([("p", s, None, 1, 2) for s in seconds], "provider string, s long, error string, input_tokens long, output_tokens long")
        jsonl.append_records(df.select("provider", F.timestamp_seconds("s").alias("timestamp"), "error", "input_tokens", "output_tokens"), source)

    run = lambda: streams.run_available(
        streams.stream_progress(streams.read_stream(spark, source, schema), window="10 seconds", delay="5 seconds"), out, state)
    batch(1, 2, 3, 100)
    run()
    batch(4, 200)  # second 4 is late now
    run()
    batch(300)
    run()
    rows = sorted((r["s"], r["requests"]) for r in spark.read.parquet(out).select(
        F.unix_seconds("window_start").alias("s"), "requests").collect())
    assert rows[0] == (0, 3) and (100, 1) in rows
