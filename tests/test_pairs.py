"""Pairs, exact samples, near duplicates, and the sources that must not lose rows."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.operators import corpus, genlog, mixing, neardup, pairs, ranking, sampling, tiles
from corpusloom.operators.respond import batch_respond
from corpusloom.sources import jsonl, trees


def chat_line(text, content="x"):
    return json.dumps({"messages": [{"role": "user", "content": text}, {"role": "assistant", "content": content}]})


def test_chat_files_by_pattern_and_list(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"part{k}.jsonl").write_text(chat_line(str(k)) + "\n\n" + chat_line("more") + "\n")
    count = lambda p: jsonl.read_chat_jsonl(spark, p).count()
    assert count(f"{tmp_path}/*.jsonl") == 6 and count([f"{tmp_path}/part0.jsonl", f"{tmp_path}/part[12].jsonl"]) == 6
    assert count(f"{tmp_path}/none*") == 0 and count([f"{tmp_path}/none", f"{tmp_path}/part1.jsonl"]) == 2


def test_malformed_chat_lines_are_never_lost(spark, tmp_path):
    path = str(tmp_path / "bad.jsonl")
    (tmp_path / "bad.jsonl").write_text("\n".join([chat_line("a"), '{"messages": [', "", '{"other": 1}']) + "\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        jsonl.read_chat_jsonl(spark, path).collect()
    kept = jsonl.read_chat_jsonl(spark, path, malformed="keep").collect()
    assert [r[schemas.CORRUPT] for r in kept if r[schemas.CORRUPT]] == ['{"messages": ['] and len(kept) == 2
    assert tuple(jsonl.malformed_lines(spark, path).first()) == (3, 1)


def test_null_content_is_kept_and_rejections_are_counted(spark):
    kind = "messages array<struct<role:string,content:string>>"
    rows = [([("user", "a"), ("assistant", None)],), ([("user", "a")],), ([("user", "a"), ("assistant", "b")],)]
    df = spark.createDataFrame(rows, kind)
    assert mixing.mix_sources({"x": df}).count() == 2 and mixing.mix_sources({"x": df}, allow_null_content=False).count() == 1
    assert [tuple(r) for r in mixing.mix_rejections({"x": df}).collect()] == [("x", 3, 2, 1)]


@pytest.mark.parametrize("n", [0, 1, 15, 37, 99, 100, 200])
def test_samples_are_exact_when_ids_repeat(spark, n):
    df = spark.range(100).select((F.col("id") % 10).alias("id"), F.col("id").alias("row"))
    sample = sampling.sample_n(df, n, exact=True)
    assert sample.count() == min(n, 100) == sample.select("row").distinct().count()
    split = Counter(r["split"] for r in sampling.train_eval_split(df, 0.15, exact=True).collect())
    assert split == {"eval": 15, "train": 85}


def test_stratified_candidates_need_no_single_task(spark):
    df = spark.range(100).selectExpr("concat('f', id) AS id", "'x' AS code", "'src/a' AS file_path", "false AS is_official", "0 AS stars")
    for n in (10, 5_000, 1_000_000):
        plan = sampling.stratified_sample(df, n)._jdf.queryExecution().executedPlan().toString()
        assert "Coalesce" not in plan
    big = sampling.stratified_sample(df, 1_000_000)
    assert big.count() == 100


def shuffled_columns(df):
    """Columns that the rows below every shuffle of a plan carry."""
    text = df._jdf.queryExecution().executedPlan().toString()
    lines = text.split("\n")
    return [lines[k + 1] for k, line in enumerate(lines[:-1]) if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]


def test_texts_stay_out_of_shuffles(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        log = spark.createDataFrame([], "source_file_id string, task_type string, timestamp timestamp, request_id long, finish_reason string, content string")
        files = spark.createDataFrame([], schemas.CORPUS_FILE)
        for plan in (genlog.clean_report(log), corpus.deduplicated_summary(files)):
            assert shuffled_columns(plan) and not any("content#" in x or "code#" in x for x in shuffled_columns(plan))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ids_by_key(spark):
    df = spark.range(500).selectExpr("concat('k', id) AS k", "repeat('text', 5) AS body").repartition(7)
    by_key = {r["k"]: r["id"] for r in ranking.dense_ids(df, ["k"], keys=["k"]).collect()}
    assert by_key == {r["k"]: r["id"] for r in ranking.dense_ids(df, ["k"]).collect()}


def test_paths_below_a_recurring_root(spark, tmp_path):
    for at in ("in/a.x", "in/in/a.x", "b.x"):
        target = tmp_path / "in" / at
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text("x" * 30)
    want = ["b.x", "in/a.x", "in/in/a.x"]
    for root in (f"{tmp_path}/in", f"{tmp_path}/in/", f"file://{tmp_path}/in", f"file:{tmp_path}/in"):
        assert sorted(r["path"] for r in trees.read_tree(spark, root, "x").collect()) == want


def test_large_keys_survive_a_null_beside_them(spark):
    rows = [(9007199254740993, [("user", "a")]), (None, [("user", "b")])]
    prompts = spark.createDataFrame(rows, "k long, messages array<struct<role:string,content:string>>").coalesce(1)

    def factory():
        return lambda messages, budget: {"content": messages[0]["content"], "input_tokens": 3}

    got = {(r["k"], r["content"], r["input_tokens"], r["error"]) for r in batch_respond(prompts, factory, ["k"]).collect()}
    assert got == {(9007199254740993, "a", 3, None), (None, "b", 3, None)}


@pytest.mark.parametrize("tile", [1024, 4])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(tiles, "TILE", tile)
    r = random.Random(4)
    texts = []
    for _ in range(8):
        base = [f"w{r.randint(0, 200)}" for _ in range(60)]
        for _ in range(r.randint(1, 9)):
            copy = list(base)
            for _ in range(r.randint(0, 3)):
                copy[r.randrange(60)] = f"w{r.randint(0, 200)}"
            texts.append(" ".join(copy))
    texts += ["one two", "One two", "", None, " ", texts[0], texts[0]]
    sets = [None if not (t or "").split() else {tuple(w[k:k + 5]) for w in [t.lower().split()] for k in range(max(1, len(w) - 4))} for t in texts]
    group = list(range(len(texts)))
    for _ in range(len(texts)):
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if x and y and len(x & y) / len(x | y) >= 0.8:
                    group[a] = group[b] = min(group[a], group[b])
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    assert {r["id"]: r["group_id"] for r in neardup.near_duplicate_groups(df).collect()} == dict(enumerate(group))
    assert sorted(r["id"] for r in neardup.near_dedup_minhash(df).collect()) == sorted(set(group))


def test_replies_with_broken_sections(spark):
    reply = "intro\n## Pair 1 [a/b]\n### Instruction\nDo\nit\n### Response\nok\n## Pair x [a/b]\n## Pair 2 [c/d]\n### Response\nno\n## Pair 3 [e/]\n### Instruction\ni\n### Response\nr"
    df = spark.createDataFrame([(1, reply), (2, None), (3, "none")], "id long, content string")
    got = [tuple(r)[2:] for r in pairs.parse_multi_pair(df).orderBy("pair_no").collect()]
    assert got == [(1, "a", "b", "Do\nit", "ok"), (3, "e", "", "i", "r")]


def test_pair_gates_on_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (2, "Write code.", "x" * 60), (3, "Explain this parser in detail", "y" * 60)], "id long, instruction string, response string")
    assert [r["id"] for r in df.where(pairs.length_bounds() & pairs.specific_instruction()).collect()] == [3]
    seeds = spark.createDataFrame([(3, "Y" * 60 + " "), (2, "other")], "id long, code string")
    assert sorted(r["id"] for r in pairs.not_a_copy(df, seeds, key="id").collect()) == [1, 2]


def test_extended_conversations_keep_every_row(spark):
    kind = "id long, messages array<struct<role:string,content:string>>"
    df = spark.createDataFrame([(i, [("system", "s"), ("user", f"u{i}"), ("assistant", "a")]) for i in range(200)], kind)
    rows = pairs.extend_conversations(df).collect()
    assert sum(r["merged"] for r in rows) == 200 and {r["merged"] for r in rows} <= {1, 2, 3} and any(r["merged"] == 3 for r in rows)
    said = [m["content"] for r in rows for m in r["messages"] if m["role"] == "user"]
    assert sorted(said) == sorted(f"u{i}" for i in range(200)) and all(sum(m["role"] == "system" for m in r["messages"]) == 1 for r in rows)


def test_interleaving_uses_up_every_set(spark):
    sets = {"a": spark.range(30), "b": spark.range(100, 107), "none": spark.range(0)}
    rows = mixing.interleave(sets, {"a": 0.5, "b": 0.5, "none": 0.2}).collect()
    assert {r["id"] for r in rows} == {*range(30), *range(100, 107)} and sorted(r["slot"] for r in rows) == list(range(len(rows)))


def test_weighted_draws_follow_the_weights(spark):
    df = spark.range(4000).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 9 ELSE 1 END AS w", "id % 4 = 3 AS dead")
    drawn = sampling.weighted_sample(df, 300, F.when(~F.col("dead"), F.col("w"))).collect()
    heavy = sum(r["w"] == 9 for r in drawn)
    assert len(drawn) == 300 and not any(r["dead"] for r in drawn) and heavy > 250
