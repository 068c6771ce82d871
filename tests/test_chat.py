"""Formats, rendering, validation, mixing."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.operators import chat, filters, mixing, prompts, validation

BOOK = prompts.PromptBook(language="Lang", system_prompt="sys")


def chats(spark, *conversations, extra=""):
    rows = [(i, None if c is None else [m if m is None else dict(zip(("role", "content"), m)) for m in c]) for i, c in enumerate(conversations)]
    return spark.createDataFrame(rows, "id long, messages array<struct<role:string,content:string>>")


S, U, A = ("system", "s"), ("user", "u"), ("assistant", "a")


def codes(spark, *conversations):
    found = validation.validate_chat(chats(spark, *conversations), "id").orderBy("entry_key", "ord").collect()
    out = {i: [] for i in range(len(conversations))}
    for r in found:
        out[r["entry_key"]].append(r["code"])
    return list(out.values())


def test_typed_rules_in_order(spark):
    got = codes(
        spark, [S, U, A], None, [], [U], [None, U, A], [(None, "x"), U, A], [("tool", "x"), U, A], [U, ("assistant", None)],
        [A, U, A], [S, A], [U, U, A], [U, A, A], [U, A, U], [U, ("tool", "t"), A], [("assistant", None)],
    )
    assert got == [
        [], ["E1"], ["E3"], ["E4", "E14"], ["E5"], ["E6"], ["E7", "E10"], ["E8"], ["E10"], ["E11"], ["E12"], ["E13"], ["E14"],
        ["E7", "E12"], ["E4", "E8", "E10"],
    ]


RAW = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, []),
    ({"source": "x"}, ["E1"]),
    ({"messages": "text"}, ["E2"]),
    ({"messages": None}, ["E2"]),
    ({"messages": {"role": "user"}}, ["E2"]),
    ({"messages": []}, ["E3"]),
    ({"messages": ["oops", {"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, ["E5"]),
    ({"messages": [{"content": "q"}, {"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, ["E6"]),
    ({"messages": [{"role": "user"}, {"role": "assistant", "content": "a"}]}, ["E8"]),
    ({"messages": [{"role": "user", "content": None}, {"role": "assistant", "content": 5}]}, ["E9", "E9"]),
    ({"messages": [{"role": None, "content": "q"}, {"role": "assistant", "content": "a"}]}, ["E7", "E10"]),
    ({"messages": [{"role": "user", "content": "q"}, {"role": 7, "content": "a"}]}, ["E7", "E12", "E14"]),
]


def test_raw_rules_tell_absent_null_and_type_apart(spark):
    df = spark.createDataFrame([(i, json.dumps(o)) for i, (o, _) in enumerate(RAW)], "id long, line string")
    found = {i: [] for i in range(len(RAW))}
    for r in validation.validate_chat(df, "id", raw="line").orderBy("entry_key", "ord").collect():
        found[r["entry_key"]].append(r["code"])
    assert list(found.values()) == [expected for _, expected in RAW]


def test_empty_dataset_fails(spark):
    row = validation.validation_summary(chats(spark, [U, A]).limit(0), "id").first()
    assert (row["entries"], row["valid_percent"], row["passed"]) == (0, 0.0, False)
    assert validation.validation_summary(chats(spark, [U, A]), "id").first()["passed"]


def test_quick_check(spark):
    df = chats(spark, [U, A], [], None, [U], [("tool", "x"), A], [U, (None, "x"), A], [("user", None), A])
    keep = lambda **o: [r["id"] for r in validation.quick_valid_messages(df, **o).orderBy("id").collect()]
    assert keep() == [0]
    assert keep(allow_null_content=True) == [0, 6]


def test_role_sequence(spark):
    assert validation.role_sequence_violations(chats(spark, [S, U, A], [U, A], [S, A, U], [])).first()[0] == 3


def test_sharegpt_speakers(spark):
    df = spark.createDataFrame(
        [(0, [("human", "h"), ("gpt", "g"), ("system", "s"), (None, "n")], "lisp"), (1, [], "lisp")],
        "id long, conversations array<struct<from:string,value:string>>, language string",
    )
    out = chat.sharegpt_to_chat(df).orderBy("id").collect()
    assert [m["role"] for m in out[0]["messages"]] == ["system", "user", "assistant", "assistant", "assistant"]
    assert [m["role"] for m in out[1]["messages"]] == ["system"]
    assert chat.convert_sharegpt(df, ["lisp"], "s").count() == 1
    assert chat.convert_sharegpt(df, ["ocaml"], "s").count() == 0


def test_ensure_system_looks_anywhere(spark):
    got = chat.ensure_system(chats(spark, [U, S, A], [U, A], [])).orderBy("id").collect()
    assert [[m["role"] for m in r["messages"]] for r in got] == [["user", "system", "assistant"], ["system", "user", "assistant"], ["system"]]


def test_exclude_task_types_keeps_null(spark):
    df = spark.createDataFrame([(None,), ("explanation",), ("completion",)], "task_type string")
    assert sorted(str(r[0]) for r in filters.exclude_task_types(df).collect()) == ["None", "completion"]


def test_render_and_spans_agree(spark):
    df = chats(spark, [("system", "<bos>"), ("user", "hé"), ("assistant", "a😀"), ("user", "x"), ("assistant", "")], [U], [("assistant", None)])
    for r in df.select("messages", chat.render_chat().alias("t"), chat.response_spans().alias("s")).collect():
        bodies = [(m["content"] or "") + "<turn|>\n" for m in r["messages"] if m["role"] == "assistant"]
        assert [r["t"][s["start"]:s["end"]] for s in r["s"]] == bodies
    one = chats(spark, [S, U, A]).select(chat.render_chat()).first()[0]
    assert one == "<|turn>system\ns<turn|>\n<|turn>user\nu<turn|>\n<|turn>model\na<turn|>\n"
    assert spark.range(1).select(chat.strip_bos(F.lit("<bos>x<bos>"))).first()[0] == "x<bos>"


def test_prompts_keep_code_verbatim(spark):
    code = "100% {code} %s \\n '\"\nline2"
    df = spark.createDataFrame([("i", code, "r")], "id string, code string, repo_name string")
    rows = {r["task_type"]: r["messages"][1]["content"] for r in prompts.build_prompts(df, BOOK).collect()}
    assert set(rows) == {"code_gen", "explanation", "completion"} and all(code in v for v in rows.values())
    assert "(from repo r):\n```lang\n" in rows["code_gen"] and rows["code_gen"].split("that: ")[-1] in prompts.CODE_GEN_INSTRUCTIONS
    assert rows["completion"].count("// TODO: implement") == 1


def test_unknown_task_fails(spark):
    df = spark.createDataFrame([("i", "c", "r", "poem")], "id string, code string, repo_name string, task_type string")
    with pytest.raises(ValueError):
        prompts.build_prompts(df, BOOK, ["poem"])
    with pytest.raises(Exception, match="Unknown task type: poem"):
        df.select(prompts.user_message(BOOK)).collect()


def test_template_chars_is_the_longest_prompt_around_empty_code(spark):
    df = spark.createDataFrame([(str(i), "", "") for i in range(200)], "id string, code string, repo_name string")
    built = prompts.build_prompts(df, BOOK, ["code_gen"]).select(
        F.max(F.length(F.col("messages")[0]["content"]) + F.length(F.col("messages")[1]["content"])))
    assert built.first()[0] == BOOK.template_chars()


def test_failed_first_turn_has_no_second(spark):
    files = spark.createDataFrame([("f", "c", "r"), ("g", "c", "r")], "id string, code string, repo_name string")
    answers = spark.createDataFrame(
        [("f", 1, "fine", None, "2", "a"), ("f", 1, "old", None, "1", "b"), ("g", 1, None, "boom", "1", "c")],
        "source_file_id string, turn int, content string, error string, timestamp string, request_id string")
    turn2 = prompts.agent_turn2(prompts.agent_turn1(files, BOOK), answers, BOOK).collect()
    assert [r["source_file_id"] for r in turn2] == ["f"]
    assert [m["role"] for m in turn2[0]["messages"]] == ["system", "user", "assistant", "user"]
    assert turn2[0]["messages"][2]["content"] == "fine"


def test_duplicate_corpus_ids_do_not_multiply(spark):
    corpus = spark.createDataFrame([("f", "one", "r", "u", 1), ("f", "two", "r", "u", 2)], "id string, code string, repo_name string, repo_url string, seq int")
    training = spark.createDataFrame([("f", "explanation"), ("x", "explanation")], "source_file_id string, task_type string")
    assert [r["code"] for r in chat.join_training_to_corpus(training, corpus, "seq").collect()] == ["two"]
    assert [r["source_file_id"] for r in chat.missing_in_corpus(training, corpus).collect()] == ["x"]


def test_corpus_is_cut_down_before_its_texts_are_shuffled(spark):
    from corpusloom.operators import joins

    corpus = spark.range(2000).selectExpr("concat('f', id) AS id", "concat('code ', id) AS code", "'r' AS repo_name", "CAST(NULL AS STRING) AS repo_url")
    corpus = corpus.unionByName(corpus.where("id IN ('f3', 'f5')")).unionByName(spark.createDataFrame([(None, "n", "r", "u")], "id string, code string, repo_name string, repo_url string"))
    training = spark.createDataFrame([("f3", "a"), ("f3", "b"), ("f9", None), (None, "c"), ("x", "d")], "source_file_id string, task_type string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = chat.join_training_to_corpus(training, corpus)
        assert sorted(map(str, joined.select("source_file_id", "task_type", "code").collect())) == [
            "Row(source_file_id='f3', task_type='a', code='code 3')", "Row(source_file_id='f3', task_type='b', code='code 3')",
            "Row(source_file_id='f9', task_type=None, code='code 9')"]
        plan = joined._jdf.queryExecution().executedPlan().toString()
        filters = [x for x in plan.splitlines() if "BroadcastHashJoin" in x]
        assert filters and all("LeftSemi" in x for x in filters)
        assert chat.join_training_to_corpus(training.limit(0), corpus).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = spark.createDataFrame([(f"f{i}",) for i in range(300)] + [(None,)], "id string")
    for bits in (64, 1 << 12, joins.FILTER_BITS):
        left = joins.maybe_joins(corpus, keys, "id", bits)
        assert left.join(keys, "id", "left_semi").count() == 302 and left.columns == corpus.columns
    assert left.count() < 310
    numbers = spark.range(10)
    assert joins.maybe_joins(numbers, numbers.select(numbers.id.cast("int").alias("id")), "id").count() == 10


def test_mix_fields_and_json(spark, tmp_path):
    from corpusloom.sources.jsonl import read_chat_jsonl, write_jsonl

    domain = chats(spark, [U, A], [U, A], [U]).withColumn("task_type", F.when(F.col("id") == 1, "explanation"))
    tagged = chats(spark, [U, A]).withColumn("source", F.lit("own")).withColumn("language", F.lit("lisp"))
    mixed = mixing.mix_sources({"domain": domain, "tagged": tagged}, domain="domain")
    assert sorted((r["source"], r["task_type"], r["language"]) for r in mixed.collect()) == [("domain", None, None), ("own", None, "lisp")]
    path = str(tmp_path / "mix")
    write_jsonl(mixed, path)
    keys = {tuple(sorted(json.loads(r["value"]))) for r in spark.read.text(path).collect()}
    assert keys == {("messages", "source"), ("language", "messages", "source")}
    assert read_chat_jsonl(spark, path).count() == 2
    assert read_chat_jsonl(spark, str(tmp_path / "none")).count() == 0


def test_stats_take_null_content_as_empty(spark):
    df = chats(spark, [U, ("assistant", None)], [("user", "four"), A]).withColumn("source", F.lit("x"))
    stats = {(r["stat"], r["key"]): r["value"] for r in mixing.mix_stats(df).collect()}
    assert stats[("min_content_len", None)] == 0 and stats[("avg_content_len", None)] == 1.5
    assert stats[("source_percent", "x")] == 100.0 and stats[("role_count", "assistant")] == 2
    full = {(r["stat"], r["key"]): r["value"] for r in mixing.chat_stats(df).collect()}
    assert full[("length_median", None)] == 1.0 and full[("messages_median", None)] == 2.0


def test_stats_of_nothing(spark):
    nothing = chats(spark, [U, A]).withColumn("source", F.lit("x")).limit(0)
    assert [(r["stat"], r["value"]) for r in mixing.mix_stats(nothing).collect()] == [("total_records", 0.0)]
    assert [(r["stat"], r["value"]) for r in mixing.chat_stats(nothing).collect()] == [("total_entries", 0.0)]


def test_declared_chat_columns():
    assert chat.CHAT_COLUMNS == schemas.CHAT_RECORD.fieldNames()
