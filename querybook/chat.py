"""Prompts, chat records, validation and mixing."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from corpusloom.operators import chat, filters, mixing, prompts, ranking, validation
from corpusloom.operators import genlog as log_ops
from corpusloom.operators.respond import batch_respond
from corpusloom.operators.sampling import shuffle_rows
from corpusloom.packaging import ship
from corpusloom.session import scratch_path
from corpusloom.sources.parquet import raw_snapshot
from querybook.fixtures import chat_fx, corpus_fx, gen_fx, sql, table
from querybook.registry import query

BOOK = prompts.PromptBook(language="Prose", system_prompt="You are a helpful Prose assistant.", fence="txt")

_NL = "chr(10)"


def _lit(text: str) -> str:
    """A Python string as a DuckDB expression (newlines by chr)."""
    return " || chr(10) || ".join("'" + line.replace("'", "''") + "'" for line in text.split("\n"))


_PICK = "('0x' || substr(md5('42|' || {id}), 1, 8))::BIGINT % 5"
_INSTRUCTION = "CASE " + _PICK + " " + " ".join(
    f"WHEN {i} THEN '{t}'" for i, t in enumerate([
        "implements a different data structure with similar operations",
        "provides a complementary utility module for the same domain",
        "solves a simplified version of the same problem",
        "extends this module with additional related functionality",
        "implements the inverse or opposite operations"])) + " END"
_CODE_GEN_HEAD = ("Based on the following Prose code, write a new Prose module that solves a related but different problem. "
                  "Use idiomatic Prose: type annotations, pattern matching, Result for errors, pipe operators where appropriate."
                  "\n\nReference code (from repo ")
_EXPLAIN_HEAD = ("Explain the following Prose code in detail. Describe what each function does, how types are used, and any "
                 "notable patterns or idioms you notice.\n\n```txt\n")
_COMPLETE_HEAD = ("Complete the following partial Prose module. The code has been truncated — finish implementing the "
                  "remaining functions to make a complete, working module.\n\n```txt\n")
_PARTIAL = (f"array_to_string(string_split(code, {_NL})[1:greatest(5, CAST(floor(len(string_split(code, {_NL})) * 0.6::DOUBLE) "
            f"AS BIGINT))], {_NL}) || {_NL} || '// TODO: implement the remaining functions'")


def user_sql(task: str, file_id: str) -> str:
    return f"""CASE {task}
      WHEN 'code_gen' THEN {_lit(_CODE_GEN_HEAD)} || repo_name || {_lit("):" + chr(10) + "```txt" + chr(10))} || code
        || {_lit(chr(10) + "```" + chr(10) * 2 + "Write a Prose module that: ")} || {_INSTRUCTION.format(id=file_id)}
      WHEN 'explanation' THEN {_lit(_EXPLAIN_HEAD)} || code
        || {_lit(chr(10) + "```" + chr(10) * 2 + "Provide a thorough explanation suitable for someone learning Prose.")}
      WHEN 'completion' THEN {_lit(_COMPLETE_HEAD)} || {_PARTIAL}
        || {_lit(chr(10) + "```" + chr(10) * 2 + "Complete the implementation. Include type annotations and follow Prose conventions.")}
      END"""


_TASKS = "(SELECT unnest(['code_gen', 'explanation', 'completion']) AS task_type) t"


def training(spark, sf):
    """Cleaned log, stored first: the join below reads it twice."""
    return raw_snapshot(log_ops.clean_log(gen_fx(spark, sf), tie="request_seq"), scratch_path(spark, "train"))


def joined(spark, sf):
    return chat.join_training_to_corpus(training(spark, sf), corpus_fx(spark, sf))


# --- prompts --------------------------------------------------------------------------------------


@query("files_x_tasks", sql(f"SELECT id, task_type FROM corpus_fx, {_TASKS}", "corpus_fx"))
def _(spark, sf):
    return prompts.files_x_tasks(corpus_fx(spark, sf).select("id"))


@query("build_prompts",
       sql(f"""SELECT source_file_id, task_type, max_tokens, length(u) AS n_chars, md5(u) AS digest FROM (
                 SELECT id AS source_file_id, task_type, {user_sql('task_type', 'id')} AS u,
                   CASE task_type WHEN 'explanation' THEN 8192 ELSE 4096 END AS max_tokens FROM corpus_fx, {_TASKS})""", "corpus_fx"))
def _(spark, sf):
    built = prompts.build_prompts(corpus_fx(spark, sf), BOOK)
    user = F.element_at("messages", 2)["content"]
    return built.select(
        "source_file_id", "task_type", "max_tokens", F.length(user).cast("long").alias("n_chars"), F.md5(user).alias("digest")
    )


_SESSION_SQL = """SELECT *, CASE task_type WHEN 'code_gen' THEN 1 ELSE 2 END AS turn FROM latest
  WHERE task_type IN ('code_gen', 'completion')"""


def sessions(spark, sf):
    """Latest code_gen rows play first turns, completion rows second turns."""
    from corpusloom.operators.dedup import latest_per_key

    newest = latest_per_key(gen_fx(spark, sf), log_ops.LOG_KEYS, tie="request_seq")
    return newest.filter(F.col("task_type").isin("code_gen", "completion")).select(
        "source_file_id", F.col("request_seq").alias("request_id"), "timestamp", "content", "error",
        F.when(F.col("task_type") == "code_gen", 1).otherwise(2).alias("turn"),
    )


@query("build_agent_turns",
       sql(f"""SELECT c.id AS source_file_id, CAST(4 AS INTEGER) AS n_messages, md5({_lit(
              "I'm working with a Prose codebase and looking at this file from repo ")} || repo_name || {_lit(
              ". Can you analyze it for me?" + chr(10) * 2 + "```txt" + chr(10))} || code || {_lit(
              chr(10) + "```" + chr(10) * 2 + "Describe the key types, functions, and patterns used. What does this module do?")})
              AS question, md5(content) AS answer, 'user' AS last_role
            FROM ss JOIN corpus_fx c ON c.id = ss.source_file_id WHERE turn = 1 AND error IS NULL""", "latest", ss=_SESSION_SQL))
def _(spark, sf):
    turn2 = prompts.agent_turn2(prompts.agent_turn1(corpus_fx(spark, sf), BOOK), sessions(spark, sf), BOOK)
    m = F.col("messages")
    return turn2.select(
        "source_file_id", F.size(m).alias("n_messages"), F.md5(m[1]["content"]).alias("question"),
        F.md5(m[2]["content"]).alias("answer"), m[3]["role"].alias("last_role"),
    )


@query("prompt_response_pairing",
       sql("""SELECT a.source_file_id, a.request_seq AS turn1_request_id, b.request_seq AS turn2_request_id, a.error AS turn1_error,
                b.error AS turn2_error FROM (SELECT * FROM ss WHERE turn = 1) a
              LEFT JOIN (SELECT * FROM ss WHERE turn = 2) b ON a.source_file_id = b.source_file_id""", "latest", ss=_SESSION_SQL))
def _(spark, sf):
    paired = prompts.prompt_response_pairing(sessions(spark, sf), ["source_file_id"])
    return paired.select("source_file_id", "turn1_request_id", "turn2_request_id", "turn1_error", "turn2_error")


def _length_responder():
    def respond(messages, max_tokens):
        text = messages[-1]["content"]
        if len(text) % 11 == 0:
            raise ValueError("refused")
        return {"content": f"{len(text)} characters", "finish_reason": "stop", "input_tokens": len(text),
                "output_tokens": max_tokens, "wall_time_ms": 0}

    return respond


@query("batch_respond",
       sql(f"""SELECT source_file_id, task_type, CASE WHEN n % 11 <> 0 THEN n || ' characters' END AS content,
                 CASE WHEN n % 11 <> 0 THEN 'stop' END AS finish_reason, CASE WHEN n % 11 = 0 THEN 0 ELSE n END AS input_tokens,
                 CAST(CASE WHEN n % 11 = 0 THEN 0 WHEN task_type = 'explanation' THEN 8192 ELSE 4096 END AS BIGINT) AS output_tokens,
                 CASE WHEN n % 11 = 0 THEN 'refused' END AS error, CASE WHEN n % 11 = 0 THEN 'ValueError' END AS error_type
               FROM (SELECT id AS source_file_id, task_type, length({user_sql('task_type', 'id')}) AS n FROM corpus_fx, {_TASKS})""",
           "corpus_fx"))
def _(spark, sf):
    ship(spark, Path(__file__).resolve().parent)  # the responder below is pickled by reference
    built = prompts.build_prompts(corpus_fx(spark, sf), BOOK)
    answered = batch_respond(
        built, _length_responder, ["source_file_id", "task_type"], max_retries=1, base_delay=0.0, max_tokens_col="max_tokens"
    )
    return answered.drop("wall_time_ms")


# --- chat records -----------------------------------------------------------------------------------


@query("join_training_to_corpus",
       sql("""SELECT t.source_file_id, t.task_type, t.model, c.repo_url, md5(c.code) AS digest
              FROM train_fx t JOIN corpus_fx c ON c.id = t.source_file_id""", "train_fx"))
def _(spark, sf):
    return joined(spark, sf).select("source_file_id", "task_type", "model", "repo_url", F.md5("code").alias("digest"))


@query("missing_in_corpus",
       sql("SELECT source_file_id, task_type FROM train_fx WHERE source_file_id NOT IN (SELECT id FROM corpus_fx)", "train_fx"))
def _(spark, sf):
    return chat.missing_in_corpus(training(spark, sf), corpus_fx(spark, sf)).select("source_file_id", "task_type")


_RECORD_SQL = f"""SELECT 'sft_' || lpad(CAST(row_number() OVER (ORDER BY t.task_type, t.source_file_id) AS STRING), 5, '0') AS id,
  t.source_file_id, c.repo_url AS source_repo_url, t.task_type, t.model AS model_used, 'Apache-2.0' AS license,
  {user_sql('t.task_type', 't.source_file_id')} AS u, t.content AS a
  FROM train_fx t JOIN corpus_fx c ON c.id = t.source_file_id"""


def records(spark, sf):
    # one record per file and task: the pair is the key
    return ranking.dense_ids(chat.to_chat_record(joined(spark, sf), BOOK), ["task_type", "source_file_id"], keys=["task_type", "source_file_id"])


@query("to_chat_record",
       sql("""SELECT id, source_file_id, source_repo_url, task_type, model_used, license, md5(u) AS question, md5(a) AS answer
              FROM rc""", "train_fx", rc=_RECORD_SQL))
def _(spark, sf):
    m = F.col("messages")
    return records(spark, sf).select(
        "id", "source_file_id", "source_repo_url", "task_type", "model_used", "license",
        F.md5(m[1]["content"]).alias("question"), F.md5(m[2]["content"]).alias("answer"),
    )


@query("role_sequence_violations", "SELECT CAST(count(*) AS BIGINT) AS violations FROM (SELECT conv_id, "
       "string_agg(role, ',' ORDER BY turn) AS r FROM conversations GROUP BY conv_id) WHERE r <> 'system,user,assistant'")
def _(spark, sf):
    return validation.role_sequence_violations(chat_fx(spark, sf))


# each turn's role and text inside its conversation, one row per message
_TURNS = "SELECT conv_id, turn, role, text FROM conversations"


def flat(df, key="conv_id"):
    """Messages as rows, so that nested values compare by hash."""
    return df.select(key, F.posexplode("messages").alias("pos", "m")).select(
        key, F.col("pos").cast("long").alias("pos"), "m.role", F.md5("m.content").alias("digest")
    )


def sharegpt(spark, sf):
    turns = F.transform("messages", lambda m: F.struct(
        F.when(m["role"] == "user", "human").when(m["role"] == "assistant", "gpt").otherwise(m["role"]).alias("from"),
        m["content"].alias("value"),
    ))
    languages = F.array(*[F.lit(x) for x in ("haskell", "elixir", "python", "ocaml", "rust", "lisp")])
    return chat_fx(spark, sf).select(
        "conv_id", turns.alias("conversations"), languages[(F.col("conv_id") % 6).cast("int")].alias("language")
    )


_LANG = "CASE conv_id % 6 WHEN 0 THEN 'haskell' WHEN 1 THEN 'elixir' WHEN 2 THEN 'python' WHEN 3 THEN 'ocaml' WHEN 4 THEN 'rust' ELSE 'lisp' END"


@query("sharegpt_to_chat",
       """SELECT conv_id, turn + 1 AS pos, CASE role WHEN 'user' THEN 'user' ELSE 'assistant' END AS role, md5(text) AS digest
          FROM conversations
          UNION ALL SELECT DISTINCT conv_id, 0, 'system', md5('You are a helpful programming assistant.') FROM conversations""")
def _(spark, sf):
    return flat(chat.sharegpt_to_chat(sharegpt(spark, sf)))


@query("filter_languages", f"SELECT DISTINCT conv_id, {_LANG} AS language FROM conversations WHERE {_LANG} NOT IN ('python', 'rust')")
def _(spark, sf):
    return filters.filter_languages(sharegpt(spark, sf)).select("conv_id", "language")


@query("language_counts", f"SELECT {_LANG} AS language, count(DISTINCT conv_id) AS n FROM conversations GROUP BY 1")
def _(spark, sf):
    return chat.language_counts(sharegpt(spark, sf))


@query("require_assistant_last",
       "SELECT conv_id FROM conversations GROUP BY conv_id HAVING max_by(role, turn) = 'assistant'")
def _(spark, sf):
    return filters.require_assistant_last(chat_fx(spark, sf)).select("conv_id")


@query("pair_to_chat",
       """SELECT item_id, CAST(0 AS BIGINT) AS pos, 'system' AS role, md5('You are a helpful programming assistant.') AS digest FROM benchmark
          UNION ALL SELECT item_id, 1, 'user', md5('Question ' || item_id) FROM benchmark
          UNION ALL SELECT item_id, 2, 'assistant', md5(text) FROM benchmark""")
def _(spark, sf):
    pairs = table(spark, sf, "benchmark").selectExpr("item_id", "concat('Question ', item_id) AS input", "text AS output")
    return flat(chat.pair_to_chat(pairs), "item_id")


@query("ensure_system",
       """WITH s AS (SELECT conv_id, bool_or(role = 'system') AS has FROM conversations GROUP BY conv_id)
          SELECT conv_id, turn + CASE WHEN has THEN 0 ELSE 1 END AS pos, role, md5(text) AS digest FROM conversations JOIN s USING (conv_id)
          UNION ALL SELECT conv_id, 0, 'system', md5('You are a helpful assistant.') FROM s WHERE NOT has""")
def _(spark, sf):
    return flat(chat.ensure_system(chat_fx(spark, sf)))


_RENDER = """SELECT conv_id, string_agg('<|turn>' || CASE role WHEN 'assistant' THEN 'model' ELSE role END || chr(10) || text || '<turn|>'
  || chr(10), '' ORDER BY turn) AS t FROM conversations GROUP BY conv_id"""


@query("render_chat", f"SELECT conv_id, length(t) AS n_chars, md5(t) AS digest FROM ({_RENDER})")
def _(spark, sf):
    rendered = chat_fx(spark, sf).select("conv_id", chat.render_chat().alias("t"))
    return rendered.select("conv_id", F.length("t").cast("long").alias("n_chars"), F.md5("t").alias("digest"))


@query("response_spans",
       """SELECT conv_id, CAST(e - b AS BIGINT) AS start, CAST(e AS BIGINT) AS "end" FROM (
            SELECT conv_id, role, length(text) + 8 AS b,
              sum(8 + length(CASE role WHEN 'assistant' THEN 'model' ELSE role END) + length(text) + 8)
                OVER (PARTITION BY conv_id ORDER BY turn) AS e FROM conversations) WHERE role = 'assistant'""")
def _(spark, sf):
    return chat_fx(spark, sf).select("conv_id", F.inline(chat.response_spans()))


# --- mixing -------------------------------------------------------------------------------------------


def mix_parts(spark, sf):
    chats = chat_fx(spark, sf)
    part = F.col("conv_id") % 4
    task = F.when(F.col("conv_id") % 3 == 0, "code_gen").when(F.col("conv_id") % 3 == 1, "explanation")
    own = F.when(F.col("conv_id") % 5 == 0, "handmade")
    return {
        "domain": chats.filter(part == 0).withColumn("task_type", task),
        "functional": chats.filter(part == 1).withColumn("language", F.lit("elixir")),
        "general": chats.filter(part == 2).withColumn("source", own),
        "coding": chats.filter(part == 3),
    }


_PARTS = """SELECT conv_id, CASE conv_id % 4 WHEN 0 THEN 'domain' WHEN 1 THEN 'functional'
    WHEN 2 THEN CASE WHEN conv_id % 5 = 0 THEN 'handmade' ELSE 'general' END ELSE 'coding' END AS source,
  CASE WHEN conv_id % 4 = 0 THEN CASE conv_id % 3 WHEN 0 THEN 'code_gen' WHEN 1 THEN 'explanation' END END AS task_type,
  CASE WHEN conv_id % 4 = 1 THEN 'elixir' END AS language, count(*) AS n, max_by(role, turn) AS last_role
  FROM conversations GROUP BY conv_id"""
_MIX = "SELECT * FROM parts WHERE coalesce(task_type, '') <> 'explanation' AND last_role = 'assistant'"


def mixed(spark, sf):
    return mixing.mix_sources(mix_parts(spark, sf), domain="domain", keep=["conv_id"])


@query("mix_sources", sql("SELECT conv_id, source, task_type, language, n AS n_messages FROM mx", parts=_PARTS, mx=_MIX))
def _(spark, sf):
    shuffled = shuffle_rows(mixed(spark, sf), id_col="conv_id")
    return shuffled.select("conv_id", "source", "task_type", "language", F.size("messages").cast("long").alias("n_messages"))


@query("tag_source",
       """SELECT conv_id, CASE WHEN conv_id % 5 = 0 THEN 'handmade' ELSE 'general' END AS source FROM conversations GROUP BY conv_id""")
def _(spark, sf):
    some = chat_fx(spark, sf).withColumn("source", F.when(F.col("conv_id") % 5 == 0, "handmade"))
    return chat.tag_source(some, "general").select("conv_id", "source")


@query("exclude_task_types",
       sql("SELECT conv_id, task_type FROM parts WHERE task_type IS NULL OR task_type <> 'explanation'", parts=_PARTS))
def _(spark, sf):
    tasks = chat_fx(spark, sf).withColumn("task_type", F.when(F.col("conv_id") % 4 == 0, F.when(
        F.col("conv_id") % 3 == 0, "code_gen").when(F.col("conv_id") % 3 == 1, "explanation")))
    return filters.exclude_task_types(tasks).select("conv_id", "task_type")


_MIX_TURNS = "SELECT m.*, c.role, length(c.text) AS len FROM mx m JOIN conversations c USING (conv_id)"


@query("mix_stats",
       sql("""SELECT 'total_records' AS stat, NULL AS key, CAST(count(*) AS DOUBLE) AS value FROM mx
              UNION ALL SELECT 'total_messages', NULL, CAST(count(*) AS DOUBLE) FROM mt
              UNION ALL SELECT 'avg_content_len', NULL, CAST(sum(len) AS BIGINT) / CAST(count(*) AS DOUBLE) FROM mt
              UNION ALL SELECT 'max_content_len', NULL, CAST(max(len) AS DOUBLE) FROM mt
              UNION ALL SELECT 'min_content_len', NULL, CAST(min(len) AS DOUBLE) FROM mt
              UNION ALL SELECT 'source_count', source, CAST(count(*) AS DOUBLE) FROM mx GROUP BY source
              UNION ALL SELECT 'source_percent', source, 100.0::DOUBLE * count(*) / (SELECT count(*) FROM mx) FROM mx GROUP BY source
              UNION ALL SELECT 'role_count', role, CAST(count(*) AS DOUBLE) FROM mt GROUP BY role""",
           parts=_PARTS, mx=_MIX, mt=_MIX_TURNS))
def _(spark, sf):
    return mixing.mix_stats(mixed(spark, sf))


@query("chat_stats",
       sql("""SELECT 'total_entries' AS stat, NULL AS key, CAST(count(*) AS DOUBLE) AS value FROM mx
              UNION ALL SELECT 'messages_mean', NULL, avg(n) FROM mx UNION ALL SELECT 'messages_median', NULL, median(n) FROM mx
              UNION ALL SELECT 'messages_max', NULL, CAST(max(n) AS DOUBLE) FROM mx
              UNION ALL SELECT 'messages_min', NULL, CAST(min(n) AS DOUBLE) FROM mx
              UNION ALL SELECT 'length_mean', NULL, avg(len) FROM mt UNION ALL SELECT 'length_median', NULL, median(len) FROM mt
              UNION ALL SELECT 'length_max', NULL, CAST(max(len) AS DOUBLE) FROM mt
              UNION ALL SELECT 'length_min', NULL, CAST(min(len) AS DOUBLE) FROM mt
              UNION ALL SELECT 'role', role, CAST(count(*) AS DOUBLE) FROM mt GROUP BY role
              UNION ALL SELECT 'source', source, CAST(count(*) AS DOUBLE) FROM mx GROUP BY source
              UNION ALL SELECT 'task_type', task_type, CAST(count(*) AS DOUBLE) FROM mx WHERE task_type IS NOT NULL GROUP BY task_type
              UNION ALL SELECT 'language', language, CAST(count(*) AS DOUBLE) FROM mx WHERE language IS NOT NULL GROUP BY language""",
           parts=_PARTS, mx=_MIX, mt=_MIX_TURNS))
def _(spark, sf):
    return mixing.chat_stats(mixed(spark, sf))


# --- validation ---------------------------------------------------------------------------------------

# conversations with faults worked in by conv_id; the SQL side applies the same faults
_FAULTY = """SELECT conv_id, turn,
    CASE WHEN conv_id % 10 = 2 AND turn = 1 THEN 'tool' WHEN conv_id % 10 = 3 AND turn >= 1 THEN 'user'
         WHEN conv_id % 10 = 4 AND turn = 0 THEN NULL WHEN conv_id % 10 = 7 AND turn = 0 THEN 'assistant'
         WHEN conv_id % 10 = 8 AND turn = 1 THEN 'system' ELSE role END AS role,
    CASE WHEN conv_id % 10 = 1 AND turn = 0 THEN NULL ELSE text END AS content
  FROM {conversations} WHERE NOT (conv_id % 10 = 5 AND turn > 0)"""
_ROLED = """SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back
  FROM ft WHERE {with_role}"""
_SEQUENCE = """
  UNION ALL SELECT conv_id, 'E10' FROM rl WHERE k = 1 AND coalesce(role, '') NOT IN ('system', 'user')
  UNION ALL SELECT conv_id, 'E11' FROM rl WHERE prev = 'system' AND coalesce(role, '') <> 'user'
  UNION ALL SELECT conv_id, 'E12' FROM rl WHERE prev = 'user' AND coalesce(role, '') <> 'assistant'
  UNION ALL SELECT conv_id, 'E13' FROM rl WHERE prev = 'assistant' AND coalesce(role, '') <> 'user'
  UNION ALL SELECT conv_id, 'E14' FROM rl WHERE back = 1 AND coalesce(role, '') <> 'assistant'"""
_TYPED_ERRORS = """
  SELECT conv_id, 'E4' AS code FROM ft GROUP BY conv_id HAVING count(*) < 2
  UNION ALL SELECT conv_id, 'E6' FROM ft WHERE role IS NULL
  UNION ALL SELECT conv_id, 'E7' FROM ft WHERE role NOT IN ('system', 'user', 'assistant')
  UNION ALL SELECT conv_id, 'E8' FROM ft WHERE content IS NULL""" + _SEQUENCE
_TYPED = {"ft": _FAULTY.format(conversations="conversations"), "rl": _ROLED.format(with_role="role IS NOT NULL"), "er": _TYPED_ERRORS}


def faulty(spark, sf):
    turns = spark.sql(_FAULTY, conversations=table(spark, sf, "conversations"))
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "content")))
    return turns.groupBy("conv_id").agg(
        F.transform(ordered, lambda m: F.struct(m["role"], m["content"])).alias("messages")
    )


@query("validate_chat", sql("SELECT conv_id AS entry_key, code, count(*) AS n FROM er GROUP BY 1, 2", **_TYPED))
def _(spark, sf):
    found = validation.validate_chat(faulty(spark, sf), "conv_id")
    return found.groupBy("entry_key", "code").agg(F.count(F.lit(1)).alias("n"))


@query("validation_summary",
       sql("""SELECT count(*) AS entries, count(*) FILTER (bad = 0) AS valid, CAST(sum(bad) AS BIGINT) AS errors,
                100.0::DOUBLE * count(*) FILTER (bad = 0) / count(*) AS valid_percent, sum(bad) = 0 AS passed
              FROM (SELECT conv_id, (SELECT count(*) FROM er WHERE er.conv_id = f.conv_id) AS bad
                    FROM (SELECT DISTINCT conv_id FROM ft) f)""", **_TYPED))
def _(spark, sf):
    return validation.validation_summary(faulty(spark, sf), "conv_id")


@query("quick_valid_messages",
       sql("""SELECT conv_id FROM ft GROUP BY conv_id HAVING bool_and(role IS NOT NULL AND role IN ('system', 'user', 'assistant')
                AND content IS NOT NULL) AND max_by(coalesce(role, '?'), turn) = 'assistant'""", **_TYPED))
def _(spark, sf):
    return validation.quick_valid_messages(faulty(spark, sf)).select("conv_id")


@query("quick_valid_messages_null_content",
       sql("""SELECT conv_id FROM ft GROUP BY conv_id HAVING bool_and(role IS NOT NULL AND role IN ('system', 'user', 'assistant'))
                AND max_by(coalesce(role, '?'), turn) = 'assistant'""", **_TYPED))
def _(spark, sf):
    return validation.quick_valid_messages(faulty(spark, sf), allow_null_content=True).select("conv_id")


_RAW_FAULTS = """SELECT conv_id, turn, role, content,
    CASE WHEN conv_id % 10 = 2 AND turn = 1 THEN 'not_object' WHEN conv_id % 10 = 8 AND turn = 0 THEN 'null_content'
         WHEN conv_id % 10 = 6 AND turn = 1 THEN 'number_content' WHEN conv_id % 10 = 4 AND turn = 1 THEN 'null_role'
         ELSE 'as_is' END AS fault
  FROM {faulty}"""
_RAW_ERRORS = """
  SELECT conv_id, 'E1' AS code FROM (SELECT DISTINCT conv_id FROM rf) WHERE conv_id % 20 = 9
  UNION ALL SELECT conv_id, 'E2' FROM (SELECT DISTINCT conv_id FROM rf) WHERE conv_id % 20 = 19
  UNION ALL SELECT conv_id, 'E3' FROM (SELECT DISTINCT conv_id FROM rf) WHERE conv_id % 20 = 10
  UNION ALL SELECT conv_id, 'E4' FROM ft GROUP BY conv_id HAVING count(*) < 2
  UNION ALL SELECT conv_id, 'E5' FROM ft WHERE fault = 'not_object'
  UNION ALL SELECT conv_id, 'E6' FROM ft WHERE role IS NULL AND fault NOT IN ('null_role', 'not_object')
  UNION ALL SELECT conv_id, 'E7' FROM ft WHERE fault = 'null_role' OR (fault <> 'not_object' AND role NOT IN ('system', 'user', 'assistant'))
  UNION ALL SELECT conv_id, 'E8' FROM ft WHERE fault = 'as_is' AND content IS NULL
  UNION ALL SELECT conv_id, 'E9' FROM ft WHERE fault IN ('null_content', 'number_content')""" + _SEQUENCE
_RAW = {
    "f0": _FAULTY.format(conversations="conversations"), "rf": _RAW_FAULTS.format(faulty="f0"),
    "ft": """SELECT conv_id, turn, CASE WHEN fault = 'null_role' THEN NULL ELSE role END AS role, content, fault
             FROM rf WHERE conv_id % 20 NOT IN (9, 19, 10)""",
    "rl": _ROLED.format(with_role="fault <> 'not_object' AND (role IS NOT NULL OR fault = 'null_role')"), "er": _RAW_ERRORS,
}


@query("validate_chat_raw", sql("SELECT conv_id AS entry_key, code, count(*) AS n FROM er GROUP BY 1, 2", **_RAW))
def _(spark, sf):
    base = spark.sql(_FAULTY, conversations=table(spark, sf, "conversations"))
    turns = spark.sql(_RAW_FAULTS, faulty=base).withColumn("json", F.expr("""
        CASE fault WHEN 'not_object' THEN '"oops"'
          WHEN 'null_content' THEN concat('{"role":', coalesce(concat('"', role, '"'), 'null'), ',"content":null}')
          WHEN 'number_content' THEN concat('{"role":"', role, '","content":5}')
          WHEN 'null_role' THEN '{"role":null,"content":"kept"}'
          ELSE to_json(named_struct('role', role, 'content', content)) END"""))
    ordered = F.array_sort(F.collect_list(F.struct("turn", "json")))
    whole = turns.groupBy("conv_id").agg(F.concat_ws(",", F.transform(ordered, lambda m: m["json"])).alias("body"))
    raw = whole.select("conv_id", F.expr("""
        CASE conv_id % 20 WHEN 9 THEN '{"source":"x"}' WHEN 19 THEN '{"messages":"text"}' WHEN 10 THEN '{"messages":[]}'
          ELSE concat('{"messages":[', body, ']}') END AS line"""))
    found = validation.validate_chat(raw, "conv_id", raw="line")
    return found.groupBy("entry_key", "code").agg(F.count(F.lit(1)).alias("n"))


@query("limit_errors",
       sql("SELECT entry_key FROM (SELECT conv_id AS entry_key FROM er ORDER BY conv_id LIMIT 20)", **_TYPED))
def _(spark, sf):
    return validation.limit_errors(validation.validate_chat(faulty(spark, sf), "conv_id")).select("entry_key")
