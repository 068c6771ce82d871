"""Pairs: near duplicates, parsing, building, quality gates, judging, proportions and interleaving."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import mixing, neardup, pairs, sampling, setjoin
from querybook.fixtures import chat_fx, corpus_fx, sql, table
from querybook.registry import query

_NEAR = r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(lower(text), '\S+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE c / (x.n + y.n - c) >= 0.8),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS group_id FROM documents d LEFT JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id
"""


@query("near_dedup_minhash", _NEAR)
def _(spark, sf):
    return neardup.near_duplicate_groups(table(spark, sf, "documents"), id_col="doc_id")


@query("near_dedup_exact", _NEAR)
def _(spark, sf):
    return setjoin.similar_text_groups(table(spark, sf, "documents"), id_col="doc_id")


# A pair per document: the first line instructs, the text answers; some copy their seed or ask for nothing.
_PAIR = """SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'Write some code!' WHEN 1 THEN 'Help me ' ELSE left(text, 30 + CAST(doc_id % 11 AS INTEGER) * 4) END AS instruction,
  CASE WHEN doc_id % 5 = 0 THEN concat('  ', replace(text, ' ', '   ')) WHEN doc_id % 5 = 1 THEN left(text, CAST(doc_id % 90 AS INTEGER)) ELSE concat(text, ' more') END AS response FROM documents"""


def pair_fx(spark, sf):
    return spark.sql(_PAIR.replace("FROM documents", "FROM {documents}"), documents=table(spark, sf, "documents"))


@query("length_bounds", sql("SELECT doc_id FROM p WHERE length(instruction) BETWEEN 20 AND 2000 AND length(response) BETWEEN 50 AND 10000", p=_PAIR))
def _(spark, sf):
    return pair_fx(spark, sf).where(pairs.length_bounds()).select("doc_id")


_SPECIFIC = r"""NOT i IN ('write code', 'write some code', 'write a program', 'write something', 'do something', 'generate code', 'help me')
  AND len(regexp_extract_all(i, '\S+')) >= 4"""


@query("generic_instruction_reject", sql(
    f"SELECT doc_id FROM (SELECT doc_id, regexp_replace(lower(trim(instruction, ' ' || chr(10))), '[.!?\\s]+$', '') AS i FROM p) WHERE {_SPECIFIC}", p=_PAIR))
def _(spark, sf):
    return pair_fx(spark, sf).where(pairs.specific_instruction()).select("doc_id")


@query("not_a_copy", sql(r"""SELECT doc_id FROM p JOIN documents d USING (doc_id)
  WHERE regexp_replace(lower(trim(p.response, ' ' || chr(10))), '\s+', ' ', 'g') <> regexp_replace(lower(trim(d.text, ' ' || chr(10))), '\s+', ' ', 'g')""", p=_PAIR))
def _(spark, sf):
    seeds = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("code"))
    return pairs.not_a_copy(pair_fx(spark, sf), seeds, key="doc_id").select("doc_id")


@query("syntax_token_check", r"""SELECT doc_id, n FROM (SELECT doc_id, CAST(regexp_matches(text, '(^|\W)license($|\W)') AS INTEGER)
  + CAST(regexp_matches(text, '(^|\W)the($|\W)') AS INTEGER) + CAST(regexp_matches(text, '(^|\W)token($|\W)') AS INTEGER) AS n FROM documents) WHERE n >= 2""")
def _(spark, sf):
    tokens = ["license", "the", "token"]
    docs = table(spark, sf, "documents")
    return docs.where(pairs.syntax_token_check("text", 2, tokens)).select("doc_id", pairs.syntax_tokens("text", tokens).alias("n"))


@query("import_allowlist", """SELECT doc_id FROM documents d WHERE NOT (doc_id % 3 = 1 AND doc_id % 9 <> 4) AND NOT (doc_id % 5 = 2 AND source NOT IN ('src0', 'src1', 'src2'))""")
def _(spark, sf):
    # every third text imports a package by number, some also one by source
    docs = table(spark, sf, "documents").selectExpr(
        "doc_id AS id", "concat(text, CASE WHEN doc_id % 3 = 1 THEN concat('\nimport pkg', doc_id % 9, '/sub') ELSE '' END, "
        "CASE WHEN doc_id % 5 = 2 THEN concat('\n  import ', source) ELSE '' END) AS response")
    known = spark.createDataFrame([("pkg4",), ("src0",), ("src1",), ("src2",), ("src0",)], "name string")
    return pairs.import_allowlist(docs, known).select(F.col("id").alias("doc_id"))


@query("gate_report", sql(f"""SELECT gate, count(*) FILTER (NOT ok) AS rejected FROM (
  SELECT 'length_bounds' AS gate, length(instruction) BETWEEN 20 AND 2000 AND length(response) BETWEEN 50 AND 10000 AS ok FROM p
  UNION ALL SELECT 'generic_instruction_reject', {_SPECIFIC} FROM (SELECT regexp_replace(lower(trim(instruction, ' ' || chr(10))), '[.!?\\s]+$', '') AS i FROM p)
) GROUP BY gate""", p=_PAIR))
def _(spark, sf):
    return pairs.gate_report(pair_fx(spark, sf), {"length_bounds": pairs.length_bounds(), "generic_instruction_reject": pairs.specific_instruction()})


@query("parse_multi_pair", """SELECT doc_id, CAST(k AS INTEGER) AS pair_no, CASE k WHEN 1 THEN 'code_gen' ELSE 'explanation' END AS task,
    CASE k WHEN 1 THEN 'medium' ELSE 'easy' END AS level, concat('Do ', k, ' for ', source) AS instruction, md5(concat('A', k, chr(10), trim(text, ' ' || chr(10)))) AS digest
  FROM documents, (SELECT unnest([1, 2]) AS k) WHERE NOT (k = 2 AND doc_id % 4 = 0)""")
def _(spark, sf):
    # the second section of every fourth reply has no response
    replies = table(spark, sf, "documents").selectExpr(
        "doc_id", "concat('Here they are.\n\n## Pair 1 [code_gen/medium]\n### Instruction\nDo 1 for ', source, '\n### Response\nA1\n', text, "
        "'\n\n## Pair 2 [explanation/easy]\n### Instruction\nDo 2 for ', source, CASE WHEN doc_id % 4 = 0 THEN '' ELSE concat('\n### Response\nA2\n', text) END) AS content")
    return pairs.parse_multi_pair(replies).select("doc_id", "pair_no", "task", "level", "instruction", F.md5("response").alias("digest"))


@query("alpaca_to_chat", """SELECT doc_id, md5(CASE WHEN doc_id % 3 = 0 THEN 'Sum up' ELSE concat('Sum up', chr(10), chr(10), source) END) AS question, md5(text) AS answer,
    CAST(3 AS INTEGER) AS n_messages FROM documents""")
def _(spark, sf):
    rows = table(spark, sf, "documents").selectExpr("doc_id", "'Sum up' AS instruction", "CASE WHEN doc_id % 3 <> 0 THEN source WHEN doc_id % 2 = 0 THEN '' END AS input", "text AS output")
    m = F.col("messages")
    return pairs.alpaca_to_chat(rows).select("doc_id", F.md5(m[1]["content"]).alias("question"), F.md5(m[2]["content"]).alias("answer"), F.size(m).alias("n_messages"))


_U = "('0x' || substr(md5('42|' || {id}), 1, 8))::BIGINT"


@query("completion_pair", sql(f"""SELECT id, CAST(keep AS INTEGER) AS head_lines, md5(array_to_string(l[1:keep], chr(10))) AS head, md5(array_to_string(l[keep + 1:], chr(10))) AS tail
  FROM (SELECT id, l, len(l) - greatest(1, CAST(floor(len(l) * (0.3::DOUBLE + (0.5::DOUBLE - 0.3::DOUBLE) * {_U.format(id='id')} / 4294967296.0::DOUBLE)) AS BIGINT)) AS keep
    FROM (SELECT id, string_split(code, chr(10)) AS l FROM corpus_fx)) WHERE keep >= 1""", "corpus_fx"))
def _(spark, sf):
    cut = pairs.completion_pair(corpus_fx(spark, sf))
    return cut.select("id", F.size(F.split("head", "\n", -1)).alias("head_lines"), F.md5("head").alias("head"), F.md5("tail").alias("tail"))


@query("extend_conversations", """WITH c AS (SELECT conv_id, string_agg(text, '|' ORDER BY turn) AS t FROM conversations WHERE role <> 'system' GROUP BY 1),
  x AS (SELECT conv_id, t, md5('42|' || conv_id) AS h, ('0x' || substr(md5('42|extend|' || conv_id), 1, 8))::BIGINT < CAST(floor(0.2::DOUBLE * 4294967296) AS BIGINT) AS long FROM c),
  n AS (SELECT *, row_number() OVER (ORDER BY h, conv_id) AS rn FROM x WHERE long)
  SELECT conv_id, CAST(1 AS INTEGER) AS merged, md5(t) AS digest FROM x WHERE NOT long
  UNION ALL SELECT min_by(conv_id, rn), CAST(count(*) AS INTEGER), md5(string_agg(t, '|' ORDER BY rn)) FROM n GROUP BY (rn - 1) // 3""")
def _(spark, sf):
    merged = pairs.extend_conversations(chat_fx(spark, sf), id_col="conv_id")
    said = F.array_join(F.transform(F.filter("messages", lambda m: m["role"] != "system"), lambda m: m["content"]), "|")
    return merged.select("conv_id", "merged", F.md5(said).alias("digest"))


@query("judge_sample", sql("SELECT id FROM corpus_fx ORDER BY md5('42|' || id), id LIMIT 500", "corpus_fx"))
def _(spark, sf):
    return sampling.judge_sample(corpus_fx(spark, sf)).select("id")


@query("judge_reject", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality + 2 < 3 OR 3 - toxic < 3)")
def _(spark, sf):
    scores = table(spark, sf, "labels").select(F.col("doc_id"), (F.col("quality") + 2).alias("correct"), (3 - F.col("toxic")).alias("clean"))
    return sampling.judge_reject(table(spark, sf, "documents"), scores, ["correct", "clean"], id_col="doc_id").select("doc_id")


@query("spot_check_sample", sql("SELECT id FROM corpus_fx ORDER BY md5('7|' || id), id LIMIT 100", "corpus_fx"))
def _(spark, sf):
    return sampling.spot_check_sample(corpus_fx(spark, sf), seed=7).select("id")


@query("weighted_sample", sql(f"""SELECT id FROM corpus_fx WHERE stars + CASE WHEN is_official THEN 20 ELSE 0 END > 0
  ORDER BY -ln(({_U.format(id='id')} + 0.5::DOUBLE) / 4294967296.0::DOUBLE) / (stars + CASE WHEN is_official THEN 20 ELSE 0 END), id LIMIT 150""", "corpus_fx"))
def _(spark, sf):
    weight = F.col("stars") + F.when(F.col("is_official"), 20).otherwise(0)
    return sampling.weighted_sample(corpus_fx(spark, sf), 150, weight).select("id")


@query("prefer_doc_comments", "SELECT doc_id, doc_id % 4 = 1 AS documented FROM documents")
def _(spark, sf):
    docs = table(spark, sf, "documents").selectExpr("doc_id", "concat(text, CASE WHEN doc_id % 4 = 1 THEN '\n  /// about it' ELSE ' /// not at the start' END) AS code")
    return docs.select("doc_id", sampling.has_doc_comments().alias("documented"))


def _share_sql(shares, id_sql):
    u, until, total = _U.format(id=id_sql), 0, sum(shares.values())
    cases = ""
    for name, share in shares.items():
        until += share
        cases += f" WHEN {u} < CAST(floor({until}::DOUBLE / {total} * 4294967296) AS BIGINT) THEN '{name}'"
    return f"CASE{cases} ELSE '{list(shares)[-1]}' END"


@query("assign_subtypes", sql(f"SELECT id, {_share_sql(sampling.EXPLANATION_SHARES, 'id')} AS subtype FROM corpus_fx", "corpus_fx"))
def _(spark, sf):
    return sampling.assign_subtypes(corpus_fx(spark, sf), sampling.EXPLANATION_SHARES).select("id", "subtype")


def _thirds(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return {"domain": docs.where("doc_id % 8 < 5"), "general": docs.where("doc_id % 8 = 5"), "functional": docs.where("doc_id % 8 > 5")}


_SETS = "SELECT doc_id, CASE WHEN doc_id % 8 < 5 THEN 'domain' WHEN doc_id % 8 = 5 THEN 'general' ELSE 'functional' END AS source FROM documents"
_SHARES = {"domain": 70, "general": 15, "functional": 15}


@query("mix_to_proportions", sql("""SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('42|' || doc_id), doc_id) AS rn FROM s)
  WHERE rn <= floor((SELECT floor(min(n * 100 / CASE source WHEN 'domain' THEN 70 ELSE 15 END)) FROM (SELECT source, count(*) AS n FROM s GROUP BY 1))
    * CASE source WHEN 'domain' THEN 70 ELSE 15 END / 100)""", s=_SETS))
def _(spark, sf):
    return mixing.mix_to_proportions(_thirds(spark, sf), _SHARES, id_col="doc_id").select("doc_id", "source")


@query("interleave", sql(f"""SELECT slot, d.source, doc_id FROM (
    SELECT slot, source, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS k FROM (SELECT range AS slot, {_share_sql(_SHARES, 'range')} AS source FROM range((SELECT 1000 + 10 * count(*) FROM documents)))) d
  JOIN (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('42|' || doc_id), doc_id) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM s) s
    ON s.source = d.source AND s.r = d.k % s.n
  WHERE slot <= (SELECT max(slot) FROM (SELECT slot, source, row_number() OVER (PARTITION BY source ORDER BY slot) AS k FROM (
      SELECT range AS slot, {_share_sql(_SHARES, 'range')} AS source FROM range((SELECT 1000 + 10 * count(*) FROM documents)))) e JOIN (SELECT source, count(*) AS n FROM s GROUP BY 1) c ON c.source = e.source AND e.k = c.n)""", s=_SETS))
def _(spark, sf):
    return mixing.interleave(_thirds(spark, sf), _SHARES, id_col="doc_id").select("slot", "source", "doc_id")
