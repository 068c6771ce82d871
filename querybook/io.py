"""Sources and sinks: round trips through the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.functions import keys
from corpusloom.operators import corpus as corpus_ops
from corpusloom.session import scratch_path
from corpusloom.sources import jsonl, parquet, trees
from querybook.corpus import licensed
from querybook.fixtures import OFFICIAL, chat_fx, corpus_fx, sql, table
from querybook.registry import query

_CORPUS_ROWS = sql("SELECT id, repo_owner, stars, license_raw, package_downloads, is_official, md5(code) AS digest FROM corpus_fx",
                   "corpus_fx")


def _digest(df):
    return df.select("id", "repo_owner", "stars", "license_raw", "package_downloads", "is_official", F.md5("code").alias("digest"))


@query("read_jsonl", _CORPUS_ROWS)
def _(spark, sf):
    path = scratch_path(spark, "jsonl")
    jsonl.write_jsonl(corpus_fx(spark, sf), path)
    return _digest(jsonl.read_jsonl(spark, path, schemas.CORPUS_FILE).filter(F.col(schemas.CORRUPT).isNull()))


@query("read_chat_jsonl",
       """SELECT conv_id, count(*) AS n_messages, md5(string_agg(text, chr(10) ORDER BY turn)) AS digest
          FROM conversations WHERE conv_id % 9 <> 0 GROUP BY conv_id""")
def _(spark, sf):
    # every ninth record has no messages and is skipped, blank lines lie between
    path = scratch_path(spark, "chat")
    lines = chat_fx(spark, sf).withColumn("messages", F.when(F.col("conv_id") % 9 != 0, F.col("messages")))
    lines.select(F.concat(F.to_json(F.struct("conv_id", "messages")), F.lit("\n")).alias("value")).write.text(path)
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([StructField("conv_id", LongType()), *schemas.MIXED_RECORD.fields])
    chats = jsonl.read_chat_jsonl(spark, path, schema)
    whole = F.array_join(F.transform("messages", lambda m: m["content"]), "\n")
    return chats.select("conv_id", F.size("messages").cast("long").alias("n_messages"), F.md5(whole).alias("digest"))


@query("read_chat_jsonl_glob", "SELECT count(DISTINCT conv_id) AS records FROM conversations")
def _(spark, sf):
    # two folders named by one pattern, and one that does not exist
    root = scratch_path(spark, "chats")
    chats = chat_fx(spark, sf)
    for k in range(2):
        jsonl.write_jsonl(chats.where(F.col("conv_id") % 2 == k), f"{root}/part-{k}")
    read = jsonl.read_chat_jsonl(spark, [f"{root}/part-*/*.json", f"{root}/none"])
    return read.agg(F.count(F.lit(1)).alias("records"))


@query("malformed_lines", """SELECT count(*) AS lines, count(*) FILTER (conv_id % 6 = 1) AS malformed FROM (SELECT DISTINCT conv_id FROM conversations)""")
def _(spark, sf):
    path = scratch_path(spark, "chat")
    whole = F.to_json(F.struct("messages"))
    lines = chat_fx(spark, sf).select(F.when(F.col("conv_id") % 6 == 1, F.concat(F.lit("{"), whole)).otherwise(whole).alias("value"))
    lines.write.text(path)
    return jsonl.malformed_lines(spark, path)


@query("read_tree", "SELECT source AS folder, count(*) AS lines, CAST(sum(doc_id) AS BIGINT) AS ids FROM documents GROUP BY source")
def _(spark, sf):
    # one folder of text files per source, below a root whose name recurs in every path
    base = scratch_path(spark, "tree")
    ids = table(spark, sf, "documents").select(F.concat(F.lit("root/"), "source").alias("at"), F.col("doc_id").cast("string").alias("value"))
    ids.repartition("at").write.partitionBy("at").text(f"{base}/root")
    files = trees.read_tree(spark, f"{base}/root", "txt", min_chars=0)
    # .../at=root%2Fsrc1/part-0.txt
    folder = F.regexp_extract("path", r"^at=root%2F([^/]+)/[^/]+\.txt$", 1)
    lines = F.explode(F.split(F.rtrim(F.col("content").cast("string"), F.lit("\n")), "\n"))
    return files.select(folder.alias("folder"), lines.alias("v")).groupBy("folder").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.col("v").cast("long")).alias("ids"))


@query("write_parquet_zstd", _CORPUS_ROWS)
def _(spark, sf):
    path = scratch_path(spark, "parquet")
    parquet.write_parquet_zstd(corpus_fx(spark, sf), path)
    return _digest(parquet.read_corpus_parquet(spark, path))


@query("read_corpus_parquet", sql("SELECT id, length(code) AS n_chars FROM corpus_fx WHERE stars >= 10", "corpus_fx"))
def _(spark, sf):
    path = scratch_path(spark, "parquet")
    parquet.write_parquet_zstd(corpus_fx(spark, sf), path)
    read = parquet.read_corpus_parquet(spark, path).filter("stars >= 10")
    return read.select("id", F.length("code").cast("long").alias("n_chars"))


@query("write_jsonl",
       """SELECT conv_id, CASE WHEN conv_id % 2 = 0 THEN 'conv_id,language,messages' ELSE 'conv_id,messages' END AS keys
          FROM conversations GROUP BY conv_id""")
def _(spark, sf):
    # an absent language leaves no key behind
    path = scratch_path(spark, "jsonl")
    jsonl.write_jsonl(chat_fx(spark, sf).withColumn("language", F.when(F.col("conv_id") % 2 == 0, "elixir")), path)
    lines = spark.read.text(path)
    return lines.select(
        F.get_json_object("value", "$.conv_id").cast("long").alias("conv_id"),
        F.array_join(F.array_sort(F.json_object_keys("value")), ",").alias("keys"),
    )


@query("append_records", sql("SELECT id, doc_id % 3 AS batch FROM corpus_fx", "corpus_fx"))
def _(spark, sf):
    path = scratch_path(spark, "log")
    files = corpus_fx(spark, sf).select("id", (F.col("doc_id") % 3).alias("batch"))
    for batch in range(3):
        jsonl.append_records(files.filter(F.col("batch") == batch), path)
    return spark.read.schema("id string, batch long").json(path)


_TREE = """SELECT doc_id, source AS repo_name, 'org' || (doc_id % 23) AS repo_owner,
  CASE doc_id % 10 WHEN 0 THEN '.hidden/' WHEN 1 THEN 'build/' WHEN 2 THEN 'build/src/' WHEN 3 THEN 'src/.cache/'
    WHEN 4 THEN '_private/' ELSE 'src/' END || 'f' || doc_id || CASE WHEN doc_id % 7 = 0 THEN '.md' ELSE '.txt' END AS path,
  replace(CASE WHEN doc_id % 6 = 0 THEN replace(text, chr(10), chr(13) || chr(10)) ELSE text END, chr(13) || chr(10), chr(10)) AS code
  FROM documents"""


@query("extract_files",
       sql("""SELECT repo_owner || '/' || repo_name || '/' || path AS id, path AS file_path,
                repo_owner IN ('org0', 'org1', 'org2') AS is_official, length(code) AS n_chars, md5(code) AS digest FROM tr
              WHERE path LIKE '%.txt' AND doc_id % 10 NOT IN (0, 1, 3) AND length(code) BETWEEN 20 AND 20000""", tr=_TREE))
def _(spark, sf):
    folder = """CASE doc_id % 10 WHEN 0 THEN '.hidden/' WHEN 1 THEN 'build/' WHEN 2 THEN 'build/src/' WHEN 3 THEN 'src/.cache/'
                WHEN 4 THEN '_private/' ELSE 'src/' END"""
    tree = table(spark, sf, "documents").selectExpr(
        "source AS repo_name", "concat('org', doc_id % 23) AS repo_owner",
        f"concat({folder}, 'f', doc_id, CASE WHEN doc_id % 7 = 0 THEN '.md' ELSE '.txt' END) AS path",
        r"encode(CASE WHEN doc_id % 6 = 0 THEN replace(text, '\n', '\r\n') ELSE text END, 'UTF-8') AS content",
    )
    files = trees.extract_files(tree, "txt", OFFICIAL, max_chars=20_000)
    return files.select("id", "file_path", "is_official", F.length("code").cast("long").alias("n_chars"), F.md5("code").alias("digest"))


_CONFIG_ROWS = """SELECT 'all' AS config, id FROM corpus_lic WHERE license IS NOT NULL
  UNION ALL SELECT 'official', id FROM corpus_lic WHERE is_official
  UNION ALL SELECT 'community_top', id FROM corpus_lic WHERE NOT is_official AND (stars >= 10 OR package_downloads >= 1000)"""


def _read_configs(spark, folders):
    parts = [spark.read.parquet(f).select(F.lit(name).alias("config"), "id") for name, f in folders.items()]
    return parts[0].union(parts[1]).union(parts[2])


@query("split_configs", sql(_CONFIG_ROWS, "corpus_lic"))
def _(spark, sf):
    return _read_configs(spark, parquet.split_configs(licensed(spark, sf), scratch_path(spark, "configs")))


@query("publish_layout", sql(_CONFIG_ROWS, "corpus_lic"))
def _(spark, sf):
    configs = parquet.split_configs(licensed(spark, sf), scratch_path(spark, "configs"))
    root = scratch_path(spark, "published")
    names = parquet.publish_layout(spark, configs, root, "# Corpus\n")
    return _read_configs(spark, {name: f"{root}/{name}/data.parquet" for name in names})


@query("raw_snapshot", sql("SELECT id, license, sha256(code) AS digest FROM deduped", "deduped"))
def _(spark, sf):
    raw = parquet.raw_snapshot(licensed(spark, sf), scratch_path(spark, "raw"))
    return corpus_ops.filter_corpus(raw, max_chars=20_000).select("id", "license", keys.content_key("code").alias("digest"))
