"""Commits, loads and saved files: what changes between one run and the next."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from corpusloom.operators import bloom, corpus, dedup, registry, sketches
from corpusloom.packaging import ship
from corpusloom.session import scratch_path
from corpusloom.sources import registry_json, statetable, treesource
from querybook.fixtures import corpus_fx, sql, table
from querybook.io import _TREE
from querybook.registry import query

_STATE = "user_id long, event_id long, event_type string, value double, ts timestamp"
_LATEST = """SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1"""


def _committed(spark, sf):
    """The events in five commits that overlap in time and touch different users."""
    state = statetable.StateTable(spark, scratch_path(spark, "state"), _STATE, ["user_id"], "ts", buckets=16)
    events = table(spark, sf, "events")
    for k in range(5):
        state.upsert(events.where(F.col("event_id") * 7 % 5 == k))
    return state


@query("state_upsert", _LATEST)
def _(spark, sf):
    return _committed(spark, sf).read().select("user_id", "event_id", "event_type", "value")


@query("state_remaining", f"""SELECT range AS user_id FROM range((SELECT max(user_id) + 20 FROM events))
  WHERE range NOT IN (SELECT user_id FROM ({_LATEST}) WHERE event_type <> 'error')""")
def _(spark, sf):
    state = _committed(spark, sf).read().withColumn("status", F.when(F.col("event_type") == "error", "error").otherwise("done"))
    work = table(spark, sf, "events").agg((F.max("user_id") + 20).alias("n")).select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("user_id"))
    return registry.resume_remaining(work, state, ["user_id"], ["done"])


# every third document comes later, with more stars every now and then
_LOADED = "SELECT id, doc_id, code, CASE WHEN doc_id % 3 = 0 THEN stars + doc_id % 2 * 50 ELSE stars END AS stars FROM corpus_fx"


@query("dedup_load", sql("SELECT id, stars, md5(code) AS digest FROM s QUALIFY row_number() OVER (PARTITION BY code ORDER BY stars DESC, id) = 1",
                         "corpus_fx", s=_LOADED))
def _(spark, sf):
    rows = spark.sql(_LOADED.replace("FROM corpus_fx", "FROM {corpus_fx}"), corpus_fx=corpus_fx(spark, sf))
    published = dedup.dedup_content(rows.where("doc_id % 3 <> 0"))
    load = rows.where("doc_id % 3 = 0")
    done = bloom.dedup_load(load, published, bits=bloom.filter_bits(100_000))
    return done.merged(published).select("id", "stars", F.md5("code").alias("digest"))


# Pages of ten documents: some are null, empty, cut off or without items, some items are null.
_PAGES = """SELECT doc_id // 10 AS page, doc_id % 10 AS place, doc_id, source FROM documents"""
_FAULT = "CASE page % 13 WHEN 3 THEN 'empty' WHEN 5 THEN 'broken' WHEN 7 THEN 'no items' WHEN 9 THEN 'no items' END"


def _saved_pages(spark, sf):
    item = """CASE WHEN doc_id % 17 = 4 THEN NULL ELSE named_struct('owner', named_struct('login', source), 'full_name', concat(source, '/r', doc_id),
      'html_url', concat('h/', doc_id), 'stargazers_count', doc_id * 3) END"""
    rows = table(spark, sf, "documents").selectExpr("doc_id div 10 AS page", "doc_id % 10 AS place", f"{item} AS item")
    items = F.transform(F.array_sort(F.collect_list(F.struct("place", "item"))), lambda x: x["item"])
    whole = F.to_json(F.struct(F.lit(100).alias("total_count"), items.alias("items")), {"ignoreNullFields": "false"})
    pages = rows.groupBy("page").agg(whole.alias("whole"))
    body = (F.when(F.col("page") % 13 == 3, "").when(F.col("page") % 13 == 5, F.expr("left(whole, length(whole) - 9)"))
            .when(F.col("page") % 13 == 7, "null").when(F.col("page") % 13 == 9, '{"items": null}').otherwise(F.col("whole")))
    path = scratch_path(spark, "pages")
    # one file for each page, so that the page's number can be told from its path; Spark's own writer needs a folder and several
    # moves for each, which the driver does one after the other
    ship(spark)

    def write(batches):
        fs, base = treesource.opened(path)
        fs.create_dir(base, recursive=True)
        for batch in batches:
            for page, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_output_stream(f"{base}/page={'__HIVE_DEFAULT_PARTITION__' if page is None else page}") as out:
                    out.write(f"{value}\n".encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    pages.select("page", body.alias("value")).mapInArrow(write, "n long").agg(F.sum("n")).collect()
    return registry_json.read_pages(spark, path)


@query("read_pages", sql(f"""SELECT page, place AS item_seq, source AS owner, 'r' || doc_id AS name, doc_id * 3 AS stars FROM p
  WHERE {_FAULT} IS NULL AND doc_id % 17 <> 4""", p=_PAGES))
def _(spark, sf):
    found = registry_json.page_items(_saved_pages(spark, sf)).withColumn("number", F.regexp_extract("page", r"page=(\d+)", 1).cast("long"))
    return registry_json.parse_repo_items(found, keep=["number", "item_seq"]).select(F.col("number").alias("page"), "item_seq", "owner", "name", "stars")


@query("page_report", sql(f"""SELECT page, CASE WHEN {_FAULT} IS NULL THEN CAST(count(*) AS INTEGER) ELSE 0 END AS items, {_FAULT} AS problem FROM p GROUP BY page""", p=_PAGES))
def _(spark, sf):
    report = registry_json.page_report(_saved_pages(spark, sf))
    return report.select(F.regexp_extract("page", r"page=(\d+)", 1).cast("long").alias("page"), "items", "problem")


@query("read_whole_tree", sql("SELECT repo_owner || '/' || repo_name || '/' || path AS path, octet_length(encode(code)) AS length, md5(code) AS digest FROM tr WHERE path LIKE '%.txt'",
                              tr=_TREE))
def _(spark, sf):
    root = scratch_path(spark, "tree")
    ship(spark)
    files = spark.sql(f"SELECT concat(repo_owner, '/', repo_name, '/', path) AS path, code FROM ({_TREE.replace('FROM documents', 'FROM {documents}')})".replace("chr(13)", "char(13)").replace("chr(10)", "char(10)"),
                      documents=table(spark, sf, "documents"))

    def write(batches):
        fs, base = treesource.opened(root)
        for batch in batches:
            for path, code in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs.create_dir(f"{base}/{path}".rsplit("/", 1)[0], recursive=True)
                with fs.open_output_stream(f"{base}/{path}") as out:
                    out.write(code.encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    files.mapInArrow(write, "n long").agg(F.sum("n")).collect()
    found = treesource.read_whole_tree(spark, root, "txt", run_files=100)
    return found.select("path", "length", F.md5("content").alias("digest"))


@query("observed_funnel", sql("""SELECT count(*) AS kept, (SELECT count(*) FROM corpus_fx) AS before FROM deduped""", "deduped"))
def _(spark, sf):
    from querybook.corpus import licensed

    observed = corpus.observed_funnel(licensed(spark, sf), max_chars=20_000)
    observed.kept.write.parquet(scratch_path(spark, "observed"))
    steps = observed.report()
    return steps.agg(F.min_by("after", F.col("after")).alias("kept"), F.max("before").alias("before"))


@query("united_sketches", sql(f"""SELECT 4 AS loads, count(*) AS files, CAST(sum(length(code)) AS BIGINT) AS chars, count(DISTINCT repo_url) AS repos, TRUE AS close FROM corpus_fx""", "corpus_fx"))
def _(spark, sf):
    files = corpus_fx(spark, sf)
    path = scratch_path(spark, "sketches")
    for k in range(4):
        sketches.load_sketch(files.where(F.col("doc_id") % 4 == k), f"load-{k}").write.mode("append").parquet(path)
    found = sketches.united(spark.read.parquet(path))
    exact = files.agg(F.count_distinct("repo_url").alias("true_repos"))
    return found.crossJoin(exact).select("loads", "files", "chars", F.col("true_repos").alias("repos"),  # one row each
                                         (F.abs(F.col("repos") - F.col("true_repos")) <= sketches.error_bound() * F.col("true_repos")).alias("close"))
