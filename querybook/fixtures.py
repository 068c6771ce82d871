"""Views that give the driver's tables the shapes the operators expect.

``*_sql`` strings are the DuckDB side; the functions build the same rows in Spark. Both follow
FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OFFICIAL = ["org0", "org1", "org2"]
MAX_CHARS = 20_000  # no document exceeds the default bound of 50,000

_CORPUS_INNER = """
  SELECT doc_id, text AS code,
    concat(CASE doc_id % 4 WHEN 0 THEN 'src' WHEN 1 THEN 'test' WHEN 2 THEN 'examples' ELSE 'lib' END,
           '/f', CAST(doc_id AS STRING), '.txt') AS file_path,
    concat('org', CAST(doc_id % 23 AS STRING)) AS repo_owner,
    CASE WHEN doc_id % 53 = 0 THEN 'Exercism-track' WHEN doc_id % 29 = 0 THEN 'styles' ELSE source END AS repo_name,
    CAST((doc_id * 7919) % 61 AS BIGINT) AS stars,
    CASE doc_id % 13 WHEN 0 THEN 'MIT' WHEN 1 THEN 'mit license' WHEN 2 THEN ' Apache License, Version 2.0 '
      WHEN 3 THEN 'GPL-3.0' WHEN 4 THEN 'BSD (simplified)' WHEN 5 THEN 'Limited use' WHEN 6 THEN NULL
      WHEN 7 THEN '' WHEN 8 THEN 'agpl-3.0' WHEN 9 THEN 'EPL-2.0' WHEN 10 THEN 'mpl 2.0'
      WHEN 11 THEN 'The Unlicense' ELSE NULL END AS license_raw,
    CASE WHEN doc_id % 5 = 0 THEN concat('pkg', CAST(doc_id AS STRING)) END AS package,
    CASE WHEN doc_id % 5 = 0 THEN CAST((doc_id * 131) % 3000 AS BIGINT) END AS package_downloads
  FROM {documents}"""

_CORPUS = """
SELECT concat(repo_owner,'/',repo_name,'/',file_path) AS id, doc_id, 'crawl' AS source, code, file_path,
       concat('https://example.org/',repo_owner,'/',repo_name) AS repo_url, repo_owner, repo_name, stars,
       repo_owner IN ('org0','org1','org2') AS is_official, license_raw, package, package_downloads
FROM (""" + _CORPUS_INNER + ") t"

_GEN = """
SELECT e.event_id AS request_seq, CASE e.user_id % 2 WHEN 0 THEN 'prov_a' ELSE 'prov_b' END AS provider,
  CASE e.user_id % 2 WHEN 0 THEN 'model_a' ELSE 'model_b' END AS model,
  CASE e.event_id % 3 WHEN 0 THEN 'code_gen' WHEN 1 THEN 'explanation' ELSE 'completion' END AS task_type,
  coalesce(c.id, concat('missing/', CAST(e.user_id AS STRING))) AS source_file_id,
  c.file_path AS source_file_path, c.repo_name AS source_repo, c.stars AS source_stars,
  e.ts AS timestamp,
  CASE WHEN e.event_type = 'error' THEN NULL WHEN e.event_id % 41 = 0 THEN '' ELSE a.code END AS content,
  CASE WHEN e.event_type = 'error' THEN NULL WHEN e.event_id % 9 = 0 THEN 'length'
       WHEN e.event_id % 31 = 0 THEN 'content_filter' ELSE 'stop' END AS finish_reason,
  CASE WHEN e.event_type = 'error' THEN 'timeout' END AS error,
  CASE WHEN e.event_id % 7 = 0 THEN 'agent_session' ELSE 'single' END AS approach,
  CAST(e.event_id % 977 AS BIGINT) * 13 AS wall_time_ms,
  CAST(CASE WHEN e.event_type = 'error' THEN 0 ELSE e.event_id % 2500 END AS BIGINT) AS input_tokens,
  CAST(CASE WHEN e.event_type = 'error' THEN 0 ELSE (e.event_id * 17) % 4096 END AS BIGINT) AS output_tokens,
  CAST(CASE WHEN e.event_type = 'error' THEN 0 ELSE e.event_id % 400 END AS BIGINT) AS cached_input_tokens,
  CASE WHEN e.event_type <> 'error' AND e.event_id % 6 = 0
       THEN CAST(e.event_id % 1000 AS DOUBLE) / 4 END AS energy_joules,
  CASE WHEN e.event_type <> 'error' AND e.event_id % 6 = 0
       THEN CAST(e.event_id % 5 AS DOUBLE) / 8 END AS reported_cost,
  CASE WHEN e.event_type <> 'error' AND e.event_id % 6 = 0
       THEN CAST((e.event_id * 7919) % 2000 AS DOUBLE) / 16 END AS balance
FROM (SELECT e0.*, e0.event_id % (SELECT count(*) FROM {documents}) AS answer_doc, e0.user_id * 7 AS about_doc
      FROM {events} e0) e
LEFT JOIN {corpus_fx} c ON c.doc_id = e.about_doc
LEFT JOIN {corpus_fx} a ON a.doc_id = e.answer_doc
"""

_REPO = """
SELECT repo_owner AS owner, repo_name AS name, min(repo_url) AS url, max(stars) AS stars,
       CASE WHEN max(doc_id) % 3 = 0 THEN NULL WHEN max(doc_id) % 3 = 1 THEN '' ELSE max(license_raw) END AS license_raw,
       min(doc_id) AS repo_seq, max(doc_id) % 17 AS chunk_seq
FROM {corpus_fx} GROUP BY repo_owner, repo_name
"""

_PKG = """
SELECT CASE repo_seq % 4 WHEN 0 THEN lower(name) ELSE concat('pkg', CAST(repo_seq AS STRING)) END AS name,
       CAST((repo_seq * 131) % 3000 AS BIGINT) AS package_downloads,
       CASE repo_seq % 3 WHEN 0 THEN 'MIT' WHEN 1 THEN 'Apache-2.0' END AS license_raw,
       CASE repo_seq % 5 WHEN 0 THEN '' WHEN 1 THEN concat('https://github.com/', owner, '/', name, '/')
         WHEN 2 THEN concat('https://github.com/', upper(owner), '/', name)
         WHEN 3 THEN concat('https://github.com/', owner, '/', name, '.git')
         ELSE 'https://github.com/org0/src0' END AS github_url,
       repo_seq AS seq
FROM {repo_fx} WHERE repo_seq % 7 <> 6
"""

_LICENSE_SQL = """
CASE WHEN license_raw IS NULL OR license_raw = '' THEN NULL
     WHEN lic IN ('mit','mit license','the mit license','expat') THEN 'MIT'
     WHEN lic IN ('apache-2.0','apache 2.0','apache 2','apache license 2.0','apache license, version 2.0',
                  'apache license version 2.0','apache-2') THEN 'Apache-2.0'
     WHEN lic IN ('bsd-3-clause','bsd','3-clause bsd','new bsd') THEN 'BSD-3-Clause'
     WHEN lic IN ('bsd-2-clause','2-clause bsd','simplified bsd') THEN 'BSD-2-Clause'
     WHEN lic IN ('isc','isc license') THEN 'ISC'
     WHEN lic IN ('unlicense','the unlicense') THEN 'Unlicense'
     WHEN lic IN ('cc0-1.0','cc0') THEN 'CC0-1.0'
     WHEN lic IN ('mpl-2.0','mpl 2.0','mozilla public license 2.0') THEN 'MPL-2.0'
     WHEN lic = '0bsd' THEN '0BSD'
     WHEN lic IN ('gpl-2.0','gpl-3.0','agpl-3.0') THEN upper(lic)
     WHEN lic IN ('lgpl-2.1','lgpl-3.0') THEN upper(lic)
     WHEN lic LIKE '%mit%' THEN 'MIT'
     WHEN lic LIKE '%apache%' THEN 'Apache-2.0'
     WHEN lic LIKE '%bsd%' AND (lic LIKE '%2%' OR lic LIKE '%simplified%') THEN 'BSD-2-Clause'
     WHEN lic LIKE '%bsd%' THEN 'BSD-3-Clause'
     WHEN lic LIKE '%isc%' THEN 'ISC' END"""

_PERMISSIVE_SQL = "('MIT','Apache-2.0','BSD-2-Clause','BSD-3-Clause','0BSD','ISC','Unlicense','CC0-1.0','MPL-2.0')"


def licensed_sql(table: str) -> str:
    """``table`` with its ``license`` column, for DuckDB."""
    return (
        f"SELECT * EXCLUDE (lic), {_LICENSE_SQL} AS license "
        f"FROM (SELECT *, lower(trim(license_raw)) AS lic FROM {table})"
    )


_NAMES = {"documents": "documents", "events": "events", "corpus_fx": "corpus_fx", "repo_fx": "repo_fx"}
_VIEWS = {
    "corpus_fx": _CORPUS.format(**_NAMES),
    "corpus_lic": licensed_sql("corpus_fx"),
    "gen_fx": _GEN.format(**_NAMES),
    "repo_fx": _REPO.format(**_NAMES),
    "pkg_fx": _PKG.format(**_NAMES),
    "chat_fx": """SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS messages
                  FROM conversations GROUP BY conv_id""",
    "kept": f"""SELECT * FROM corpus_lic WHERE length(code) <= {MAX_CHARS} AND length(code) >= 20
                AND (license IS NOT NULL OR package IS NOT NULL)
                AND (license IS NULL OR license NOT IN ('GPL-2.0','GPL-3.0','AGPL-3.0','LGPL-2.1','LGPL-3.0'))
                AND NOT lower(repo_owner) LIKE '%exercism%' AND NOT lower(repo_name) LIKE '%exercism%'""",
    "deduped": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
                  PARTITION BY code ORDER BY stars DESC NULLS LAST, id) AS rn FROM kept) WHERE rn = 1""",
    "latest": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
                 PARTITION BY source_file_id, task_type
                 ORDER BY timestamp DESC NULLS LAST, request_seq DESC) AS rn FROM gen_fx) WHERE rn = 1""",
    "basic": """SELECT *, CAST(len(list_distinct(string_split(trim(content, chr(10)||chr(9)||' '), chr(10)))) AS DOUBLE)
                / len(string_split(trim(content, chr(10)||chr(9)||' '), chr(10))) AS ratio
                FROM latest WHERE finish_reason = 'stop' AND content IS NOT NULL AND length(content) > 0""",
    "train_fx": "SELECT * FROM basic WHERE ratio >= 0.3",
}
_NEEDS = {
    "corpus_lic": ["corpus_fx"], "gen_fx": ["corpus_fx"], "repo_fx": ["corpus_fx"], "pkg_fx": ["repo_fx"],
    "kept": ["corpus_lic"], "deduped": ["kept"], "latest": ["gen_fx"], "basic": ["latest"], "train_fx": ["basic"],
}


def sql(body: str, *views: str, **extra: str) -> str:
    """``body`` behind the CTEs it needs; ``extra`` adds local ones after them."""
    order: list[str] = []

    def need(view: str) -> None:
        for parent in _NEEDS.get(view, []):
            need(parent)
        if view not in order:
            order.append(view)

    for view in views:
        need(view)
    ctes = [(v, _VIEWS[v]) for v in order] + list(extra.items())
    head = "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in ctes) + "\n" if ctes else ""
    return head + body


# --- Spark side ---------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus_from(documents: DataFrame) -> DataFrame:
    """``corpus_fx`` as a pure projection, usable on batch and streaming documents alike."""
    n = "CAST(doc_id AS STRING)"
    inner = documents.selectExpr(
        "doc_id", "text AS code",
        "concat(CASE doc_id % 4 WHEN 0 THEN 'src' WHEN 1 THEN 'test' WHEN 2 THEN 'examples' ELSE 'lib' END, "
        f"'/f', {n}, '.txt') AS file_path",
        "concat('org', CAST(doc_id % 23 AS STRING)) AS repo_owner",
        "CASE WHEN doc_id % 53 = 0 THEN 'Exercism-track' WHEN doc_id % 29 = 0 THEN 'styles' ELSE source END AS repo_name",
        "CAST((doc_id * 7919) % 61 AS BIGINT) AS stars",
        "CASE doc_id % 13 WHEN 0 THEN 'MIT' WHEN 1 THEN 'mit license' WHEN 2 THEN ' Apache License, Version 2.0 ' "
        "WHEN 3 THEN 'GPL-3.0' WHEN 4 THEN 'BSD (simplified)' WHEN 5 THEN 'Limited use' WHEN 6 THEN NULL "
        "WHEN 7 THEN '' WHEN 8 THEN 'agpl-3.0' WHEN 9 THEN 'EPL-2.0' WHEN 10 THEN 'mpl 2.0' "
        "WHEN 11 THEN 'The Unlicense' ELSE NULL END AS license_raw",
        f"CASE WHEN doc_id % 5 = 0 THEN concat('pkg', {n}) END AS package",
        "CASE WHEN doc_id % 5 = 0 THEN CAST((doc_id * 131) % 3000 AS BIGINT) END AS package_downloads",
    )
    return inner.select(
        F.concat_ws("/", "repo_owner", "repo_name", "file_path").alias("id"), "doc_id", F.lit("crawl").alias("source"),
        "code", "file_path", F.concat(F.lit("https://example.org/"), "repo_owner", F.lit("/"), "repo_name").alias("repo_url"),
        "repo_owner", "repo_name", "stars", F.col("repo_owner").isin(OFFICIAL).alias("is_official"),
        "license_raw", "package", "package_downloads",
    )


def corpus_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_from(table(spark, sf_dir, "documents"))


def gen_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        _GEN, documents=table(spark, sf_dir, "documents"), events=table(spark, sf_dir, "events"),
        corpus_fx=corpus_fx(spark, sf_dir),
    )


def repo_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_REPO, corpus_fx=corpus_fx(spark, sf_dir))


def pkg_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_PKG, repo_fx=repo_fx(spark, sf_dir))


def chat_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    return turns.groupBy("conv_id").agg(
        F.transform(ordered, lambda m: F.struct(m["role"].alias("role"), m["text"].alias("content"))).alias("messages")
    )
