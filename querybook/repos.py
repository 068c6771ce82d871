"""Repository and package metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import dedup, filters
from corpusloom.operators import registry as ops
from corpusloom.sources import registry_json
from querybook.fixtures import _LICENSE_SQL, _PERMISSIVE_SQL, corpus_fx, pkg_fx, repo_fx, sql
from querybook.registry import query

_PACKAGES_SQL = """
SELECT name, max_by(struct_pack(d := package_downloads, l := license_raw, u := github_url), seq) AS p, min(seq) AS position
FROM (SELECT lower(name) AS name, package_downloads, license_raw, github_url, seq FROM pkg_fx) GROUP BY name"""
_PACKAGES_FLAT = """
SELECT name, p.d AS package_downloads, p.l AS license_raw, p.u AS github_url,
  CASE WHEN instr(p.u, 'github.com/') > 0
       THEN lower(substr(rtrim(p.u, '/'), instr(p.u, 'github.com/') + 11)) END AS github_owner_repo, position
FROM pk0"""
_ENRICHED = """
SELECT owner, name, url, stars, repo_seq, chunk_seq,
  CASE WHEN coalesce(license_raw, '') = '' AND m.l IS NOT NULL THEN m.l ELSE license_raw END AS license_raw,
  m.n AS package, m.d AS package_downloads
FROM (SELECT r.*, coalesce(u.m, v.m) AS m FROM repo_fx r
  LEFT JOIN (SELECT github_owner_repo AS k, max_by(struct_pack(n := name, d := package_downloads, l := license_raw), position) AS m
             FROM pk WHERE github_owner_repo IS NOT NULL GROUP BY github_owner_repo) u ON u.k = lower(r.owner || '/' || r.name)
  LEFT JOIN (SELECT name AS k, struct_pack(n := name, d := package_downloads, l := license_raw) AS m FROM pk) v
    ON v.k = lower(r.name))"""
_PERMISSIVE_RAW = f"coalesce(({_LICENSE_SQL}) IN {_PERMISSIVE_SQL}, FALSE)"


def packages(spark, sf):
    return registry_json.last_per_name(
        registry_json.with_owner_repo(pkg_fx(spark, sf).withColumn("name", F.lower("name")))
    )


def enriched(spark, sf):
    return ops.enrich_repos(repo_fx(spark, sf), packages(spark, sf))


@query("parse_repo_items",
       sql("""SELECT repo_seq, CASE WHEN repo_seq % 11 = 0 THEN '' ELSE owner END AS owner,
                CASE WHEN repo_seq % 7 = 0 THEN name || '/sub' ELSE name END AS name, url,
                CASE WHEN repo_seq % 3 = 0 THEN '' ELSE 'about ' || name END AS description, stars,
                CASE WHEN repo_seq % 4 = 1 THEN license_raw END AS license_raw,
                CASE WHEN repo_seq % 11 = 0 THEN 0 ELSE 1 END AS n_authors, repo_seq % 2 = 0 AS fork, FALSE AS archived
              FROM repo_fx""", "repo_fx"))
def _(spark, sf):
    items = repo_fx(spark, sf).withColumn("item", F.expr("""
        to_json(named_struct(
          'owner', named_struct('login', CASE WHEN repo_seq % 11 = 0 THEN NULL ELSE owner END),
          'full_name', CASE WHEN repo_seq % 7 = 0 THEN concat(owner, '/', name, '/sub')
                            WHEN repo_seq % 5 = 0 THEN name ELSE concat(owner, '/', name) END,
          'html_url', url,
          'description', CASE WHEN repo_seq % 3 = 0 THEN NULL ELSE concat('about ', name) END,
          'stargazers_count', stars,
          'license', CASE WHEN repo_seq % 4 = 0 THEN named_struct('spdx_id', 'NOASSERTION')
                          WHEN repo_seq % 4 = 1 THEN named_struct('spdx_id', license_raw) END,
          'fork', repo_seq % 2 = 0))"""))
    parsed = registry_json.parse_repo_items(items, keep=["repo_seq"])
    return parsed.withColumn("n_authors", F.size("authors")).drop("authors")


@query("parse_package_items", sql("SELECT * FROM pk", "pkg_fx", pk0=_PACKAGES_SQL, pk=_PACKAGES_FLAT))
def _(spark, sf):
    items = pkg_fx(spark, sf).withColumn("item", F.expr("""
        to_json(named_struct('name', upper(name),
          'meta', named_struct('links', named_struct('GitHub', github_url),
                               'licenses', CASE WHEN license_raw IS NULL THEN array() ELSE array(license_raw, 'X') END),
          'downloads', named_struct('all', package_downloads)))"""))
    return registry_json.parse_package_items(items)


@query("enrich_repos", sql("SELECT * FROM en", "pkg_fx", pk0=_PACKAGES_SQL, pk=_PACKAGES_FLAT, en=_ENRICHED))
def _(spark, sf):
    return enriched(spark, sf)


@query("keep_permissive_repos",
       sql(f"""SELECT owner, name, license_raw FROM (SELECT *, lower(trim(license_raw)) AS lic FROM en)
               WHERE license_raw IS NULL OR {_PERMISSIVE_RAW}""",
           "pkg_fx", pk0=_PACKAGES_SQL, pk=_PACKAGES_FLAT, en=_ENRICHED))
def _(spark, sf):
    return filters.keep_permissive_repos(enriched(spark, sf)).select("owner", "name", "license_raw")


@query("prefilter_repos",
       sql("SELECT owner, name, license_raw, package FROM en WHERE license_raw IS NOT NULL OR package IS NOT NULL",
           "pkg_fx", pk0=_PACKAGES_SQL, pk=_PACKAGES_FLAT, en=_ENRICHED))
def _(spark, sf):
    return filters.prefilter_repos(enriched(spark, sf)).select("owner", "name", "license_raw", "package")


# documents of one repository are spread over query slices, so slices overlap
_FOUND_SQL = """SELECT repo_owner AS owner, repo_name AS name, stars, doc_id % 17 AS chunk_seq, doc_id AS item_seq FROM corpus_fx"""


def found(spark, sf):
    return corpus_fx(spark, sf).selectExpr(
        "repo_owner AS owner", "repo_name AS name", "stars", "doc_id % 17 AS chunk_seq", "doc_id AS item_seq"
    )


@query("dedup_across_chunks",
       sql("""SELECT owner, name, min_by(item_seq, chunk_seq * 1000000000000 + item_seq) AS item_seq, min(chunk_seq) AS chunk_seq
              FROM fd GROUP BY owner, name""", "corpus_fx", fd=_FOUND_SQL))
def _(spark, sf):
    return dedup.dedup_across_chunks(found(spark, sf)).select("owner", "name", "item_seq", "chunk_seq")


@query("distinct_union",
       sql("SELECT DISTINCT owner, name FROM (SELECT owner, name FROM fd UNION ALL SELECT owner, name FROM repo_fx)",
           "repo_fx", fd=_FOUND_SQL))
def _(spark, sf):
    both = found(spark, sf).select("owner", "name").unionByName(repo_fx(spark, sf).select("owner", "name"))
    return both.dropDuplicates(["owner", "name"])


@query("chunk_counts",
       sql("""SELECT chunk_seq, n AS found, coalesce(f, 0) AS new,
                CAST(sum(coalesce(f, 0)) OVER (ORDER BY chunk_seq) AS BIGINT) AS cumulative, n > 1000 AS over_limit
              FROM (SELECT chunk_seq, count(*) AS n FROM fd GROUP BY chunk_seq)
              LEFT JOIN (SELECT home, count(*) AS f FROM (SELECT min(chunk_seq) AS home FROM fd GROUP BY owner, name)
                         GROUP BY home) ON home = chunk_seq""", "corpus_fx", fd=_FOUND_SQL))
def _(spark, sf):
    return ops.chunk_counts(found(spark, sf))


@query("limit_repos",
       sql("SELECT owner, name, stars FROM repo_fx ORDER BY stars DESC, owner, name LIMIT 50", "repo_fx"))
def _(spark, sf):
    return repo_fx(spark, sf).select("owner", "name", "stars").transform(
        ops.limit_repos, 50, [F.desc("stars"), F.col("owner"), F.col("name")]
    )


@query("enrichment_stats",
       sql(f"""SELECT count(*) AS discovered, count(package) AS enriched,
                 count(*) FILTER (license_raw IS NOT NULL AND NOT ok) AS skipped_license,
                 count(*) FILTER (license_raw IS NULL AND package IS NULL) AS skipped_unlicensed,
                 count(*) FILTER (ok OR (license_raw IS NULL AND package IS NOT NULL)) AS to_process
               FROM (SELECT *, {_PERMISSIVE_RAW} AS ok FROM (SELECT *, lower(trim(license_raw)) AS lic FROM en))""",
           "pkg_fx", pk0=_PACKAGES_SQL, pk=_PACKAGES_FLAT, en=_ENRICHED))
def _(spark, sf):
    return ops.enrichment_stats(enriched(spark, sf))


_STATE_SQL = """SELECT repo_owner || '/' || repo_name AS key,
  CASE max(doc_id) % 6 WHEN 0 THEN 'error' WHEN 1 THEN 'no_files' ELSE 'collected' END AS status,
  count(*) AS files FROM corpus_fx GROUP BY repo_owner, repo_name HAVING max(doc_id) % 5 <> 2"""


def state(spark, sf):
    per_repo = corpus_fx(spark, sf).groupBy("repo_owner", "repo_name").agg(
        F.max("doc_id").alias("d"), F.count(F.lit(1)).alias("files")
    )
    return per_repo.filter("d % 5 <> 2").selectExpr(
        "concat(repo_owner, '/', repo_name) AS key",
        "CASE d % 6 WHEN 0 THEN 'error' WHEN 1 THEN 'no_files' ELSE 'collected' END AS status", "files",
    )


@query("collection_stats",
       sql("""SELECT count(*) FILTER (status = 'collected') AS processed, count(*) FILTER (status = 'error') AS failed,
                count(*) FILTER (status = 'no_files') AS no_files,
                CAST(sum(files) FILTER (status = 'collected') AS BIGINT) AS files_collected FROM st""",
           "corpus_fx", st=_STATE_SQL))
def _(spark, sf):
    return ops.collection_stats(state(spark, sf))


@query("resume_remaining",
       sql("""SELECT owner || '/' || name AS key FROM repo_fx
              WHERE owner || '/' || name NOT IN (SELECT key FROM st WHERE status <> 'error')""", "repo_fx", st=_STATE_SQL))
def _(spark, sf):
    work = repo_fx(spark, sf).selectExpr("concat(owner, '/', name) AS key")
    return ops.resume_remaining(work, state(spark, sf), ["key"], ["collected", "no_files"])
