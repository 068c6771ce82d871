"""Corpus filters, scalars, funnel and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import keys, licenses, report, text
from corpusloom.operators import corpus as ops
from corpusloom.operators import dedup, filters
from querybook.fixtures import MAX_CHARS, OFFICIAL, _PERMISSIVE_SQL, corpus_fx, sql, table
from querybook.registry import query

COPYLEFT_SQL = (
    "('GPL-2.0','GPL-3.0','AGPL-3.0','LGPL-2.1','LGPL-3.0','GPL-2.0-only','GPL-3.0-only','AGPL-3.0-only',"
    "'GPL-2.0-or-later','GPL-3.0-or-later')"
)


def licensed(spark, sf):
    return ops.with_license(corpus_fx(spark, sf))


def _kept(spark, sf):
    return ops.filter_corpus(licensed(spark, sf), deduplicate=False, max_chars=MAX_CHARS)


# --- filters ------------------------------------------------------------------------------------


@query("filter_generated", sql(f"SELECT id FROM corpus_fx WHERE length(code) <= {MAX_CHARS}", "corpus_fx"))
def _(spark, sf):
    return filters.filter_generated(corpus_fx(spark, sf), MAX_CHARS).select("id")


@query("filter_stubs", sql("SELECT id FROM corpus_fx WHERE length(code) >= 20", "corpus_fx"))
def _(spark, sf):
    return filters.filter_stubs(corpus_fx(spark, sf)).select("id")


@query("filter_unlicensed",
       sql("SELECT id, license FROM corpus_lic WHERE license IS NOT NULL OR package IS NOT NULL", "corpus_lic"))
def _(spark, sf):
    return filters.filter_unlicensed(licensed(spark, sf)).select("id", "license")


@query("filter_non_permissive",
       sql(f"SELECT id, license FROM corpus_lic WHERE license IS NULL OR NOT license IN {COPYLEFT_SQL}", "corpus_lic"))
def _(spark, sf):
    return filters.filter_non_permissive(licensed(spark, sf)).select("id", "license")


@query("filter_name_patterns",
       sql("""SELECT id FROM corpus_fx
              WHERE NOT regexp_matches(repo_owner, '(?i)exercism') AND NOT regexp_matches(repo_name, '(?i)exercism')""",
           "corpus_fx"))
def _(spark, sf):
    return filters.filter_name_patterns(corpus_fx(spark, sf)).select("id")


@query("filter_corpus", sql("SELECT id, repo_url, stars, license, length(code) AS n_chars FROM deduped", "deduped"))
def _(spark, sf):
    kept = ops.filter_corpus(licensed(spark, sf), max_chars=MAX_CHARS)
    return kept.select("id", "repo_url", "stars", "license", F.length("code").cast("long").alias("n_chars"))


@query("exclude_repos", sql("SELECT id, repo_name FROM corpus_fx WHERE repo_name <> 'styles'", "corpus_fx"))
def _(spark, sf):
    return filters.exclude_repos(corpus_fx(spark, sf), ["styles"]).select("id", "repo_name")


@query("filter_token_budget",
       sql("SELECT id FROM corpus_fx WHERE length(code) <= CAST(floor((1500 - 900 / 2.96) * 2.96) AS BIGINT)", "corpus_fx"))
def _(spark, sf):
    return filters.filter_token_budget(corpus_fx(spark, sf), 1500, 900).select("id")


@query("config_all", sql("SELECT id, license FROM corpus_lic WHERE license IS NOT NULL", "corpus_lic"))
def _(spark, sf):
    return filters.config_all(licensed(spark, sf)).select("id", "license")


@query("config_official", sql("SELECT id, repo_owner FROM corpus_fx WHERE is_official", "corpus_fx"))
def _(spark, sf):
    return filters.config_official(corpus_fx(spark, sf)).select("id", "repo_owner")


@query("config_community_top",
       sql("""SELECT id, stars, package_downloads FROM corpus_fx
              WHERE NOT is_official AND (stars >= 10 OR package_downloads >= 1000)""", "corpus_fx"))
def _(spark, sf):
    return filters.config_community_top(corpus_fx(spark, sf)).select("id", "stars", "package_downloads")


# --- scalars --------------------------------------------------------------------------------------


@query("normalize_license", sql("SELECT id, license_raw, license FROM corpus_lic", "corpus_lic"))
def _(spark, sf):
    return licensed(spark, sf).select("id", "license_raw", "license")


@query("is_permissive",
       sql(f"SELECT id, coalesce(license IN {_PERMISSIVE_SQL}, FALSE) AS permissive FROM corpus_lic", "corpus_lic"))
def _(spark, sf):
    return corpus_fx(spark, sf).select("id", licenses.is_permissive("license_raw").alias("permissive"))


@query("check_license",
       sql(f"""SELECT id, license, license_raw, coalesce(license IN {_PERMISSIVE_SQL}, FALSE) AS permissive
               FROM corpus_lic""", "corpus_lic"))
def _(spark, sf):
    return corpus_fx(spark, sf).select("id", licenses.check_license("license_raw").alias("c")).select("id", "c.*")


@query("is_official",
       sql("SELECT id, (repo_owner = 'org0' OR repo_owner = 'org1' OR repo_owner = 'org2') AS official FROM corpus_fx",
           "corpus_fx"))
def _(spark, sf):
    return corpus_fx(spark, sf).select("id", keys.is_official("repo_owner", OFFICIAL).alias("official"))


@query("record_id",
       sql("SELECT doc_id, repo_owner || '/' || repo_name || '/' || file_path AS record_id FROM corpus_fx", "corpus_fx"))
def _(spark, sf):
    return corpus_fx(spark, sf).select(
        "doc_id", keys.record_id("repo_owner", "repo_name", "file_path").alias("record_id")
    )


@query("repo_key",
       sql("""SELECT doc_id, repo_owner || '/' || repo_name AS repo_key, lower(repo_owner || '/' || repo_name) AS owner_repo
              FROM corpus_fx""", "corpus_fx"))
def _(spark, sf):
    return corpus_fx(spark, sf).select(
        "doc_id", keys.repo_key("repo_owner", "repo_name").alias("repo_key"),
        keys.owner_repo("repo_owner", "repo_name").alias("owner_repo"),
    )


@query("loc", sql("SELECT id, CAST(len(string_split(code, chr(10))) AS BIGINT) AS loc FROM corpus_fx", "corpus_fx"))
def _(spark, sf):
    return corpus_fx(spark, sf).select("id", text.loc("code").alias("loc"))


@query("complexity",
       sql("""SELECT id, CASE WHEN n < 5 THEN 'simple' WHEN n < 20 THEN 'medium' ELSE 'complex' END AS complexity
              FROM (SELECT id, len(string_split(code, chr(10))) AS n FROM corpus_fx)""", "corpus_fx"))
def _(spark, sf):
    return corpus_fx(spark, sf).select("id", text.complexity(text.loc("code"), 5, 20).alias("complexity"))


@query("source_class",
       sql("""SELECT id, CASE WHEN file_path LIKE 'src/%' THEN 'src' WHEN file_path LIKE 'test/%' THEN 'test'
                WHEN file_path LIKE 'examples/%' THEN 'examples' ELSE 'other' END AS source_class FROM corpus_fx""",
           "corpus_fx"))
def _(spark, sf):
    return corpus_fx(spark, sf).select("id", text.source_class("file_path").alias("source_class"))


@query("tier",
       sql("""SELECT id, CASE WHEN is_official THEN 'official' WHEN stars >= 10 THEN 'community_top'
                ELSE 'community' END AS tier FROM corpus_fx""", "corpus_fx"))
def _(spark, sf):
    return corpus_fx(spark, sf).select("id", keys.tier("is_official", "stars").alias("tier"))


_PAGE_LINES = "string_split(trim(html, chr(10)||chr(13)||chr(9)||' '), chr(10))"


@query("unique_line_ratio",
       f"""SELECT 'd' || doc_id AS id, CAST(len(list_distinct(l)) AS DOUBLE) / len(l) AS ratio
           FROM (SELECT doc_id, string_split(trim(text, chr(10)||chr(13)||chr(9)||' '), chr(10)) AS l FROM documents)
           UNION ALL
           SELECT 'p' || page_id AS id, CAST(len(list_distinct(l)) AS DOUBLE) / len(l) AS ratio
           FROM (SELECT page_id, {_PAGE_LINES} AS l FROM pages)""")
def _(spark, sf):
    docs = table(spark, sf, "documents").selectExpr("concat('d', doc_id) AS id", "text AS body")
    pages = table(spark, sf, "pages").selectExpr("concat('p', page_id) AS id", "html AS body")
    return docs.union(pages).select("id", text.unique_line_ratio("body").alias("ratio"))


@query("partial_code",
       sql("""SELECT id, length(p) AS n_chars, md5(p) AS digest FROM (
                SELECT id, array_to_string(l[1:greatest(5, CAST(floor(len(l) * 0.6::DOUBLE) AS BIGINT))], chr(10))
                       || chr(10) || '// TODO: implement the remaining functions' AS p
                FROM (SELECT id, string_split(code, chr(10)) AS l FROM corpus_fx))""", "corpus_fx"))
def _(spark, sf):
    partial = corpus_fx(spark, sf).select("id", text.partial_code("code").alias("p"))
    return partial.select("id", F.length("p").cast("long").alias("n_chars"), F.md5("p").alias("digest"))


@query("pick_instruction",
       sql("""SELECT id, CAST(('0x' || substr(md5('42|' || id), 1, 8))::BIGINT % 5 AS INTEGER) AS choice FROM corpus_fx""",
           "corpus_fx"))
def _(spark, sf):
    return corpus_fx(spark, sf).select("id", keys.pick(42, 5, "id").alias("choice"))


@query("estimate_tokens",
       sql("SELECT id, CAST(ceil(length(code) / 2.96::DOUBLE) AS BIGINT) AS est_tokens FROM corpus_fx", "corpus_fx"))
def _(spark, sf):
    return corpus_fx(spark, sf).select("id", text.estimate_tokens("code").alias("est_tokens"))


@query("report_formats",
       sql("""SELECT source, substr(md5(source), 1, 8) AS short_sha, round(sum(length(code)) / 1e6, 1) AS size_mb,
                round(100.0::DOUBLE * count(*) / max(n), 1) AS pct
              FROM (SELECT repo_name AS source, code, count(*) OVER () AS n FROM corpus_fx) GROUP BY source""", "corpus_fx"))
def _(spark, sf):
    corpus = corpus_fx(spark, sf)
    total = corpus.agg(F.count(F.lit(1)).alias("n"))
    per_source = corpus.groupBy(F.col("repo_name").alias("source")).agg(
        F.count(F.lit(1)).alias("files"), F.sum(F.length("code")).alias("chars")
    )
    return per_source.select(
        "source", report.short_sha(F.md5("source")).alias("short_sha"), report.size_mb("chars").alias("size_mb"),
        report.percentage("files", total.scalar()).alias("pct"),
    )


# --- funnel, reports --------------------------------------------------------------------------------


@query("dedup_content",
       sql("""SELECT id, sha256(code) AS digest, stars FROM (SELECT *, row_number() OVER (
                PARTITION BY code ORDER BY stars DESC, id) AS rn FROM corpus_fx) WHERE rn = 1""", "corpus_fx"))
def _(spark, sf):
    winners = dedup.dedup_content(corpus_fx(spark, sf))
    return winners.select("id", keys.content_key("code").alias("digest"), "stars")


@query("dedup_content_narrow",
       sql("""SELECT id, stars FROM (SELECT *, row_number() OVER (
                PARTITION BY code ORDER BY stars DESC, id) AS rn FROM corpus_fx) WHERE rn = 1""", "corpus_fx"))
def _(spark, sf):
    return dedup.dedup_content(corpus_fx(spark, sf), duplicates_only=True).select("id", "stars")


@query("corpus_summary",
       sql("""SELECT count(*) AS files, count(DISTINCT repo_url) AS repos,
                CAST(sum(len(string_split(code, chr(10)))) AS BIGINT) AS lines, CAST(sum(length(code)) AS BIGINT) AS chars
              FROM deduped""", "deduped"))
def _(spark, sf):
    return ops.deduplicated_summary(ops.filter_corpus(licensed(spark, sf), deduplicate=False, max_chars=MAX_CHARS))


@query("license_distribution",
       sql("SELECT license, count(*) AS files FROM corpus_lic WHERE license IS NOT NULL GROUP BY license", "corpus_lic"))
def _(spark, sf):
    return ops.license_distribution(licensed(spark, sf))


@query("official_vs_community",
       sql("SELECT count(*) FILTER (is_official) AS official, count(*) FILTER (NOT is_official) AS community FROM corpus_fx",
           "corpus_fx"))
def _(spark, sf):
    return ops.official_vs_community(corpus_fx(spark, sf))


@query("duplicate_ids",
       sql("""SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows
              FROM (SELECT repo_url, count(*) AS n FROM corpus_fx GROUP BY repo_url) WHERE n > 1""", "corpus_fx"))
def _(spark, sf):
    # file ids are unique in the view, repository urls are not
    return ops.duplicate_ids(corpus_fx(spark, sf), "repo_url")


@query("validate_corpus",
       sql("""SELECT * FROM (
                SELECT 'duplicate_ids' AS check_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS n
                  FROM (SELECT count(*) AS n FROM corpus_lic GROUP BY repo_url) WHERE n > 1
                UNION ALL SELECT 'empty_code', count(*) FROM corpus_lic WHERE length(code) = 0
                UNION ALL SELECT 'missing_license', count(*) FROM corpus_lic WHERE license IS NULL
                UNION ALL SELECT 'large_files', count(*) FROM corpus_lic WHERE length(code) > 10000) WHERE n > 0""",
           "corpus_lic"))
def _(spark, sf):
    return ops.validate_corpus(licensed(spark, sf).withColumn("id", F.col("repo_url")), large_chars=10_000)


@query("funnel_report",
       sql(f"""SELECT CAST(step AS INTEGER) AS step, step_name, CAST(n AS BIGINT) AS before, CAST(n - m AS BIGINT) AS removed,
                 CAST(m AS BIGINT) AS after FROM (
          SELECT 1 AS step, 'filter_generated' AS step_name, count(*) AS n,
                 count(*) FILTER (length(code) <= {MAX_CHARS}) AS m FROM corpus_lic
          UNION ALL SELECT 2, 'filter_stubs', count(*), count(*) FILTER (length(code) >= 20)
            FROM corpus_lic WHERE length(code) <= {MAX_CHARS}
          UNION ALL SELECT 3, 'filter_unlicensed', count(*), count(*) FILTER (license IS NOT NULL OR package IS NOT NULL)
            FROM corpus_lic WHERE length(code) BETWEEN 20 AND {MAX_CHARS}
          UNION ALL SELECT 4, 'filter_non_permissive', count(*), count(*) FILTER (license IS NULL OR NOT license IN {COPYLEFT_SQL})
            FROM corpus_lic WHERE length(code) BETWEEN 20 AND {MAX_CHARS} AND (license IS NOT NULL OR package IS NOT NULL)
          UNION ALL SELECT 5, 'filter_name_patterns', count(*), (SELECT count(*) FROM kept)
            FROM corpus_lic WHERE length(code) BETWEEN 20 AND {MAX_CHARS} AND (license IS NOT NULL OR package IS NOT NULL)
              AND (license IS NULL OR NOT license IN {COPYLEFT_SQL})
          UNION ALL SELECT 6, 'dedup_content', count(*), count(DISTINCT code) FROM kept)""", "kept"))
def _(spark, sf):
    return ops.funnel_report(licensed(spark, sf), max_chars=MAX_CHARS)


@query("config_flags",
       sql("""SELECT id, license IS NOT NULL AS in_all, is_official AS in_official,
                coalesce(NOT is_official AND (stars >= 10 OR package_downloads >= 1000), FALSE) AS in_community_top
              FROM corpus_lic""", "corpus_lic"))
def _(spark, sf):
    return ops.config_flags(licensed(spark, sf)).select("id", "in_all", "in_official", "in_community_top")
