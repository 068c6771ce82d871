"""Saved search and package pages to repository and package tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.functions.text import decode_utf8
from corpusloom.operators.ranking import global_row_number

# Fixed values: "no usable license" marker and the host that package links point at.
NO_LICENSE = "NOASSERTION"
HOST = "github.com/"


def read_pages(spark: SparkSession, path: str | list[str], at: str = "$.items") -> DataFrame:
    """``page, page_seq, body, entries`` of every saved result page, one JSON file each.

    ``entries`` is the array at ``at`` (``$`` where a page is a bare array) as a variant, null if the page is broken, null or
    blank, or has something else there. ``page_seq`` counts pages in the order of their paths, from 0. Spark lists no file
    without a byte, and none whose name begins with ``.`` or ``_``: they are no pages.
    """
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("page"), decode_utf8("content").alias("body"))
    paths = files.select("page")
    places = global_row_number(paths, [F.col("page")], "page_seq").withColumn("page_seq", F.col("page_seq") - 1)
    there = F.try_variant_get(F.try_parse_json("body"), at, "variant")
    return files.join(places, "page").select("page", "page_seq", "body", F.when(F.schema_of_variant(there).startswith("ARRAY"), there).alias("entries"))


def page_items(pages: DataFrame, seq: str = "page_seq") -> DataFrame:
    """``page, page_seq, item_seq, item``: one row per entry of :func:`read_pages`, its JSON text in ``item``; null entries,
    and pages without entries, give none."""
    exploded = pages.lateralJoin(pages.sparkSession.tvf.variant_explode(F.col("entries").outer()))
    return exploded.where("not is_variant_null(value)").select("page", seq, F.col("pos").cast("long").alias("item_seq"), F.to_json("value").alias("item"))


def page_report(pages: DataFrame) -> DataFrame:
    """``page, items, problem`` of every page: how many entries it has, and why it has none (``empty``, ``broken``,
    ``no items``), null if it has an array."""
    body = F.trim(F.coalesce("body", F.lit("")), F.lit(" \t\r\n"))
    problem = (F.when(F.col("entries").isNotNull(), None).when(body == "", "empty").when(F.try_parse_json("body").isNull(), "broken").otherwise("no items"))
    size = F.size(F.try_variant_get("entries", "$", "array<variant>"))
    return pages.select("page", F.when(F.col("entries").isNull(), 0).otherwise(size).alias("items"), problem.alias("problem"))


def parse_repo_items(df: DataFrame, json_col: str = "item", keep: list[str] | None = None) -> DataFrame:
    """One search item per row to one repository per row; ``keep`` passes other columns through."""
    item = df.select(*(keep or []), F.from_json(json_col, schemas.SEARCH_ITEM).alias("i"))
    full = F.coalesce("i.full_name", F.lit(""))
    login = F.coalesce("i.owner.login", F.lit(""))
    slash = F.instr(full, "/")
    return item.select(
        *(keep or []),
        login.alias("owner"),
        F.when(slash > 0, F.substring(full, slash + 1, F.length(full))).otherwise(full).alias("name"),
        F.coalesce("i.html_url", F.concat(F.lit(f"https://{HOST}"), full)).alias("url"),
        F.coalesce("i.description", F.lit("")).alias("description"),
        F.coalesce("i.stargazers_count", F.lit(0)).alias("stars"),
        F.nullif("i.license.spdx_id", F.lit(NO_LICENSE)).alias("license_raw"),
        F.when(login != "", F.array(login)).otherwise(F.array().cast("array<string>")).alias("authors"),
        F.coalesce("i.fork", F.lit(False)).alias("fork"),
        F.coalesce("i.archived", F.lit(False)).alias("archived"),
    )


def with_owner_repo(df: DataFrame, url: str = "github_url") -> DataFrame:
    """Lower-cased ``owner/repo`` of a link, trailing slashes removed, null for other hosts."""
    link = F.coalesce(url, F.lit(""))
    bare = F.rtrim(link, F.lit("/"))
    at = F.instr(bare, HOST)
    tail = F.when(at > 0, F.substring(bare, at + len(HOST), F.length(bare))).otherwise(bare)
    return df.withColumn("github_owner_repo", F.when(link.contains(HOST), F.lower(tail)))


def parse_package_items(df: DataFrame, json_col: str = "item", seq: str = "seq") -> DataFrame:
    """Packages keyed by lower-cased name. The last item of a name gives its data; ``position`` is
    where the name first appeared, which decides between packages that share a link."""
    item = df.select(F.col(seq).alias("seq"), F.from_json(json_col, schemas.PACKAGE_ITEM).alias("i"))
    flat = with_owner_repo(item.select(
        F.lower(F.coalesce("i.name", F.lit(""))).alias("name"),
        F.col("i.downloads.all").alias("package_downloads"),
        F.try_element_at("i.meta.licenses", F.lit(1)).alias("license_raw"),
        F.coalesce("i.meta.links.GitHub", F.lit("")).alias("github_url"),
        "seq",
    ))
    return last_per_name(flat)


def last_per_name(packages: DataFrame) -> DataFrame:
    data = F.struct("package_downloads", "license_raw", "github_url", "github_owner_repo")
    return (
        packages.groupBy("name").agg(F.max_by(data, "seq").alias("p"), F.min("seq").alias("position"))
        .select("name", "p.*", "position")
    )
