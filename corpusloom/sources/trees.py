"""Source trees to corpus records."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import keys, text
from corpusloom.functions.licenses import normalize_license
from corpusloom.operators.filters import MAX_FILE_CHARS, MIN_FILE_CHARS


def read_tree(spark: SparkSession, root: str, extension: str, max_chars: int = MAX_FILE_CHARS,
              min_chars: int = MIN_FILE_CHARS) -> DataFrame:
    """``(path, content)`` of one extension below ``root``, the path relative to it.

    Sizes that cannot satisfy the character bounds are skipped by the source, unread: a character
    takes one to four bytes.

    Spark's listing hides names that start with ``.`` or ``_``. Trees with ``_`` names have to come
    in as a ready ``(path, content)`` table.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{extension}").load(root)
        .filter(F.col("length").between(min_chars, 4 * max_chars))
    )
    # listed paths are absolute URIs: the qualified root, which they start with, is cut off once
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(root)
    qualified = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target).toString()
    # "file:/a", "file:///a" and plain "/a" are the same place
    scheme = r"^file:/+"
    prefix = re.sub(scheme, "file:/", qualified.rstrip("/")) + "/"
    listed = F.regexp_replace("path", scheme, "file:/")
    return files.select(F.substring(listed, len(prefix) + 1, F.length(listed)).alias("path"), "content")


def visible_path(path: Column) -> Column:
    """No hidden path part, and no build output outside a source folder."""
    parts = F.split(path, "/")
    hidden = F.exists(parts, lambda p: p.startswith("."))
    build_only = F.array_contains(parts, "build") & ~F.array_contains(parts, "src")
    return ~hidden & ~build_only


def extract_files(
    files: DataFrame,
    extension: str,
    official_owners: list[str],
    source: str = "crawl",
    collected_at: str | None = None,
    max_chars: int = MAX_FILE_CHARS,
    min_chars: int = MIN_FILE_CHARS,
) -> DataFrame:
    """Corpus records from files joined with their repository.

    ``files`` has ``path`` (relative to the repository) and ``content`` (bytes), plus repository
    columns ``repo_owner, repo_name, repo_url, repo_description, stars, license_raw, authors,
    package, package_downloads, fork, archived, commit_sha``; missing ones become null. Byte bounds
    come before decoding: a character takes one to four bytes.
    """
    optional = {
        "repo_url": "string", "repo_description": "string", "stars": "long", "license_raw": "string",
        "authors": "array<string>", "package": "string", "package_downloads": "long", "fork": "boolean",
        "archived": "boolean", "commit_sha": "string",
    }
    for name, kind in optional.items():
        if name not in files.columns:
            files = files.withColumn(name, F.lit(None).cast(kind))
    stamp = F.lit(collected_at) if collected_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    wanted = files.filter(F.col("path").endswith(f".{extension}") & visible_path(F.col("path"))).filter(
        F.octet_length("content").between(min_chars, 4 * max_chars)
    )
    decoded = wanted.withColumn("code", text.normalize_newlines(text.decode_utf8("content"))).filter(
        F.length("code").between(min_chars, max_chars)
    )
    return decoded.select(
        keys.record_id("repo_owner", "repo_name", "path").alias("id"), F.lit(source).alias("source"), "code",
        F.col("path").alias("file_path"), "repo_url", "repo_owner", "repo_name",
        F.coalesce("repo_description", F.lit("")).alias("repo_description"), F.coalesce("stars", F.lit(0)).alias("stars"),
        keys.is_official("repo_owner", official_owners).alias("is_official"),
        normalize_license("license_raw").alias("license"), "license_raw",
        F.coalesce("authors", F.array().cast("array<string>")).alias("authors"), "package", "package_downloads",
        F.coalesce("fork", F.lit(False)).alias("fork"), F.coalesce("archived", F.lit(False)).alias("archived"),
        stamp.alias("collected_at"), "commit_sha", F.lit(1).alias("schema_version"),
    )
