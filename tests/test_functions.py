"""Literal edge rows of the column builders."""

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import keys, licenses, report, text, usage


def evaluate(spark, values, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["out"] for r in df.select("i", column.alias("out")).orderBy("i").collect()]


LICENSES = [
    (None, None), ("", None), ("   ", None), ("ISC", "ISC"), ("miscellaneous", "ISC"), ("bsd 2", "BSD-2-Clause"),
    ("new bsd", "BSD-3-Clause"), ("Apache-ish", "Apache-2.0"), ("LGPL-3.0", "LGPL-3.0"), ("EPL-2.0", None),
    ("UNLICENSED", None), (" MIT\n", "MIT"), ("Limited use", "MIT"), ("gpl-3.0-OR-later", "GPL-3.0-or-later"),
    ("0bsd", "0BSD"), ("BSD (simplified)", "BSD-2-Clause"), ("bsd-ish", "BSD-3-Clause"), ("The Unlicense", "Unlicense"),
]


def test_normalize_license(spark):
    raw = [r for r, _ in LICENSES]
    assert evaluate(spark, raw, licenses.normalize_license("v")) == [e for _, e in LICENSES]


def test_strict_license_has_no_substring_rules(spark):
    assert evaluate(spark, ["Limited use", "mit"], licenses.normalize_license("v", strict=True)) == [None, "MIT"]


def test_permissive_is_never_null(spark):
    assert evaluate(spark, [None, "", "GPL-3.0", "mpl 2.0"], licenses.is_permissive("v")) == [False, False, False, True]


def python_ratio(value):
    parts = value.strip().split("\n")
    return len(set(parts)) / max(len(parts), 1)


def python_partial(code):
    rows = code.split("\n")
    return "\n".join(rows[: max(5, int(len(rows) * 0.6))]) + text.COMPLETION_HINT


def test_unique_line_ratio(spark):
    values = ["", "  \n ", "a\n\n\n", "\n".join(["x"] * 10), "\n".join("aaaaaaabbc"), "\x1ca\nb\x85", "a\r\na"]
    assert evaluate(spark, values, text.unique_line_ratio("v")) == [python_ratio(v) for v in values]


def test_partial_code(spark):
    values = ["", "a\n", *("\n".join(f"l{i}" for i in range(n)) for n in (1, 5, 6, 8, 9, 15, 100))]
    assert evaluate(spark, values, text.partial_code("v")) == [python_partial(v) for v in values]


def test_strip_matches_python(spark):
    values = [f"{c}a{c}b{c}" for c in text.WHITESPACE] + ["", " \t\n"]
    assert evaluate(spark, values, text.strip("v")) == [v.strip() for v in values]


def test_loc_counts_code_points_and_lines(spark):
    assert evaluate(spark, ["", "a", "a\n", "é\n😀\n\n"], text.loc("v")) == [1, 1, 2, 4]
    assert evaluate(spark, ["é😀"], F.length("v")) == [2]


def test_source_class_and_complexity(spark):
    assert evaluate(spark, ["src/a", "test/x/y", "examples", "lib/src/a", "srcs/a"], text.source_class("v")) == [
        "src", "test", "examples", "other", "other"]
    assert evaluate(spark, [99, 100, 499, 500], text.complexity("v"), "int") == ["simple", "medium", "medium", "complex"]


def test_decode_replaces_bad_bytes_like_python(spark):
    blobs = [b"ok\r\nx\ry", b"bad \xff\xfe end", b"\xe2\x82", "é😀".encode()]
    got = evaluate(spark, blobs, text.normalize_newlines(text.decode_utf8("v")), "binary")
    expected = [b.decode("utf-8", "replace").replace("\r\n", "\n").replace("\r", "\n") for b in blobs]
    assert got == expected


def test_pick_is_stable_and_covers_all(spark):
    df = spark.range(500).select(keys.pick(42, 5, "id").alias("p"))
    again = spark.range(500).repartition(7).select(keys.pick(42, 5, "id").alias("p"))
    count = lambda d: sorted(map(tuple, d.groupBy("p").count().collect()))
    assert count(df) == count(again) and len(count(df)) == 5


def test_cost_and_speed(spark):
    df = spark.createDataFrame(
        [(100, 50, 300, 0.0, 10, 1000), (1_000_000, 0, 0, 0.5, 10, 0), (1_000_000, 1_000_000, 0, None, 10, 500)],
        "i long, o long, c long, reported double, out long, wall long",
    )
    estimate = usage.estimated_cost("i", "o", "c", F.lit(2.0), F.lit(4.0))
    rows = df.select(
        estimate.alias("e"), usage.request_cost("reported", estimate).alias("c"), usage.tokens_per_second("out", "wall").alias("t")
    ).collect()
    assert [r["e"] for r in rows] == pytest.approx([0.0002, 2.0, 6.0])
    assert [r["c"] for r in rows] == pytest.approx([0.0002, 0.5, 6.0])
    assert [r["t"] for r in rows] == [10.0, 0.0, 20.0]


def test_report_formats(spark):
    row = spark.range(1).select(
        report.short_sha(F.lit("0123456789")).alias("s"), report.size_mb(F.lit(1_250_000)).alias("m"),
        report.percentage(F.lit(1), F.lit(3)).alias("p"),
    ).first()
    assert tuple(row) == ("01234567", 1.3, 33.3)
