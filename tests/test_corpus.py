"""Funnel, dedup and reports."""

import pytest

from corpusloom.operators import corpus, dedup, filters

SCHEMA = ("id string, code string, repo_url string, repo_owner string, repo_name string, stars long, is_official boolean, "
          "license string, package string, package_downloads long")


def files(spark, *rows):
    base = dict(id="i", code="c" * 30, repo_url="u", repo_owner="o", repo_name="n", stars=0, is_official=False,
                license="MIT", package=None, package_downloads=None)
    names = list(base)
    return spark.createDataFrame([tuple({**base, **r}[k] for k in names) for r in rows], SCHEMA)


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_size_bounds_are_inclusive_code_points(spark):
    df = files(spark, *[dict(id=f"{n}", code="x" * n) for n in (19, 20, 50_000, 50_001)], dict(id="wide", code="😀" * 20))
    assert ids(filters.filter_stubs(filters.filter_generated(df))) == ["20", "50000", "wide"]


def test_null_semantics_of_filters(spark):
    df = files(
        spark, dict(id="a", license=None), dict(id="b", license=None, package="p"), dict(id="c", license="GPL-3.0"),
        dict(id="d", repo_owner=None), dict(id="e", repo_name="My-ExErCiSm"),
    )
    assert ids(filters.filter_unlicensed(df)) == ["b", "c", "d", "e"]
    assert ids(filters.filter_non_permissive(df)) == ["a", "b", "d", "e"]
    assert ids(filters.filter_name_patterns(df)) == ["a", "b", "c"]


def test_subsets(spark):
    df = files(
        spark, dict(id="off", is_official=True, stars=99), dict(id="stars", stars=10), dict(id="dl", package_downloads=1000),
        dict(id="low", stars=9), dict(id="unknown", is_official=None, stars=99), dict(id="nolic", license=None, stars=10),
    )
    assert ids(filters.config_official(df)) == ["off"]
    assert ids(filters.config_community_top(df)) == ["dl", "nolic", "stars"]
    assert ids(filters.config_all(df)) == ["dl", "low", "off", "stars", "unknown"]
    flags = corpus.config_flags(df)
    assert ids(flags.filter("in_community_top")) == ["dl", "nolic", "stars"]


@pytest.mark.parametrize("narrow", [False, True])
def test_dedup_keeps_most_starred_then_smallest_id(spark, narrow):
    df = files(
        spark, dict(id="b", code="same", stars=5), dict(id="a", code="same", stars=5), dict(id="n", code="same", stars=None),
        dict(id="z", code="other", stars=None), dict(id="q", code=None), dict(id="r", code=None),
        *[dict(id=f"h{i:03}", code="hot", stars=i % 7) for i in range(300)],
    )
    got = dedup.dedup_content(df, duplicates_only=narrow)
    assert ids(got) == ["a", "h006", "q", "z"]
    assert ids(dedup.dedup_content(got, duplicates_only=narrow)) == ids(got)


def test_dedup_cuts_hot_keys_before_the_shuffle(spark):
    plan = dedup.dedup_content(files(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_funnel_report_adds_up(spark):
    df = files(
        spark, dict(id="1", code="x"), dict(id="2", license=None), dict(id="3", license="GPL-2.0"), dict(id="4", repo_owner="exercism"),
        dict(id="5"), dict(id="6"), dict(id="7", code="y" * 60_000), dict(id="8", code=None),
    )
    rows = corpus.funnel_report(df).orderBy("step").collect()
    assert [(r["before"], r["removed"], r["after"]) for r in rows] == [
        (8, 2, 6), (6, 1, 5), (5, 1, 4), (4, 1, 3), (3, 1, 2), (2, 1, 1)]
    assert corpus.filter_corpus(df).count() == rows[-1]["after"]


def test_funnel_on_given_tables(spark):
    from querybook.corpus import licensed

    report = corpus.funnel_report(licensed(spark, "/root/testdata/sf0.001"), max_chars=20_000).orderBy("step").collect()
    assert [r["removed"] for r in report] == [0, 3, 48, 31, 2, 4]
    assert report[-1]["after"] == 112


def test_skipped_rules(spark):
    rules = corpus.corpus_rules(skip=("filter_stubs", "filter_unlicensed"))
    df = files(spark, dict(id="s", code="x", license=None), dict(id="g", license="GPL-3.0"))
    assert ids(corpus.filter_corpus(df, rules)) == ["s"]


def test_summary_counts_null_repo_once(spark):
    df = files(spark, dict(code="a\nb", repo_url=None), dict(code="c", repo_url=None), dict(code="d\n", repo_url="u"))
    assert tuple(corpus.corpus_summary(df).first()) == (3, 2, 5, 6)


def test_validate_reports_only_failures(spark):
    assert corpus.validate_corpus(files(spark, dict(id="1"), dict(id="2"))).count() == 0
    bad = files(spark, dict(id="1", code=""), dict(id="1", license=None), dict(id=None), dict(id=None, code="x" * 100_001))
    assert {r["check_name"]: r["n"] for r in corpus.validate_corpus(bad).collect()} == {
        "duplicate_ids": 4, "empty_code": 1, "missing_license": 1, "large_files": 1}
    assert corpus.duplicate_ids(bad).first()[0] == 4


def test_unknown_official_counts_as_community(spark):
    df = files(spark, dict(is_official=None), dict(is_official=True), dict())
    assert tuple(corpus.official_vs_community(df).first()) == (1, 2)


def test_token_budget(spark):
    df = files(spark, dict(id="in", code="x" * 296), dict(id="out", code="x" * 298))
    assert filters.token_budget_chars(100, 0) == 296
    assert ids(filters.filter_token_budget(df, 100, 0)) == ["in"]
    assert ids(filters.filter_token_budget(df, 0, 0)) == ["in", "out"]


def test_latest_wins_even_when_it_failed(spark):
    rows = [("f", "t", "2024-01-01", "r1", "stop"), ("f", "t", "2024-01-02", "r2", None), ("g", "t", None, "r3", "stop"),
            ("g", "t", "2023-01-01", "r4", "length"), ("h", "t", "2024-01-01", "r5", "stop"), ("h", "t", "2024-01-01", "r6", "stop")]
    df = spark.createDataFrame(rows, "source_file_id string, task_type string, timestamp string, request_id string, finish_reason string")
    keys = ["source_file_id", "task_type"]
    pick = lambda d: sorted(r["request_id"] for r in d.collect())
    assert pick(dedup.latest_per_key(df, keys)) == ["r2", "r4", "r6"]
    assert pick(dedup.latest_per_key(df, keys, prefer_success=True)) == ["r1", "r3", "r6"]


def test_rules_reach_the_scan_as_one_filter(spark):
    from querybook.corpus import _kept

    plan = _kept(spark, "/root/testdata/sf0.001").select("id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Filter ") == 1 and "Exchange" not in plan


def test_same_result_for_any_shuffle_width(spark):
    from querybook.corpus import licensed

    df = licensed(spark, "/root/testdata/sf0.001")
    expected = ids(corpus.filter_corpus(df))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert ids(corpus.filter_corpus(df)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_degenerate_boundary(spark):
    text = spark.createDataFrame([("a", "\n".join("aaaaaaaabc")), ("b", "\n".join("aaaaaaabcc")[:19]), ("c", "\n".join(["l"] * 10))],
                                 "id string, content string")
    assert ids(filters.filter_degenerate(text)) == ["a", "b"]
    assert ids(filters.degenerate_rejects(text)) == ["c"]
