"""Physical plans of registered queries."""

import pytest

from querybook import load_all
from querybook.registry import QUERIES

load_all()
SF_DIR = "/root/testdata/sf0.001"


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


MAP_ONLY = ["filter_generated", "filter_unlicensed", "normalize_license", "unique_line_ratio", "build_prompts", "config_flags",
            "train_eval_split", "extract_files", "partial_code"]
SHUFFLED = ["filter_corpus", "funnel_report", "latest_per_key", "clean_report", "provider_summary", "enrich_repos", "error_streaks",
            "validate_chat", "validate_chat_raw", "mix_stats", "chat_stats", "budget_cutoff", "stratified_sample", "dense_ids"]


@pytest.mark.parametrize("name", MAP_ONLY)
def test_row_operators_do_not_shuffle(spark, name):
    text = plan(spark, name)
    assert "Exchange" not in text and "EvalPython" not in text


@pytest.mark.parametrize("name", SHUFFLED)
def test_no_cross_products_and_no_python(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert bad not in text


@pytest.mark.parametrize("name", ["filter_corpus", "dedup_content", "latest_per_key", "dedup_across_chunks"])
def test_keys_are_cut_on_the_map_side(spark, name):
    assert plan(spark, name).count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", ["mix_stats", "chat_stats"])
def test_statistics_read_every_source_once(spark, name):
    assert plan(spark, name).count("Scan parquet") == 4


def test_columns_are_pruned(spark):
    text = plan(spark, "license_distribution")
    assert "text" not in text.split("ReadSchema")[-1].split("\n")[0]
