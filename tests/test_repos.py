"""Search items, packages, enrichment."""

import json

from corpusloom.operators import registry
from corpusloom.operators.dedup import dedup_across_chunks
from corpusloom.sources.registry_json import last_per_name, parse_package_items, parse_repo_items, with_owner_repo


def items(spark, *objects):
    return spark.createDataFrame([(i, json.dumps(o)) for i, o in enumerate(objects)], "seq long, item string")


def test_parse_repo_items(spark):
    df = parse_repo_items(items(
        spark,
        {"owner": {"login": "ann"}, "full_name": "ann/tool/x", "html_url": "u", "description": None, "stargazers_count": 3,
         "license": {"spdx_id": "NOASSERTION"}, "fork": True},
        {"owner": {"login": ""}, "full_name": "bare", "license": None},
        {"full_name": "b/c", "license": {"spdx_id": "MIT"}, "description": "d", "archived": True},
    ), keep=["seq"]).orderBy("seq").collect()
    a, b, c = df
    assert (a.owner, a.name, a.url, a.description, a.stars, a.license_raw, a.authors, a.fork) == (
        "ann", "tool/x", "u", "", 3, None, ["ann"], True)
    assert (b.owner, b.name, b.url, b.stars, b.authors, b.archived) == ("", "bare", "https://github.com/bare", 0, [], False)
    assert (c.owner, c.license_raw, c.description, c.archived) == ("", "MIT", "d", True)


def test_parse_package_items_last_data_wins_first_position_stays(spark):
    df = parse_package_items(items(
        spark,
        {"name": "Wob", "meta": {"licenses": ["MIT"], "links": {"GitHub": "https://github.com/A/Wob/"}}, "downloads": {"all": 1}},
        {"name": "other", "meta": {}},
        {"name": "wob", "meta": {"licenses": [], "links": {"GitHub": "https://example.org/A/Wob"}}, "downloads": {"all": 9}},
    )).orderBy("name").collect()
    assert [(r.name, r.package_downloads, r.license_raw, r.github_owner_repo, r.position) for r in df] == [
        ("other", None, None, None, 1), ("wob", 9, None, None, 0)]


def enrich(spark, repos, packages):
    r = spark.createDataFrame(repos, "owner string, name string, license_raw string")
    p = spark.createDataFrame(packages, "name string, package_downloads long, license_raw string, github_url string, seq long")
    out = registry.enrich_repos(r, last_per_name(with_owner_repo(p)))
    return {x["name"]: (x["package"], x["package_downloads"], x["license_raw"]) for x in out.collect()}


def test_link_match_beats_name_match_as_a_whole(spark):
    got = enrich(spark, [("Ann", "Tool", "")], [
        ("tool", 1, "MIT", "", 0), ("linked", 2, None, "https://github.com/ann/tool", 1)])
    assert got == {"Tool": ("linked", 2, "")}


def test_shared_link_takes_the_package_listed_last(spark):
    link = "https://github.com/ann/tool"
    got = enrich(spark, [("ann", "tool", None)], [("p1", 1, "MIT", link, 0), ("p2", 2, "ISC", link, 1), ("p1", 3, "MIT", link, 2)])
    assert got == {"tool": ("p2", 2, "ISC")}


def test_link_spelling(spark):
    got = enrich(spark, [("a", "slash", None), ("a", "git", None), ("a", "own", "GPL-3.0")], [
        ("x", 1, "MIT", "https://github.com/A/Slash//", 0), ("y", 2, "MIT", "https://github.com/a/git.git", 1),
        ("z", 3, "MIT", "https://github.com/a/own", 2)])
    assert got == {"slash": ("x", 1, "MIT"), "git": (None, None, None), "own": ("z", 3, "GPL-3.0")}


def test_bare_host_matches_nothing(spark):
    got = enrich(spark, [("a", "b", None)], [("x", 1, "MIT", "https://github.com/", 0)])
    assert got == {"b": (None, None, None)}


def test_chunks(spark):
    found = spark.createDataFrame([("a", "x", 0, 0), ("a", "y", 0, 1), ("a", "x", 1, 2), ("b", "z", 1, 3), ("b", "z", 2, 4)],
                                  "owner string, name string, chunk_seq long, item_seq long")
    first = sorted((r.name, r.chunk_seq) for r in dedup_across_chunks(found).collect())
    assert first == [("x", 0), ("y", 0), ("z", 1)]
    counts = [tuple(r) for r in registry.chunk_counts(found).orderBy("chunk_seq").collect()]
    assert counts == [(0, 2, 2, 2, False), (1, 2, 1, 3, False), (2, 1, 0, 3, False)]


def test_resume(spark):
    work = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "key string")
    state = spark.createDataFrame([("a", "collected"), ("b", "error"), ("b", "error")], "key string, status string")
    left = lambda **o: sorted(str(r.key) for r in registry.resume_remaining(work, state, ["key"], **o).collect())
    assert left() == ["None", "c"]
    assert left(done_statuses=["collected"]) == ["None", "b", "c"]
    assert left(force=True) == ["None", "a", "b", "c"]
