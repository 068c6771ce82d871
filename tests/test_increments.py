"""Commits, loads, saved pages and trees: what must hold when runs are repeated or die."""

import json
import random

import pytest
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.operators import bloom, corpus, dedup, sketches
from corpusloom.plans import collect, convert
from corpusloom.sources import registry_json, statetable, treesource

STATE = "key string, status string, ts double, note string"


def state_at(spark, path, buckets=8):
    return statetable.StateTable(spark, str(path), STATE, ["key"], "ts", buckets)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_commits_equal_the_latest_row_of_every_key(spark, tmp_path):
    table, r, want = state_at(spark, tmp_path / "s"), random.Random(1), {}
    assert table.read().collect() == [] and table.read().columns == ["key", "status", "ts", "note"]
    for commit in range(6):
        rows = [(r.choice([None, *map(str, range(40))]), f"s{commit}", r.choice([None, float(r.randint(0, 30))]), "n") for _ in range(r.choice([3, 60]))]
        table.upsert(spark.createDataFrame(rows, STATE).repartition(3).withColumn("_n", F.lit(0)))
        best = {}
        for k, s, t, n in rows:  # rows of one commit that are alike in time differ in nothing else here
            if k not in best or (t is not None and (best[k][2] is None or t > best[k][2])):
                best[k] = (k, s, t, n)
        for k, row in best.items():
            if k not in want or want[k][2] is None or (row[2] is not None and row[2] >= want[k][2]):
                want[k] = row
    assert rows_of(table.read()) == sorted(want.values(), key=repr)
    assert rows_of(state_at(spark, tmp_path / "s", buckets=99).read()) == rows_of(table.read())  # the first commit fixes the buckets
    assert table.upsert(spark.createDataFrame([], STATE)) is None and table.versions() == [1, 2, 3, 4, 5, 6]


def test_untouched_buckets_are_not_rewritten_and_old_versions_stay(spark, tmp_path):
    table = state_at(spark, tmp_path / "s", buckets=16)
    table.upsert(spark.range(200).select(F.col("id").cast("string").alias("key"), F.lit("a").alias("status"), F.lit(1.0).alias("ts")))
    before, rows = table.folders(), rows_of(table.read())
    table.upsert(spark.createDataFrame([("7", "b", 2.0, None), ("new", "b", 2.0, None)], STATE))
    after = table.folders()
    changed = {b for b in after if after[b] != before.get(b)}
    assert len(before) == 16 and 1 <= len(changed) <= 2
    assert rows_of(table.read(version=1)) == rows and table.read().count() == 201
    assert table.vacuum(keep=1) == 0 and table.versions() == [2]  # the first folder still holds most buckets
    assert table.read().where("key = '7'").first().status == "b" and table.read().where("note is null").count() == 201
    with pytest.raises(ValueError, match="no version 1"):
        table.read(version=1)


def test_a_commit_that_dies_leaves_the_old_version(spark, tmp_path, monkeypatch):
    table = state_at(spark, tmp_path / "s")
    table.upsert(spark.createDataFrame([("a", "old", 1.0, None)], STATE))
    change = spark.createDataFrame([("a", "new", 2.0, None)], STATE)

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(statetable.StateTable, "_publish", die)
        with pytest.raises(RuntimeError, match="killed"):
            table.upsert(change)
    assert table.read().first().status == "old"
    (tmp_path / "s" / "manifests" / "000000000002.json").write_text('{"version": 2, "folders": {')  # died while it wrote the manifest
    assert table.read().first().status == "old"
    assert table.upsert(change) == 3 and table.read().first().status == "new"


def test_two_commits_at_once_are_merged_one_after_the_other(spark, tmp_path, monkeypatch):
    first, second = state_at(spark, tmp_path / "s"), state_at(spark, tmp_path / "s")
    first.upsert(spark.createDataFrame([("a", "x", 1.0, None)], STATE))
    publish, raced = statetable.StateTable._publish, []

    def overtaken(self, version, folders):
        if self is first and not raced:
            raced.append(version)
            second.upsert(spark.createDataFrame([("b", "y", 1.0, None), ("a", "newer", 5.0, None)], STATE))
        publish(self, version, folders)

    monkeypatch.setattr(statetable.StateTable, "_publish", overtaken)
    assert first.upsert(spark.createDataFrame([("c", "z", 1.0, None), ("a", "older", 4.0, None)], STATE)) == 3 and raced == [2]
    assert [(r.key, r.status) for r in first.read().orderBy("key").collect()] == [("a", "newer"), ("b", "y"), ("c", "z")]
    with pytest.raises(statetable.StateConflict):
        publish(first, 3, {})


FILE = "id string, code string, stars long, extra string"


@pytest.mark.parametrize("bits", [64, bloom.BITS])
def test_a_deduplicated_load_is_the_deduplication_of_both(spark, bits):
    """The small filter holds every row for known: the join alone decides then."""
    r = random.Random(2)
    row = lambda i: (f"i{i}", r.choice([None, "", *[f"text {k}" for k in range(60)]]), r.choice([None, 1, 5, 5, 9]), "e")
    published = dedup.dedup_content(spark.createDataFrame([row(i) for i in range(150)] + [("hot", "the same", 3, "e")], FILE))
    load = spark.createDataFrame([row(i) for i in range(500, 620)] + [(f"h{i}", "the same", i % 4, "e") for i in range(300)] + [("i3", "unheard of", 1, "e")], FILE).repartition(4)
    done = bloom.dedup_load(load, published, bits)
    want = dedup.dedup_content(published.unionByName(load))
    assert rows_of(done.merged(published)) == rows_of(want)
    assert done.known <= done.suspected and (bits > 64 or done.suspected > done.known)
    empty = load.limit(0)
    assert rows_of(bloom.dedup_load(empty, published, bits).merged(published)) == rows_of(published)
    assert rows_of(bloom.dedup_load(load, empty, bits).merged(empty)) == rows_of(dedup.dedup_content(load))


def test_filters_are_as_exact_as_asked(spark):
    keys = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("k"))
    bits = bloom.filter_bits(20_000, 0.01)
    hashes = bloom.hash_count(bits, 20_000)
    words = bloom.bloom_filter(keys, "k", bits, hashes)
    assert bloom.maybe_known(keys, "k", words, hashes).where("not _maybe").count() == 0
    other = spark.range(50_000, 70_000).select(F.md5(F.col("id").cast("string")).alias("k"))
    assert bloom.maybe_known(other, "k", words, hashes).where("_maybe").count() < 0.02 * 20_000


def repo(name, **more):
    return {"owner": {"login": "o"}, "full_name": f"o/{name}", "html_url": f"https://github.com/o/{name}", "license": {"spdx_id": "MIT"}, **more}


def test_saved_pages_to_enriched_repositories(spark, tmp_path):
    search, packages = tmp_path / "search", tmp_path / "packages"
    search.mkdir()
    packages.mkdir()
    for k, text in enumerate([json.dumps({"total_count": 3, "items": [repo("a", stargazers_count=3), None, repo("b")]}), " \n", "null", '{"items": [{"full_name": "cut',
                              '{"items": {"full_name": "o/no"}}', '{"message": "rate limit"}', json.dumps({"items": []}), json.dumps({"items": [repo("a"), repo("c")]}, indent=2)]):
        (search / f"page-{k}.json").write_text(text)
    package = lambda name, link: {"name": name, "meta": {"links": {"GitHub": link}, "licenses": ["MIT"]}, "downloads": {"all": 7}}
    (packages / "1.json").write_text(json.dumps([package("a", "https://github.com/o/a"), package("old", "")]))
    (packages / "2.json").write_text(json.dumps([package("A", "https://github.com/O/C/")]))
    pages = registry_json.read_pages(spark, str(search))
    assert [(r.page_seq, r.item_seq, json.loads(r["item"])["full_name"]) for r in registry_json.page_items(pages).orderBy("page_seq", "item_seq").collect()] == [
        (0, 0, "o/a"), (0, 2, "o/b"), (7, 0, "o/a"), (7, 1, "o/c")]
    assert [tuple(r)[1:] for r in registry_json.page_report(pages).orderBy("page").collect()] == [
        (3, None), (0, "empty"), (0, "no items"), (0, "broken"), (0, "no items"), (0, "no items"), (0, None), (2, None)]
    found = {r.name: (r.stars, r.package) for r in collect.discover_saved(spark, str(search), str(packages)).collect()}
    assert found == {"a": (3, "a"), "b": (0, None), "c": (0, "a")}  # the last page gives a package's link, its name still matches


def test_whole_trees_with_every_kind_of_name(spark, tmp_path):
    want = {}
    for folder in ("_private", ".hidden", "build/src", "src/.cache/_x", "", "a b/ü"):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        for name in ("_f.txt", ".g.txt", "h.md", "empty.txt", "part=1.txt"):
            raw = b"" if name.startswith("empty") else bytes(range(256)) * 3 + f"{folder}/{name}\r\n".encode()
            (tmp_path / folder / name).write_bytes(raw)
            if name.endswith(".txt"):
                want[f"{folder}/{name}".lstrip("/")] = raw
    found = treesource.read_whole_tree(spark, str(tmp_path), "txt", run_files=4, run_bytes=2000)
    assert {r.path: bytes(r.content) for r in found.collect()} == want
    assert found.rdd.getNumPartitions() >= len(want) / 4
    assert treesource.read_whole_tree(spark, f"file://{tmp_path}", min_bytes=1).where("length = 0 or length <> octet_length(content)").count() == 0
    (tmp_path / "none").mkdir()
    assert treesource.read_whole_tree(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="(?i)not.*exist|no such|FileNotFound"):
        treesource.read_whole_tree(spark, str(tmp_path / "missing")).count()


def test_the_funnel_is_counted_in_the_pass_that_writes(spark, tmp_path, monkeypatch):
    rows = [{"id": f"o/n/{i}", "code": f"code number {i // 2} " * (0 if i == 7 else 3), "stars": i, "repo_owner": "exercism" if i % 10 == 9 else "o", "repo_name": "n",
             "license": [None, "MIT", "GPL-3.0"][i % 3]} for i in range(60)]
    (tmp_path / "raw.jsonl").write_text("\n".join(map(json.dumps, rows)))
    raw = spark.read.schema(schemas.CORPUS_FILE).json(str(tmp_path / "raw.jsonl"))
    want = rows_of(corpus.funnel_report(raw))
    monkeypatch.setattr(corpus, "funnel_report", None)  # no second scan
    done = convert.convert_corpus(spark, str(tmp_path / "raw.jsonl"), str(tmp_path / "out"))
    assert rows_of(done.funnel) == want
    plain = corpus.observed_funnel(raw, deduplicate=False)
    assert plain.kept.count() == plain.report().orderBy(F.desc("step")).first()["after"]
    nothing = corpus.observed_funnel(raw.where("id is null"))
    assert nothing.kept.collect() == [] and {r["after"] for r in nothing.report().collect()} == {0}


def test_sketches_of_loads_are_united_without_the_loads(spark):
    files = spark.range(30_000).selectExpr("concat('u', id % 9000) AS repo_url", "concat('text\n', id % 20000) AS code")
    loads = {f"l{k}": files.where(F.pmod(F.xxhash64("code"), F.lit(4)) == k) for k in range(3)}
    stored = sketches.sketch_loads(loads)
    found = sketches.united(stored.unionByName(stored.where("load = 'l1'"))).first()
    exact = sketches.united(sketches.sketch_loads({"one": files.where(F.pmod(F.xxhash64("code"), F.lit(4)) < 3)})).first()
    true = files.where(F.pmod(F.xxhash64("code"), F.lit(4)) < 3).select("code").distinct().count()
    assert (found.loads, found.files, found.lines) == (3, exact.files, 2 * exact.files)
    assert found.repos == exact.repos and abs(found.contents - true) <= sketches.error_bound() * true
    nothing = sketches.united(sketches.load_sketch(files.limit(0), "none")).first()
    assert tuple(nothing) == (1, 0, 0, 0, 0, 0)


def test_saved_pages_are_single_files(spark, tmp_path, monkeypatch):
    from querybook import increments

    monkeypatch.setattr(increments, "scratch_path", lambda _, label: f"{tmp_path}/{label}")
    spark.range(25).selectExpr("id AS doc_id", "'s' AS source").write.parquet(f"{tmp_path}/in/documents.parquet")
    found = increments._saved_pages(spark, f"{tmp_path}/in").select("page").collect()
    assert sorted(r.page.rsplit("/", 1)[1] for r in found) == ["page=0", "page=1", "page=2"]
    assert all(p.is_file() for p in (tmp_path / "pages").iterdir())
