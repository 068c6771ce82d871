"""The exact set-similarity join against brute force, and how much it compares."""

import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import neardup, setjoin, tiles
from corpusloom.session import shared_dir


def shingle_set(text):
    w = (text or "").lower().split()
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else None


def brute(rows, threshold=0.8):
    """Smallest id reachable by links, and the number of linked pairs of different sets."""
    sets = {}
    for i, t in rows:
        s = shingle_set(t)
        if s:
            sets.setdefault(frozenset(s), []).append(i)
    keys, links = list(sets), []
    for a, x in enumerate(keys):
        for b in range(a):
            y = keys[b]
            if len(x & y) / len(x | y) >= threshold:
                links.append((a, b))
    root = list(range(len(keys)))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    least = {}
    for k, r in enumerate(root):
        least[r] = min([least.get(r, 10**9), *sets[keys[k]]])
    group = {i: least[root[k]] for k, s in enumerate(keys) for i in sets[s]}
    return {i: group.get(i, i) for i, _ in rows}, len(links)


def near_rows(seed, clusters=14, size=12, edits=3, words=70, passage=""):
    r = random.Random(seed)
    texts = []
    for _ in range(clusters):
        base = [f"w{r.randint(0, 300)}" for _ in range(r.randint(words // 2, words))]
        for _ in range(r.randint(1, size)):
            copy = list(base)
            for _ in range(r.randint(0, edits)):
                copy[r.randrange(len(copy))] = f"w{r.randint(0, 300)}"
            texts.append(" ".join(copy) + " " + passage)
    return list(enumerate(texts))


def grouped(spark, rows, **how):
    df = spark.createDataFrame(rows, "id long, text string").withColumns({"_id": F.lit(1), "_set": F.lit("x")}).repartition(4)
    return {r["id"]: r["group_id"] for r in setjoin.similar_text_groups(df, **how).collect()}


@pytest.mark.parametrize("tile", [4, 1024])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(tiles, "TILE", tile)
    rows = near_rows(1) + [(900, None), (901, ""), (902, " \n "), (903, "one two"), (904, "One  two"), (905, "a b c d e f"), (906, "a b c d e f g"),
                           (907, "x " * 9000), (908, "x " * 9000 + "y")]
    assert grouped(spark, rows) == brute(rows)[0]


@pytest.mark.parametrize("threshold", [0.5, 0.6, 1.0])
def test_other_thresholds(spark, threshold):
    rows = near_rows(7, clusters=8, edits=6)
    assert grouped(spark, rows, threshold=threshold) == brute(rows, threshold)[0]


def test_a_passage_in_every_text_is_not_compared(spark):
    """A passage of eighty words stands in all texts; compared pairs stay within four times the members of groups."""
    passage = " ".join(f"p{k}" for k in range(80))
    rows = near_rows(3, clusters=60, size=4, passage=passage)
    want, _ = brute(rows)
    df = spark.createDataFrame(rows, "id long, text string")
    keyed, sets = setjoin.text_sets(df, "text", "id", 5)
    found = setjoin.similar_sets(sets)
    assert {r["id"]: r.group_id for r in setjoin.named_groups(keyed, found.groups, "id").collect()} == want
    members = sets.count()
    assert members > 100 and found.compared() <= 4 * members < members * members / 10


def test_a_crowd_of_near_copies_costs_a_comparison_each(spark):
    r = random.Random(5)
    base = [f"w{k}" for k in range(200)]
    rows = [(i, " ".join(base[:k] + [f"new{i}"] + base[k + 1:])) for i, k in enumerate(r.randrange(200) for _ in range(400))]
    keyed, sets = setjoin.text_sets(spark.createDataFrame(rows, "id long, text string"), "text", "id", 5)
    found = setjoin.similar_sets(sets)
    assert {r.group_id for r in setjoin.named_groups(keyed, found.groups, "id").collect()} == {0}
    assert found.compared() <= 20 * len(rows)  # all pairs: 79,800


def test_empty_tables_and_repeated_ids(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "other words that are not alike at all"), (2, "a b c d e f"), (2, "a b c d e f"), (None, "q r s t u v")], "id long, text string")
    assert setjoin.similar_text_groups(df.where("id > 9")).collect() == []
    found = sorted((r["id"], r.group_id) for r in setjoin.similar_text_groups(df.where("id is not null")).collect())
    assert found == [(1, 1), (1, 1), (2, 1), (2, 1)]
    assert neardup.near_duplicate_groups(df.where("id > 9")).collect() == []


def scratch_bytes(spark):
    return sum(p.stat().st_size for p in Path(shared_dir(spark)).rglob("*.parquet"))


@pytest.mark.parametrize("groups", [setjoin.similar_text_groups, neardup.near_duplicate_groups])
def test_sets_are_stored_once(spark, groups):
    """Texts without a partner: their sets are written once (8 bytes an element), and the digest brings copies together."""
    r = random.Random(11)
    texts = [" ".join(f"w{r.randint(0, 10**9)}" for _ in range(1200)) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate([*texts, *texts[:20]])), "id long, text string").repartition(4)
    before = scratch_bytes(spark)
    found = {x["id"]: x.group_id for x in groups(df).collect()}
    assert found == {i: i if i < 150 else i - 150 for i in range(170)}
    assert scratch_bytes(spark) - before < 1.5 * 8 * 1196 * 170


def test_no_set_is_shuffled_to_learn_what_is_shared(spark):
    df = spark.createDataFrame(near_rows(2), "id long, text string")
    plan = setjoin.prefixes(setjoin.text_sets(df, "text", "id", 5)[1], 0.8)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert len(moved) == 3 and not any(re.search(r"\b_(set|token)#", columns) for columns in moved)


def test_elements_that_look_alike(spark):
    """Elements that differ only in bits that neither the bucket nor the lower half holds: alike when counted, not when compared."""
    r = random.Random(3)
    sets = []
    for k in range(60):
        base = [(r.randrange(16) << 60) + (r.randrange(4) << 40) + r.randrange(40) for _ in range(30)]
        for _ in range(r.randint(1, 4)):
            sets.append(sorted({(e if r.random() > 0.06 else e ^ (1 << 40)) - (1 << 63) for e in base}))
    sets = [list(x) for x in sorted(set(map(tuple, sets)))]
    links = {(a, b) for a, x in enumerate(sets) for b, y in enumerate(sets) if a != b and len({*x} & {*y}) / len({*x} | {*y}) >= 0.8}
    want = list(range(len(sets)))
    for _ in sets:
        for a, b in links:
            want[a] = want[b] = min(want[a], want[b])
    df = spark.createDataFrame([(k, len(x), x) for k, x in enumerate(sets)], "_id long, _n int, _set array<long>")
    found = {x["_id"]: x["_group"] for x in setjoin.similar_sets(df).groups.collect()}
    assert links and {k: found.get(k, k) for k in range(len(sets))} == dict(enumerate(want))


def test_many_copies_are_left_out_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(setjoin, "BROADCAST_IDS", 0)
    rows = near_rows(4, clusters=6)
    rows += [(i + 500, t.upper()) for i, t in rows] + [(900, None), (901, "")]
    assert grouped(spark, rows) == brute(rows)[0]
