"""Similarity joins and search against brute force."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import forest, jaccard, topk
from corpusloom.operators import components, tiles


def united(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000), (None, 3), (7, None)] + [(2000, 2001)] * 5
    found = {r.id: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = united([e for e in edges if None not in e], {v for e in edges if None not in e and e[0] != e[1] for v in e} | {5000})
    want.pop(5000)
    assert found == want
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_texts(seed=0):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        base = [r.choice(words) for _ in range(r.randint(60, 200))]
        texts.append(" ".join(base))
        for _ in range(r.randint(0, 9)):
            copy = list(base)
            for _ in range(r.randint(0, 5)):
                copy[r.randrange(len(copy))] = r.choice(words)
            texts.append((" " if r.random() < 0.8 else " \n ").join(copy))
    texts += [texts[0]] * 7 + ["one two", "One  two", "one", "a b c d e", "a b c d e", "", " \n", None, None]
    texts.append(" ".join(r.choice(words) for _ in range(30_000)))  # a very long one, and a near copy of it
    texts.append(texts[-1] + " more")
    return texts


def shingle_set(text):
    w = (text or "").lower().split()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_links(items, threshold=0.8):
    sets = [shingle_set(t) for _, t in items]
    holders = defaultdict(list)
    for n, s in enumerate(sets):
        for x in s:
            holders[x].append(n)
    common = Counter()
    for at in holders.values():
        for a in range(len(at)):
            for b in range(a + 1, len(at)):
                common[at[a], at[b]] += 1
    return [(a, b) for (a, b), c in common.items() if c / (len(sets[a]) + len(sets[b]) - c) >= threshold]


@pytest.mark.parametrize("tile", [1024, 3])
def test_jaccard_groups_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(tiles, "TILE", tile)  # small tiles cut the groups into blocks
    items = list(enumerate(near_texts()))
    docs = spark.createDataFrame([(i, t, 9, True) for i, t in items], "doc_id long, text string, n_links int, kept boolean")
    found = {r.doc_id: (r.n_links, r.class_id, r.kept) for r in jaccard.similarity_groups(docs).collect()}
    links = brute_links(items)
    degree = Counter(x for pair in links for x in pair)
    classes = united(links, range(len(items)))
    assert found == {i: (degree[i], classes[i], classes[i] == i) for i, _ in items}


def test_jaccard_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "quite another text that stands here"), (2, "a b c d e f"), (None, "a b c d e f"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = jaccard.similarity_groups(docs)
    got = sorted((r.doc_id or 0, r.n_links, r.class_id or 0, r.kept) for r in groups.collect())
    assert got == [(0, 0, 0, True), (1, 0, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]
    kept = sorted((r.doc_id or 0, r.text or "") for r in jaccard.keep_one(docs, groups).collect())
    assert kept == [(0, "a b c d e f"), (1, "a b c d e f"), (1, "quite another text that stands here"), (3, "")]
    assert jaccard.similarity_groups(docs.limit(0)).count() == 0


def test_one_id_on_two_texts_loses_neither(spark):
    a, b = "one two three four five six seven", "quite another text that stands here alone"
    docs = spark.createDataFrame([(3, a, 1), (5, a, 2), (5, b, 3), (5, b, 3), (6, b.upper(), 4), (7, None, 5), (7, None, 5), (None, a, 6)], "doc_id long, text string, kept int")
    kept = sorted((r.doc_id or 0, r.text or "") for r in jaccard.keep_one(docs, jaccard.similarity_groups(docs)).collect())
    assert kept == [(0, a), (3, a), (5, b), (7, "")]


def test_a_passage_in_every_text_unites_nothing(spark, monkeypatch):
    """Texts share half of their shingles, and so most of them some band: only verified groups are counted pair by pair."""
    r = random.Random(8)
    passage = " ".join(f"p{k}" for k in range(60))
    texts = []
    for _ in range(40):
        base = [f"w{r.randint(0, 3000)}" for _ in range(45)]
        for _ in range(r.choice([1, 1, 3])):
            copy = list(base)
            copy[r.randrange(45)] = "other"
            texts.append(" ".join(copy) + " " + passage)
    items = list(enumerate(texts))
    sizes, spread = [], tiles.spread
    monkeypatch.setattr(jaccard.tiles, "spread", lambda members, *more: (sizes.append(members.groupBy("_group").count().agg(F.max("count"), F.sum("count")).first()), spread(members, *more))[1])
    found = {r.doc_id: (r.n_links, r.class_id) for r in jaccard.similarity_groups(spark.createDataFrame(items, "doc_id long, text string")).collect()}
    links = brute_links(items)
    degree, classes = Counter(x for pair in links for x in pair), united(links, range(len(items)))
    assert found == {i: (degree[i], classes[i]) for i, _ in items} and links
    members = defaultdict(set)  # equal texts are one member
    for i, text in items:
        members[classes[i]].add(text)
    crowds = [len(m) for m in members.values() if len(m) > 1]
    assert tuple(sizes[-1]) == (max(crowds), sum(crowds))


def test_bayesian_bound():
    for n in (32, 64, 160):
        m = jaccard.fewest_matches(n, 0.8, 1e-6)
        tail = lambda k: sum(math.comb(n + 1, i) * 0.8 ** i * 0.2 ** (n + 1 - i) for i in range(k + 1))
        assert tail(m) >= 1e-6 > (tail(m - 1) if m else 0)


def test_pruning_keeps_similar_and_drops_different_pairs():
    g = np.random.default_rng(0)
    base = g.integers(0, 1 << 63, 200, dtype=np.uint64)
    near = np.concatenate([base[:190], g.integers(0, 1 << 63, 10, dtype=np.uint64)])
    far = np.concatenate([base[:60], g.integers(0, 1 << 63, 140, dtype=np.uint64)])
    values = jaccard.minhashes([base, near, far], 160, seed=2)
    i, j = jaccard.survivors(values, values, 0.8, 1e-6)
    assert (0, 1) in set(zip(i.tolist(), j.tolist())) and (0, 2) not in set(zip(i.tolist(), j.tolist()))


@pytest.mark.parametrize("dense", [True, False])
def test_intersections(dense):
    g = np.random.default_rng(1)
    sets = [np.unique(g.integers(0, 60, 40).astype(np.uint64)) for _ in range(12)]
    i, j = np.nonzero(np.ones((12, 12), bool)) if dense else (np.array([0, 3]), np.array([1, 5]))
    assert tiles.intersections(sets, i, j).tolist() == [len(set(sets[a].tolist()) & set(sets[b].tolist())) for a, b in zip(i, j)]


def vectors(seed=0, n=400, dim=16):
    g = np.random.default_rng(seed)
    out = [g.standard_normal(dim).tolist() for _ in range(n)]
    out += [(np.array(out[k % 20]) + 0.05 * g.standard_normal(dim)).tolist() for k in range(150)]
    out += [out[3]] * 6
    return out


ODD_VECTORS = [None, [], [0.0] * 16, [1.0, None], [float("nan")] * 16, [float("inf")] * 16, [1.0, 2.0], [1.0, 2.0], [1e300] * 16, [1e300] * 16]


@pytest.mark.parametrize("tile,leaf", [(1024, 1024), (7, 64)])
def test_forest_equals_brute_force(spark, monkeypatch, tile, leaf):
    monkeypatch.setattr(tiles, "TILE", tile)
    xs = vectors() + ODD_VECTORS
    frame = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(xs)], "vec_id long, embedding array<double>, kept string")
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in forest.near_duplicates(frame, leaf=leaf).collect()}
    ok = {i: forest.unit(np.array(x)) for i, x in enumerate(xs) if x and None not in x and np.isfinite(x).all() and np.any(x)}
    links = [(a, b) for a in ok for b in ok if a < b and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= 0.9]
    degree, comps = Counter(x for p in links for x in p), united(links, range(len(xs)))
    assert found == {i: (degree[i], comps[i], comps[i] == i) for i in range(len(xs))}


def brute_vectors(xs):
    ok = {i: forest.unit(np.array(x)) for i, x in enumerate(xs) if x and None not in x and np.isfinite(x).all() and np.any(x)}
    links = [(a, b) for a in ok for b in ok if a < b and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= 0.9]
    degree, comps = Counter(x for p in links for x in p), united(links, range(len(xs)))
    return {i: (degree[i], comps[i], comps[i] == i) for i in range(len(xs))}


@pytest.mark.parametrize("rounds,both", [(40, 0.5), (0, 0.5), (1, 0.5), (40, 0.0)])
def test_large_leaves_are_split_further_or_compared_in_tiles(spark, monkeypatch, rounds, both):
    """No leaf beyond the bound reaches a task, and a crowd of near copies in it is united all the same."""
    for name, value in (("SAMPLE", 64), ("OVERSIZE", 2), ("ROUNDS", rounds), ("MOST_BOTH", both), ("ROWS", 50)):
        monkeypatch.setattr(forest, name, value)
    monkeypatch.setattr(tiles, "TILE", 40)
    g = np.random.default_rng(5)
    crowd = g.standard_normal(16)
    xs = vectors(2) + [(crowd + 0.04 * g.standard_normal(16)).tolist() for _ in range(250)] + ODD_VECTORS
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "vec_id long, embedding array<double>")
    found, deepen = [], forest.deepen
    monkeypatch.setattr(forest, "deepen", lambda *a: (found.append(deepen(*a)), found[-1])[1])
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in forest.near_duplicates(frame, leaf=32).collect()}
    assert got == brute_vectors(xs)
    small, stuck = found[0]
    assert max(s.groupBy("_leaf").count().agg(F.max("count")).first()[0] or 0 for s in small) <= 64
    assert (stuck is None) == (rounds == 40 and both == 0.5)


def test_a_leaf_of_ties_is_not_split(spark):
    rows = spark.range(100).select(F.lit(7).cast("long").alias("_leaf"), F.col("id").cast("string").cast("binary").alias("_member"),
                                   F.lit(np.array([1.0, 0.0]).tobytes()).alias("_raw"))
    small, stuck = forest.deepen(rows, 10, 0.1)
    assert stuck.count() == 100 and not any(s.count() for s in small)


@pytest.mark.parametrize("rows,sparse", [(1024, 4), (16, 4), (16, 0)])
@pytest.mark.parametrize("across", [False, True])
def test_union_inside_a_leaf_is_exact(monkeypatch, rows, sparse, across):
    monkeypatch.setattr(forest, "ROWS", rows)
    monkeypatch.setattr(forest, "SPARSE", sparse)
    g = np.random.default_rng(9)
    for dim, n in ((2, 60), (3, 150), (4, 200), (8, 40)):
        x = g.standard_normal((n, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        first = g.random(n) < 0.4 if across else None
        links = [(i, j) for i in range(n) for j in range(i) if x[i] @ x[j] >= 0.9 and (first is None or first[i] != first[j])]
        want = united(links, range(n))
        assert forest.united(x, 0.9, first).tolist() == [want[i] for i in range(n)]


def planted_pairs(cosine, n=400, others=20_000, dim=64, seed=3):
    """Rows 2k and 2k + 1 have exactly that cosine and stand alone; the other rows are random."""
    g = np.random.default_rng(seed)
    a = g.standard_normal((n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = g.standard_normal((n, dim))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    pairs = np.stack([a, cosine * a + math.sqrt(1 - cosine ** 2) * b], axis=1).reshape(2 * n, dim)
    rest = g.standard_normal((others, dim))
    return np.concatenate([pairs, rest / np.linalg.norm(rest, axis=1, keepdims=True)])


def pairs_met(x, n, depth):
    met = np.zeros(n, bool)
    for t in range(forest.TREES):
        rows, leaves = forest.plant(x[::2], depth, t).leaves(x)
        places = defaultdict(set)
        for row, leaf in zip(rows[rows < 2 * n].tolist(), leaves[rows < 2 * n].tolist()):
            places[row].add(leaf)
        met |= np.array([bool(places[2 * k] & places[2 * k + 1]) for k in range(n)])
    return met.mean()


@pytest.mark.parametrize("depth", [4, 8, 10])
@pytest.mark.parametrize("cosine", [0.9, 0.92, 0.95])
def test_forest_meets_planted_pairs(cosine, depth):
    assert pairs_met(planted_pairs(cosine), 400, depth) >= 0.98


def test_forest_edge_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert forest.near_duplicates(none).count() == 0
    rows = spark.createDataFrame([(None, [1.0, 0.0]), (5, [1.0, 0.0]), (5, [1.0, 0.0]), (6, None)], "vec_id long, embedding array<float>")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in forest.near_duplicates(rows).collect())
    assert got == [(0, 0, 0, True), (5, 1, 5, True), (5, 1, 5, True), (6, 0, 6, True)]


@pytest.mark.parametrize("shard,step,block", [(16_384, 4096, 1024), (100, 16, 5)])
def test_top_k_equals_brute_force(spark, monkeypatch, shard, step, block):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "STEP_ROWS", step)
    monkeypatch.setattr(topk, "QUERY_ROWS", block)
    xs = [x for x in vectors(1)] + [None, [], [1.0, None], [float("nan")] * 16, [0.5] * 3, [0.0] * 16]
    frame = spark.createDataFrame([(i, x, "clash", 3) for i, x in enumerate(xs)], "vec_id long, embedding array<double>, score string, rank int")
    found = defaultdict(list)
    for r in topk.exact_top_k(frame, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    ok = {i: np.floor(64 * np.array(x + [0.0] * (16 - len(x)))).astype(int) for i, x in enumerate(xs) if x is not None and None not in x and np.isfinite(x).all()}
    for i in [k for k in ok if k % 20 == 0]:
        best = sorted(((-int(ok[i] @ ok[j]), j) for j in ok if j != i))[:20]
        assert found.pop(i) == [(k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert not found


def test_top_k_scores_queries_together_and_exactly():
    """A layout step meets several queries at once; components whose products floats cannot hold are scored as integers."""
    g = np.random.default_rng(3)
    for size in (40, 1 << 28):
        x = g.integers(-size, size, (300, 20))
        x[100:200] //= 1 + np.arange(100)[:, None]
        ids, asked = np.arange(300) // 2, np.arange(0, 40, 2)
        columns, queries = topk.vertical([r.tobytes() for r in x.astype("<i8")], 20), x[:20]
        masses, mass = topk.tail_mass(columns), topk.tail_mass(queries.T)
        kind = np.float64 if masses[0].max() * mass[0].max() < topk.EXACT else np.int64
        assert (kind == np.float64) == (size == 40)
        bests = [topk.Best(5) for _ in asked]
        for a in range(0, 300, 60):
            part = slice(a, a + 60)
            topk.search(queries.astype(kind), asked, mass, columns[:, part].astype(kind), masses[:, part], ids[part], bests)
        for q, best in enumerate(bests):
            want = sorted((-sum(map(int.__mul__, map(int, queries[q]), map(int, x[c]))), int(ids[c])) for c in range(300) if ids[c] != asked[q])[:5]
            assert list(zip((-best.scores).tolist(), best.ids.tolist())) == want


def test_sets_meet_only_in_their_tiles(spark, monkeypatch):
    """Tiles are laid out without sets, bands with the same members are compared once, and a repeated id gives one set."""
    laid, made, spread, shingled = [], [], tiles.spread, jaccard.shingle_sets
    monkeypatch.setattr(tiles, "spread", lambda rows, *a: laid.append(rows) or spread(rows, *a))
    monkeypatch.setattr(jaccard, "shingle_sets", lambda rows: made.append(shingled(rows)) or made[-1])
    words = [f"w{k}" for k in range(60)]
    near = words[:30] + ["other"] + words[31:]  # 51 of 61 shingles: linked
    far = words[:30] + [f"x{k}" for k in range(10)] + words[40:]  # shares bands at most
    rows = [(5, " ".join(words)), (5, " ".join(words)), (5, " ".join(words).upper()), (5, "another text of one id"), (None, " ".join(words)),
            (6, " ".join(near)), (7, " ".join(far)), (8, None), (9, " ".join(words))]
    got = jaccard.similarity_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_links, r.class_id or 0) for r in got) == [
        (0, 0, 0), (5, 0, 5), (5, 4, 5), (5, 4, 5), (5, 4, 5), (6, 4, 5), (7, 0, 7), (8, 0, 8), (9, 4, 5)]
    assert len(laid) == 2 and not any({"_set", "_values"} & set(x.columns) for x in laid)
    members = [r["_member"] for r in made[0].collect()]
    assert len(members) == len(set(members)) >= 2
    bands = spark.createDataFrame([(k, m) for k in range(4) for m in (b"a", b"b")] + [(9, b"a"), (9, b"c")], "_key long, _member binary")
    assert bands.groupBy("_key").agg(*jaccard.same_members()).select("_n", "_x", "_y").distinct().count() == 2


def test_quantised_vectors():
    rows = [None, [], [1.0, None], [float("nan")], [0.5, -0.01], [float("inf"), 1.0], [2.0]]
    for kind in (pa.float32(), pa.float64()):
        column = pa.array([[9.0], *rows], pa.list_(kind)).slice(1)
        assert [b if b is None else np.frombuffer(b, "<i8").tolist() for b in topk.quantised(column).to_pylist()] == [None, [], None, None, [32, -1], None, [128]]


def test_top_k_edge_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.exact_top_k(none, F.col("vec_id") % 20 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (0, [2.0]), (1, [1.0]), (2, [1.0]), (None, [9.0])], "vec_id long, embedding array<float>")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.exact_top_k(few, F.col("vec_id") == 1).collect()]
    assert sorted(got) == [(1, 1, 0, 8192), (1, 2, 0, 4096), (1, 3, 2, 4096)]
