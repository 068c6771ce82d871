"""The quality model keeps every character but digits apart, in whatever script, and scores the same with and without a copy of its tables."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import quality

GREEK, LATIN = "αβγδεζηθικλμνξοπρστυφχψω", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789.,;"
SCHEMA = "doc_id long, text string, lang string"


def words(r, letters, n, starts=6):
    """Words that each come from a few fixed ones, so that a model can learn them."""
    known = ["".join(r.choice(letters) for _ in range(5)) for _ in range(starts)]
    return lambda g: " ".join(g.choice(known) for _ in range(n))


def plain(text):
    return [ord("0") if c.isdecimal() else ord(c) for c in text]


def brute_perplexity(texts):
    """Interpolated modified Kneser-Ney over whole code points, from the definitions."""
    grams = lambda t: [tuple(s[k:k + 4]) for s in [[0, 0, 0, *(c + 1 for c in plain(t)), 0]] for k in range(len(s) - 3)]
    levels = {4: Counter(g for t in texts for g in grams(t))}
    for n in (3, 2, 1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    symbols = max(quality.CODES, len(levels[1]) + 1)
    cuts, contexts = {}, {n: defaultdict(list) for n in levels}
    for n, found in levels.items():
        m = Counter(found.values())
        cuts[n] = [0, 0.5, 1.0, 1.5]
        if m[1] and m[2] and m[3]:
            y = m[1] / (m[1] + 2 * m[2])
            cuts[n] = [0, *(min(max(d, 0.1 * (k + 1)), k + 0.95) for k, d in enumerate((1 - 2 * y * m[2] / m[1], 2 - 3 * y * m[3] / m[2], 3 - 4 * y * m[4] / m[3])))]
        for g, c in found.items():
            contexts[n][g[:-1]].append(c)

    def p(g):
        n = len(g)
        if n == 0:
            return 1 / symbols
        seen = contexts[n].get(g[:-1])
        if not seen:
            return p(g[1:])
        c, total = levels[n].get(g, 0), sum(seen)
        return max(c - cuts[n][min(c, 3)], 0) / total + sum(cuts[n][min(x, 3)] for x in seen) / total * p(g[1:])

    return lambda t: 10 ** (-sum(math.log10(p(g)) for g in grams(t)) / (len(t) + 1))


@pytest.fixture(scope="module")
def corpus(spark):
    """Latin texts with more than 64 characters, fewer Greek, Chinese and emoji ones."""
    r = random.Random(3)
    makers = [words(r, LATIN, 20, 40)] * 6 + [words(r, GREEK, 20), words(r, [chr(0x4E00 + k) for k in range(300)], 20), words(r, "😀😁😂🤣😃٣４", 20)]
    texts = [makers[k % len(makers)](r) for k in range(270)]
    docs = spark.createDataFrame([(k, t, "xx") for k, t in enumerate(texts)], SCHEMA)
    return texts, docs, quality.fit(docs, docs.select("doc_id"))


def test_all_characters_count(corpus):
    texts, docs, model = corpus
    seen = {c for t in texts for c in plain(t)}
    assert len(seen) > 90 and set(model.common) == seen and model.symbols == len(seen) + 2
    brute = brute_perplexity(texts)
    for r in quality.score(docs, model, ["text"]).collect()[::9]:
        assert math.isclose(r.perplexity, brute(r.text), rel_tol=1e-4)


def test_scores_from_tables_equal_those_from_a_copy(spark, corpus, monkeypatch):
    texts, docs, model = corpus
    odd = spark.createDataFrame([(1, None, "a"), (1, "", "b"), (1, "", "b"), (None, texts[0], None), (7, "ж" * 9, "c"), (7, "ж" * 9, "c"), (8, "\U0010ffff\x00�", "d")], SCHEMA)
    both = docs.unionByName(odd)
    found = []
    for most in (quality.BROADCAST_GRAMS, 10):
        monkeypatch.setattr(quality, "BROADCAST_GRAMS", most)
        rows = quality.score(both, (model, model), ["doc_id", "lang"]).withColumn("p", F.col("perplexity")).collect()
        found.append(sorted(((r.doc_id or -1, r.lang or "", r.n_symbols, r.perplexity or 0.0) for r in rows)))
    assert len(found[0]) == len(found[1]) == len(texts) + 7
    for a, b in zip(*found):
        assert a[:3] == b[:3] and math.isclose(a[3], b[3], rel_tol=1e-4)


def test_junk_of_a_minority_script_goes(spark, tmp_path):
    """Greek letters stand a multiple of six places from those of trusted words: codes by remainder took them for the same."""
    r = random.Random(8)
    greek, latin = words(r, GREEK, 30), words(r, LATIN, 30, 400)
    rows = [(k, greek(r) if k % 14 == 0 else latin(r), "el" if k % 14 == 0 else "en") for k in range(3500)]
    moved = str.maketrans({c: chr(0x3B1 + (ord(c) - 0x3B1 + 6) % 24) for c in GREEK})
    junk = [(k + 10_000, t.translate(moved), lang) for k, t, lang in rows if lang == "el"]
    spark.createDataFrame([(k, 1, 0) for k, *_ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(rows + junk, SCHEMA)
    kept = {x.doc_id for x in corpus_pipeline.filter_quality(spark, docs, str(tmp_path)).collect()}
    assert len([k for k in kept if k < 10_000]) > 0.95 * len(rows) and not [k for k in kept if k >= 10_000]
