"""Hard negatives, ranked search and license scans against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import lexical, licenses, negatives


def mined(rows, anchors, k=5, low=80, scale=256):
    """(anchor, positive, rank, negative, positive score, negative score) of every anchor, by sorting all scores."""
    clean = [(i, label, [math.floor(scale * np.float64(np.float32(x))) for x in v]) for i, label, v in rows
             if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, label, v in {(i, label, tuple(v)) for i, label, v in clean if anchors(i)}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in clean if j != i)
        for down, positive, _ in [s for s in scored if s[2] == label][:k]:
            inside = [(s, j) for s, j, other in scored if other != label and low * -down <= 100 * -s <= 100 * -down][:k]
            out += [(i, positive, r + 1, j, -down, -s) for r, (s, j) in enumerate(inside)]
    return sorted(out)


def vector_rows(seed, n, labels=3, width=6):
    r = random.Random(seed)
    rows = [(i, r.randrange(labels), [r.choice([0.0, 0.25, 0.5, 1.0, r.uniform(-0.2, 1)]) for _ in range(width)]) for i in range(n)]
    hot = [0.5] * width  # equal vectors: ties, in both labels
    rows += [(1000 + i, i % labels, hot) for i in range(60)]
    rows += [(2000, None, hot), (None, 1, hot), (2010, 1, None), (2020, 1, [0.1, None]), (2030, 1, [math.nan] * width), (2040, 1, []),
             (2050, 0, [1.0] * 3), rows[5], rows[7], (20, 2, hot), (20, 2, hot), (2060, 1, [-1.0] * width)]
    return rows


@pytest.mark.parametrize("block_bytes", [8 << 20, 2000])
def test_hard_negatives_are_those_of_a_full_sort(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(negatives, "BLOCK_BYTES", block_bytes)
    rows = vector_rows(1, 300)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(5)
    clash = df.withColumns({"anchor": F.lit(1), "id": F.lit("x"), "raw": F.lit(2), "score": F.lit(0)})
    found = sorted(map(tuple, negatives.hard_negatives(clash, F.col("vec_id") % 10 == 0).collect()))
    want = mined(rows, lambda i: i % 10 == 0)
    assert len(want) > 500 and found == want


def test_hard_negatives_of_wide_scores_and_empty_tables(spark):
    rows = [(i, i % 2, [float(1_000_000 + i), 20_000.0 * i]) for i in range(40)]  # products beyond 2^53
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    assert sorted(map(tuple, negatives.hard_negatives(df, F.col("vec_id") == 20).collect())) == mined(rows, lambda i: i == 20)
    empty = df.where("vec_id < 0")
    assert negatives.hard_negatives(empty, F.lit(True)).collect() == []
    assert negatives.hard_negatives(df, F.lit(None).cast("boolean")).collect() == []
    with pytest.raises(ValueError, match="windows"):
        negatives.hard_negatives(df, F.lit(True), highest=101)


def test_windows_stream_in_key_order():
    pairs = sorted([(0, -100, 0, 7), (0, -100, 1, 3), (0, -100, 1, 9), (0, -90, 0, 8), (0, -85, 1, 1), (0, -79, 1, 2), (0, 5, 0, 4), (0, 5, 1, 6),
                    (1, 0, 0, 2), (1, 0, 1, 3)])
    assert list(negatives.open_windows(iter(pairs), 5, 2, 80, 100)) == [
        (0, 7, 1, 3, 100, 100), (0, 7, 2, 9, 100, 100), (0, 8, 1, 1, 90, 85), (0, 8, 2, 2, 90, 79), (1, 2, 1, 3, 0, 0)]


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans(licenses.UPPER, licenses.LOWER)


def ranked(docs, items, k=10):
    counts = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                        for t in set(TERM.findall((text or "").translate(LOWER))) if t in c)
            if score > 0 and i is not None:
                scored.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def prose(seed, n):
    r = random.Random(seed)
    words = [f"w{min(int(r.paretovariate(0.7)), 400)}" for _ in range(3000)]
    texts = [(i, r.choice([" ", "-", "\n"]).join(r.choice(words) for _ in range(r.choice([3, 20, 20, 60, 300])))) for i in range(n)]
    texts += [(5000 + i, "the same words in each of these texts w1 w2") for i in range(700)]  # one crowded stratum
    texts += [(6000, None), (6001, ""), (6002, " .,;"), (None, "w1 w1 w1 w399"), (6003, "W1 Été été K 日本"), (6003, "w1 again"),
              texts[3], (6004, "w2 " * 40_000), (6005, "none of it")]
    return texts


@pytest.mark.parametrize(("round_terms", "postings"), [(200_000, 4_000_000), (25, 60)])
def test_ranked_search_is_that_of_a_full_scan(spark, monkeypatch, round_terms, postings):
    monkeypatch.setattr(lexical, "ROUND_TERMS", round_terms)  # the second case indexes all terms and searches in rounds
    monkeypatch.setattr(lexical, "TASK_POSTINGS", postings)
    docs = prose(2, 400)
    items = [(i, docs[i * 7][1][:400]) for i in range(30)] + [(90, None), (91, ""), (92, "unheard of"), (93, "ÉTÉ été k w1"), (94, "same words"),
                                                         (None, "w3 w5"), (95, "w1"), (95, "w2"), (94, "same words")]
    corpus = spark.createDataFrame(docs, "doc_id long, text string").repartition(7).withColumns({"m": F.lit(1), "term": F.lit("x"), "id": F.lit(3), "tf": F.lit(0)})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({"rank": F.lit(0), "doc_id": F.lit(1)})
    found = sorted(map(tuple, lexical.rank_documents(corpus, asked).collect()), key=repr)
    assert found == ranked(docs, items)


def test_ranked_search_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a"), (2, "")], "item_id long, text string")
    assert [tuple(r)[:3] for r in lexical.rank_documents(docs, items).collect()] == [(1, 1, 1)]
    assert lexical.rank_documents(docs.where("doc_id < 0"), items).collect() == []
    assert lexical.rank_documents(docs.where("doc_id = 2"), items).collect() == []
    assert lexical.rank_documents(docs, items.where("item_id < 0")).collect() == []


def test_strata_that_cannot_win_are_not_visited(monkeypatch):
    import pyarrow as pa

    rows = [(10, 0, None, 0, [1, 2]), (10, 0, b"a", 9, [0]), (10, 0, b"a", 3, [1])]
    rows += [(1000 + 10 * s, 0, t, tf, d) for s in range(200) for t, tf, d in ((None, 0, [100 + s]), (b"a", 1, [0]))]
    table = pa.table(dict(zip(["m", "chunk", "term", "tf", "docs"], map(list, zip(*rows)))), schema=pa.schema(
        [("m", pa.int64()), ("chunk", pa.int32()), ("term", pa.binary()), ("tf", pa.int32()), ("docs", pa.list_(pa.int64()))]))
    strata = lexical.Strata(table, {b"a": 0})
    seen = []
    monkeypatch.setattr(lexical.Best, "add", lambda self, scores, ids, add=lexical.Best.add: (seen.extend(ids.tolist()), add(self, scores, ids))[1])
    assert strata.search([(0, 5)], 2).ids.tolist() == [1, 2]
    assert len(seen) < 20


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def scanned(texts, templates=None):
    """Word by word, without index or padding."""
    templates = licenses.TEMPLATES if templates is None else templates
    split = [WORD.findall((t or "").translate(LOWER)) for t in texts]
    df = Counter(w for words in split for w in set(words))
    out = []
    for words in split:
        hits = [(i, label) for p, label in licenses.BASE_PHRASES.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
        labels, shares = {label for _, label in hits}, [0.0]
        for t in templates:
            there = all(any(words[i:i + len(p.split())] == p.split() for i in range(len(words))) for p in t.phrases)
            rare = sorted(set(t.words) & set(words), key=lambda w: (df[w], w))[: licenses.RARE_WORDS]
            starts = Counter(s for w in rare for s in {i - q for i, x in enumerate(words) if x == w for q, y in enumerate(t.words) if y == w})
            if there and max(starts.values(), default=0) >= licenses.AGREE:
                labels.add(t.label)
                shares.append(max(starts.values()) / len(rare))
        places = [i for i, _ in hits]
        out.append((len(words), len(hits), min(places, default=None), max(places, default=None),
                    ",".join(sorted({label for _, label in hits})), ",".join(sorted(labels)), max(shares)))
    return out


def licensed_texts():
    r = random.Random(4)
    filler = "the of to in this software and under license version any words with free public use".split()
    texts = [" ".join(r.choice(filler) for _ in range(r.choice([0, 5, 80]))) + " /* " + t.text + " */ " + " ".join(r.choice(filler) for _ in range(20))
             for t in licenses.TEMPLATES for _ in range(2)]
    texts += [t.text.upper().replace(" ", "\n * ") for t in licenses.TEMPLATES]
    texts += [t.phrases[0] for t in licenses.TEMPLATES]
    shuffled = licenses.TEMPLATES[2].words
    r.shuffle(shuffled)
    texts += [" ".join(shuffled), "mit", "license mit", "cc by cc by CC-BY", "all rights reserved, all rights reserved", "cc  by", "ccby cc bye", "xcc by",
              "ccé by cc byé", "GENERAL PUBLIC LICENKE general public license", "the gnu general public license", "", None, " \n", "日本 cc by", "CC BY \u212a cc by", "\u212a", "GNU AFFERO İ general public l\u0130cense",
              "license " * 30_000 + "all rights reserved", "all rights all rights reserved", "mit license " * 2000, "cc by"] + ["All rights reserved."] * 3
    return texts


def test_license_scan_is_that_of_a_word_by_word_search(spark):
    texts = licensed_texts()
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumns({"words": F.lit(1), "padded": F.lit("x"), "labels": F.lit("y"), "t0": F.lit(2)})
    found = sorted(map(tuple, licenses.scan(docs).collect()))
    assert found == [(i, *row) for i, row in enumerate(scanned(texts))]


def test_license_scan_keeps_rows_and_runs_without_python(spark):
    docs = spark.createDataFrame([(None, "cc by"), (1, "cc by"), (1, "cc by"), (2, None)], "doc_id long, text string")
    found = licenses.scan(docs)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([
        (None, 2, 1, 0, 0, "cc-by", "cc-by", 0.0), *[(1, 2, 1, 0, 0, "cc-by", "cc-by", 0.0)] * 2, (2, 0, 0, None, None, "", "", 0.0)], key=repr)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert licenses.scan(docs.where("doc_id = 9")).collect() == []
