"""Trained operators: held-out accuracy, brute-force probabilities, edge cases."""

import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusloom.llm import hmm, htmltext, langid, quality
from corpusloom.llm.common import table
from corpusloom.llm.htmlblocks import blocks

SF = "/root/testdata/sf0.01"
LONG = "the cat and the dog went to the house of the queen " * 3000


def tiny(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, perplexity string, held_out int")


def row(i, text, lang="en"):
    return (i, text, lang, "clash", "clash", 5)


# --- language ---------------------------------------------------------------------------------


def test_language_of_held_out_documents(spark):
    docs = table(spark, SF, "documents")
    found = {r.doc_id: r for r in langid.identify(docs).collect()}
    rows = docs.select("doc_id", "lang").collect()
    held = [r for r in rows if found[r.doc_id].held_out]
    assert len(found) == len(rows) and len(held) > 150
    assert sum(found[r.doc_id].lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_language_edge_cases(spark):
    train = [row(i, t, v) for i, (t, v) in enumerate(
        [("the cat and the dog", "en"), ("der hund und die katze", "de"), ("le chat et le chien", "fr"), ("el gato y el perro", "es")] * 6)]
    odd = [row(100, None), row(101, ""), row(102, "123 !? \n"), row(None, "the dog"), row(104, LONG, None), row(105, "the cat", None), row(105, "the cat", None), row(106, "漢字" * 9, None)]
    found = langid.identify(tiny(spark, train + odd)).collect()
    assert len(found) == len(train) + len(odd) and found[0].__fields__ == ["doc_id", "held_out", "lang_pred", "score"]
    by = {r.doc_id: r for r in found}
    assert [by[k].lang_pred for k in (100, 101, 102)] == ["und"] * 3 and by[100].score == 0
    assert by[104].lang_pred == "en" and by[105].lang_pred == "en" and by[106].lang_pred != "und"
    assert langid.identify(tiny(spark, [])).count() == 0
    assert {r.lang_pred for r in langid.identify(tiny(spark, [row(1, "some words", None)])).collect()} == {"und"}


def test_families_come_first():
    assert langid.family_of("de") == langid.family_of("en") != langid.family_of("fr") == langid.family_of("es")
    assert langid.family_of("pt-BR") == "romance" and langid.family_of("xx") == "xx"


# --- quality ----------------------------------------------------------------------------------


def brute_kneser_ney(model, texts):
    """log10 probabilities of all 4-grams that the texts hold, straight from the definitions."""
    codes = quality.code_table(model.common)
    counts = Counter()
    for t in texts:
        c = [0, 0, 0, *codes[[min(ord(x), 0xFFFF) for x in t]].tolist(), 0]
        counts.update(tuple(c[k:k + 4]) for k in range(len(c) - 3))
    levels = {4: counts}
    for n in (3, 2, 1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])

    def cut(n):
        m = Counter(levels[n].values())
        if not (m[1] and m[2] and m[3]):
            return [0, 0.5, 1.0, 1.5]
        y = m[1] / (m[1] + 2 * m[2])
        raw = [1 - 2 * y * m[2] / m[1], 2 - 3 * y * m[3] / m[2], 3 - 4 * y * m[4] / m[3]]
        return [0, *(min(max(d, 0.1 * (k + 1)), k + 0.95) for k, d in enumerate(raw))]

    cuts = {n: cut(n) for n in levels}
    contexts = {n: defaultdict(list) for n in levels}
    for n, found in levels.items():
        for g, c in found.items():
            contexts[n][g[:-1]].append(c)

    def p(g):
        n = len(g)
        if n == 0:
            return 1 / quality.CODES
        seen = contexts[n].get(g[:-1])
        if not seen:
            return p(g[1:])
        c, total = levels[n].get(g, 0), sum(seen)
        return max(c - cuts[n][min(c, 3)], 0) / total + sum(cuts[n][min(x, 3)] for x in seen) / total * p(g[1:])

    return p


def test_kneser_ney_equals_its_definition(spark):
    r = random.Random(0)
    texts = ["".join(r.choice("aaabbc dE.é") for _ in range(r.randint(1, 120))) for _ in range(60)]
    docs = tiny(spark, [row(i, t) for i, t in enumerate(texts)])
    model = quality.fit(docs, docs.select("doc_id"))
    codes, log_p = model.tables()
    p = brute_kneser_ney(model, texts)
    for g in itertools.chain(itertools.product(range(0, 13, 3), repeat=4), [(60, 60, 60, 60), (0, 0, 0, 1), (1, 60, 2, 1)]):
        index = ((g[0] * 64 + g[1]) * 64 + g[2]) * 64 + g[3]
        assert math.isclose(10 ** float(log_p[index]), p(g), rel_tol=1e-4)
    assert np.allclose((10.0 ** log_p.reshape(-1, 64).astype(float)).sum(axis=1), 1, atol=1e-4)
    scored = {r.doc_id: r for r in quality.score(docs, model, ["doc_id"]).collect()}
    c = [0, 0, 0, *codes[[ord(x) for x in texts[5]]].tolist(), 0]
    want = -sum(math.log10(p(tuple(c[k:k + 4]))) for k in range(len(c) - 3)) / (len(texts[5]) + 1)
    assert scored[5].n_symbols == len(texts[5]) + 1 and math.isclose(math.log10(scored[5].perplexity), want, rel_tol=1e-4)


@pytest.mark.parametrize("halves", [False, True])
def test_models_count_all_trusted_documents(spark, halves):
    n = 24_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.col("id").cast("string"), F.lit(" "), F.hex(F.col("id") * 7919)).alias("text"))
    if halves:
        models = quality.fit_halves(docs, docs.select("doc_id"))
        parts = [[r.text for r in docs.where(quality.fold_of(F.col("text")) == k).collect()] for k in range(quality.FOLDS)]
    else:
        models, parts = [quality.fit(docs, docs.select("doc_id"))], [[r.text for r in docs.collect()]]
    assert sum(map(len, parts)) == n
    for model, texts in zip(models, parts):
        _, log_p = model.tables()
        p = brute_kneser_ney(model, texts)
        for g in itertools.product(range(0, 12, 3), repeat=4):
            index = ((g[0] * 64 + g[1]) * 64 + g[2]) * 64 + g[3]
            assert math.isclose(10 ** float(log_p[index]), p(g), rel_tol=1e-5)


def test_quality_separates_labelled_documents(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    found = {r.doc_id: r.kept for r in quality.classify(docs, labels).collect()}
    marks = labels.collect()
    good = [found[r.doc_id] for r in marks if r.quality == 1 and r.toxic == 0]
    bad = [found[r.doc_id] for r in marks if r.quality == 0]
    assert len(found) == docs.count() and np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_quality_edge_cases(spark):
    rows = [row(i, f"plain words number {'abc'[i % 3]} here") for i in range(30)] + [row(40, None), row(41, ""), row(None, "plain words", None), row(42, "%%##!!@@" * 9), row(43, LONG), row(44, "plain words", "xx")]
    labels = spark.createDataFrame([(i, 1, None) for i in range(30)] + [(None, 1, 0), (42, 0, 0), (43, None, 0)] + [(1, 1, 0)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in quality.classify(tiny(spark, rows), labels).collect()}
    assert len(found) == 36 and not found[40].kept and not found[41].kept and found[40].perplexity is None
    assert found[3].kept and not found[42].kept and found[43].n_symbols == len(LONG) + 1
    unlabelled = labels.limit(0)
    assert {r.kept for r in quality.classify(tiny(spark, rows[:3]), unlabelled).collect()} == {True}
    assert quality.classify(tiny(spark, []), labels).count() == 0


def test_machines_solve_their_problem():
    """At the optimum of a support vector machine the primal and the dual value meet; the best of many random directions is worse."""
    g = np.random.default_rng(5)
    rows, dense = [], np.zeros((60, 40))
    for k in range(60):
        cells = np.sort(g.choice(40, 9, replace=False))
        values = g.random(9)
        rows.append((cells, values))
        dense[k, cells] = values
    y = np.where(dense @ g.standard_normal(40) + 0.3 * g.standard_normal(60) > 0, 1.0, -1.0)
    c = 2.0
    w = langid.linear_svm(rows, y, c, epochs=4000, dimensions=40).astype(np.float64)
    x = np.hstack([dense, np.ones((60, 1))])
    value = lambda v: 0.5 * v @ v + c * np.maximum(0, 1 - y * (x @ v)).sum()
    q = (x @ x.T) * np.outer(y, y)  # projected gradient ascent of the dual
    alpha = np.zeros(60)
    for _ in range(40_000):
        alpha = np.clip(alpha + (1 - q @ alpha) / np.linalg.norm(q, 2), 0, c)
    dual = alpha.sum() - 0.5 * alpha @ q @ alpha
    assert math.isclose(value(w), dual, rel_tol=2e-3) and np.allclose(w, x.T @ (alpha * y), atol=2e-2)
    assert all(value(w + 0.1 * g.standard_normal(41)) > value(w) for _ in range(200))


def test_votes_of_three_languages_are_those_of_their_machines():
    g = np.random.default_rng(6)
    rows = [(np.array([k % 3, 3 + k % 5]), np.array([0.9, 0.1 + 0.01 * k])) for k in range(30)]
    model = langid.OneVersusOne(rows, [("a", "b", "c")[k % 3] for k in range(30)])
    x = np.zeros((50, langid.DIMENSIONS), np.float32)
    x[:, :8] = g.random((50, 8))
    won, score = model.predict(x)
    for row, k, s in zip(x, won, score):
        votes, sums, trust = [0] * 3, [0.0] * 3, [0.0] * 3
        for (i, j), w in zip(model.pairs, model.weights):
            margin = float(row @ w[:-1] + w[-1])
            votes[i if margin >= 0 else j] += 1
            sums[i], sums[j] = sums[i] + margin, sums[j] - margin
            sure = 1 / (1 + math.exp(-4 * margin))
            trust[i], trust[j] = trust[i] + sure, trust[j] + 1 - sure
        assert k == max(range(3), key=lambda c: (votes[c], sums[c])) and math.isclose(s, trust[k] / 2, rel_tol=1e-5)


# --- hidden Markov model ----------------------------------------------------------------------


def toy(states=3, classes=5, seed=0):
    g = np.random.default_rng(seed)
    share = lambda *n: (lambda x: x / x.sum(axis=-1, keepdims=True))(g.random(n))
    return hmm.Model({}, np.ones(classes), np.ones(classes), share(states), share(states, states), share(states, classes).T)


def brute(model, seq):
    """Likelihood and expected counts over all paths."""
    total, start, move, emit = 0.0, np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for path in itertools.product(range(3), repeat=len(seq)):
        p = model.start[path[0]] * model.emit[seq[0], path[0]]
        for a, b, c in zip(path, path[1:], seq[1:]):
            p *= model.move[a, b] * model.emit[c, b]
        total += p
        start[path[0]] += p
        for a, b in zip(path, path[1:]):
            move[a, b] += p
        for c, a in zip(seq, path):
            emit[c, a] += p
    return total, start / total, move / total, emit / total


def test_forward_and_expected_counts_equal_sums_over_paths():
    model, g = toy(), np.random.default_rng(1)
    texts = [g.integers(0, 5, n) for n in (1, 4, 2, 6, 4)]
    found = hmm.Counts.none(5, 3)
    like = np.zeros(len(texts))
    for rows, flat, starts, sizes in hmm.batches_of(texts):
        like[rows] = hmm.forward(model, flat, starts, sizes)
        hmm.expect(model, flat, starts, sizes, found)
    want = [brute(model, t.tolist()) for t in texts]
    assert np.allclose(like, [math.log(w[0]) for w in want])
    assert np.allclose(found.start, sum(w[1] for w in want), atol=1e-5)
    assert np.allclose(found.move, sum(w[2] for w in want), atol=1e-5)
    assert np.allclose(found.emit, sum(w[3] for w in want), atol=1e-5)


def base_scores(rows):
    import zlib

    tokens = {i: [*(w for w in (t or "").encode().lower().split()), b"\n"] for i, t in rows}
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    c = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    n, v = sum(c.values()), len(c)
    return {i: (held[i], len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)) for i, t in tokens.items()}


def test_scores_of_documents(spark, monkeypatch):
    monkeypatch.setattr(hmm, "BLOCK_ROWS", 64)
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = {r.doc_id: r for r in hmm.language_model_scores(docs).collect()}
    want = base_scores(rows)
    for i, (held, n, known, train, base) in want.items():
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, train)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    held = [found[i] for i in want if want[i][0]]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_are_those_of_a_plain_forward_recursion(spark, monkeypatch):
    """Words, classes, counts and the recursion once more, token by token, without blocks or batches."""
    monkeypatch.setattr(hmm, "BLOCK_ROWS", 40)
    monkeypatch.setattr(hmm, "BLOCK_BYTES", 20_000)  # blocks are dealt out further
    docs = table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows, model = hmm.train(docs, states=3, rounds=1)
    found = {r.doc_id: r for r in hmm.score(rows, model, "doc_id").collect()}
    tokens = {i: [*(t or "").encode().lower().split(), b"\n"] for i, t in texts.items()}
    c = Counter(w for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 10 for w in t)
    top = sorted((w for w in c if w != b"\n"), key=lambda w: -c[w])
    assert len(model.own) == hmm.OWN_CLASSES and {xxhash.xxh64_intdigest(w) for w in top if c[w] > c[top[hmm.OWN_CLASSES - 1]]} <= set(model.own)
    ends = lambda w: 0 if w == b"\n" else model.own.get(xxhash.xxh64_intdigest(w)) or hmm.OWN_CLASSES + 1 + zlib.crc32(w[-3:]) % hmm.END_CLASSES
    mass, kinds = Counter(), Counter()
    for w, n in c.items():
        mass[ends(w)] += n
        kinds[ends(w)] += 1
    assert {k: (model.mass[k], model.kinds[k]) for k in mass} == {k: (mass[k], kinds[k]) for k in mass}
    for i, t in tokens.items():
        alpha, total = None, 0.0
        for w in t:
            k = ends(w)
            alpha = [(model.start[b] if alpha is None else sum(a * model.move[j][b] for j, a in enumerate(alpha))) * model.emit[k][b] for b in range(3)]
            total += math.log10(sum(alpha)) + (0 if k <= hmm.OWN_CLASSES else math.log10((c[w] + 0.1) / (mass[k] + 0.1 * (kinds[k] + 1))))
            alpha = [a / sum(alpha) for a in alpha]
        assert math.isclose(found[i].score, total, rel_tol=1e-9)
    assert np.allclose(model.emit.sum(axis=0), 1) and np.allclose(model.move.sum(axis=1), 1)


def test_scores_of_odd_rows(spark):
    rows = [(0, None), (1, ""), (2, "A\x0bb C d  É"), (None, "a b"), (4, LONG), (5, "a b"), (5, "a b"), (7, "unseen words")]
    found = hmm.language_model_scores(tiny(spark, [row(i, t) for i, t in rows])).collect()
    assert len(found) == 8 and all(np.isfinite(r.score) and r.score < 0 for r in found)
    by = {r.doc_id: r for r in found}
    assert (by[0].n_tokens, by[1].n_tokens, by[2].n_tokens) == (1, 1, 4) and by[4].n_tokens == len(LONG.split()) + 1
    assert hmm.language_model_scores(tiny(spark, [])).count() == 0


def test_word_and_class_probabilities_sum_to_one():
    model = hmm.Model({}, np.array([3.0, 10.0]), np.array([1.0, 4.0]))
    known = sum((c + 0.1) / (10 + 0.1 * 5) for c in (1, 2, 3, 4))
    assert math.isclose(known + 0.1 / (10 + 0.1 * 5), 1) and model.tokens == 13 and model.vocabulary == 5


# --- pages ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def field(spark):
    return htmltext.fit(table(spark, SF, "pages"))


def test_articles_of_the_given_pages(spark, field):
    import html
    import re

    pages = table(spark, SF, "pages")
    for r in htmltext.extract(pages, field).join(pages.select("page_id", "html"), "page_id").collect():
        body = r.html.split("<article>")[1].split("</article>")[0]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", body))
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in parts]
        assert r.text == "\n".join(x for x in want if x) and r.n_chars == len(r.text)


B = "This is the first real paragraph of the story, with words. It has more."


@pytest.mark.parametrize("source,want", [
    (f"<body><div role='navigation'><a href=x>Home</a> <a href=y>News</a></div><div class='content'><h1>Head</h1><p>{B}</p><p>Short.</p></div><ul class='comments'><li>Nice one indeed.</li></ul></body>", f"Head\n{B}\nShort."),
    (f"<body><header><h1>Site name</h1><nav><a>a</a></nav></header><article><h1>T</h1><div><p>{B}</p><div><p>Inner.</p></div></div><figure><img src=a><figcaption>A caption.</figcaption></figure>"
     f"<pre>code  here</pre><table><tr><td>1</td><td>two</td></tr></table><p class='notice'>Please note cookies</p></article><div id='disqus_thread'><p>I disagree with this.</p></div><footer>x</footer></body>",
     f"T\n{B}\nInner.\nA caption.\ncode here\n1\ntwo"),
    (f"<body><aside class='sidebar'><h3>Related</h3><p>{B}</p></aside><article><p>{B}</p></article><div class='related-posts'><h3>More</h3><p>Read this too, it is good.</p></div></body>", B),
    (f"<body><article><h1>T</h1><p>{B}</p><div class='comments'><h2>Comments</h2><article class='comment'><p>Comment text by a reader.</p></article></div></article></body>", f"T\n{B}"),
    (f"<p>{B}</p><p>{B}</p>", f"{B}\n{B}"),
    ("<body><header><a href='/'>Site</a></header><div class='sidebar'>side text</div><article><header><h1>Title</h1></header><p>Real &lt;text&gt; here.</p>"
     "<aside>Related things</aside><div class='ad'>Buy now</div><p>More&nbsp;&amp; more</p><section id='comments'><p>I like this article very much.</p></section></article><footer>foot</footer></body>",
     "Title\nReal <text> here.\nMore & more"),
    ("<body><div id='cookie-notice'><p>We use cookies.</p></div><nav>menu</nav><main><h1>T</h1><p>One</p><p>Two <b>bold</b> x\n y</p></main>"
     "<div class='comments'><div class='comment'><p>Great post, thanks for writing it.</p></div></div><form><label>Name</label><button>Send</button></form></body>", "T\nOne\nTwo bold x y"),
    ("<article><p>A word.<script>var x='</p>';</script><style>p{}</style><!-- no --><p>B word.<div class='newsletter'>Sign up</div></article>", "A word.\nB word."),
    (None, ""), ("", ""), ("<nav>only menus</nav>", ""), ("<article><p>cut off here <a href='x", "cut off here"),
])
def test_parts_that_are_no_article(field, source, want):
    assert htmltext.main_text(field, source) == want


def test_layouts_that_training_has_not_seen(spark, field):
    texts = [[b.text for b in blocks(r.html)] for r in table(spark, SF, "pages").select("html").limit(60).collect()]
    wrong = total = 0
    for k, t in enumerate(texts * 3):
        page, labels = htmltext.Layout(t, 10 ** 7 + k).page()
        got = field.decode(htmltext.features(page))
        wrong += sum(a != b for a, b in zip(got, labels))
        total += len(labels)
    assert wrong < 0.02 * total


def test_viterbi_is_the_best_path():
    f, r = htmltext.Field(), random.Random(0)
    f.moves = [[0.3, -0.7], [-0.2, 0.4]]
    for _ in range(50):
        f.weights = {f"f{k}": r.uniform(-2, 2) for k in range(7)}
        page = [[f"f{k}"] for k in range(r.randint(1, 7))]
        s = f.local(page)
        value = lambda path: sum(a for a, y in zip(s, path) if y) + sum(f.moves[a][b] for a, b in zip(path, path[1:]))
        assert math.isclose(value(f.decode(page)), max(value(p) for p in itertools.product((0, 1), repeat=len(page))))
        ones, moved = f.marginals(s)
        weight = {p: math.exp(value(p)) for p in itertools.product((0, 1), repeat=len(page))}
        total = sum(weight.values())
        assert np.allclose(ones, [sum(w for p, w in weight.items() if p[k]) / total for k in range(len(page))])
        assert math.isclose(moved.sum(), len(page) - 1, abs_tol=1e-9)


def test_page_tables(spark, field):
    rows = [(1, None, None, "x"), (None, "u", "<article><p>text of it</p></article>", "x"), (2, "u", "<p>" + "long words " * 50_000 + "</p>", "x"), (2, "u", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = htmltext.extract(pages, field)
    assert found.columns == ["page_id", "url", "text", "n_chars"] and found.count() == 4
    assert {r.text for r in found.where("page_id is null or page_id = 1").collect()} == {"", "text of it"}
    assert htmltext.main_texts(pages.limit(0)).count() == 0
