"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

Features are a block's ancestors (tags, and words of their names) and simple measures of its text. The
field is trained on labelled pages: a bounded sample of the given ones, labelled by their semantic markup,
and the same texts set in layouts whose labels are known because they were laid out so. Viterbi decoding
gives each page's best sequence of main and other blocks.
"""

from __future__ import annotations

import html
import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from corpusloom.llm.common import hash_sample, ready
from corpusloom.llm.htmlblocks import Block, blocks

SAMPLE_PAGES = 120  # bound of the training sample
LAYOUTS = 8  # layouts that each sampled page's text is set in
EPOCHS, RATE, DECAY = 10, 0.3, 1e-4

SECTIONS = frozenset("article aside blockquote body div figure footer form header main menu nav section table td ul ol".split())


def length_bin(n: int) -> int:
    return min(8, int(math.log2(n + 1)))


def features(page: list[Block]) -> list[list[str]]:
    """Names of the features that hold for each block of a page."""
    out = []
    for k, b in enumerate(page):
        found = {"bias", f"parent:{b.tags[-1] if b.tags else ''}"}
        outer: list[str] = []
        for tag, words in zip(b.tags, b.names):
            found.add(f"in:{tag}")
            found.update(f"name:{w}" for w in words)
            if tag in SECTIONS:
                found.update(f"path:{o}>{tag}" for o in outer[-2:])
                outer.append(tag)
        share = b.link_chars / len(b.text)
        found.add(f"links:{0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.9 else 3}")
        found.add(f"length:{length_bin(len(b.text.split()))}")
        found.add(f"stop:{b.text[-1] in '.!?…。'}")
        found.add(f"place:{'first' if k == 0 else 'last' if k == len(page) - 1 else 'inner'}")
        out.append(sorted(found))
    return out


class Field:
    """Two labels (1: main text); scores of label 1 per feature, and of transitions."""

    def __init__(self) -> None:
        self.weights: dict[str, float] = {}
        self.moves = [[0.0, 0.0], [0.0, 0.0]]

    def local(self, page: list[list[str]]) -> list[float]:
        w = self.weights
        return [sum(w.get(f, 0.0) for f in found) for found in page]

    def decode(self, page: list[list[str]]) -> list[int]:
        """Viterbi."""
        scores = self.local(page)
        if not scores:
            return []
        m = self.moves
        zero, one = 0.0, scores[0]
        back = []
        for s in scores[1:]:
            from_zero = (0 if zero + m[0][0] >= one + m[1][0] else 1, 0 if zero + m[0][1] > one + m[1][1] else 1)
            back.append(from_zero)
            zero, one = (max(zero + m[0][0], one + m[1][0]), max(zero + m[0][1], one + m[1][1]) + s)
        label = int(one > zero)
        path = [label]
        for choice in reversed(back):
            label = choice[label]
            path.append(label)
        return path[::-1]

    def marginals(self, scores: list[float]) -> tuple[list[float], np.ndarray]:
        """Probability of label 1 per block, and expected transitions, by scaled forward and backward sums."""
        move = np.exp(self.moves)
        local = [(1.0, math.exp(max(-30.0, min(30.0, s)))) for s in scores]
        forward = []
        a = local[0]
        for k, e in enumerate(local):
            if k:
                a = ((a[0] * move[0][0] + a[1] * move[1][0]) * e[0], (a[0] * move[0][1] + a[1] * move[1][1]) * e[1])
            total = a[0] + a[1]
            a = (a[0] / total, a[1] / total)
            forward.append(a)
        ones, moved = [0.0] * len(local), np.zeros((2, 2))
        b = (1.0, 1.0)
        for k in range(len(local) - 1, -1, -1):
            p = (forward[k][0] * b[0], forward[k][1] * b[1])
            ones[k] = p[1] / (p[0] + p[1])
            if k:
                e = (local[k][0] * b[0], local[k][1] * b[1])
                joint = np.array([[forward[k - 1][i] * move[i][j] * e[j] for j in (0, 1)] for i in (0, 1)])
                moved += joint / joint.sum()
                b = (move[0][0] * e[0] + move[0][1] * e[1], move[1][0] * e[0] + move[1][1] * e[1])
                top = max(b)
                b = (b[0] / top, b[1] / top)
        return ones, moved

    def train(self, pages: list[tuple[list[list[str]], list[int]]], epochs: int = EPOCHS) -> None:
        """Adaptive stochastic gradient ascent of the conditional log-likelihood with weight decay."""
        order = random.Random(5)
        square: dict[str, float] = {}
        move_square = np.full((2, 2), 1e-6)
        moves = np.zeros((2, 2))
        for _ in range(epochs):
            order.shuffle(pages)
            for found, labels in pages:
                if not labels:
                    continue
                ones, moved = self.marginals(self.local(found))
                gradient: dict[str, float] = {}
                for names, y, p in zip(found, labels, ones):
                    if abs(y - p) > 1e-4:
                        for f in names:
                            gradient[f] = gradient.get(f, 0.0) + y - p
                for f, g in gradient.items():
                    g -= DECAY * self.weights.get(f, 0.0)
                    square[f] = square.get(f, 1e-6) + g * g
                    self.weights[f] = self.weights.get(f, 0.0) + RATE * g / math.sqrt(square[f])
                seen = np.zeros((2, 2))
                for i, j in zip(labels, labels[1:]):
                    seen[i, j] += 1
                g = seen - moved - DECAY * moves
                move_square += g * g
                moves += RATE * g / np.sqrt(move_square)
                self.moves = np.clip(moves, -3, 3).tolist()


# Names by which sites mark the parts of a page.
MAIN_NAMES = "article content post entry story main body text page title headline".split()
OTHER_NAMES = {
    "nav": "nav navigation menu navbar breadcrumb breadcrumbs topbar links pagination pager toc".split(),
    "header": "header masthead banner logo branding top site".split(),
    "footer": "footer bottom copyright legal colophon".split(),
    "aside": "sidebar side aside widget related recommended popular trending more rail".split(),
    "ad": "ad ads advert advertisement adsense sponsored sponsor promo promotion commercial".split(),
    "notice": "notice cookie cookies consent gdpr alert warning popup modal overlay newsletter subscribe signup paywall message".split(),
    "comments": "comments comment reply replies discussion respond responses disqus reader feedback thread".split(),
    "form": "form search login register contact".split(),
    "share": "share social sharing tools meta tags".split(),
}
OTHER_TAGS = {
    "nav": "nav div ul", "header": "header div", "footer": "footer div", "aside": "aside div section", "ad": "div aside section ins p", "notice": "div section p p aside dialog",
    "comments": "section div ol ul aside", "form": "form", "share": "div ul",
}


def semantic_label(b: Block) -> int | None:
    """Label that a page's own markup gives: inside an article or main element and in no part that is
    something else; None where the page has no such markup."""
    if any(t in ("nav", "aside", "footer", "form", "button", "select", "textarea", "menu", "dialog") for t in b.tags):
        return 0
    if any(w in words for named in b.names for words in OTHER_NAMES.values() for w in named):
        return 0
    return 1 if "article" in b.tags or "main" in b.tags else None


class Layout:
    """Sets given texts in a random page; every text gets the label of the part that it is put in."""

    def __init__(self, texts: list[str], seed: int):
        self.r = random.Random(seed)
        self.texts = [t for t in texts if t] or ["Words of a page that has none."]
        self.words = [w for t in self.texts for w in t.split()][:5000]
        self.parts: list[str] = []
        self.labels: dict[str, int] = {}

    def mark(self, text: str, label: int) -> str:
        """The text with a serial word in front, by which its block is known again."""
        key = f"q{len(self.labels)}q"
        self.labels[key] = label
        return html.escape(f"{key} {text}", quote=False)

    def some(self, low: int, high: int) -> str:
        return " ".join(self.r.choice(self.words) for _ in range(self.r.randint(low, high)))

    def attributes(self, kind: str | None) -> str:
        names = OTHER_NAMES[kind] if kind else MAIN_NAMES
        if self.r.random() < 0.1:
            return ""
        name = self.r.choice(names)
        if self.r.random() < 0.4:
            name += self.r.choice("-_ ") + self.r.choice(["box", "wrap", "list", "inner", "area", "block", "item", *names])
        return f' {self.r.choice(["class", "class", "id"])}="{name}"'

    def other(self, kind: str) -> str:
        r = self.r
        tag = r.choice(OTHER_TAGS[kind].split())
        plain = tag == "div" or tag in ("p", "section", "ul", "ol", "ins")
        # a bare div says nothing: parts without a telling tag always get a name
        attributes = ""
        while plain and not attributes or r.random() < 0.3 and not attributes:
            attributes = self.attributes(kind)
        if kind in ("nav", "share") or kind in ("aside", "footer", "header") and r.random() < 0.5:
            items = "".join(f'<li><a href="/{k}">{self.mark(self.some(1, 4), 0)}</a></li>' for k in range(r.randint(2, 7)))
            inner = items if tag in ("ul", "ol") else f"<ul>{items}</ul>" if r.random() < 0.7 else items.replace("<li>", "<div>").replace("</li>", "</div>")
        elif kind == "comments":
            inner = "".join(f"<div{self.attributes('comments')}><p>{self.mark(self.prose(), 0)}</p></div>" if r.random() < 0.6 else
                            f"<{'li' if tag in ('ol', 'ul') else 'p'}>{self.mark(self.prose(), 0)}</{'li' if tag in ('ol', 'ul') else 'p'}>" for _ in range(r.randint(1, 4)))
            if r.random() < 0.5:
                inner = self.heading(1, 3) + inner
            if r.random() < 0.2:
                inner = f"<article{self.attributes('comments')}><p>{self.mark(self.prose(), 0)}</p></article>{inner}"
        elif kind == "form":
            inner = f'<label>{self.mark(self.some(1, 3), 0)}</label><input name="q"><button>{self.mark(self.some(1, 2), 0)}</button>'
            if r.random() < 0.3:
                inner += f"<select><option>{self.mark(self.some(1, 2), 0)}</option><option>{self.mark(self.some(1, 2), 0)}</option></select>"
            if r.random() < 0.2:
                inner += f"<textarea>{self.mark(self.some(1, 5), 0)}</textarea>"
        elif tag == "p":
            inner = self.mark(self.some(3, 25), 0)
        else:
            body = self.mark(self.prose() if r.random() < 0.4 else self.some(2, 20), 0)
            inner = body if r.random() < 0.5 else f"<p>{body}</p>"
            if r.random() < 0.25:
                inner = self.heading(1, 4) + inner
        if kind == "header" and r.random() < 0.3:
            inner = f"<h1>{self.mark(self.some(1, 4), 0)}</h1>{inner}"
        return f"<{tag}{attributes}>{inner}</{tag}>"

    def heading(self, low: int, high: int) -> str:
        """A heading of a part that is not the article."""
        tag = self.r.choice(["h2", "h3", "h4"])
        return f"<{tag}>{self.mark(self.some(low, high), 0)}</{tag}>"

    def prose(self) -> str:
        return self.r.choice(self.texts)

    def main(self) -> str:
        r = self.r
        tag = r.choice(["article", "article", "article", "main", "div", "section", "", ""])
        attributes = ""
        while tag in ("div", "section") and not attributes:
            attributes = self.attributes(None)
        title = f"<h1>{self.mark(self.some(3, 12), 1)}</h1>"
        inner = [f"<header>{title}</header>" if r.random() < 0.3 and tag else title if r.random() < 0.8 else ""]
        for _ in range(r.randint(1, 10)):
            x = r.random()
            if x < 0.50:
                inner.append(f"<p>{self.mark(self.prose() if r.random() < 0.8 else self.some(1, 8), 1)}</p>")
            elif x < 0.56:
                inner.append(f"<div{self.attributes(None) if not tag or r.random() < 0.6 else ''}>{self.mark(self.prose(), 1)}</div>")
            elif x < 0.62:
                inner.append(f"<figure><img src='i'><figcaption>{self.mark(self.some(2, 10), 1)}</figcaption></figure><pre>{self.mark(self.some(2, 10), 1)}</pre>")
            elif x < 0.68:
                inner.append(f"<h2>{self.mark(self.some(1, 8), 1)}</h2>")
            elif x < 0.74:
                inner.append(f"<ul><li>{self.mark(self.some(2, 15), 1)}</li><li>{self.mark(self.some(2, 15), 1)}</li></ul>")
            elif x < 0.78:
                inner.append(f"<blockquote>{self.mark(self.prose(), 1)}</blockquote>")
            elif x < 0.81:
                inner.append(f"<table><tr><td>{self.mark(self.some(1, 5), 1)}</td><td>{self.mark(self.some(1, 5), 1)}</td></tr></table>")
            elif x < 0.84:
                inner.append(f"<p><a href='/x'>{self.mark(self.some(3, 10), 1)}</a> {html.escape(self.some(5, 20))}</p>")
            else:
                inner.append(self.other(r.choice(["ad", "aside", "share", "comments", "form", "notice", "nav"])))
        body = "".join(inner)
        if r.random() < 0.3:
            body = f"<div{self.attributes(None)}>{body}</div>"
        if r.random() < 0.15:
            body += self.other("comments")
        return f"<{tag}{attributes}>{body}</{tag}>" if tag else body

    def page(self) -> tuple[list[Block], list[int]]:
        r = self.r
        often = r.choice([0.0, 0.3, 0.5, 0.7])
        before = [self.other(k) for k in ("header", "nav", "notice", "ad", "form") if r.random() < often]
        after = [self.other(k) for k in ("aside", "comments", "ad", "nav", "form", "notice", "footer") if r.random() < often]
        body = "".join([*before, self.main(), *after])
        if r.random() < 0.4:
            body = f'<div class="{r.choice(["wrapper", "container", "page", "layout"])}">{body}</div>'
        found = blocks(f"<html><body>{body}</body></html>")
        labels = [self.labels[b.text.split(" ", 1)[0]] for b in found]
        for b in found:
            b.text = b.text.split(" ", 1)[1]
        return found, labels


def train(sample: list[str | None], layouts: int = LAYOUTS, epochs: int = EPOCHS) -> Field:
    """A field from sampled pages (with the labels of their markup) and their texts in random layouts."""
    lessons = []
    for k, source in enumerate(sample or [None]):
        page = blocks(source)
        marked = [semantic_label(b) for b in page]
        if 1 in marked:
            lessons.append((features(page), [m or 0 for m in marked]))
        for n in range(layouts):
            found, labels = Layout([b.text for b in page], 1000 * k + n).page()
            lessons.append((features(found), labels))
    field = Field()
    field.train(lessons, epochs)
    return field


def main_text(field: Field, source: str | None) -> str:
    """Main blocks in page order, joined by line ends."""
    page = blocks(source)
    return "\n".join(b.text for b, label in zip(page, field.decode(features(page))) if label)


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES, id_col: str = "page_id", html_col: str = "html") -> Field:
    """Train on about ``sample`` pages, chosen by hash; without pages, on layouts of stock text."""
    ready(pages)
    rows = pages.select(F.col(id_col).alias("_id"), F.col(html_col).alias("_html")).where("_html is not null")
    return train(sorted(r["_html"] for r in hash_sample(rows, sample, "_id", "_html").collect()))


def extract(pages: DataFrame, field: Field, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id, url, text, n_chars`` of every row; null and empty pages, and pages without main text, have an empty text.

    Whole pages are read, however long or broken; repeated rows and null ids are kept; other columns are
    left out, whatever their names. An empty table gives an empty result.
    """
    spark = ready(pages)
    shared = spark.sparkContext.broadcast(field)
    schema = StructType([pages.schema[id_col], pages.schema[url_col], StructField("text", StringType()), StructField("n_chars", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for batch in batches:
            texts = [main_text(f, source) for source in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema.fieldNames())

    return pages.select(id_col, url_col, html_col).mapInArrow(run, schema)


def main_texts(pages: DataFrame) -> DataFrame:
    """Fit on a bounded sample of the pages, then extract all of them."""
    return extract(pages, fit(pages))
