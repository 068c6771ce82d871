"""Hierarchical language identification: language family first, then the languages within it.

Both levels are one-versus-one linear support vector machines over hashed character n-grams, trained by
dual coordinate descent on a bounded, hash-chosen sample of labelled texts per language. Prediction is one
pass over whole texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from corpusloom.llm.common import id_bucket, ready, tidy

# Families of closely related languages; any other code is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "turkic": "az kk ky tr tt ug uz",
    "indic": "bn gu hi mr ne pa sd si ur",
    "uralic": "et fi hu",
    "semitic": "am ar he mt",
    "sinitic": "wuu yue zh",
}

DIMENSIONS = 1 << 14
SAMPLE_PER_LANGUAGE = 300  # bound of the training sample
UNKNOWN = "und"


def family_of(lang: str) -> str:
    base = lang.lower().replace("_", "-").split("-")[0]
    return next((f for f, codes in FAMILIES.items() if base in codes.split()), base)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Lower-case letter of every code point of the basic plane, 32 for what is no letter."""
    out = np.full(1 << 16, 32, np.uint32)
    for c in range(1 << 16):
        if chr(c).isalpha():
            out[c] = ord(chr(c).lower()[0])
    return out


def normalised(text: str) -> np.ndarray:
    """Code points with letters in lower case and a space for everything else, one space at either end."""
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    high = points >= 1 << 16
    out = letters()[np.where(high, 32, points)]
    if high.any():
        for c in np.unique(points[high]).tolist():
            if chr(c).isalpha():
                out[points == c] = ord(chr(c).lower()[0])
    return out


def features(text: str) -> np.ndarray | None:
    """Unit vector of square-rooted counts of hashed 1- to 3-grams; None if the text has no letter."""
    c = normalised(text)
    if not (c != 32).any():
        return None
    shift = np.uint32(32 - 14)
    a, b, d = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)
    one = c * a
    two = one[:-1] + c[1:] * b
    three = two[:-1] + c[2:] * d
    hashed = np.concatenate([
        (one[c != 32] * d) >> shift,
        (two[(c[:-1] != 32) | (c[1:] != 32)] * np.uint32(0x27D4EB2F)) >> shift,
        (three[c[1:-1] != 32] * np.uint32(0x165667B1)) >> shift,
    ])
    v = np.sqrt(np.bincount(hashed, minlength=DIMENSIONS).astype(np.float32))
    return v / np.linalg.norm(v)


Sparse = tuple[np.ndarray, np.ndarray]  # cells and values of one text's features


def linear_svm(rows: list[Sparse], y: np.ndarray, c: float = 10.0, epochs: int = 60, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Weights and bias of a hinge-loss machine by dual coordinate descent; y is +1 or -1.

    Only the weights are kept up to date: memory grows with the features of the rows, not with pairs of rows. The bias
    is the weight of a feature that every row has.
    """
    w = np.zeros(dimensions + 1)
    full = [(np.append(cells, dimensions), np.append(values, 1.0)) for cells, values in rows]
    norms = [float(v @ v) for _, v in full]
    alpha = [0.0] * len(full)
    order = np.random.default_rng(0)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(full)).tolist():
            cells, values = full[i]
            gradient = y[i] * (w[cells] @ values) - 1.0
            new = min(max(alpha[i] - gradient / norms[i], 0.0), c)
            step = new - alpha[i]
            if abs(step) > 1e-12:
                w[cells] += step * y[i] * values
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w.astype(np.float32)


class OneVersusOne:
    """Votes of pairwise machines; ties go to the larger sum of margins, then to the first class."""

    def __init__(self, rows: list[Sparse], y: list[str]):
        self.classes = sorted(set(y))
        self.pairs = list(combinations(range(len(self.classes)), 2))
        labels = np.array([self.classes.index(v) for v in y])
        weights = []
        for i, j in self.pairs:
            at = np.flatnonzero((labels == i) | (labels == j)).tolist()
            weights.append(linear_svm([rows[k] for k in at], np.where(labels[at] == i, 1.0, -1.0)))
        self.weights = np.array(weights, np.float32).reshape(len(self.pairs), DIMENSIONS + 1)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class numbers, and the mean over the winner's machines of the logistic margin."""
        n, k = len(x), len(self.classes)
        votes, sums, trust = np.zeros((n, k)), np.zeros((n, k)), np.zeros((n, k))
        margins = x @ self.weights[:, :-1].T + self.weights[:, -1]
        for m, (i, j) in zip(margins.T, self.pairs):
            sure = 1 / (1 + np.exp(-np.clip(4.0 * m.astype(np.float64), -500, 500)))
            votes[:, i] += m >= 0
            votes[:, j] += m < 0
            sums[:, i] += m
            sums[:, j] -= m
            trust[:, i] += sure
            trust[:, j] += 1 - sure
        won = np.lexsort((sums, votes), axis=1)[:, -1] if k > 1 else np.zeros(n, np.int64)
        score = trust[np.arange(n), won] / (k - 1) if k > 1 else np.ones(n)
        return won, score


class Hierarchy:
    """Families, then the languages of the family that won."""

    def __init__(self, rows: list[Sparse], langs: list[str]):
        families = [family_of(v) for v in langs]
        self.top = OneVersusOne(rows, families)
        self.within = {}
        for f in self.top.classes:
            at = [i for i, g in enumerate(families) if g == f]
            self.within[f] = OneVersusOne([rows[i] for i in at], [langs[i] for i in at])

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        family, score = self.top.predict(x)
        langs = np.empty(len(x), object)
        for k, name in enumerate(self.top.classes):
            rows = np.flatnonzero(family == k)
            if len(rows):
                inner = self.within[name]
                won, trust = inner.predict(x[rows])
                langs[rows] = np.array(inner.classes, object)[won]
                score[rows] *= trust
        return langs.tolist(), score


def training_sample(
    docs: DataFrame, trainable: Column, per_language: int, id_col: str, text_col: str, lang_col: str,
) -> DataFrame:
    """``(lang, text)`` of the ``per_language`` labelled rows of each language with the smallest id hashes.

    Ids alone are ranked (each task keeps its first rows of a language); texts are fetched for the chosen.
    """
    ids = docs.where(trainable & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"))
    order = Window.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id")
    chosen = ids.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= per_language).select("_id", "_lang").distinct()
    texts = docs.where(trainable).select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"))
    return texts.join(F.broadcast(chosen), ["_id", "_lang"]).select("_lang", "_text")


def fit(
    docs: DataFrame, trainable: Column | None = None, per_language: int = SAMPLE_PER_LANGUAGE,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> Hierarchy | None:
    """Train on at most about ``per_language`` texts of each language; None if no labelled text has a letter.

    Sparse features come from the tasks; the driver holds those of the bounded sample and one machine's weights.
    """
    spark = ready(docs)
    sample = training_sample(docs, F.lit(True) if trainable is None else trainable, per_language, id_col, text_col, lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, cells, values = [], [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                v = features(text) if text else None
                if v is not None:
                    at = np.flatnonzero(v)
                    langs.append(lang)
                    cells.append(at.astype("<u2").tobytes())
                    values.append(v[at].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(cells, pa.binary()), pa.array(values, pa.binary())], ["lang", "cells", "values"])

    rows = sorted(map(tuple, sample.mapInArrow(tidy(run), "lang string, cells binary, values binary").collect()))
    if not rows:
        return None
    sparse = [(np.frombuffer(cells, "<u2").astype(np.int64), np.frombuffer(values, "<f4").astype(np.float64)) for _, cells, values in rows]
    return Hierarchy(sparse, [r[0] for r in rows])


def predict(
    docs: DataFrame, model: Hierarchy | None, keep: list[str], text_col: str = "text",
) -> DataFrame:
    """Columns ``keep`` with ``lang_pred`` and ``score`` (0 to 1) for every row.

    Null, empty and letterless texts are ``und`` with score 0, and so is everything without a model.
    Whole texts count, however long; repeated rows each get a row; columns named ``lang_pred`` or ``score``
    in the input are replaced. An empty table gives an empty result.
    """
    spark = ready(docs)
    keep = [c for c in keep if c not in ("lang_pred", "score")]
    schema = StructType([*[docs.schema[c] for c in keep], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    text_at = keep.index(text_col) if text_col in keep else len(keep)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hierarchy = shared.value
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            rows, vectors = [], []

            def flush() -> None:
                if rows:
                    found, score = hierarchy.predict(np.array(vectors))
                    for i, lang in zip(rows, found):
                        langs[i] = lang
                    scores[rows] = score
                    rows.clear()
                    vectors.clear()

            for i, text in enumerate(texts if hierarchy else []):
                v = features(text) if text else None
                if v is not None:
                    rows.append(i)
                    vectors.append(v)
                if len(rows) == 256:
                    flush()
            flush()
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(keep))], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], schema.fieldNames())

    sent = [F.col(f"`{c}`") for c in keep] + ([] if text_col in keep else [F.col(text_col)])
    return docs.select(*sent).mapInArrow(tidy(run), schema)


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether crc32 of the id as text falls in the held-out fold; false for a null id."""
    return F.coalesce(id_bucket(F.col(id_col), folds) == fold, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``id, held_out, lang_pred, score`` of every row, by a model that never saw the held-out fold."""
    model = fit(docs, ~held_out(id_col), id_col=id_col, text_col=text_col, lang_col=lang_col)
    flagged = docs.select(id_col, F.col(text_col), held_out(id_col).alias("held_out"))
    return predict(flagged, model, [id_col, "held_out"], text_col)
