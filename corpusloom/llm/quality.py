"""Quality classifier: perplexity under an interpolated modified Kneser-Ney character model.

A model of order four is trained on each half of all trusted documents, and a text is scored by the half
that it does not belong to: no text is held against a model that saw it. Every character is a symbol of its own, but for digits, which
are all read as 0. N-gram counts are summed per n-gram, and discounts, back-off weights and probabilities come from joins of these count
tables on context and suffix, sharded by n-gram. Up to ``BROADCAST_GRAMS`` n-grams documents are scored against a broadcast copy
without moving their text; with more, blocks of documents ask the sharded tables for the n-grams that they hold.
The cuts on both sides are quantiles of the perplexities of *all* trusted documents, by language and length
class: short texts vary more, and repeated words lie close to normal, so one cut cannot serve all lengths.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache, cached_property, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from corpusloom.llm.common import ready, store, tidy
from corpusloom.llm.hmm import placed
from corpusloom.llm.limits import Limits, limits
from corpusloom.llm.pieces import chunks
from corpusloom.operators.joins import join_small

ORDER = 4
BITS = 21  # a symbol is a code point plus one; three of them make a context of 63 bits
SYMBOL = (1 << BITS) - 1
CODES = 64  # an alphabet counts as so many symbols at least
EDGE = 0  # before the first and after the last character of a text
POINTS = 0x110000  # code points there are
BROADCAST_GRAMS = 4_000_000  # models with more 4-grams are not gathered: documents ask the tables
BROADCAST_IDS = 1_000_000  # more trusted ids than that meet the documents in a shuffle
QUANTILE = 0.995  # share of trusted documents between the lower and the upper cut
LEAST_TRUSTED = 200  # a length class takes its neighbours along up to this number of trusted documents
FOLDS = 2
CHUNK_CHARS = 1_000_000


@cache
def plain() -> np.ndarray:
    """Every code point as the model reads it: itself, and 0 for decimal digits. What number stands in a text is no matter of its
    quality, and trusted texts with long numbers would pull the cuts apart."""
    out = np.arange(POINTS, dtype=np.int64)
    out[[c for c in range(POINTS) if chr(c).isdecimal()]] = ord("0")
    return out


def points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Plain code points of all texts in one array, and each text's length."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return plain()[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)], sizes


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context and symbol of the 4-gram that ends at every character and at every end of text; each text's number of them."""
    flat, sizes = points(texts)
    padded = sizes + ORDER  # three edges before, one after
    starts = np.cumsum(padded) - padded
    symbols = np.full(int(padded.sum()), EDGE, np.int64)
    keep = np.ones(len(symbols), bool)
    for k in range(ORDER - 1):
        keep[starts + k] = False
    keep[starts + padded - 1] = False
    symbols[keep] = flat + 1
    context = np.zeros_like(symbols)
    for k in range(1, ORDER):
        context[k:] |= symbols[:-k] << BITS * (k - 1)
    keep[starts + padded - 1] = True
    return context[keep], symbols[keep], sizes + 1


def distinct_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts and symbols of the distinct 4-grams of some texts; which of them stands at every place; each text's places."""
    context, symbol, sizes = grams(texts)
    number, contexts = pd.factorize(context)
    at, found = pd.factorize(number << BITS | symbol)
    return contexts[found >> BITS], found & SYMBOL, at, sizes


def shorter(context: Column | np.ndarray, n: int) -> Column | np.ndarray:
    """What an n-gram keeps of a longer context."""
    mask = (1 << BITS * (n - 1)) - 1
    return context.bitwiseAND(F.lit(mask).cast("long")) if isinstance(context, Column) else context & mask


def lookup(known: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``values`` in a sorted array, and which of them are there."""
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return at, known[at] == values


@dataclass
class Order:
    """N-grams of one length, sorted: contexts with their back-off weights; number of the context, symbol, and a value for each."""

    contexts: np.ndarray
    backoffs: np.ndarray
    grams: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, context: np.ndarray, symbol: np.ndarray, value: np.ndarray, backoff: np.ndarray) -> Order:
        by = np.lexsort((symbol, context))
        contexts, first, size = np.unique(context[by], return_index=True, return_counts=True)
        numbers = np.repeat(np.arange(len(contexts), dtype=np.int64), size)
        return cls(contexts, backoff[by][first], numbers << BITS | symbol[by], value[by])

    def find(self, context: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Place of the context, whether it is there; the same of the n-gram."""
        at, known = lookup(self.contexts, context)
        gram, seen = lookup(self.grams, at << BITS | symbol)
        return at, known, gram, seen & known


@dataclass
class Gathered:
    """Copy of a model's tables that fits a worker."""

    symbols: int
    orders: list[Order]

    def log_probability(self, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """log10 of the interpolated probability of 4-grams, seen or not."""
        p = np.full(len(context), 1 / self.symbols)
        for n, order in enumerate(self.orders, 1):
            at, known, gram, seen = order.find(shorter(context, n), symbol)
            p = np.where(seen, order.values[gram], np.where(known, order.backoffs[at], 1.0) * p)
        return np.log10(p)


@dataclass
class KneserNey:
    """Tables ``context, symbol, p, gamma`` of the seen n-grams by order: probability, and back-off weight of the context.

    ``symbols``: size of the alphabet, with the end and one symbol for what was never seen. ``rows``: number of 4-grams.
    """

    symbols: int
    orders: list[DataFrame]
    rows: int

    def gather(self) -> Gathered:
        out = []
        for table in self.orders:
            rows = table.select("context", "symbol", F.col("p").cast("float"), F.col("gamma").cast("float")).toPandas()
            out.append(Order.of(*(rows[c].to_numpy() for c in ("context", "symbol", "p", "gamma"))))
        return Gathered(self.symbols, out)

    @cached_property
    def gathered(self) -> Gathered:
        return self.gather()

    @property
    def common(self) -> list[int]:
        """Code points that the model has seen."""
        return [int(s) - 1 for s in self.gathered.orders[0].grams & SYMBOL if s != EDGE]

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """For an alphabet of up to ``CODES`` symbols: codes of characters, and log10 of the probability of every possible 4-gram."""
        if self.symbols > CODES:
            raise ValueError(f"{self.symbols} symbols, more than {CODES}")
        seen = [EDGE, *[c + 1 for c in self.common]]
        of = np.array([*seen, *range(POINTS + 1, POINTS + 1 + CODES - len(seen))], np.int64)
        out = np.empty((CODES, CODES ** (ORDER - 1)), np.float32)
        rest = np.arange(CODES ** (ORDER - 1))
        middle = of[rest // CODES ** 2] << BITS | of[rest // CODES % CODES]
        for k in range(CODES):
            out[k] = self.gathered.log_probability(of[k] << 2 * BITS | middle, of[rest % CODES])
        return code_table(self.common), out.ravel()

    def log_probability(self, asked: DataFrame) -> DataFrame:
        """``context, symbol, log_p`` of the 4-grams ``asked``, from joins with the tables."""
        found = asked.select("context", "symbol", F.lit(1 / self.symbols).alias("p"))
        for n, table in enumerate(self.orders, 1):
            seen = table.select(F.col("context").alias("short"), "symbol", F.col("p").alias("own"))
            weights = table.groupBy(F.col("context").alias("short")).agg(F.first("gamma").alias("gamma"))
            found = found.withColumn("short", shorter(F.col("context"), n)).join(seen, ["short", "symbol"], "left")
            found = join_small(found, weights, "short") if n < 3 else found.join(weights, "short", "left")
            p = F.coalesce("own", F.coalesce("gamma", F.lit(1.0)) * F.col("p"))
            found = store(found.select("context", "symbol", p.alias("p")), f"asked-{n}")
        return found.select("context", "symbol", F.log10("p").alias("log_p"))


def code_table(common: list[int]) -> np.ndarray:
    """Code of every code point: the place of its plain one in ``common``, counted from one; all others share the next."""
    table = np.full(POINTS, len(common) + 1, np.uint32)
    table[common] = np.arange(1, len(common) + 1)
    return table[plain()]


def _texts(column: pa.Array) -> Iterator[list[str]]:
    yield from chunks([t or "" for t in column.to_pylist()], CHUNK_CHARS)


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Discounts for counts one, two, and three or more, from the counts of counts."""
    n = counts.agg(*[F.count_if(F.col("c") == k).alias(f"n{k}") for k in range(1, 5)]).first()
    n1, n2, n3, n4 = (n[f"n{k}"] for k in range(1, 5))
    if not (n1 and n2 and n3):  # too few distinct counts to estimate from
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.1 * (k + 1)), k + 0.95) for k, d in enumerate(raw))


def fold_of(text: Column) -> Column:
    """Half of a text; equal texts share theirs."""
    return F.pmod(F.xxhash64(text), F.lit(FOLDS)).cast("int")


def trusted_texts(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_text`` of all trusted documents that have one. Up to ``BROADCAST_IDS`` ids are broadcast, more are joined by a shuffle."""
    ready(docs)
    ids = store(trusted.select(F.col(id_col).alias("_id")).where("_id is not null").distinct(), "trusted-ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where("_text <> ''")
    return store(texts.join(ids, "_id", "left_semi").select("_text"), "trusted-texts")


def fit(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> KneserNey | None:
    """Train on all trusted documents; None if they hold no text.

    ``trusted``: ids in column ``id_col``; repeated and null ids count once and not at all.
    """
    return train(trusted_texts(docs, trusted, id_col, text_col))


def fit_halves(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[KneserNey | None, ...]:
    """Models of the halves of all trusted documents, for ``score``; a half without text takes the other's model."""
    texts = trusted_texts(docs, trusted, id_col, text_col)
    models = [train(texts.where(fold_of(F.col("_text")) == k)) for k in range(FOLDS)]
    return tuple(m or next((x for x in models if x), None) for m in models)


def train(texts: DataFrame) -> KneserNey | None:
    """Model of the column ``_text``; None if there is no text."""

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in _texts(batch.column(0)):
                context, symbol, at, _ = distinct_grams(run)
                yield pa.RecordBatch.from_arrays([pa.array(context), pa.array(symbol), pa.array(np.bincount(at))], ["context", "symbol", "c"])

    gram = ["context", "symbol"]
    counted = texts.mapInArrow(tidy(count_grams), "context long, symbol long, c long").groupBy(*gram).agg(F.sum("c").alias("c"))
    counts = {ORDER: store(counted, "grams")}
    rows = counts[ORDER].count()
    if not rows:
        return None
    for n in range(ORDER - 1, 0, -1):  # continuation counts: distinct characters seen before
        counts[n] = counts[n + 1].groupBy(shorter(F.col("context"), n).alias("context"), "symbol").agg(F.count("*").alias("c"))
    symbols = max(CODES, counts[1].count() + 1)

    orders: list[DataFrame] = []
    for n in range(1, ORDER + 1):
        d1, d2, d3 = discounts(counts[n])
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        contexts = counts[n].groupBy("context").agg(F.sum("c").alias("total"), F.sum(cut).alias("mass"))
        joined = counts[n].join(contexts, "context")
        own = (F.col("c") - cut) / F.col("total")
        if n == 1:
            joined = joined.withColumn("below", F.lit(1.0 / symbols))
        else:
            joined = joined.withColumn("short", shorter(F.col("context"), n - 1)).join(
                orders[-1].select(F.col("context").alias("short"), "symbol", F.col("p").alias("below")), ["short", "symbol"])
        orders.append(store(joined.select(*gram, (own + F.col("mass") / F.col("total") * F.col("below")).alias("p"),
                                          (F.col("mass") / F.col("total")).alias("gamma")), f"kn-{n}"))
    return KneserNey(symbols, orders, rows)


def measured(texts: pa.Array, log_p: Callable[[np.ndarray, np.ndarray], np.ndarray] | None) -> list[pa.Array]:
    """Symbols (characters and one end) and perplexity of whole texts."""
    sizes = np.zeros(len(texts), np.int64)
    value = np.full(len(texts), np.nan)
    start = 0
    for run in _texts(texts):
        part = slice(start, start + len(run))
        sizes[part] = [len(t) + 1 for t in run]
        if log_p is not None:
            context, symbol, at, symbols = distinct_grams(run)
            total = np.add.reduceat(log_p(context, symbol)[at], np.cumsum(symbols) - symbols)
            value[part] = np.where(symbols > 1, 10.0 ** np.minimum(-total / symbols, 300), np.nan)
        start += len(run)
    return [pa.array(sizes), pa.array(value, mask=np.isnan(value))]


def score(
    docs: DataFrame, model: KneserNey | None | tuple[KneserNey | None, ...], keep: list[str], text_col: str = "text",
) -> DataFrame:
    """Columns ``keep`` with ``n_symbols`` (characters and one end) and ``perplexity`` of the whole text.

    With the models of both halves, a text is scored by the half that is not its own.
    Null and empty texts, and all texts without a model, have no perplexity (null). Repeated rows each get
    a row; input columns with the names of the new ones are replaced.
    """
    spark = ready(docs)
    if isinstance(model, tuple) and len(model) > 1:  # a pass for each half: a worker holds one copy
        halves = [score(docs.where(fold_of(F.col(text_col)) == k), model[(k + 1) % len(model)], keep, text_col) for k in range(len(model))]
        return reduce(DataFrame.unionByName, halves)
    model = model[0] if isinstance(model, tuple) else model
    keep = [c for c in keep if c not in ("n_symbols", "perplexity")]
    schema = StructType([*[docs.schema[c] for c in keep], StructField("n_symbols", LongType()), StructField("perplexity", DoubleType())])
    if model and model.rows > BROADCAST_GRAMS:
        return score_in_blocks(docs, model, keep, text_col, schema)
    text_at = keep.index(text_col) if text_col in keep else len(keep)
    shared = spark.sparkContext.broadcast(model and model.gather())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_p = shared.value and shared.value.log_probability
        for batch in batches:
            own = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*own, *measured(batch.column(text_at), log_p)], schema.fieldNames())

    sent = [F.col(f"`{c}`") for c in keep] + ([] if text_col in keep else [F.col(text_col)])
    return docs.select(*sent).mapInArrow(tidy(run), schema)


def score_in_blocks(docs: DataFrame, model: KneserNey, keep: list[str], text_col: str, schema: StructType) -> DataFrame:
    """``score`` without a copy of the model: blocks of documents, bounded by rows and bytes, ask the tables for their distinct 4-grams."""
    names = [f"_{k}" for k in range(len(keep))]
    rows = placed(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)], F.coalesce(F.col(text_col), F.lit("")).alias("_text")))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            for block in np.unique(blocks):
                for run in _texts(batch.column(1).filter(pa.array(blocks == block))):
                    context, symbol, *_ = distinct_grams(run)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(context), block)), pa.array(context), pa.array(symbol)], ["_block", "context", "symbol"])

    asked = store(rows.select("_block", "_text").mapInArrow(tidy(ask), "_block long, context long, symbol long").distinct(), "asked")
    answers = asked.join(model.log_probability(asked.select("context", "symbol").distinct()), ["context", "symbol"])

    def run(docs_of: pa.Table, answers_of: pa.Table) -> pa.Table:
        context, symbol, log_p = (answers_of[c].to_numpy() for c in ("context", "symbol", "log_p"))
        order = Order.of(context, symbol, log_p, log_p)
        texts = docs_of["_text"].combine_chunks()
        own = [docs_of[n].combine_chunks() for n in names]
        return pa.Table.from_arrays([*own, *measured(texts, lambda c, s: order.values[order.find(c, s)[2]])], schema.fieldNames())

    return rows.select("_block", *names, "_text").groupBy("_block").cogroup(answers.select("_block", "context", "symbol", "log_p").groupBy("_block")).applyInArrow(run, schema)


def cuts(scored: DataFrame, trusted: DataFrame, quantile: float = QUANTILE, id_col: str = "doc_id", lang_col: str = "lang") -> Limits:
    """Accepted logarithms of perplexity by language and length class, from all trusted documents.

    A share of ``1 - quantile`` of them lies outside, half on either side.
    """
    ids = trusted.select(F.col(id_col)).where(F.col(id_col).isNotNull()).distinct()
    good = scored.where("perplexity is not null").select(id_col, lang_col, "n_symbols", "perplexity").join(ids, id_col)
    outside = (1 - quantile) / 2
    return limits(good, F.log("perplexity"), F.col("n_symbols") - 1, F.col(lang_col), 500.0, outside, outside, LEAST_TRUSTED)


def accepted(found: Limits, lang_col: str = "lang") -> tuple[Column, Column, Column]:
    """``(low_cut, cut, kept)`` of scored rows; languages without a trusted document take the overall cuts.

    Without any trusted document every text is kept. Texts without characters are not.
    """
    low, high = (F.exp(found.column(F.col(lang_col), F.col("n_symbols") - 1, side)) for side in (0, 1))
    within = F.col("perplexity").between(low, high)
    return low, high, F.when(F.col("n_symbols") <= 1, False).otherwise(F.coalesce(within, F.lit(True)))


def trusted_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Ids of documents labelled good and not toxic; rows with a null label are not trusted."""
    return labels.where("quality = 1 and coalesce(toxic, 0) = 0").select(id_col)


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, keep: list[str] | None = None,
             id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``keep`` columns (id and language unless given) with ``n_symbols, perplexity, cut, kept, low_cut``."""
    trusted = trusted_ids(labels, id_col)
    models = fit_halves(docs, trusted, id_col=id_col, text_col=text_col)
    scored = store(score(docs, models, keep or [id_col, lang_col], text_col), "scored")
    low, cut, kept = accepted(cuts(scored, trusted, quantile, id_col, lang_col), lang_col)
    return scored.withColumn("cut", cut).withColumn("kept", kept).withColumn("low_cut", low)
