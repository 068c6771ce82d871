"""Language-model scoring with a hidden Markov model over the words of a text.

A word is emitted in two steps: the state emits the word's class, the class emits the word. Frequent words
are classes of their own, the others share classes by their endings, so the emission table is of fixed
size while word counts cover the whole corpus. Baum-Welch counts are summed over all partitions; the scaled
forward recursion then gives the exact likelihood of every text.

Word counts stay distributed. Each block of input rows asks for the counts of its distinct words; the
answers return to the block, which then turns its texts into classes once. No vocabulary is broadcast or
collected. Baum-Welch and the scores read the stored classes.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, LongType, StructField, StructType

from corpusloom.llm.common import give_back, id_bucket, ready, store, tidy, with_position
from corpusloom.operators.joins import join_small

STATES = 8
OWN_CLASSES = 2048  # most frequent words
END_CLASSES = 2048  # shared by ending
END = b"\n"  # the end token; no word contains white space
PRIOR = 0.1  # additive smoothing of word counts
WARM_DOCUMENTS, WARM_ROUNDS = 1500, 12  # bounded sample that places the states before the full passes
FULL_ROUNDS = 2
BLOCK_ROWS, BLOCK_BYTES = 4096, 16 << 20
BATCH_TOKENS = 500_000


def words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lowered; bytes.lower and bytes.split are exactly ASCII."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def ending_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % END_CLASSES


@dataclass
class Model:
    """``own``: word hash to class; ``mass``: training tokens and ``kinds``: distinct words of a class."""

    own: dict[int, int]
    mass: np.ndarray
    kinds: np.ndarray
    start: np.ndarray = field(default_factory=lambda: np.zeros(0))
    move: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    emit: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # class x state

    @property
    def tokens(self) -> int:
        return int(self.mass.sum())

    @property
    def vocabulary(self) -> int:
        return int(self.kinds.sum())


def by_time(sizes: np.ndarray) -> np.ndarray:
    """Number of sequences still running at each step; sizes in descending order."""
    return np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")


def forward(model: Model, classes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Natural log likelihood of each class sequence (sizes descending), by scaled forward steps."""
    log_like = np.zeros(len(sizes))
    alpha, ones = None, np.ones(len(model.start))
    for t, n in enumerate(by_time(sizes).tolist()):
        alpha = (model.start if t == 0 else alpha[:n] @ model.move) * model.emit.take(classes[starts[:n] + t], axis=0)
        s = alpha @ ones
        alpha /= s[:, None]
        log_like[:n] += np.log(s)
    return log_like


def class_numbers(model: Model, names: list[bytes], hashes: np.ndarray) -> np.ndarray:
    """Class of each distinct word: 0 for the end, then own classes, then classes by ending."""
    own = model.own.get
    return np.fromiter((0 if w == END else own(h) or 1 + OWN_CLASSES + ending_class(w) for w, h in zip(names, hashes.view(np.uint64).tolist())),
                       np.int64, len(names))


@dataclass
class Counts:
    """Expected counts of Baum-Welch."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def none(cls, n_classes: int, n_states: int) -> Counts:
        return cls(np.zeros(n_states), np.zeros((n_states, n_states)), np.zeros((n_classes, n_states)))


def expect(model: Model, classes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, into: Counts) -> None:
    """Add the expected counts of the sequences (sizes descending).

    Tokens are laid out step by step, all sequences of a step together, in single precision; sums are in double.
    """
    running = by_time(sizes)
    step = np.arange(len(classes)) - np.repeat(starts, sizes)
    seen = classes[np.argsort(step.astype(np.uint16) if len(running) < 1 << 16 else step, kind="stable")]
    emitted = model.emit.astype(np.float32).take(seen, axis=0)
    move, start = model.move.astype(np.float32), model.start.astype(np.float32)
    alphas, scales = np.empty_like(emitted), np.empty(len(seen), np.float32)
    ends = np.cumsum(running).tolist()
    begins = [0, *ends[:-1]]
    alpha, ones = None, np.ones(len(start), np.float32)
    for t, (a, b) in enumerate(zip(begins, ends)):
        alpha = np.multiply(start if t == 0 else alpha[: b - a] @ move, emitted[a:b], out=alphas[a:b])
        np.dot(alpha, ones, out=scales[a:b])
        alpha /= scales[a:b, None]
    emitted /= scales[:, None]
    moved = np.zeros_like(into.move)
    beta = None
    for t in range(len(ends) - 1, -1, -1):
        a, b = begins[t], ends[t]
        alpha = alphas[a:b]
        if beta is not None:
            n = len(beta)
            after = np.multiply(emitted[b:b + n], beta, out=emitted[b:b + n])
            moved += alpha[:n].T @ after
            here = np.ones_like(alpha)
            np.matmul(after, move.T, out=here[:n])
            beta = here
        else:
            beta = np.ones_like(alpha)
        alpha *= beta  # now the probabilities of the states
    into.move += model.move * moved
    into.start += alphas[: ends[0]].sum(axis=0, dtype=np.float64)
    for k in range(alphas.shape[1]):
        into.emit[:, k] += np.bincount(seen, weights=alphas[:, k], minlength=len(into.emit))


def batches_of(texts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Sequences by falling length in batches of about BATCH_TOKENS: row numbers, flat, starts, sizes."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    order = np.argsort(-sizes, kind="stable")
    group = np.cumsum(sizes[order]) // BATCH_TOKENS
    for rows in np.split(order, np.flatnonzero(np.diff(group)) + 1):
        if len(rows):
            s = sizes[rows]
            yield rows, np.concatenate([texts[i] for i in rows]), np.cumsum(s) - s, s


def gathered(sequences: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Runs of sequences, long enough that those of like length can be worked on together."""
    run: list[np.ndarray] = []
    tokens = 0
    for x in sequences:
        run.append(x)
        tokens += len(x)
        if tokens >= 8 * BATCH_TOKENS:
            yield run
            run, tokens = [], 0
    if run:
        yield run


def maximise(model: Model, counts: Counts) -> None:
    """New probabilities, with priors that keep every class possible in every state."""
    overall = (model.mass + PRIOR) / (model.mass + PRIOR).sum()
    model.start = (counts.start + 1) / (counts.start + 1).sum()
    model.move = (counts.move + 0.1) / (counts.move + 0.1).sum(axis=1, keepdims=True)
    emit = counts.emit + 20 * overall[:, None]
    model.emit = emit / emit.sum(axis=0)


def placed(docs: DataFrame) -> DataFrame:
    """Rows with ``_block``: file and run of BLOCK_ROWS rows, the same whenever the files are read. A run with more than
    BLOCK_BYTES of text is dealt out to several blocks."""
    rows = with_position(docs).withColumn("_run", F.xxhash64("_file", F.floor(F.col("_row") / BLOCK_ROWS)))
    heavy = rows.groupBy("_run").agg(F.ceil(F.sum(F.octet_length("_text")) / BLOCK_BYTES).cast("long").alias("_parts")).where("_parts > 1")
    return join_small(rows, heavy, "_run").withColumn(
        "_block", F.when(F.col("_parts").isNull(), F.col("_run")).otherwise(F.xxhash64("_run", F.col("_row") % F.col("_parts")))).drop("_run", "_parts")


def hashes_of(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found)).view(np.int64)


def word_counts(docs: DataFrame) -> DataFrame:
    """``_block, word, c, first, ending``: counts over all training texts of each block's distinct words.

    ``first`` marks one block of each word, so that sums over it count every word once. A word has one row for
    each block that holds it, a small share of all rows however frequent it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, Counter] = {}

        def flush(block: int) -> pa.RecordBatch:
            found = blocks.pop(block)
            names = list(found)
            endings = np.fromiter((-1 if w == END else ending_class(w) for w in names), np.int32, len(names))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(names), block)), pa.array(hashes_of(names)), pa.array(endings), pa.array(list(found.values()), pa.int64())],
                ["_block", "word", "ending", "n"])

        for batch in batches:
            rows: dict[int, tuple[list, list]] = defaultdict(lambda: ([], []))
            for block, train, text in zip(*(c.to_pylist() for c in batch.columns)):
                rows[block][0 if train else 1].append(text)
            for block, (train, held) in rows.items():
                found = blocks.setdefault(block, Counter())
                found.update(chain.from_iterable(map(words, train)))
                found[END] += len(train)
                for w in set(chain.from_iterable(map(words, held))).difference(found):
                    found[w] = 0
            for block in list(blocks):
                if len(blocks) > 1 and block not in rows:
                    yield flush(block)
        for block in list(blocks):
            yield flush(block)

    rows = docs.select("_block", "_train", "_text").mapInArrow(tidy(run), "_block long, word long, ending int, n long")
    every = Window.partitionBy("word")
    return rows.select("_block", "word", "ending", F.sum("n").over(every).alias("c"),
                       (F.row_number().over(every.orderBy("_block")) == 1).alias("first"))


def classes_of(counts: DataFrame) -> Model:
    """The classes and their totals; the most frequent words are classes of their own."""
    spark = counts.sparkSession
    known = counts.where("first and c > 0")
    top = known.where("ending >= 0").orderBy(F.desc("c"), "word").limit(OWN_CLASSES).select("word", "c").collect()
    own = spark.createDataFrame([(r.word, i + 1) for i, r in enumerate(top)], "word long, own int")
    per_class = known.join(F.broadcast(own), "word", "left").groupBy(
        F.coalesce("own", F.when(F.col("ending") < 0, 0).otherwise(F.col("ending") + 1 + OWN_CLASSES)).alias("class"),
    ).agg(F.sum("c").alias("mass"), F.count("*").alias("kinds")).collect()
    n_classes = 1 + OWN_CLASSES + END_CLASSES
    model = Model({r.word % (1 << 64): i + 1 for i, r in enumerate(top)}, np.zeros(n_classes), np.zeros(n_classes))
    for r in per_class:
        model.mass[r["class"]], model.kinds[r["class"]] = r["mass"], r["kinds"]
    return model


def encoded(docs: DataFrame, counts: DataFrame, model: Model, id_col: str) -> DataFrame:
    """Every row's ``classes`` (16 bits a token) and all of its figures that do not depend on the states:
    ``n_tokens, n_known, base_score`` and ``inner``, the log10 probability of the words given their classes."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([
        docs.schema[id_col], StructField("_train", BooleanType()), StructField("_key", LongType()), StructField("n_tokens", LongType()),
        StructField("n_known", LongType()), StructField("base_score", DoubleType()), StructField("inner", DoubleType()), StructField("classes", BinaryType()),
    ])

    def run(docs_of: pa.Table, counts_of: pa.Table) -> pa.Table:
        m = shared.value
        number: dict[bytes, int] = defaultdict(count().__next__)
        texts = []
        for text in docs_of["_text"].to_pylist():
            tokens = words(text)
            tokens.append(END)
            texts.append(np.fromiter(map(number.__getitem__, tokens), np.int32, len(tokens)))
        names = list(number)
        number.clear()
        known = counts_of["word"].to_numpy()
        order = np.argsort(known)
        hashes = hashes_of(names)
        at = np.minimum(np.searchsorted(known, hashes, sorter=order), max(len(known) - 1, 0))
        c = np.zeros(len(names))
        if len(known):
            c = np.where(known[order[at]] == hashes, counts_of["c"].to_numpy()[order[at]], 0).astype(np.float64)
        classes = class_numbers(m, names, hashes)
        names.clear()
        base = np.log10((c + PRIOR) / (m.tokens + PRIOR * (m.vocabulary + 1)))
        # a class of one word emits nothing else; a shared class keeps room for one unknown word
        inner = np.where(classes <= OWN_CLASSES, 0.0, np.log10((c + PRIOR) / (m.mass[classes] + PRIOR * (m.kinds[classes] + 1))))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        flat, starts = np.concatenate(texts), np.cumsum(sizes) - sizes
        texts.clear()
        wide = classes.astype("<u2")[flat]
        give_back()  # the names, before the sums
        raw = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(np.append(starts, len(flat)).astype("<i4") * 2), pa.py_buffer(wide)])
        return pa.Table.from_arrays([
            docs_of[id_col].combine_chunks(), docs_of["_train"].combine_chunks(), docs_of["_key"].combine_chunks(), pa.array(sizes),
            pa.array(np.add.reduceat((c > 0)[flat].astype(np.int64), starts)), pa.array(np.add.reduceat(base[flat], starts)),
            pa.array(np.add.reduceat(inner[flat], starts)), raw], names=schema.fieldNames())

    left = docs.select("_block", id_col, "_train", "_key", "_text").groupBy("_block")
    return left.cogroup(counts.select("_block", "word", "c").groupBy("_block")).applyInArrow(run, schema)


def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for raw in batch.column("classes"):
            yield np.frombuffer(raw.as_buffer(), "<u2")


def fit(rows: DataFrame, model: Model, states: int = STATES, rounds: int = FULL_ROUNDS) -> Model:
    """States from a bounded sample of the :func:`encoded` rows, then ``rounds`` over all training rows."""
    spark = rows.sparkSession
    n_classes = len(model.mass)
    train = rows.where("_train").select("_key", "classes")
    chosen = train.select("_key").orderBy("_key").limit(WARM_DOCUMENTS).agg(F.max("_key")).first()[0]
    sample = train.where(F.col("_key") <= F.lit(chosen)).orderBy("_key").limit(WARM_DOCUMENTS).select("classes")
    warm = sorted(bytes(r.classes) for r in sample.collect()) if chosen is not None else []
    seeded = np.random.default_rng(7)
    model.start = np.full(states, 1 / states)
    model.move = np.full((states, states), 0.05 / max(1, states - 1)) + np.eye(states) * (0.95 - 0.05 / max(1, states - 1))
    model.move /= model.move.sum(axis=1, keepdims=True)
    emit = (model.mass + PRIOR)[:, None] * np.exp(0.7 * seeded.standard_normal((n_classes, states)))
    model.emit = emit / emit.sum(axis=0)
    for _ in range(WARM_ROUNDS if warm else 0):
        found = Counts.none(n_classes, states)
        for _, flat, starts, sizes in batches_of([np.frombuffer(w, "<u2") for w in warm]):
            expect(model, flat, starts, sizes, found)
        maximise(model, found)

    names_of = [f"s{k}" for k in range(states)]
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = Counts.none(n_classes, states)
            for texts in gathered(sequences(batches)):
                for _, flat, starts, sizes in batches_of(texts):
                    expect(shared.value, flat, starts, sizes, found)
            table = np.concatenate([found.emit, found.move, found.start[None, :]])
            kept = np.flatnonzero(table.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(kept), *(pa.array(table[kept, k]) for k in range(states))], ["row", *names_of])

        summed = train.select("classes").mapInArrow(tidy(run), "row long, " + ", ".join(f"{n} double" for n in names_of)).groupBy("row").agg(
            *[F.sum(n).alias(n) for n in names_of]).toPandas()
        shared.destroy()
        table = np.zeros((n_classes + states + 1, states))
        table[summed["row"].to_numpy()] = summed[names_of].to_numpy()
        maximise(model, Counts(table[-1], table[n_classes:-1], table[:n_classes]))
    return model


def score(rows: DataFrame, model: Model, id_col: str) -> DataFrame:
    """The scores of all :func:`encoded` rows, a pass without a shuffle."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    schema = StructType([
        rows.schema[id_col], StructField("held_out", BooleanType()), StructField("n_tokens", LongType()), StructField("n_known", LongType()),
        StructField("train_tokens", LongType()), StructField("base_score", DoubleType()), StructField("score", DoubleType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value

        def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            like = np.zeros(t.num_rows)
            for at, flat, starts, sizes in batches_of(list(sequences([t]))):
                like[at] = forward(m, flat, starts, sizes) / np.log(10)
            return pa.RecordBatch.from_arrays([
                t[id_col], pc.invert(t["_train"]), t["n_tokens"], t["n_known"], pa.array(np.full(t.num_rows, m.tokens, np.int64)),
                t["base_score"], pa.array(like + t["inner"].to_numpy())], schema.fieldNames())

        held: list[pa.RecordBatch] = []
        tokens = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                tokens += int(pc.sum(batch["n_tokens"]).as_py())
            if tokens >= 8 * BATCH_TOKENS:
                yield flush(held)
                held, tokens = [], 0
        if held:
            yield flush(held)

    return rows.select(id_col, "_train", "n_tokens", "n_known", "base_score", "inner", "classes").mapInArrow(tidy(run), schema)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(id_bucket(F.col(id_col), 10) == 0, F.lit(False))


def language_model_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES,
                          rounds: int = FULL_ROUNDS) -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``score`` is the log10 likelihood under the hidden Markov model, ``base_score`` that of smoothed word
    frequencies. Null and empty texts are the end token alone; null ids are not held out; repeated rows
    are scored and counted each. Without training texts all counts are zero and the model is its prior.
    Other columns are left out, whatever their names.
    """
    rows, model = train(docs, id_col, text_col, states, rounds)
    return score(rows, model, id_col)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, rounds: int = FULL_ROUNDS) -> tuple[DataFrame, Model]:
    """The rows as stored classes, and the model fitted on those that are not held out."""
    ready(docs)
    rows = placed(docs.select(F.col(id_col), F.col(text_col).alias("_text"))).select(
        F.col(id_col), "_text", "_block", (~held_out(id_col)).alias("_train"), F.xxhash64(id_col, F.lit("warm")).alias("_key"))
    counts = store(word_counts(rows), "word-counts")
    model = classes_of(counts)
    stored = store(encoded(rows, counts, model, id_col), "classes")
    return stored, fit(stored, model, states, rounds)
