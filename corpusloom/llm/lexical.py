"""Ranked lexical search over a length-stratified index.

Documents with the same length normaliser ``m`` form a stratum (large strata are cut into chunks, so that none
is a task's burden). Inside a stratum a term's postings stand by ``tf``: all documents of one posting list have
the same impact, which is worked out once. A stratum's largest impacts bound what any of its documents can
score for an item; strata are visited by falling bound until none can reach the item's k-th best score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import ready, store, tidy, with_position
from corpusloom.llm.topk import Best
from corpusloom.operators.joins import join_small
from corpusloom.operators.tiles import by_group

K = 10
STRATUM_DOCUMENTS, STRATUM_POSTINGS = 512, 1 << 18  # of a chunk
TASK_POSTINGS = 4_000_000
ROUND_TERMS = 200_000  # distinct terms of the items that one round sends to the tasks

# Terms are runs of ASCII letters and digits and of everything beyond ASCII: in UTF-8, of bytes.
_TERM_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text in order, A-Z lowered."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split() if text else []


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


@dataclass
class Index:
    """``postings``: ``m, chunk, term, tf, docs``; the row without a term lists the ids of the chunk's documents,
    the others the places in that list. ``documents``: N, ``length``: L."""

    postings: DataFrame
    documents: int
    length: int


def term_counts(docs: DataFrame, id_col: str, text_col: str, wanted: frozenset[bytes] | None) -> DataFrame:
    """``id, n, terms, tfs`` of every row; only the ``wanted`` terms are listed, ``n`` counts all."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = shared.value
        for batch in batches:
            n, ends, terms, tfs = [], [0], [], []
            for text in batch.column(1).to_pylist():
                found = terms_of(text)
                n.append(len(found))
                counts = Counter(found if keep is None else filter(keep.__contains__, found))
                terms += counts
                tfs += counts.values()
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(terms, pa.binary())),
                pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32()))], ["id", "n", "terms", "tfs"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col)).mapInArrow(
        tidy(run), "id long, n long, terms array<binary>, tfs array<int>")


def build_index(docs: DataFrame, wanted: frozenset[bytes] | None = None, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The index of all rows, for the ``wanted`` terms only if they are given.

    Null and empty texts, and texts without a term, are in no stratum and do not count. Rows with a null id count
    in N, L and df but are never found. Rows that repeat an id are documents of their own. Texts are read whole.
    """
    spark = ready(docs)
    counted = with_position(store(term_counts(docs, id_col, text_col, wanted), "term-counts"))
    total = counted.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("length"), F.sum(F.size("terms")).alias("postings")).first()
    n, length = total["documents"], total["length"] or 0
    rows = counted.where("size(terms) > 0").withColumn("m", F.expr(f"100 - 90 + (90 * n * {n}L) div {max(length, 1)}L"))
    chunks = rows.groupBy("m").agg(F.greatest(F.ceil(F.count("*") / STRATUM_DOCUMENTS), F.ceil(F.sum(F.size("terms")) / STRATUM_POSTINGS))
                                   .cast("int").alias("chunks")).where("chunks > 1")
    placed = join_small(rows, chunks, "m", "left").withColumn(
        "chunk", F.pmod(F.xxhash64("_file", "_row"), F.coalesce("chunks", F.lit(1))).cast("int"))

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in by_group(batches, ["m", "chunk"]):
            whole = group.combine_chunks()
            m, chunk = whole["m"][0].as_py(), whole["chunk"][0].as_py()
            lists = whole["terms"].chunk(0)
            terms = lists.flatten().dictionary_encode()
            tf, code = whole["tfs"].chunk(0).flatten().to_numpy(), terms.indices.to_numpy()
            place = np.repeat(np.arange(len(whole)), np.diff(lists.offsets.to_numpy()))
            order = np.lexsort((place, tf, code))
            code, tf, place = code[order], tf[order], place[order]
            first = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (tf[1:] != tf[:-1])]))
            ends = np.concatenate([[0, len(whole)], len(whole) + np.append(first[1:], len(code))]).astype(np.int32)
            ids = pa.concat_arrays([whole["id"].combine_chunks(), pa.array(place, pa.int64())])
            rows_out = len(first) + 1
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(rows_out, m), pa.int64()), pa.array(np.full(rows_out, chunk), pa.int32()),
                pa.concat_arrays([pa.array([None], pa.binary()), terms.dictionary.take(pa.array(code[first]))]),
                pa.array(np.concatenate([[0], tf[first]]), pa.int32()), pa.ListArray.from_arrays(pa.array(ends), ids)],
                ["m", "chunk", "term", "tf", "docs"])

    dealt = dealt_strata(placed.select("m", "chunk", "id", "terms", "tfs"), total["postings"] or 0).sortWithinPartitions("m", "chunk")
    postings = store(dealt.mapInArrow(tidy(invert), "m long, chunk int, term binary, tf int, docs array<long>"), "strata")
    return Index(postings, n, length)


def dealt_strata(rows: DataFrame, postings: int) -> DataFrame:
    """Rows of a chunk together; AQE puts small partitions together unless many are needed to bound a task."""
    tasks = -(-postings // TASK_POSTINGS)
    if tasks > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return rows.repartition(tasks, "m", "chunk")
    return rows.repartition("m", "chunk")


class Strata:
    """The strata that one task holds, with every posting list's impact worked out once."""

    def __init__(self, table: pa.Table, number_of: dict[bytes, int]):
        m, chunk, tf = (table[c].to_numpy() for c in ("m", "chunk", "tf"))
        lists = table["docs"].combine_chunks()
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.chunk(0)
        sizes, values = np.diff(lists.offsets.to_numpy()), lists.flatten()
        flat = values.fill_null(0).to_numpy(zero_copy_only=False)
        heads = tf == 0
        stratum = np.cumsum(heads) - 1
        self.strata = int(heads.sum())
        self.ids = flat[np.repeat(heads, sizes)]
        self.named = values.is_valid().to_numpy(zero_copy_only=False)[np.repeat(heads, sizes)]
        self.sizes = sizes[heads]
        start = np.cumsum(self.sizes) - self.sizes
        self.stratum_of = np.repeat(np.arange(self.strata), self.sizes)
        impact = 1_000_000_000 * tf.astype(np.int64) // np.maximum(1000 * tf.astype(np.int64) + 8 * m, 1)
        term = np.array([-1 if t is None else number_of.get(t, -1) for t in table["term"].to_pylist()], np.int64)
        of_row = np.repeat(np.arange(len(tf)), sizes)
        docs = flat + start[stratum[of_row]] if len(flat) else flat
        entry_term = term[of_row]
        order = np.argsort(entry_term, kind="stable")
        order = order[np.searchsorted(entry_term[order], 0):]
        self.docs, self.impacts = docs[order].astype(np.int64), impact[of_row][order]
        known, at = np.unique(entry_term[order], return_index=True)
        ends = np.append(at[1:], len(order))
        self.span = {t: (a, b) for t, a, b in zip(known.tolist(), at.tolist(), ends.tolist())}
        self.largest = {}
        for t, (a, b) in self.span.items():  # the largest impact of a term in each of its strata
            top = np.zeros(self.strata, np.int64)
            np.maximum.at(top, self.stratum_of[self.docs[a:b]], self.impacts[a:b])
            rows = np.flatnonzero(top)
            self.largest[t] = rows, top[rows]
        self.scores = np.zeros(len(self.ids), np.int64)

    def search(self, terms: list[tuple[int, int]], k: int) -> Best:
        """Best documents for ``(term, weight)`` pairs; strata that cannot reach the k-th best are not visited."""
        best = Best(k)
        here = [(*self.span[t], t, w) for t, w in terms if w > 0 and t in self.span]
        bound = np.zeros(self.strata, np.int64)
        for _, _, t, w in here:
            rows, top = self.largest[t]
            bound[rows] += w * top
        order = np.argsort(-bound, kind="stable")
        order = order[: int((bound > 0).sum())]
        at, width = 0, 8
        while at < len(order):
            visit = order[at:at + width]
            visit = visit[bound[visit] >= best.floor()]
            if not len(visit):
                break
            at, width = at + width, width * 4
            open_ = np.zeros(self.strata, bool)
            open_[visit] = True
            for a, b, _, w in here:
                docs = self.docs[a:b]
                inside = open_[self.stratum_of[docs]]
                self.scores[docs[inside]] += w * self.impacts[a:b][inside]
            docs = np.flatnonzero(self.scores)
            found = self.scores[docs]
            self.scores[docs] = 0
            good = (found >= best.floor()) & self.named[docs]
            best.add(found[good], self.ids[docs[good]])
        return best


def search(index: Index, items: DataFrame, k: int = K, id_col: str = "item_id", text_col: str = "text", doc_col: str = "doc_id") -> DataFrame:
    """``id_col, rank, doc_col, score``: the ``k`` documents with the highest scores above 0 for every item.

    Equal scores go by smaller document id. Items that are null, empty or without a known term find nothing; equal
    items count once, an id on several texts is searched for with each, null item ids are kept. Items go to the
    tasks in rounds of bounded size. An empty index or no items give an empty result; other columns are left out.
    """
    spark = ready(items)
    id_type = items.schema[id_col].dataType.simpleString()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(set(terms_of(t))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.binary()))], ["item", "terms"])

    asked = store(items.select(F.col(id_col), F.col(text_col)).distinct().mapInArrow(tidy(ask), f"item {id_type}, terms array<binary>"), "items")
    rounds = -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // ROUND_TERMS)
    found = []
    for number in range(rounds):
        block = asked.where((F.pmod(F.xxhash64("item", "terms"), F.lit(rounds)) == number) & (F.size("terms") > 0)).collect()
        names = sorted({bytes(t) for r in block for t in r.terms})
        if names and index.documents:
            found.append(_round(index, [(r.item, [bytes(t) for t in r.terms]) for r in block], names, k, items.schema[id_col]))
    schema = f"`{id_col}` {id_type}, rank int, `{doc_col}` long, score long"
    out = spark.createDataFrame([], schema)
    for part in found:
        out = out.unionByName(part.select(F.col("item").alias(id_col), "rank", F.col("id").alias(doc_col), "score"))
    return out


def _round(index: Index, block: list[tuple[object, list[bytes]]], names: list[bytes], k: int, item_field) -> DataFrame:
    spark = index.postings.sparkSession
    asked = F.broadcast(spark.createDataFrame([(t,) for t in names], "term binary"))  # ROUND_TERMS bounds it
    lists = index.postings.where("term is not null").join(asked, "term")
    df = {bytes(r.term): r.df for r in lists.groupBy("term").agg(F.sum(F.size("docs")).alias("df")).collect()}
    number_of = {t: i for i, t in enumerate(names)}
    wanted = [[(number_of[t], weight(index.documents, df[t])) for t in terms if t in df] for _, terms in block]
    shared = spark.sparkContext.broadcast((number_of, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        item, ids, scores = [], [], []
        if held:
            numbers, questions = shared.value
            strata = Strata(pa.Table.from_batches(held), numbers)
            for q, terms in enumerate(questions):
                best = strata.search(terms, k)
                item += [q] * len(best.ids)
                ids += best.ids.tolist()
                scores += best.scores.tolist()
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], ["q", "id", "score"])

    heads = index.postings.where("term is null")
    named = heads.unionByName(lists.select(heads.columns))
    dealt = dealt_strata(named, sum(df.values())).sortWithinPartitions("m", "chunk", F.asc_nulls_first("term"), "tf")
    hits = dealt.mapInArrow(tidy(run), "q int, id long, score long")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    ranked = hits.where("id is not null").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    items = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(block)], f"q int, item {item_field.dataType.simpleString()}")
    return store(ranked.join(F.broadcast(items), "q").select("item", "rank", "id", "score"), "hits")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K, item_col: str = "item_id", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Index ``docs`` for the terms of ``items`` and search it (:func:`build_index`, :func:`search`).

    More than ROUND_TERMS distinct terms are not sent to the indexing tasks: the index then holds all terms.
    """
    spark = ready(docs)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(sorted({w for t in batch.column(0).to_pylist() for w in terms_of(t)}), pa.binary())], ["term"])

    names = store(items.select(F.col(text_col)).mapInArrow(tidy(ask), "term binary").distinct(), "terms")
    few = names.count() <= ROUND_TERMS
    index = build_index(docs, frozenset(bytes(r.term) for r in names.collect()) if few else None, id_col, text_col)
    return search(index, items, k, item_col, text_col, id_col)
