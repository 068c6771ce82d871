"""Cuts by language and length class: junk goes, clean documents stay."""

import numpy as np
from pyspark.sql import functions as F

from corpusloom.llm import limits, quality
from corpusloom.llm.common import table

ROOT = "/root/testdata"


def test_ranges_take_near_classes_along():
    cells = [(3, v, 1) for v in range(10)] + [(8, 100 + v, 10) for v in range(10)]
    found = limits.ranges(cells, 0.0, 0.0, 10)
    assert found[3] == (0, 9) and found[8] == (100, 109)
    assert limits.ranges(cells, 0.0, 0.0, 20)[3] == (0, 109)
    assert limits.ranges(cells, 0.1, 0.1, 100)[8] == (101, 108)
    assert limits.ranges(cells, 0.005, 0.0, 100)[8] == (100, 109)


def test_junk_of_all_lengths_goes(spark):
    docs, labels = table(spark, f"{ROOT}/sf0.1", "documents"), table(spark, f"{ROOT}/sf0.1", "labels")
    rows = quality.classify(docs, labels, keep=["doc_id", "lang", "text"]).join(labels, "doc_id").collect()
    junk = [r for r in rows if r.quality == 0]
    repeated = [r.kept for r in junk if len(r.text.split()) > 9 and len(set(r.text.split())) <= max(3, len(r.text.split()) // 12)]
    assert len(repeated) > 100 and np.mean(repeated) < 0.15  # before: 57 of 107
    assert np.mean([r.kept for r in junk]) < 0.05 and np.mean([r.kept for r in junk if r.lang == "de"]) < 0.05
    assert np.mean([r.kept for r in rows if r.quality == 1 and r.toxic == 0]) > 0.99
    assert all(r.kept == (r.low_cut <= r.perplexity <= r.cut) for r in rows if r.perplexity is not None)


def test_good_documents_that_no_model_saw_stay(spark):
    docs, labels = table(spark, f"{ROOT}/sf0.1", "documents"), table(spark, f"{ROOT}/sf0.1", "labels")
    found = quality.classify(docs, labels.where("doc_id % 2 = 0"))
    unseen = labels.where("doc_id % 2 = 1 and quality = 1 and toxic = 0")
    assert found.join(unseen, "doc_id").agg(F.avg(F.col("kept").cast("int"))).first()[0] > 0.98
