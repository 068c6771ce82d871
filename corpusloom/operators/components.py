"""Connected components of an edge list, by random contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import scratch_path


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(id, component)`` for every vertex of an edge; ``component`` is the smallest id reachable.

    In each round every vertex is merged into the neighbour (or itself) with the smallest hash of that
    round, and edges are renamed; in expectation a fixed share of the vertices goes each time, so the
    number of rounds is logarithmic, chains included. A hub's edges are combined before they are shuffled.
    Rounds are stored, nothing is collected. Null vertices and loops are ignored.
    """
    spark = edges.sparkSession

    def store(df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    now = store(edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b").distinct(), "edges")
    merges: list[DataFrame] = []
    while not now.isEmpty():
        mix = F.lit(len(merges))
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b", mix).alias("h"), F.col("b").alias("v"))).alias("m"))
        own = F.struct(F.xxhash64("a", mix).alias("h"), F.col("a").alias("v"))
        merge = store(best.select(F.col("a").alias("old"), F.least("m", own)["v"].alias("new")), "merge")
        merges.append(merge)
        renamed = (now.join(merge, F.col("a") == F.col("old")).select(F.col("new").alias("a"), "b")
                   .join(merge, F.col("b") == F.col("old")).select("a", F.col("new").alias("b")))
        now = store(renamed.where("a <> b").distinct(), "edges")
    if not merges:
        return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    found = merges[0].select(F.col("old").alias("id"), F.col("new").alias("root"))
    for merge in merges[1:]:
        found = found.join(merge, F.col("root") == F.col("old"), "left").select("id", F.coalesce("new", "root").alias("root"))
    found = store(found, "roots")
    smallest = found.groupBy("root").agg(F.min("id").alias("component"))
    return found.join(smallest, "root").select("id", "component")
