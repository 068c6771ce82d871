"""Seeded, engine-portable sampling and splitting.

Rows are ordered by ``md5(seed|id)``: the outcome depends on the ids only, not on partitioning.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.functions.keys import hash_number, seeded_hash, tier

SEED = 42  # fixed value
EVAL_FRACTION = 0.05  # fixed value

# Sizes of the judged and the hand-checked sample, lowest accepted score, subtype shares.
JUDGED, SPOT_CHECKED, LEAST_SCORE = 500, 100, 3
EXPLANATION_SHARES = {"what it does": 30, "concepts": 20, "expression": 20, "signature": 15, "difference": 15}
TRANSLATION_SHARES = {"typescript": 40, "javascript": 20, "elixir": 20, "elm": 20}

# Quotas of the stratified sample.
QUOTA_OFFICIAL = 4
QUOTA_COMPLEXITY = {"simple": 7, "medium": 7, "complex": 6}
QUOTA_SOURCE = {"src": 10, "test": 6, "examples": 4}

BROADCAST_ROWS = 100_000
_BUCKET_DIGITS = 5  # 16**5 = 1,048,576 hash buckets


def shuffle_rows(df: DataFrame, seed: int = SEED, id_col: str = "id") -> DataFrame:
    """Seeded permutation: a range-partitioned sort on the hash."""
    return df.orderBy(seeded_hash(seed, id_col), id_col)


def _cut(df: DataFrame, hashed: Column, id_col: str, n: int | None = None, fraction: float | None = None) -> Column:
    """Where the first ``n`` rows (or the first ``ceil(fraction * rows)``) by ``(hashed, id)`` end: the last
    pair ``_h, _id``, how many rows have it (``_n``), and how many of them are still in (``_in``). ``hashed`` begins
    with hexadecimal digits.

    A top-n would send n rows of every task to one place. Instead the cut is located on the id
    column alone: a histogram over about a million hash buckets names the bucket it falls in, and
    the ids of that bucket are counted in order. Choosing the rows is then a comparison with one
    value, in a scan without a shuffle. The result is null when fewer rows exist.
    """
    ids = df.select(F.col(id_col).alias("_id"), hashed.alias("_h")).withColumn("_b", hash_number(F.col("_h"), _BUCKET_DIGITS))
    sizes = ids.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    if n is None:
        rows = sizes.agg(F.sum("_n")).scalar()
        wanted = F.ceil(rows * F.lit(fraction)).cast("long")
    else:
        wanted = F.lit(n).cast("long")
    running = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spread = sizes.select("_b", "_n", F.sum("_n").over(running).alias("_until"), wanted.alias("_want"))
    cut = spread.filter("_until >= _want and _until - _n < _want").agg(
        F.first(F.struct(F.col("_b").alias("b"), (F.col("_want") - F.col("_until") + F.col("_n")).alias("m")))
    ).scalar()
    in_order = Window.orderBy("_h", "_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        ids.filter(F.col("_b") == cut["b"]).groupBy("_h", "_id").agg(F.count(F.lit(1)).alias("_n"))
        .select("_h", "_id", "_n", F.sum("_n").over(in_order).alias("_until")).filter(F.col("_until") >= cut["m"])
        .agg(F.min(F.struct("_h", "_id", "_n", (cut["m"] - F.col("_until") + F.col("_n")).alias("_in"))).alias("_c"))
    ).select("_c").scalar()
    return found


def _marked(df: DataFrame, hashed: Column, id_col: str, n: int | None = None, fraction: float | None = None) -> DataFrame:
    """``df`` with ``_in``: exactly the first ``n`` rows. The cut is taken at once: one row reaches the driver.

    If only some of the rows with the last id are in, they are told apart by a hash of their content, with a second cut
    among them. Rows alike in content too are interchangeable: they are counted, and as many copies of one as are in and
    out stand for them. So a task gets neither the rows of an id nor those of a content.
    """
    spark = df.sparkSession
    if n == 0 or fraction == 0:
        return df.withColumn("_in", F.lit(False))
    last = spark.range(1).select(_cut(df, hashed, id_col, n, fraction).alias("c")).first()["c"]
    if last is None:  # fewer rows than asked for, so all of them are in
        return df.withColumn("_in", F.lit(True))
    place = F.struct(hashed.alias("_h"), F.col(id_col).alias("_id"))
    at = F.struct(F.lit(last["_h"]).alias("_h"), F.lit(last["_id"]).cast(df.schema[id_col].dataType).alias("_id"))
    if last["_in"] == last["_n"]:
        return df.withColumn("_in", place <= at)
    clear = df.filter(place != at).withColumn("_in", place < at)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    edge = df.filter(place == at).select(row.alias("_row"), F.md5(F.to_json(row)).alias("_content"))
    end = spark.range(1).select(_cut(edge, F.col("_content"), "_content", last["_in"]).alias("c")).first()["c"]
    apart = edge.filter(F.col("_content") != end["_h"]).select("_row.*", (F.col("_content") < end["_h"]).alias("_in"))
    alike = edge.filter(F.col("_content") == end["_h"]).agg(F.first("_row").alias("_row"))
    copies = alike.select("_row.*", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(end["_n"]).cast("long"))).alias("_copy"))
    return clear.unionByName(apart).unionByName(copies.withColumn("_in", F.col("_copy") <= end["_in"]).drop("_copy"))


def sample_n(df: DataFrame, n: int, seed: int = SEED, id_col: str = "id", exact: bool = False) -> DataFrame:
    """n rows, or all rows when there are fewer.

    Rows that share an id go together, so with repeated ids a few more can come out; ``exact`` tells them
    apart by their content and returns n rows whatever the ids are.
    """
    hashed = seeded_hash(seed, id_col)
    if exact or n == 0:
        return _marked(df, hashed, id_col, n=n).filter("_in").drop("_in")
    last = _cut(df, hashed, id_col, n)
    place = F.struct(hashed.alias("_h"), F.col(id_col).alias("_id"))
    return df.filter(last["_h"].isNull() | (place <= F.struct(last["_h"].alias("_h"), last["_id"].alias("_id"))))


def shuffle_take(df: DataFrame, n: int, seed: int = SEED, id_col: str = "id", exact: bool = False) -> DataFrame:
    """First n rows of the seeded permutation, in its order, without a shuffle buffer; ``exact`` as in ``sample_n``."""
    return shuffle_rows(sample_n(df, n, seed, id_col, exact), seed, id_col)


def train_eval_split(df: DataFrame, fraction: float = EVAL_FRACTION, seed: int = SEED, id_col: str = "id",
                     exact: bool = False) -> DataFrame:
    """Add ``split`` (``train``/``eval``). By default each row is decided by its own hash; ``exact``
    puts ``ceil(fraction * rows)`` rows into eval, told apart by content where they share an id."""
    if exact:
        marked = _marked(df, seeded_hash(seed, id_col), id_col, fraction=fraction)
    else:
        marked = df.withColumn("_in", hash_number(seeded_hash(seed, id_col)) < F.lit(math.floor(fraction * 2**32)))
    return marked.withColumn("split", F.when(F.col("_in"), "eval").otherwise("train")).drop("_in")


def judge_sample(df: DataFrame, n: int = JUDGED, seed: int = SEED, id_col: str = "id") -> DataFrame:
    """Rows for a judge to score."""
    return sample_n(df, n, seed, id_col, exact=True)


def spot_check_sample(df: DataFrame, n: int = SPOT_CHECKED, seed: int = SEED, id_col: str = "id") -> DataFrame:
    """Rows for people to look at."""
    return sample_n(df, n, seed, id_col, exact=True)


def judge_reject(df: DataFrame, scores: DataFrame, dimensions: list[str], least: float = LEAST_SCORE, id_col: str = "id") -> DataFrame:
    """Rows without a score below ``least`` in any dimension; rows that were not judged, and missing
    scores, reject nothing. A row judged more than once takes its lowest scores."""
    worst = scores.groupBy(F.col(id_col).alias("_id")).agg(*[F.min(d).alias(f"_{d}") for d in dimensions])
    low = F.least(*[F.coalesce(f"_{d}", F.lit(least)) for d in dimensions] + [F.lit(least)]) < F.lit(least)
    return df.join(worst.where(low).select("_id"), F.col(id_col) == F.col("_id"), "left_anti")


def has_doc_comments(code: Column | str = "code", marker: str = "///") -> Column:
    """Whether a line of the text is a documentation comment."""
    c = F.col(code) if isinstance(code, str) else code
    return F.coalesce(c.rlike(rf"(?m)^\s*{marker}"), F.lit(False))


def weighted_sample(df: DataFrame, n: int, weight: Column, seed: int = SEED, id_col: str = "id") -> DataFrame:
    """``n`` rows without replacement, with chances in proportion to ``weight``.

    Each row gets the key ``-ln(u) / weight`` with ``u`` from its id's hash; the smallest keys win. Rows
    with a null or non-positive weight are never drawn. The key's logarithm is written as a hexadecimal
    fraction, so that the cut is found as in ``sample_n``: on that scale the keys of weights of any size are
    spread over the histogram.
    """
    u = (hash_number(seeded_hash(seed, id_col)) + F.lit(0.5)) / F.lit(2.0 ** 32)
    key = -F.log(u) / F.col("_w")
    scaled = F.least(F.greatest((F.log(key) + F.lit(256.0)) / F.lit(512.0), F.lit(0.0)), F.lit(1 - 2.0 ** -52))
    fraction = F.floor(scaled * F.lit(2.0 ** 52)).cast("long")
    weighed = df.withColumn("_w", weight.cast("double")).filter("_w > 0").withColumn("_k", F.lower(F.lpad(F.hex(fraction), 13, "0")))
    return _marked(weighed, F.col("_k"), id_col, n=n).filter("_in").drop("_in", "_w", "_k")


def assign_subtypes(df: DataFrame, shares: dict[str, float], seed: int = SEED, id_col: str = "id", alias: str = "subtype") -> DataFrame:
    """Add a subtype drawn by the id's hash with the given shares (percent or weights)."""
    total, until = sum(shares.values()), 0.0
    u = hash_number(seeded_hash(seed, id_col))
    choice = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, share in shares.items():
        until += share
        choice = choice.when(u < F.lit(math.floor(until / total * 2 ** 32)), name)
    return df.withColumn(alias, choice.otherwise(F.lit(list(shares)[-1])))


def classify(df: DataFrame, simple_below: int = text.SIMPLE_BELOW, medium_below: int = text.MEDIUM_BELOW) -> DataFrame:
    """Add ``loc``, ``complexity``, ``source_class`` and ``tier``."""
    return df.withColumn("loc", text.loc("code")).withColumns({
        "complexity": text.complexity("loc", simple_below, medium_below),
        "source_class": text.source_class("file_path"),
        "tier": tier("is_official", "stars"),
    })


def _scaled(quotas: dict[str, int], n: int, base: int) -> dict[str, int]:
    return {k: max(1, round(v * n / base)) for k, v in quotas.items()}


def _quota(quotas: dict[str, int], column: str) -> Column:
    value = F.lit(0)
    for name, count in quotas.items():
        value = F.when(F.col(column) == name, F.lit(count)).otherwise(value)
    return value


def stratified_sample(df: DataFrame, n: int = 20, seed: int = SEED, scale_quotas: bool = False, **sizes) -> DataFrame:
    """``n`` diverse files in four phases: official ones, complexity quotas, source-class quotas,
    random fill. Quotas keep their size for other ``n`` unless ``scale_quotas``.

    Candidates come first: of every stratum the rows whose hash is not above that of its
    ``depth``-th row, found from a histogram of (stratum, hash bucket). No task gets a whole stratum,
    whatever ``n``. The phases work on the candidates' narrow rows, whose number is set by ``n`` and
    the quotas (and the rows that share a stratum's last bucket), not by the corpus.
    """
    official, by_complexity, by_source = QUOTA_OFFICIAL, QUOTA_COMPLEXITY, QUOTA_SOURCE
    if scale_quotas:
        official = max(1, round(official * n / 20))
        by_complexity, by_source = _scaled(by_complexity, n, 20), _scaled(by_source, n, 20)
    depth = n + official + sum(by_complexity.values()) + sum(by_source.values())
    classified = classify(df, **sizes)
    narrow = classified.select("id", seeded_hash(seed, "id").alias("_h"), "complexity", "source_class", "tier")
    strata = F.array(
        F.lit("any"), F.when(F.col("tier") == "official", F.lit("official")),
        F.concat(F.lit("c:"), "complexity"), F.concat(F.lit("s:"), "source_class"),
    )
    bucketed = narrow.withColumns({"_b": hash_number(F.col("_h"), _BUCKET_DIGITS), "_stratum": F.explode(F.array_compact(strata))})
    sizes_of = bucketed.groupBy("_stratum", "_b").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy("_stratum").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = (
        sizes_of.withColumn("_until", F.sum("_n").over(running)).filter(F.col("_until") - F.col("_n") < F.lit(depth))
        .groupBy("_stratum").agg(F.max("_b").alias("_last"))
    )
    # one row per stratum; strata are as many as there are classes of size, source and tier
    leading = (
        bucketed.join(F.broadcast(cuts), "_stratum").filter(F.col("_b") <= F.col("_last"))
        .withColumn("_r", F.row_number().over(Window.partitionBy("_stratum").orderBy("_h", "id"))).filter(F.col("_r") <= depth)
        .drop("_r", "_stratum", "_b", "_last").dropDuplicates(["id"])
    )

    def rank(*groups):
        return F.row_number().over(Window.partitionBy(*groups).orderBy("_h", "id"))

    def taken(*groups):
        return F.count_if(F.col("_phase") > 0).over(Window.partitionBy(*(groups or [F.lit(1)])))

    def phase(frame, number, eligible, room, *groups):
        """Rows not yet taken get ``number`` while their rank among the untaken fits in ``room``."""
        ranked = frame.withColumns({"_room": room, "_free": F.col("_phase") == 0}).withColumn("_r", rank("_free", *groups))
        pick = F.col("_free") & eligible & (F.col("_r") <= F.col("_room"))
        return ranked.withColumn("_phase", F.when(pick, number).otherwise(F.col("_phase"))).drop("_room", "_free", "_r")

    everyone = F.lit(True)
    c = leading.withColumn("_phase", F.lit(0))
    c = phase(c, 1, F.col("tier") == "official", F.lit(official), "tier")
    c = phase(c, 2, everyone, _quota(by_complexity, "complexity") - taken("complexity"), "complexity")
    open_slots = F.lit(n) - taken()
    c = phase(c, 3, everyone,
              F.when(open_slots > 0, _quota(by_source, "source_class") - taken("source_class")).otherwise(0), "source_class")
    c = phase(c, 4, everyone, F.lit(n) - taken())
    place = F.struct(
        "_phase",
        F.when(F.col("_phase") == 2, F.array_position(F.array(*map(F.lit, by_complexity)), F.col("complexity")))
        .when(F.col("_phase") == 3, F.array_position(F.array(*map(F.lit, by_source)), F.col("source_class"))),
        "_h", "id",
    )
    chosen = c.filter("_phase > 0").select("id", "_phase", place.alias("_place")).orderBy("_place").limit(n)
    picked = chosen.select("id", F.col("_phase").alias("phase"), "_place")
    # n rows, a parameter: small enough to broadcast, or joined by shuffle
    return classify(df.join(F.broadcast(picked) if n <= BROADCAST_ROWS else picked, "id"), **sizes).orderBy("_place").drop("_place")


def sample_summary(sample: DataFrame) -> DataFrame:
    """Counts by complexity, source class and tier."""
    dims = ["complexity", "source_class", "tier"]
    grouped = sample.groupingSets([[d] for d in dims], *dims).agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_g")
    )
    names = {3: "complexity", 5: "source_class", 6: "tier"}
    dimension = F.lit(None).cast("string")
    for code, name in names.items():
        dimension = F.when(F.col("_g") == code, F.lit(name)).otherwise(dimension)
    return grouped.select(dimension.alias("dimension"), F.coalesce(*dims).alias("value"), "n")
