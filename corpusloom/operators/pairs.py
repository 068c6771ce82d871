"""Instruction-response pairs: parsing, building, and the checks that a pair has to pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.functions.keys import hash_number, seeded_hash
from corpusloom.operators.chat import CODING_SYSTEM
from corpusloom.operators.prompts import message
from corpusloom.operators.ranking import global_row_number

# Bounds of a pair in characters, the share and size of merged conversations.
RESPONSE_CHARS = (50, 10_000)
INSTRUCTION_CHARS = (20, 2_000)
EXTENDED_SHARE, EXTENDED_ROWS = 0.2, 3
CUT_SHARES = (0.3, 0.5)

# Tokens whose presence shows source code, and instructions that ask for nothing in particular.
SYNTAX_TOKENS = ["pub fn", "import", "fn", "type", "case", "let"]
GENERIC = ["write code", "write some code", "write a program", "write something", "do something", "generate code", "help me"]


def parse_multi_pair(df: DataFrame, reply: str = "content") -> DataFrame:
    """One row per ``## Pair n [task/level]`` section of a reply: ``pair_no, task, level, instruction,
    response``; sections without an instruction or a response are left out. Other columns stay."""
    sections = F.split(F.concat(F.lit("\n"), reply), r"\n## Pair ")
    cut = df.withColumn("_s", F.explode(F.slice(sections, F.lit(2), F.greatest(F.size(sections) - 1, F.lit(0)))))
    # every heading cuts once: what stands before the first of its kind, and all the rest
    asked = cut.withColumn("_a", F.split("_s", "\n### Instruction\n", 2)).where("size(_a) = 2")
    answered = asked.withColumn("_r", F.split(F.col("_a")[1], "\n### Response\n", 2)).where("size(_r) = 2")
    head = r"^(\d+) \[([^/\]\n]*)/([^\]\n]*)\]"
    found = answered.withColumns({"_h": F.col("_a")[0], "_i": F.col("_r")[0], "_o": F.col("_r")[1]}).where(F.col("_h").rlike(head))
    return found.select(
        *df.columns, F.regexp_extract("_h", head, 1).cast("int").alias("pair_no"), F.regexp_extract("_h", head, 2).alias("task"),
        F.regexp_extract("_h", head, 3).alias("level"), text.strip("_i").alias("instruction"), text.strip("_o").alias("response"),
    ).where("instruction <> '' and response <> ''")


def alpaca_to_chat(df: DataFrame, system: str = CODING_SYSTEM) -> DataFrame:
    """``instruction``/``input``/``output`` rows to messages; a filled input follows the instruction."""
    extra = F.coalesce("input", F.lit(""))
    user = F.when(extra == "", F.col("instruction")).otherwise(F.concat_ws("\n\n", "instruction", extra))
    turns = F.array(message("system", F.lit(system)), message("user", user), message("assistant", F.col("output")))
    return df.withColumn("messages", turns).drop("instruction", "input", "output")


def completion_pair(df: DataFrame, code: str = "code", id_col: str = "id", seed: int = 42, shares: tuple[float, float] = CUT_SHARES) -> DataFrame:
    """Add ``head`` and ``tail``: the last 30 to 50 % of the lines (by the id's hash) are the answer.

    Files of one line have no tail and are left out.
    """
    low, high = shares
    share = F.lit(low) + F.lit(high - low) * hash_number(seeded_hash(seed, id_col)) / F.lit(2.0 ** 32)
    lines = text.lines(code)
    keep = (F.size(lines) - F.greatest(F.lit(1), F.floor(F.size(lines) * share)).cast("int")).cast("int")
    cut = df.withColumns({"_lines": lines, "_keep": keep}).where("_keep >= 1")
    return cut.withColumns({
        "head": F.array_join(F.slice("_lines", F.lit(1), F.col("_keep")), "\n"),
        "tail": F.array_join(F.slice("_lines", F.col("_keep") + 1, F.size("_lines")), "\n"),
    }).drop("_lines", "_keep")


def extend_conversations(df: DataFrame, id_col: str = "id", share: float = EXTENDED_SHARE, rows: int = EXTENDED_ROWS, seed: int = 42) -> DataFrame:
    """Merge about ``share`` of the single-turn records, ``rows`` at a time in hash order, into one
    conversation with one system message: ``(id, merged, messages)``; the id is that of the first record.

    Only ids are ranked. A last group may be smaller.
    """
    chosen = hash_number(seeded_hash(seed, F.lit("extend"), id_col)) < F.lit(int(share * 2 ** 32))
    keys = df.where(chosen).select(F.col(id_col).alias("_id"), seeded_hash(seed, id_col).alias("_h"))
    ranked = global_row_number(keys, ["_h", "_id"], "_n").withColumn("_group", F.floor((F.col("_n") - 1) / rows))
    merged = (
        df.join(ranked, F.col(id_col) == F.col("_id")).groupBy("_group")
        .agg(F.array_sort(F.collect_list(F.struct("_n", F.col(id_col).alias("id"), "messages"))).alias("_rows"))
    )
    turns = F.flatten(F.transform("_rows", lambda r: F.filter(r["messages"], lambda m: ~F.coalesce(m["role"] == "system", F.lit(False)))))
    system = F.slice(F.filter(F.col("_rows")[0]["messages"], lambda m: F.coalesce(m["role"] == "system", F.lit(False))), 1, 1)
    long = merged.select(F.col("_rows")[0]["id"].alias(id_col), F.size("_rows").alias("merged"), F.concat(system, turns).alias("messages"))
    single = df.where(~F.coalesce(chosen, F.lit(False))).select(id_col, F.lit(1).alias("merged"), "messages")
    return single.unionByName(long)


def length_bounds(instruction: str = "instruction", response: str = "response", instruction_chars: tuple[int, int] = INSTRUCTION_CHARS,
                  response_chars: tuple[int, int] = RESPONSE_CHARS) -> Column:
    good = F.length(instruction).between(*instruction_chars) & F.length(response).between(*response_chars)
    return F.coalesce(good, F.lit(False))


def specific_instruction(instruction: str = "instruction", least_words: int = 4, generic: list[str] | None = None) -> Column:
    """Not one of the generic requests (with or without closing marks), and of ``least_words`` at least."""
    plain = F.regexp_replace(F.lower(text.strip(instruction)), r"[.!?\s]+$", "")
    words = F.size(F.filter(F.split(plain, r"\s+"), lambda w: w != ""))
    return F.coalesce(~plain.isin(generic or GENERIC) & (words >= least_words), F.lit(False))


def syntax_tokens(code: str = "response", tokens: list[str] | None = None) -> Column:
    """Number of different tokens of the language that occur as whole words."""
    hits = [F.col(code).rlike(rf"(^|\W){t}($|\W)").cast("int") for t in (tokens or SYNTAX_TOKENS)]
    return F.coalesce(sum(hits[1:], hits[0]), F.lit(0))


def syntax_token_check(code: str = "response", least: int = 1, tokens: list[str] | None = None) -> Column:
    return syntax_tokens(code, tokens) >= least


def normalised(col: str) -> Column:
    """Text without case and white-space differences."""
    return F.regexp_replace(F.lower(text.strip(col)), r"\s+", " ")


def not_a_copy(pairs: DataFrame, seeds: DataFrame, key: str = "source_file_id", response: str = "response", code: str = "code", id_col: str = "id") -> DataFrame:
    """Pairs whose response differs from their seed; pairs without a known seed stay.

    Only digests of the seeds are joined.
    """
    known = seeds.select(F.col(id_col).alias(key), F.sha2(normalised(code), 256).alias("_seed"))
    joined = pairs.join(known.groupBy(key).agg(F.collect_set("_seed").alias("_seeds")), key, "left")
    same = F.coalesce(F.array_contains("_seeds", F.sha2(normalised(response), 256)), F.lit(False))
    return joined.where(~same).select(*pairs.columns)


def imports_of(code: str = "response", pattern: str = r"(?m)^\s*import\s+([\w/]+)") -> Column:
    """Distinct imported package names: the part before the first slash."""
    found = F.regexp_extract_all(F.col(code), F.lit(pattern), F.lit(1))
    return F.array_distinct(F.transform(found, lambda m: F.substring_index(m, "/", 1)))


def import_allowlist(pairs: DataFrame, packages: DataFrame, code: str = "response", key: str = "id", name: str = "name") -> DataFrame:
    """Pairs that import known packages only. Names alone are exploded and matched."""
    used = pairs.select(F.col(key).alias("_key"), F.explode(imports_of(code)).alias("_name"))
    unknown = used.join(packages.select(F.col(name).alias("_name")).distinct(), "_name", "left_anti").select("_key").distinct()
    return pairs.join(unknown, F.col(key) == F.col("_key"), "left_anti")


def gate_report(df: DataFrame, gates: dict[str, Column]) -> DataFrame:
    """``(gate, rejected)``: how many rows each gate rejects, in one scan."""
    counted = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in gates.items()])
    return counted.select(F.inline(F.array(*[F.struct(F.lit(n).alias("gate"), F.col(n).alias("rejected")) for n in gates])))
