"""Files to prompts."""

from __future__ import annotations

from dataclasses import dataclass, field
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.functions.keys import pick
from corpusloom.operators.dedup import latest_per_key

# Task names, prompt wording, instructions and the per-task answer budget.
TASK_TYPES = ["code_gen", "explanation", "completion"]
TASK_MAX_TOKENS = {"explanation": 8192}
DEFAULT_MAX_TOKENS = 4096
SINGLE_PROMPTS = {
    "code_gen": (
        "Based on the following {language} code, write a new {language} module that solves a related but different "
        "problem. Use idiomatic {language}: type annotations, pattern matching, Result for errors, pipe operators "
        "where appropriate.\n\nReference code (from {source_label}):\n```{fence}\n{code}\n```\n\n"
        "Write a {language} module that: {instruction}"
    ),
    "explanation": (
        "Explain the following {language} code in detail. Describe what each function does, how types are used, and "
        "any notable patterns or idioms you notice.\n\n```{fence}\n{code}\n```\n\n"
        "Provide a thorough explanation suitable for someone learning {language}."
    ),
    "completion": (
        "Complete the following partial {language} module. The code has been truncated — finish implementing the "
        "remaining functions to make a complete, working module.\n\n```{fence}\n{partial_code}\n```\n\n"
        "Complete the implementation. Include type annotations and follow {language} conventions."
    ),
}
CODE_GEN_INSTRUCTIONS = [
    "implements a different data structure with similar operations",
    "provides a complementary utility module for the same domain",
    "solves a simplified version of the same problem",
    "extends this module with additional related functionality",
    "implements the inverse or opposite operations",
]
AGENT_ANALYZE = (
    "I'm working with a {language} codebase and looking at this file from {source_label}. Can you analyze it for me?"
    "\n\n```{fence}\n{code}\n```\n\nDescribe the key types, functions, and patterns used. What does this module do?"
)
AGENT_GENERATE = (
    "Thanks for the analysis. Now I need to create some training examples for a {language} coding assistant. Based on "
    "this file, generate 3 diverse instruction-response pairs.\n\nRequirements:\n- Pair 1: A code generation task "
    "(medium difficulty)\n- Pair 2: An explanation task\n- Pair 3: A code completion or refactoring task\n\n"
    "Format each pair EXACTLY like this:\n\n"
    "## Pair 1 [code_gen/medium]\n### Instruction\n<the instruction text>\n### Response\n<the response with {language} "
    "code if applicable>\n\n"
    "## Pair 2 [explanation/easy]\n### Instruction\n<the instruction text>\n### Response\n<the explanation>\n\n"
    "## Pair 3 [completion/medium]\n### Instruction\n<the instruction text>\n### Response\n<the completed code or "
    "refactored solution>\n\n"
    "Make sure any {language} code in responses is syntactically valid and follows idiomatic {language} patterns."
)


@dataclass(frozen=True)
class PromptBook:
    """Wording of the prompts. ``{code}``, ``{partial_code}``, ``{source_label}`` and
    ``{instruction}`` come from the row, ``{language}`` and ``{fence}`` from here."""

    language: str
    system_prompt: str
    fence: str = ""
    single: dict[str, str] = field(default_factory=lambda: dict(SINGLE_PROMPTS))
    instructions: list[str] = field(default_factory=lambda: list(CODE_GEN_INSTRUCTIONS))
    analyze: str = AGENT_ANALYZE
    generate: str = AGENT_GENERATE
    seed: int = 42

    def fill(self, template: str, row: dict[str, Column]) -> Column:
        """Concatenate literals and columns, so braces or percent signs inside code are safe."""
        constants = {"language": self.language, "fence": self.fence or self.language.lower()}
        parts: list[Column] = []
        for literal, name, _, _ in Formatter().parse(template):
            if literal:
                parts.append(F.lit(literal))
            if name in constants:
                parts.append(F.lit(constants[name]))
            elif name:
                parts.append(row[name])
        return F.concat(*parts)

    def template_chars(self) -> int:
        """Characters around the code in the longest code_gen prompt."""
        empty = dict.fromkeys(("code", "source_label", "partial_code"), "")
        wording = self.single["code_gen"].format(
            language=self.language, fence=self.fence or self.language.lower(),
            instruction=max(self.instructions, key=len), **{**empty, "source_label": "repo "},
        )
        return len(wording) + len(self.system_prompt)


def _row(book: PromptBook, seed_cols: tuple[str, ...]) -> dict[str, Column]:
    choice = pick(book.seed, len(book.instructions), *seed_cols)
    return {
        "code": F.col("code"),
        "partial_code": text.partial_code("code"),
        "source_label": F.concat(F.lit("repo "), F.col("repo_name")),
        "instruction": F.get(F.array(*[F.lit(i) for i in book.instructions]), choice),
    }


def user_message(book: PromptBook, task: Column | str = "task_type", seed_cols: tuple[str, ...] = ("id",)) -> Column:
    """User message of a row's task; an unknown task fails the query."""
    task = F.col(task) if isinstance(task, str) else task
    row = _row(book, seed_cols)
    message = F.when(F.lit(False), F.lit(""))
    for name, template in book.single.items():
        message = message.when(task == name, book.fill(template, row))
    return message.otherwise(F.raise_error(F.concat(F.lit("Unknown task type: "), F.coalesce(task, F.lit("null")))))


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def files_x_tasks(df: DataFrame, tasks: list[str] | None = None) -> DataFrame:
    return df.withColumn("task_type", F.explode(F.array(*[F.lit(t) for t in (tasks or TASK_TYPES)])))


def build_prompts(files: DataFrame, book: PromptBook, tasks: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """One prompt per file and task; ``keep`` passes columns of the file through."""
    unknown = set(tasks or TASK_TYPES) - set(book.single)
    if unknown:
        raise ValueError(f"Unknown task type: {sorted(unknown)}")
    budgets = F.lit(DEFAULT_MAX_TOKENS)
    for task, tokens in TASK_MAX_TOKENS.items():
        budgets = F.when(F.col("task_type") == task, F.lit(tokens)).otherwise(budgets)
    system = message("system", F.lit(book.system_prompt))
    return files_x_tasks(files, tasks).select(
        F.array(system, message("user", user_message(book))).alias("messages"), "task_type", F.lit("single").alias("approach"),
        F.col("id").alias("source_file_id"), budgets.alias("max_tokens"), *(keep or []),
    )


def agent_turn1(files: DataFrame, book: PromptBook) -> DataFrame:
    """First turn of a session: analyse the file."""
    user = book.fill(book.analyze, _row(book, ("id",)))
    return files.select(
        F.array(message("system", F.lit(book.system_prompt)), message("user", user)).alias("messages"),
        F.lit("analysis").alias("task_type"), F.lit("agent_session").alias("approach"),
        F.col("id").alias("source_file_id"), F.lit(1).alias("turn"),
    )


def agent_turn2(turn1: DataFrame, responses: DataFrame, book: PromptBook) -> DataFrame:
    """Second turn: the first turn, its latest answer and a fixed request. Sessions whose first turn
    failed have no second one."""
    first = latest_per_key(responses.filter(F.col("turn") == 1), ["source_file_id"])
    answered = first.filter(F.col("error").isNull()).select("source_file_id", "content")
    history = F.concat(
        "messages",
        F.array(message("assistant", F.col("content")), message("user", book.fill(book.generate, {}))),
    )
    return turn1.join(answered, "source_file_id").select(
        history.alias("messages"), F.lit("multi_pair_generation").alias("task_type"), "approach", "source_file_id",
        F.lit(2).alias("turn"),
    )


def prompt_response_pairing(log: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per session with both turns side by side; a missing second turn gives nulls. Of
    repeated turns the latest counts. One aggregation does it; no side is joined with the other."""
    keys = keys or ["provider", "source_file_id"]
    fields = ["request_id", "content", "error"]

    def latest(turn: int) -> Column:
        here = F.col("turn") == turn
        return F.max_by(F.when(here, F.struct(*fields)), F.when(here, F.struct("timestamp", "request_id"))).alias(f"turn{turn}")

    paired = log.groupBy(*keys).agg(latest(1), latest(2)).filter(F.col("turn1").isNotNull())
    return paired.select(*keys, *[F.col(f"turn{t}")[f].alias(f"turn{t}_{f}") for t in (1, 2) for f in fields])
