"""Rules over chat records, one row per violation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted roles.
ROLES = ["system", "user", "assistant"]


def _error(code: str, detail: Column | str = "") -> Column:
    detail = F.lit(detail) if isinstance(detail, str) else detail
    return F.struct(F.lit(code).alias("code"), F.coalesce(detail, F.lit("")).alias("detail"))


def _maybe(condition: Column, error: Column) -> Column:
    """One-element array when the condition holds, else empty."""
    return F.when(F.coalesce(condition, F.lit(False)), F.array(error)).otherwise(F.array().cast(_ERRORS))


_ERRORS = "array<struct<code:string,detail:string>>"


def _message_errors(m: Column, j: Column) -> Column:
    at = F.concat(F.lit("message "), j.cast("string"))
    bad_role = ~F.coalesce(m["role"].isin(ROLES), F.lit(False))
    return F.when(~m["is_object"], F.array(_error("E5", at))).otherwise(F.concat(
        _maybe(~m["has_role"], _error("E6", at)),
        _maybe(m["has_role"] & bad_role, _error("E7", F.concat(at, F.lit(": "), F.coalesce(m["role"], F.lit("null"))))),
        _maybe(~m["has_content"], _error("E8", at)),
        _maybe(m["has_content"] & ~m["text_content"], _error("E9", at)),
    ))


def _sequence_error(pair: Column) -> Column:
    previous, current = pair["previous"], pair["current"]

    def wrong(role, following, code):
        return (previous == role) & ~F.coalesce(current == following, F.lit(False)), _error(code, current)

    checks = [wrong("system", "user", "E11"), wrong("user", "assistant", "E12"), wrong("assistant", "user", "E13")]
    result = F.array().cast(_ERRORS)
    for condition, error in reversed(checks):
        result = F.when(F.coalesce(condition, F.lit(False)), F.array(error)).otherwise(result)
    return result


def _errors(state: str = "_state", messages: str = "_messages") -> Column:
    """All violations in reporting order, from normalised messages."""
    m = F.col(messages)
    n = F.size(m)
    roles = F.transform(F.filter(m, lambda x: x["is_object"] & x["has_role"]), lambda x: x["role"])
    first, last = F.get(roles, F.lit(0)), F.get(roles, F.size(roles) - 1)
    has_roles = F.size(roles) > 0
    short = F.greatest(F.size(roles) - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice(roles, F.lit(1), short), F.slice(roles, F.lit(2), short),
        lambda a, b: F.struct(a.alias("previous"), b.alias("current")),
    )
    per_message = F.concat(
        _maybe(n < 2, _error("E4")),
        F.flatten(F.transform(m, _message_errors)),
        _maybe(has_roles & ~F.coalesce(first.isin("system", "user"), F.lit(False)), _error("E10", first)),
        F.flatten(F.transform(pairs, _sequence_error)),
        _maybe(has_roles & ~F.coalesce(last == "assistant", F.lit(False)), _error("E14", last)),
    )
    return (
        F.when(F.col(state) == "missing", F.array(_error("E1")))
        .when(F.col(state) == "other", F.array(_error("E2")))
        .when(n == 0, F.array(_error("E3")))
        .otherwise(per_message)
    )


def _normalise_typed(df: DataFrame, key: str) -> DataFrame:
    messages = F.transform("messages", lambda m: F.struct(
        m.isNotNull().alias("is_object"), m["role"].isNotNull().alias("has_role"), m["role"].alias("role"),
        m["content"].isNotNull().alias("has_content"), m["content"].isNotNull().alias("text_content"),
    ))
    state = F.when(F.col("messages").isNull(), "missing").otherwise("list")
    return df.select(F.col(key).alias("entry_key"), state.alias("_state"), messages.alias("_messages"))


def _normalise_raw(df: DataFrame, key: str, raw: str) -> DataFrame:
    """VARIANT keeps absent keys, nulls and types apart; types are read message by message because
    the schema of a whole array merges its elements."""
    entry = df.select(F.col(key).alias("entry_key"), F.try_parse_json(raw).alias("_v"))
    field = entry.withColumn("_m", F.expr("try_variant_get(_v, '$.messages', 'variant')"))
    kind = F.expr("schema_of_variant(_m)")
    state = F.when(F.col("_m").isNull(), "missing").when(kind.startswith("ARRAY"), "list").otherwise("other")
    items = F.expr("""
        transform(try_cast(_m AS array<variant>), m -> named_struct(
          'is_object', schema_of_variant(m) LIKE 'OBJECT%',
          'has_role', variant_get(m, '$.role', 'variant') IS NOT NULL,
          'role', try_variant_get(m, '$.role', 'string'),
          'has_content', variant_get(m, '$.content', 'variant') IS NOT NULL,
          'text_content', coalesce(schema_of_variant(variant_get(m, '$.content', 'variant')) = 'STRING', false)))""")
    tagged = field.withColumn("_state", state)
    return tagged.select("entry_key", "_state", F.when(F.col("_state") == "list", items).alias("_messages"))


def with_errors(df: DataFrame, key: str, raw: str | None = None) -> DataFrame:
    """``(entry_key, errors)`` for typed ``messages``, or for JSON text in column ``raw``."""
    normal = _normalise_raw(df, key, raw) if raw else _normalise_typed(df, key)
    return normal.select("entry_key", _errors().alias("errors"))


def validate_chat(df: DataFrame, key: str, raw: str | None = None) -> DataFrame:
    """One row ``(entry_key, ord, code, detail)`` per violation, ``ord`` in rule order.

    Codes: E1 no messages; E2 messages not a list; E3 empty; E4 fewer than two; E5 message not an
    object; E6 role missing; E7 unknown role; E8 content missing; E9 content not text; E10 first
    role; E11-E13 order after system, user, assistant; E14 last role. Typed rows report a null
    content as E8, since they cannot tell it from an absent one.
    """
    exploded = with_errors(df, key, raw).select("entry_key", F.posexplode("errors").alias("ord", "e"))
    return exploded.select("entry_key", "ord", "e.code", "e.detail")


def validation_summary(df: DataFrame, key: str, raw: str | None = None) -> DataFrame:
    """Entries, valid entries, their share and the verdict; an empty set of records fails."""
    checked = with_errors(df, key, raw)
    return checked.agg(
        F.count(F.lit(1)).alias("entries"), F.count_if(F.size("errors") == 0).alias("valid"),
        F.coalesce(F.sum(F.size("errors")), F.lit(0)).alias("errors"),
    ).withColumns({
        "valid_percent": F.when(F.col("entries") > 0, F.lit(100.0) * F.col("valid") / F.col("entries")).otherwise(0.0),
        "passed": (F.col("entries") > 0) & (F.col("errors") == 0),
    })


def limit_errors(errors: DataFrame, n: int = 20) -> DataFrame:
    return errors.orderBy("entry_key", "ord").limit(n)


def quick_valid(messages: str = "messages", allow_null_content: bool = False) -> Column:
    """Not empty, every message has a known role, the assistant speaks last.

    Typed rows cannot tell an absent content from a null one: by default both are rejected,
    ``allow_null_content=True`` (what ``mix_sources`` uses) keeps both.
    """
    def fine(m):
        known = m["role"].isin(ROLES)
        return known if allow_null_content else known & m["content"].isNotNull()

    good = (
        (F.size(messages) > 0) & F.forall(messages, fine) & (F.try_element_at(messages, F.lit(-1))["role"] == "assistant")
    )
    return F.coalesce(good, F.lit(False))


def quick_valid_messages(df: DataFrame, allow_null_content: bool = False) -> DataFrame:
    return df.filter(quick_valid(allow_null_content=allow_null_content))


def role_sequence_violations(df: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """Number of records whose roles are not exactly ``expected``."""
    wanted = F.array(*[F.lit(r) for r in (expected or ROLES)])
    same = F.coalesce(F.transform("messages", lambda m: m["role"]) == wanted, F.lit(False))
    return df.agg(F.count_if(~same).alias("violations"))
