"""Request cost and speed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import _c


def estimated_cost(
    input_tokens: Column | str,
    output_tokens: Column | str,
    cached_tokens: Column | str,
    price_in: Column | str,
    price_out: Column | str,
) -> Column:
    """Cost from prices per million tokens; cached input is free."""
    zero = F.lit(0)
    billable = F.greatest(zero, F.coalesce(_c(input_tokens), zero) - F.coalesce(_c(cached_tokens), zero))
    return billable / F.lit(1e6) * _c(price_in) + F.coalesce(_c(output_tokens), zero) / F.lit(1e6) * _c(price_out)


def request_cost(reported: Column | str, estimate: Column | str) -> Column:
    """The reported cost when it is known and not zero, else the estimate."""
    return F.coalesce(F.nullif(_c(reported), F.lit(0.0)), _c(estimate), F.lit(0.0))


def tokens_per_second(output_tokens: Column | str, wall_time_ms: Column | str) -> Column:
    wall = _c(wall_time_ms)
    return F.when(wall > 0, _c(output_tokens) / (wall / F.lit(1000.0))).otherwise(F.lit(0.0))
