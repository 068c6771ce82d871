"""Display formatting for small report tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import _c


def short_sha(sha: Column | str) -> Column:
    return F.left(_c(sha), F.lit(8))


def size_mb(n_bytes: Column | str) -> Column:
    return F.round(_c(n_bytes) / F.lit(1e6), 1)


def percentage(part: Column | str, total: Column | str) -> Column:
    return F.round(F.lit(100.0) * _c(part) / _c(total), 1)
