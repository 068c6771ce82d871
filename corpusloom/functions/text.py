"""Text measures over whole strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Size classes in lines, completion cut, token estimate.
SIMPLE_BELOW = 100
MEDIUM_BELOW = 500
KEEP_FRACTION = 0.6
KEEP_AT_LEAST = 5
COMPLETION_HINT = "\n// TODO: implement the remaining functions"
CHARS_PER_TOKEN = 2.96


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: Column | str) -> Column:
    """Strip Unicode whitespace on both ends (linear; Spark's plain trim only drops spaces)."""
    return F.btrim(_c(col), F.lit(WHITESPACE))


def lines(col: Column | str) -> Column:
    """Split on newlines, keeping trailing empty lines."""
    return F.split(_c(col), "\n", -1)


def newline_count(col: Column | str) -> Column:
    """Number of newlines by byte arithmetic: no regex engine, no array."""
    c = _c(col)
    return (F.octet_length(c) - F.octet_length(F.replace(c, F.lit("\n"), F.lit("")))).cast("long")


def loc(col: Column | str) -> Column:
    return newline_count(col) + F.lit(1)


def complexity(loc_col: Column | str, simple_below: int = SIMPLE_BELOW, medium_below: int = MEDIUM_BELOW) -> Column:
    n = _c(loc_col)
    return (
        F.when(n < simple_below, "simple").when(n < medium_below, "medium").otherwise("complex")
    )


def source_class(path: Column | str) -> Column:
    """Class of the first path segment."""
    head = F.substring_index(_c(path), "/", 1)
    return F.when(head.isin("src", "test", "examples"), head).otherwise("other")


def unique_line_ratio(col: Column | str) -> Column:
    """Distinct lines over lines of the stripped text; whitespace-only text gives 1.0."""
    c = _c(col)
    # the lambda binds the lines once; spelled out, the text would be split twice
    ratio = F.transform(
        F.array(lines(strip(c))), lambda p: F.size(F.array_distinct(p)).cast("double") / F.size(p).cast("double")
    )[0]
    return F.when(c.isNotNull(), ratio)


def partial_code(col: Column | str, hint: str = COMPLETION_HINT) -> Column:
    """The leading part of a file (60 % of its lines, five at least) followed by a hint."""
    parts = lines(col)
    keep = F.greatest(F.lit(KEEP_AT_LEAST), (F.size(parts) * F.lit(KEEP_FRACTION)).cast("int"))
    return F.concat(F.array_join(F.slice(parts, F.lit(1), keep), "\n"), F.lit(hint))


def estimate_tokens(col: Column | str, chars_per_token: float = CHARS_PER_TOKEN) -> Column:
    return F.ceil(F.length(_c(col)) / F.lit(float(chars_per_token))).cast("long")


def normalize_newlines(col: Column | str) -> Column:
    nl = F.lit("\n")
    return F.replace(F.replace(_c(col), F.lit("\r\n"), nl), F.lit("\r"), nl)


def decode_utf8(content: Column | str) -> Column:
    """Bytes to text; invalid sequences become U+FFFD instead of failing the task."""
    return F.make_valid_utf8(_c(content).cast("string"))
