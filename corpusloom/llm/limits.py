"""Quantiles of a measure among known good documents, by language and length class."""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLASSES = 24  # powers of two; the last one is open

Ranges = list[tuple[float, float]]  # lowest and highest accepted value by length class


def length_class(length: Column) -> Column:
    return F.least(F.floor(F.log2(length + 1)), F.lit(CLASSES - 1)).cast("int")


@dataclass
class Limits:
    """Accepted ranges of every language with good documents, and of all languages together."""

    by_lang: dict[str, Ranges]
    overall: Ranges | None

    def column(self, lang: Column, length: Column, side: int) -> Column:
        """Lowest (side 0) or highest (side 1) accepted value of a row; null without any good document."""
        if self.overall is None:
            return F.lit(None).cast("double")
        at = length_class(length) + 1
        of = lambda ranges: F.element_at(F.array(*[F.lit(float(r[side])) for r in ranges]), at)
        found = reduce(lambda acc, kv: acc.when(lang == kv[0], of(kv[1])), sorted(self.by_lang.items()), F.when(F.lit(False), 0.0))
        return found.otherwise(of(self.overall))


def ranges(cells: list[tuple[int, int, int]], low: float, high: float, least: int) -> Ranges:
    """Range of every length class from ``(class, value, count)``, cutting off the shares ``low`` and ``high``.

    A class with fewer than ``least`` documents takes those of the nearest classes along.
    """
    out = []
    for k in range(CLASSES):
        for reach in range(CLASSES):
            near = sorted((v, n) for c, v, n in cells if abs(c - k) <= reach)
            if sum(n for _, n in near) >= least:
                break
        seen = list(accumulate(n for _, n in near))
        first = bisect_left(seen, int(low * seen[-1]) + 1)
        last = bisect_left(seen, seen[-1] - int(high * seen[-1]))
        out.append((near[first][0], near[last][0]))
    return out


def limits(good: DataFrame, value: Column, length: Column, lang: Column, step: float, low: float, high: float, least: int) -> Limits:
    """Ranges of ``value`` over the rows of ``good``, outward to multiples of ``1 / step``.

    Rows are counted by language, length class and rounded value, so groups stay small whatever the table.
    A language with fewer than ``least`` rows also accepts what all languages together do.
    """
    rows = good.groupBy(lang.alias("_lang"), length_class(length).alias("_class"), F.floor(value * step).alias("_cell")).agg(
        F.count("*").alias("_n")).collect()
    if not rows:
        return Limits({}, None)
    found: dict[str | None, list[tuple[int, int, int]]] = {}
    for r in rows:
        found.setdefault(r["_lang"], []).append((r["_class"], r["_cell"], r["_n"]))
    scaled = lambda cells: [(a / step, (b + 1) / step) for a, b in ranges(cells, low, high, least)]
    overall = scaled([c for cells in found.values() for c in cells])
    by_lang = {}
    for lang_, cells in found.items():
        if lang_ is not None:
            own = scaled(cells)
            few = sum(n for _, _, n in cells) < least
            by_lang[lang_] = [(min(a, c), max(b, d)) for (a, b), (c, d) in zip(own, overall)] if few else own
    return Limits(by_lang, overall)
