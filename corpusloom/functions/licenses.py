"""License strings to SPDX identifiers."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import _c, strip

# Accepted identifiers, copyleft identifiers, and known spellings.
PERMISSIVE = [
    "MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "ISC", "Unlicense", "CC0-1.0", "MPL-2.0",
]
COPYLEFT = [
    "GPL-2.0", "GPL-3.0", "AGPL-3.0", "LGPL-2.1", "LGPL-3.0",
    "GPL-2.0-only", "GPL-3.0-only", "AGPL-3.0-only", "GPL-2.0-or-later", "GPL-3.0-or-later",
]
SPELLINGS = {
    "mit": "MIT",
    "mit license": "MIT",
    "the mit license": "MIT",
    "expat": "MIT",
    "apache-2.0": "Apache-2.0",
    "apache 2.0": "Apache-2.0",
    "apache 2": "Apache-2.0",
    "apache license 2.0": "Apache-2.0",
    "apache license, version 2.0": "Apache-2.0",
    "apache license version 2.0": "Apache-2.0",
    "apache-2": "Apache-2.0",
    "bsd-3-clause": "BSD-3-Clause",
    "bsd-2-clause": "BSD-2-Clause",
    "bsd": "BSD-3-Clause",
    "3-clause bsd": "BSD-3-Clause",
    "2-clause bsd": "BSD-2-Clause",
    "simplified bsd": "BSD-2-Clause",
    "new bsd": "BSD-3-Clause",
    "isc": "ISC",
    "isc license": "ISC",
    "unlicense": "Unlicense",
    "the unlicense": "Unlicense",
    "cc0-1.0": "CC0-1.0",
    "cc0": "CC0-1.0",
    "mpl-2.0": "MPL-2.0",
    "mpl 2.0": "MPL-2.0",
    "mozilla public license 2.0": "MPL-2.0",
}


def normalize_license(raw: Column | str, strict: bool = False) -> Column:
    """SPDX identifier, or null for empty and unknown strings.

    Exact spellings first, then ordered substring rules. The rules are deliberately loose ("limited
    use" contains "mit"); ``strict=True`` leaves them out.
    """
    exact = {**{name.lower(): name for name in PERMISSIVE + COPYLEFT}, **SPELLINGS}
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(exact.items())])

    def identify(cleaned: Column) -> Column:
        found = F.try_element_at(table, cleaned)
        if strict:
            return found
        return F.coalesce(
            found,
            F.when(cleaned.contains("mit"), "MIT")
            .when(cleaned.contains("apache"), "Apache-2.0")
            .when(cleaned.contains("bsd") & (cleaned.contains("2") | cleaned.contains("simplified")), "BSD-2-Clause")
            .when(cleaned.contains("bsd"), "BSD-3-Clause")
            .when(cleaned.contains("isc"), "ISC"),
        )

    # the lambda binds the cleaned string once; spelled out, every rule would strip it again
    return F.transform(F.array(F.lower(strip(raw))), identify)[0]


def is_permissive(raw: Column | str, strict: bool = False) -> Column:
    return F.coalesce(normalize_license(raw, strict).isin(PERMISSIVE), F.lit(False))


def check_license(raw: Column | str, strict: bool = False) -> Column:
    """Struct of the identifier, the raw string and the permissive flag."""
    return F.struct(
        normalize_license(raw, strict).alias("license"),
        _c(raw).alias("license_raw"),
        is_permissive(raw, strict).alias("permissive"),
    )
