"""Row keys and seeded hashes. Hashes that decide an output use md5/sha2 so that any engine can
reproduce them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import _c


def record_id(owner: Column | str, name: Column | str, path: Column | str) -> Column:
    return F.concat_ws("/", _c(owner), _c(name), _c(path))


def repo_key(owner: Column | str, name: Column | str) -> Column:
    return F.concat_ws("/", _c(owner), _c(name))


def owner_repo(owner: Column | str, name: Column | str) -> Column:
    """Lower-cased match key."""
    return F.lower(repo_key(owner, name))


def content_key(col: Column | str) -> Column:
    return F.sha2(_c(col), 256)


def digest(col: Column | str) -> Column:
    """``content_key`` as 32 bytes, for use as a shuffle key."""
    return F.unhex(content_key(col))


def seeded_hash(seed: int, *cols: Column | str) -> Column:
    """md5 of ``seed|col|…``; nulls hash like empty strings."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def hash_number(hashed: Column, digits: int = 8) -> Column:
    """Leading hex digits of a hash as a number."""
    return F.conv(F.substring(hashed, 1, digits), 16, 10).cast("long")


def pick(seed: int, n: int, *cols: Column | str) -> Column:
    """Reproducible choice in ``0..n-1``."""
    return (hash_number(seeded_hash(seed, *cols)) % F.lit(n)).cast("int")


def is_official(owner: Column | str, official_owners: list[str]) -> Column:
    return _c(owner).isin(official_owners)


def tier(official: Column | str, stars: Column | str, top_stars: int = 10) -> Column:
    return (
        F.when(_c(official), "official").when(_c(stars) >= top_stars, "community_top").otherwise("community")
    )
