"""Run registered queries against their SQL in DuckDB: ``python -m tests.oracle [sf] [name …]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
ROOT = Path("/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if value is None:
        return "null"
    return f"{type(value).__name__}:{value}"


def _canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, oracle: str, sf_dir: str) -> str | None:
    """None when the rows agree, else what differs."""
    df = fn(spark, sf_dir)
    left = _canon(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(oracle)
    names = [d[0] for d in rel.description]
    right = _canon(names, rel.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} vs {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} vs {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b:
            return f"first difference: {a} vs {b}"[:600]
    return None


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry

    from corpusloom.session import build_session

    sf_dir = str(ROOT / f"sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}")
    only = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, fn, oracles[name], sf_dir)
                note = problem or "ok"
            else:
                note, problem = f"rows only: {fn(spark, sf_dir).count()}", None
        except Exception as exc:  # report and go on with the next query
            problem = note = f"{type(exc).__name__}: {str(exc)[:700]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'pass'} {name:28s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
