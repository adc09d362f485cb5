"""Run queries and their DuckDB SQL side by side: ``python tests/compare.py SF_DIR [NAME ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if value is None or value != value:
        return "NULL"
    if hasattr(value, "isoformat"):
        return value.isoformat()[:19]
    if hasattr(value, "item"):
        value = value.item()
    return repr(value)


def _rows(columns: list[str], rows) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = sorted(tuple(_cell(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], cells


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if columns, number of rows and all values agree, else what does not."""
    names, mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    wanted, theirs = _rows([d[0] for d in result.description], result.fetchall())
    if names != wanted:
        return f"columns {names} != {wanted}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main() -> None:
    from conftest import new_session

    from tickloom.workload import QUERIES

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, con = new_session(), connect(sf_dir)
    bad = 0
    for name in names:
        q, start = QUERIES[name], time.time()
        try:
            df = q.run(spark, sf_dir)
            verdict = difference(df, con, q.sql) if q.sql else f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        ok = verdict is None or verdict.startswith("rows only")
        bad += not ok
        print(f"{'ok  ' if ok else 'BAD '} {name} {time.time() - start:.1f}s {verdict or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
