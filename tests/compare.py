"""Run queries on both engines and compare them as unordered rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    fixed = [tuple("NaN" if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in rows]
    return sorted(fixed, key=repr)


def differences(spark_df, con, sql: str) -> str:
    """'' if equal, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = _rows(names, result.fetchall())
    got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if [[type(v) for v in r] for r in got[:1]] != [[type(v) for v in r] for r in want[:1]]:
        return f"types {got[:1]} != {want[:1]}"
    if got == want:
        return ""
    a, b = set(got) - set(want), set(want) - set(got)
    return f"{len(got)} rows vs {len(want)}; only spark {len(a)}: {sorted(a, key=repr)[:2]}; only sql {len(b)}: {sorted(b, key=repr)[:2]}"[:1500]


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from conftest import make_session

    folder, names = sys.argv[1], sys.argv[2:]
    session, con = make_session(), duck(folder)
    sql = entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names:  # all by default
            continue
        start = time.time()
        try:
            frame = query(session, folder)
            frame.write.format("noop").mode("overwrite").save()
            took = time.time() - start
            start = time.time()
            verdict = differences(frame, con, sql[name]) or "ok"
        except Exception as e:  # show and go on with the next query
            took, verdict = time.time() - start, f"ERROR {str(e)[:1500]}"
        print(f"{name:26s} spark {took:6.2f}s  check {time.time() - start:6.2f}s  {verdict}", flush=True)
