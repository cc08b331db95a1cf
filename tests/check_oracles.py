"""Compare every query with its SQL, as multisets of rows: python tests/check_oracles.py [sf_dir] [name …]"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    return repr(round(v, 9)) if isinstance(v, float) else repr(v)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def compare(frame, con, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    got = [tuple(r) for r in frame.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    a, b = rows_of(frame.columns, got), rows_of(names, want)
    if a != b:
        return f"{len(got)} rows vs {len(want)}; only here {list((a - b).items())[:2]}; only in SQL {list((b - a).items())[:2]}"
    return None if want else "both empty"


def main() -> int:
    from local_spark import session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = session(), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    failed = 0
    for name in names:
        start = time.time()
        try:
            if name in oracles:
                problem = compare(queries[name](spark, sf_dir), con, oracles[name])
            else:
                problem = None if queries[name](spark, sf_dir).count() else "no rows"
        except Exception as e:  # noqa: BLE001  (report every query)
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:24s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
