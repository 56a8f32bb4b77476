"""Run registered queries next to their SQL counterparts and compare rows, names and types.

``python -m tests.compare [sf or folder] [query ...]``
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()
# DuckDB and Spark spell the same types differently.
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean"}


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def oracle_table(con, sql: str):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    rows = cursor.fetchall()
    types = {r[0]: TYPES.get(r[1], r[1].lower()) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return names, types, rows


def difference(spark_df, con, sql: str) -> tuple[str | None, int]:
    """(description of the first difference or None, row count)."""
    names, types, rows = oracle_table(con, sql)
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(names)}", 0
    ours_types = dict(spark_df.dtypes)
    wrong = [(n, ours_types[n], types[n]) for n in names if ours_types[n] != types[n]]
    got = [tuple(r) for r in spark_df.select(*names).collect()]
    if wrong:
        return f"types {wrong}", len(got)
    ours, theirs = Counter(got), Counter(rows)
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        return (
            f"{len(got)} vs {len(rows)} rows; only ours {list(extra)[:3]} ({sum(extra.values())}); "
            f"only oracle {list(missing)[:3]} ({sum(missing.values())})"
        ), len(got)
    return None, len(got)


def main() -> int:
    root = Path(__file__).resolve().parents[1]
    sys.path.insert(0, str(root))
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    folder = sf if "/" in sf else f"/root/testdata/sf{sf}"
    spark, con = make_session(), connect(folder)
    oracle, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name not in oracle:
                print(f"{'rows':5} {name} {df.count()} rows {time.time() - start:.1f}s", flush=True)
                continue
            problem, rows = difference(df, con, oracle[name])
        except Exception as error:  # report and go on to the next query
            problem, rows = f"{type(error).__name__}: {str(error)[:900]}", 0
        bad += problem is not None
        print(f"{'ok' if problem is None else 'BAD':5} {name} {rows} rows {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("differences:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
