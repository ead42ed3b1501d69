"""Run queries and their SQL side by side and report differences."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, "" if v is None else str(v)) for v in row)


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b and type(a) is type(b)


def differences(df, con, sql):
    """None if names and rows agree exactly, else a short text."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    order = sorted(names)
    actual = sorted((tuple(r[c] for c in order) for r in df.collect()), key=_key)
    at = [names.index(c) for c in order]
    expected = sorted((tuple(r[i] for i in at) for r in expected), key=_key)
    if len(actual) != len(expected):
        return f"{len(actual)} rows against {len(expected)}"
    for a, e in zip(actual, expected):
        if not all(map(_same, a, e)):
            return f"{order}: {a} against {e}"
    return None


if __name__ == "__main__":
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from skyroute.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session(8, spark__ui__showConsoleProgress="false")
    con = duck(sf_dir)
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            if sql:
                note = differences(run(spark, sf_dir), con, sql) or "same"
            else:
                rows = run(spark, sf_dir).collect()
                note = f"{len(rows)} rows {rows[:3] if len(rows) < 20 else ''}"
        except Exception as error:
            note = f"ERROR {str(error)[:600]}"
        print(f"{name:24s} {time.time() - began:6.1f}s {note}", flush=True)
