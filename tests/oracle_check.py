"""Run every query next to its SQL text and compare rows, column names and values."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


KIND = {"BOOLEAN": "boolean", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date"}


def duck(base: str):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(base, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"f{value:.6f}" if value != 0 else ("f-0" if math.copysign(1, value) < 0 else "f0.000000")
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def key(row):
    return tuple((v is None, str(v)) for v in row)


def compare(spark, con, name, fn, text, base):
    """None if equal, else a short description of the first difference; with the run time."""
    started = time.time()
    df = fn(spark, base)
    got_rows = [tuple(r) for r in df.collect()]
    took = time.time() - started
    if text is None:
        return None, took, len(got_rows)
    cursor = con.execute(text)
    want_names = [d[0] for d in cursor.description]
    want_rows = cursor.fetchall()
    if sorted(df.columns) != sorted(want_names):
        return f"columns {sorted(set(df.columns) ^ set(want_names))[:6]}", took, len(got_rows)
    kinds = {d[0]: KIND.get(str(d[1]), str(d[1])) for d in cursor.description}
    wrong = [(n, t, kinds[n]) for n, t in df.dtypes if kinds[n] != t]
    if wrong:
        return f"types {wrong[:6]}", took, len(got_rows)
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    worder = sorted(range(len(want_names)), key=lambda i: want_names[i])
    got = sorted((tuple(plain(r[i]) for i in order) for r in got_rows), key=key)
    want = sorted((tuple(plain(r[i]) for i in worder) for r in want_rows), key=key)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", took, len(got)
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            names = [df.columns[i] for i in order]
            diff = [(n, x, y) for n, x, y in zip(names, a, b) if x != y or type(x) is not type(y)]
            return f"values {diff[:4]}", took, len(got)
    return None, took, len(got)


def main(base: str, only: list[str]) -> int:
    import __spark_entry__ as e
    from natalis.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("OFF")
    con = duck(base)
    texts, bad = e.oracle_sql(), 0
    for name, fn in e.queries().items():
        if only and name not in only:
            continue
        try:
            problem, took, n = compare(spark, con, name, fn, texts.get(name), base)
        except Exception as error:  # noqa: BLE001
            problem, took, n = f"{type(error).__name__}: {str(error)[:600]}", 0.0, -1
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:32s} {took:6.2f}s rows={n}"
              f"{'' if name in texts else ' (no sql)'} {problem or ''}", flush=True)
    missing = sorted(set(texts) - set(e.queries()))
    print("bad:", bad, "texts without query:", missing)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
