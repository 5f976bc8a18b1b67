"""Run registered queries next to their SQL in DuckDB and compare columns, row count and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else f"{v:.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6f}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(str(_plain(x)) for x in v) + "]"
    return v


_KINDS = {
    "tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "int",
    "string": "text", "varchar": "text", "double": "float", "float": "float", "boolean": "bool",
    "date": "date",
}


def _kind(t: str) -> str:
    t = t.lower()
    return _KINDS.get(t, "time" if t.startswith("timestamp") else t)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    rel = con.sql(sql)
    want_cols = {c: _kind(str(t)) for c, t in zip(rel.columns, rel.types)}
    got_cols = {c: _kind(t) for c, t in df.dtypes}
    if want_cols != got_cols:
        return f"schema: spark {got_cols} oracle {want_cols}"
    names = sorted(want_cols)
    got = [tuple(_plain(r[c]) for c in names) for r in df.collect()]
    order = [rel.columns.index(c) for c in names]
    want = [tuple(_plain(r[i]) for i in order) for r in rel.fetchall()]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    got.sort(key=key), want.sort(key=key)
    if len(got) != len(want):
        return f"rows: spark {len(got)} oracle {len(want)}; only spark {[x for x in got if x not in set(want)][:2]}, only oracle {[x for x in want if x not in set(got)][:2]}"
    for g, w in zip(got, want):
        if g != w:
            return f"values: {names} spark {g} oracle {w}"
    return None


def main(argv: list[str]) -> None:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from larder.session import local_session

    sf_dir = argv[0]
    spark, con = local_session(8), connect(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if len(argv) > 1 and not any(name.startswith(a) for a in argv[1:]):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                problem = compare(df, con, sqls[name])
                n = ""
            else:
                problem, n = None, f"rows only: {df.count()}"
        except Exception as e:  # report and go on with the next query
            problem, n = f"{type(e).__name__}: {str(e)[:700]}", ""
        bad += problem is not None
        print(f"{'BAD ' if problem else 'ok  '} {name} {time.time() - t0:.1f}s {n} {problem or ''}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
