"""Compare every ``queries()`` entry with its ``oracle_sql()`` twin in DuckDB.

Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``.  Prints one line
per query and exits non-zero on any mismatch.  The comparison is the one the
driver makes: row count, column names, and the multiset of rows with columns
taken in name order.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                  "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_mismatches(df, rel) -> list[str]:
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for f in df.schema.fields:
        want = _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        got = duck_types.get(f.name)
        if got is not None and got != want:
            out.append(f"{f.name}:{want}/{got}")
    return out


def canon(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, names: list[str] | None = None) -> dict[str, str]:
    import __spark_entry__ as e

    qs, sql = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        df = qs[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        if name not in sql:
            out[name] = f"rows-only ({len(s_rows)} rows)"
            continue
        rel = con.sql(sql[name])
        d_cols = rel.columns
        d_rows = rel.fetchall()
        if sorted(s_cols) != sorted(d_cols):
            out[name] = f"COLUMNS spark={s_cols} duck={d_cols}"
        elif len(s_rows) != len(d_rows):
            out[name] = f"ROWCOUNT spark={len(s_rows)} duck={len(d_rows)}"
        elif canon(s_cols, s_rows) != canon(d_cols, d_rows):
            a, b = canon(s_cols, s_rows), canon(d_cols, d_rows)
            diff = list((a - b).items())[:3], list((b - a).items())[:3]
            out[name] = f"VALUES spark-only={diff[0]} duck-only={diff[1]}"
        else:
            tm = type_mismatches(df, rel)
            out[name] = f"ok ({len(s_rows)} rows)" + (f" types spark/duck {tm}" if tm else "")
    return out


if __name__ == "__main__":
    from geoscribe.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:] or None
    spark = build_session("local[8]")
    res = compare(spark, sf, only)
    bad = 0
    for k, v in res.items():
        print(f"{k:24s} {v}")
        bad += not (v.startswith("ok") or v.startswith("rows-only"))
    print(f"{len(res) - bad}/{len(res)} pass")
    sys.exit(1 if bad else 0)
