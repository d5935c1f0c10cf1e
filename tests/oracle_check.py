"""Run registered queries in Spark and their oracle SQL in DuckDB and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Comparison: same column names (sorted), same row count, same multiset of
rows after normalising values (floats rounded to 9 significant digits,
dates/timestamps to ISO strings).  Exits non-zero on any mismatch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, float):
        if math.isnan(v):
            return ("f", "nan")
        return ("n", float(f"{v:.9g}"))
    if isinstance(v, int):
        return ("n", float(v)) if abs(v) < 2**53 else ("n", v)
    if isinstance(v, decimal.Decimal):
        return ("n", float(f"{float(v):.9g}"))
    if isinstance(v, dt.datetime):
        return ("t", v.isoformat())
    if isinstance(v, dt.date):
        return ("t", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(norm(x) for x in v))
    if isinstance(v, dict):
        return ("m", tuple(sorted((k, norm(x)) for k, x in v.items())))
    return ("s", str(v))


SPARK_TYPES = {"int": "int32", "bigint": "int64", "smallint": "int16", "tinyint": "int8", "double": "float64",
               "float": "float32", "string": "string", "date": "date", "timestamp_ntz": "timestamp",
               "timestamp": "timestamp_tz", "boolean": "bool"}
DUCK_TYPES = {"INTEGER": "int32", "BIGINT": "int64", "SMALLINT": "int16", "TINYINT": "int8", "DOUBLE": "float64",
              "FLOAT": "float32", "VARCHAR": "string", "DATE": "date", "TIMESTAMP": "timestamp",
              "TIMESTAMP WITH TIME ZONE": "timestamp_tz", "BOOLEAN": "bool", "HUGEINT": "int128"}


def spark_type(t) -> str:
    n = t.simpleString()
    return "decimal" if n.startswith("decimal") else SPARK_TYPES.get(n, n)


def duck_type(t) -> str:
    n = str(t).upper()
    return "decimal" if n.startswith("DECIMAL") else DUCK_TYPES.get(n, n)


def type_diffs(df, rel) -> dict:
    """Columns whose Spark and DuckDB types fall in different categories."""
    s = {f.name: spark_type(f.dataType) for f in df.schema.fields}
    d = {c: duck_type(t) for c, t in zip(rel.columns, rel.types)}
    return {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}


def duck_conn(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def spark_rows(df):
    cols = df.columns
    rows = [tuple(r[c] if not hasattr(r[c], "asDict") else r[c].asDict(recursive=True)
                  for c in cols) for r in df.collect()]
    return cols, rows


def compare(name, s_cols, s_rows, d_cols, d_rows):
    if sorted(s_cols) != sorted(d_cols):
        return f"columns differ: spark={s_cols} duck={d_cols}"
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sc = Counter(tuple(norm(r[i]) for i in si) for r in s_rows)
    dc = Counter(tuple(norm(r[i]) for i in di) for r in d_rows)
    if len(s_rows) != len(d_rows):
        msg = f"row count spark={len(s_rows)} duck={len(d_rows)}"
    elif sc != dc:
        msg = "values differ"
    else:
        return None
    only_s = list((sc - dc).elements())[:3]
    only_d = list((dc - sc).elements())[:3]
    return f"{msg}; cols={order}\n  spark-only={only_s}\n  duck-only={only_d}"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from usagelens.session import get_session
    import __spark_entry__ as E

    spark = get_session("local[8]", shuffle_partitions=8)
    qs, oracles = E.queries(), E.oracle_sql()
    con = duck_conn(sf_dir)
    bad = 0
    for name in (names or sorted(qs)):
        t0 = time.time()
        try:
            s_cols, s_rows = spark_rows(qs[name](spark, sf_dir))
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(ex).__name__}: {str(ex)[:600]}")
            bad += 1
            continue
        ts = time.time() - t0
        sql = oracles.get(name)
        if not sql:
            print(f"ROWS {name}: {len(s_rows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sql)
            d_cols = [c[0] for c in cur.description]
            d_rows = cur.fetchall()
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(ex)[:600]}")
            bad += 1
            continue
        err = compare(name, s_cols, s_rows, d_cols, d_rows)
        if err:
            bad += 1
            print(f"FAIL {name}: {err}")
        else:
            print(f"OK   {name}: {len(s_rows)} rows {ts:.1f}s")
    print(f"{bad} failing of {len(names or qs)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
