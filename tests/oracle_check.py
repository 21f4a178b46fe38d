"""Run registered queries against their DuckDB oracles, like the driver does.

    python tests/oracle_check.py [sf_dir] [key ...]

Prints one line per key: rows (spark/oracle), column-name, column-type and value match.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, Decimal):
        return repr(float(v))
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    return str(v)


# Spark simpleString -> DuckDB type name, for the column-type comparison.
TYPE_NAMES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
              "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def rows_of_spark(df):
    cols = df.columns
    return cols, [tuple(norm(r[c]) for c in cols) for r in df.collect()]


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    cols = rel.columns
    return cols, [tuple(norm(v) for v in r) for r in rel.fetchall()]


def compare(spark, sf_dir: str, key: str, query, sql: str | None, con) -> dict:
    t = time.time()
    df = query(spark, sf_dir)
    s_cols, s_rows = rows_of_spark(df)
    out = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(time.time() - t, 2)}
    if sql is None:
        out["oracle"] = None
        return out
    o_cols, o_rows = rows_of_duck(con, sql)
    out["oracle_rows"] = len(o_rows)
    out["cols_match"] = sorted(s_cols) == sorted(o_cols)
    s_types = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema}
    rel = con.sql(sql)
    o_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    out["types_match"] = s_types == o_types
    if not out["types_match"]:
        out["types"] = (s_types, o_types)
    if out["cols_match"]:
        order = [o_cols.index(c) for c in s_cols]
        o_rows = [tuple(r[i] for i in order) for r in o_rows]
    out["values_match"] = Counter(s_rows) == Counter(o_rows)
    if not out["values_match"]:
        a, b = Counter(s_rows), Counter(o_rows)
        out["only_spark"] = list((a - b).elements())[:3]
        out["only_oracle"] = list((b - a).elements())[:3]
        out["cols"] = (s_cols, o_cols)
    return out


def main(argv):
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from marquee.session import get_spark
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for k in keys or list(qs):
        try:
            r = compare(spark, sf_dir, k, qs[k], sqls.get(k), con)
        except Exception as e:  # report and go on
            r = {"key": k, "error": repr(e)[:400]}
        ok = (r.get("values_match", r.get("oracle", 0) is None) and "error" not in r
              and r.get("types_match", True))
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{bad} bad of {len(keys or qs)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
