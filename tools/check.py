"""Local correctness check: run each registered query in Spark and its oracle
SQL in DuckDB on the same parquet tables; compare column names, types, row
counts and order-insensitive values.

    python tools/check.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from salescast.session import get_session  # noqa: E402
from salescast.plans.catalog import queries, oracle_sql  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

SPARK_TO_DUCK = {
    "IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
    "StringType()": "VARCHAR", "DateType()": "DATE", "BooleanType()": "BOOLEAN",
    "TimestampNTZType()": "TIMESTAMP", "FloatType()": "FLOAT",
}


STRICT = "--strict" in sys.argv


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(v) if STRICT else round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def key(row):
    return tuple((x is None, str(type(x)), x) if not isinstance(x, float) else (False, "f", x) for x in row)


def main():
    args = [a for a in sys.argv[1:] if a not in ("--plain", "--strict")]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    pats = args[1:]
    if "--plain" in sys.argv:
        # a vanilla session, as an outside caller would create it
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.sql.session.timeZone", "America/Los_Angeles").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = get_session("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sqls = queries(), oracle_sql()
    ok = bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            srows = [tuple(norm(v) for v in r) for r in sdf.collect()]
            scols = sdf.columns
            stypes = [SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType)) for f in sdf.schema.fields]
        except Exception:
            print(f"FAIL {name}: spark error\n{traceback.format_exc()[-1500:]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            ok += 1
            continue
        try:
            cur = con.execute(sqls[name])
            drows = [tuple(norm(v) for v in r) for r in cur.fetchall()]
            dcols = [d[0] for d in cur.description]
            dtypes = [str(d[1]) for d in cur.description]
        except Exception as e:
            print(f"FAIL {name}: duckdb error {str(e)[:1500]}")
            bad += 1
            continue
        problems = []
        if scols != dcols:
            problems.append(f"cols spark={scols} duck={dcols}")
        tmis = [(c, a, b) for c, a, b in zip(scols, stypes, dtypes)
                if a != b and not (a.startswith("DecimalType") and b.startswith("DECIMAL"))]
        if tmis:
            problems.append(f"types {tmis}")
        if len(srows) != len(drows):
            problems.append(f"rows spark={len(srows)} duck={len(drows)}")
        else:
            ss = sorted(srows, key=key)
            dd = sorted(drows, key=key)
            diff = [(a, b) for a, b in zip(ss, dd) if a != b]
            if diff:
                problems.append(f"{len(diff)} value diffs, e.g. {diff[:2]}")
        if problems:
            print(f"FAIL {name} ({ts:.1f}s): " + " | ".join(problems))
            bad += 1
        else:
            print(f"OK   {name}: {len(srows)} rows {ts:.1f}s")
            ok += 1
    print(f"\n{ok} ok, {bad} failed")


if __name__ == "__main__":
    main()
