"""Run registered queries and their SQL side by side.

    python tests/compare.py [sf_dir] [name prefix ...]
"""

import math
import os
import sys
import time
from datetime import date, datetime
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        v = int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, datetime):
        return v.isoformat()
    if isinstance(v, date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return f"{type(v).__name__}:{v}" if v is not None else "null"


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark_df, relation):
    """None if both sides agree, otherwise a short description."""
    got_cols, got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    want_cols, want = canonical(relation.columns, relation.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} and {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows and {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main(argv):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failures = 0
    for name, build in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = difference(build(spark, sf_dir), con.sql(oracles[name]))
                note = "ok"
            else:
                problem, note = None, f"rows only: {len(build(spark, sf_dir).collect())}"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failures += problem is not None
        print(f"{time.time() - start:6.1f}s {'FAIL' if problem else note:5s} {name} {problem or ''}", flush=True)
    print("failures", failures)
    spark.stop()
    return failures


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv)))
