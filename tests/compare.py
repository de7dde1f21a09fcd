"""Compare queries with their SQL: python tests/compare.py SF_DIR [NAME...]"""

from __future__ import annotations

import datetime
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in sorted(Path(sf_dir).glob("*.parquet")):
        at = f"{p}/*.parquet" if p.is_dir() else str(p)
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{at}')")
    return con


def plain(v: object) -> object:
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    return v


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, query, sql: str, sf_dir: str) -> tuple[int, str]:
    """Rows of the query and the difference to its SQL ("" if none)."""
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    out = con.execute(sql)
    names = [d[0] for d in out.description]
    if sorted(names) != columns:
        return sum(got.values()), f"columns {columns} and {sorted(names)}"
    order = [names.index(c) for c in columns]
    want = Counter(tuple(plain(r[k]) for k in order) for r in out.fetchall())
    if got == want:
        return sum(got.values()), ""
    return sum(got.values()), f"{sum((got - want).values())} only in Spark, e.g. {list((got - want))[:3]}; {sum((want - got).values())} only in SQL, e.g. {list((want - got))[:3]}"


if __name__ == "__main__":
    import __spark_entry__ as e

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    names = sys.argv[2:] or [n for n in e.queries()]
    con, sql = views(sys.argv[1]), e.oracle_sql()
    for name in names:
        began = time.time()
        try:
            if name in sql:
                rows, unlike = difference(spark, con, e.queries()[name], sql[name], sys.argv[1])
                print(f"{name}: {rows} rows, {unlike or 'equal'} ({time.time() - began:.1f} s)", flush=True)
            else:
                print(f"{name}: {len(e.queries()[name](spark, sys.argv[1]).collect())} rows, no SQL ({time.time() - began:.1f} s)", flush=True)
        except Exception as x:
            print(f"{name}: {type(x).__name__} {str(x)[:1500]}", flush=True)
