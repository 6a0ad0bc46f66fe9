"""Compare registered queries with their SQL: python tests/oracle.py [folder] [query ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def normal(df: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of text, columns in name order."""

    def text(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return "∅"
        if isinstance(v, (float,)):
            return repr(float(v))
        if isinstance(v, pd.Timestamp):
            return v.isoformat()
        return str(v)

    cols = sorted(df.columns)
    return sorted(tuple(text(v) for v in row) for row in df[cols].astype(object).itertuples(index=False, name=None))


def compare(spark, con, folder, query, sql) -> tuple[str, int, float]:
    start = time.time()
    out = query(spark, folder)
    pdf = pd.DataFrame([r.asDict() for r in out.collect()], columns=out.columns, dtype=object)
    took = time.time() - start
    if sql is None:
        return "rows only", len(pdf), took
    rel = con.execute(sql)
    want = pd.DataFrame(rel.fetchall(), columns=[d[0] for d in rel.description], dtype=object)
    if sorted(pdf.columns) != sorted(want.columns):
        return f"columns {sorted(pdf.columns)} != {sorted(want.columns)}", len(pdf), took
    a, b = normal(pdf), normal(want)
    if a == b:
        return "ok", len(a), took
    only_a = sorted(set(a) - set(b))[:2]
    only_b = sorted(set(b) - set(a))[:2]
    return f"differs {len(a)}/{len(b)} {sorted(pdf.columns)}\n   spark {only_a}\n   sql   {only_b}", len(a), took


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sqls = connect(folder), entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or queries:
        try:
            verdict, rows, took = compare(spark, con, folder, queries[name], sqls.get(name))
        except Exception as e:  # noqa: BLE001
            verdict, rows, took = f"FAILED {str(e)[:600]}", 0, 0.0
        print(f"{name:28s} {rows:8d} {took:6.2f}s  {verdict}", flush=True)
