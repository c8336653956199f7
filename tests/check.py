"""Compares registered queries with their SQL: python tests/check.py [sf_dir] [query ...]

HOT_ROWS=200 in the environment makes groups above 200 rows count as hot, so that scans are split.
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle(sf_dir):
    import duckdb

    db = duckdb.connect()
    db.execute("set timezone = 'UTC'")
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(row[i] for i in order) for row in rows), key=repr)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def compare(df, db, sql):
    """None if equal, else what differs."""
    got_columns, got = canonical(df.columns, map(tuple, df.collect()))
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    want_columns, want = canonical(columns, result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} against {want_columns}"
    types = {c: str(d[1]) for c, d in zip(columns, result.description)}
    spark_types = {c: KINDS.get(k, k) for c, k in df.dtypes}
    wrong = {c: (spark_types[c], types[c]) for c in types if spark_types[c] != types[c]}
    if got != want:
        extra, lost = set(got) - set(want), set(want) - set(got)
        return f"{len(got)} rows against {len(want)}; e.g. spark {list(extra)[:2]} sql {list(lost)[:2]}"
    return f"types {wrong}" if wrong else None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    if "HOT_ROWS" in os.environ:
        from commitpost.plans import scan

        scan.HOT_ROWS = int(os.environ["HOT_ROWS"])
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    db = oracle(sf_dir)
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            problem = compare(df, db, sql) if sql else None
            rows = df.count()
            verdict = "no SQL" if not sql and not problem else problem or "ok"
        except Exception as error:
            rows, verdict = -1, f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28} {rows:8} rows {time.time() - start:6.1f} s  {verdict}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
