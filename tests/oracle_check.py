"""Run catalogue queries next to their SQL twins and compare every row.

``python tests/oracle_check.py [sf_dir] [query ...]``
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(row):
    out = []
    for value in row:
        if isinstance(value, float):
            value = "nan" if math.isnan(value) else repr(value + 0.0)
        elif value is not None and not isinstance(value, (str, bytes)):
            value = int(value) if isinstance(value, (bool, int)) or value == int(value) else value
            value = repr(float(value)) if not isinstance(value, int) else str(value)
        out.append("\0null" if value is None else str(value))
    return tuple(out)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(canonical(r) for r in df.select(*[f"`{n}`" for n in names]).collect())


def duck_rows(con, sql):
    columns = [r[0] for r in con.sql(f"DESCRIBE {sql}").fetchall()]
    names = sorted(columns)
    picked = ", ".join(f'"{n}"' for n in names)
    return names, sorted(canonical(r) for r in con.sql(f"SELECT {picked} FROM ({sql})").fetchall())


def compare(spark, con, sf_dir, query, sql):
    """None when equal, else what differs."""
    names, mine = spark_rows(query(spark, sf_dir))
    expected_names, expected = duck_rows(con, sql)
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if len(mine) != len(expected):
        return f"{len(mine)} rows != {len(expected)}"
    differing = [(a, b) for a, b in zip(mine, expected) if a != b]
    return f"{len(differing)} rows differ, first {differing[0]}" if differing else None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = duck(sf_dir), contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:] or name not in sql:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, query, sql[name])
        except Exception as err:  # report and go on with the next query
            problem = f"{type(err).__name__}: {str(err)[:1500]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print(f"failed: {failed}")


if __name__ == "__main__":
    main()
