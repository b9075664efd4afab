"""Run reports on Spark and their SQL on DuckDB over the same tables, and compare.

    python tests/oracle.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "date": "DATE",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql) -> str | None:
    """A description of the first difference, or None."""
    relation = con.sql(sql)
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if types != expected_types:
        return f"schema {types} != {expected_types}"
    ours = canonical(df.columns, df.collect())
    theirs = canonical(relation.columns, relation.fetchall())
    if ours != theirs:
        missing = [r for r in theirs if r not in set(ours)][:3]
        extra = [r for r in ours if r not in set(theirs)][:3]
        return f"rows {len(ours)} vs {len(theirs)}; missing {missing}; extra {extra}"
    return None if ours else "no rows"


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, queries, oracle = duck(folder), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        started = time.time()
        try:
            df = queries[name](spark, folder)
            problem = compare(df, con, oracle[name]) if name in oracle else (None if df.count() else "no rows")
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} {time.time() - started:.2f}s {'' if name in oracle else '(rows only) '}{problem or ''}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
