"""Compare registered queries with their SQL: ``python -m tests.oracle_check [sf] [name...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
ROOT = os.environ.get("SHELFMARK_TESTDATA", "/root/testdata")


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def arrow_rows(table) -> tuple[list[str], list[str], list[tuple]]:
    names = sorted(table.column_names)
    types = [str(table.schema.field(n).type).replace("large_", "") for n in names]
    columns = [table[n].to_pylist() for n in names]
    return names, types, sorted(zip(*columns), key=repr)


def compare(spark, con, function, sql: str, sf_dir: str) -> str:
    """Empty when names, types and rows agree, else the difference."""
    ours = arrow_rows(function(spark, sf_dir).toArrow())
    theirs = arrow_rows(con.sql(sql).to_arrow_table())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if ours[1] != theirs[1]:
        return f"types {ours[0]} {ours[1]} != {theirs[1]}"
    if len(ours[2]) != len(theirs[2]):
        return f"{len(ours[2])} rows != {len(theirs[2])}"
    wrong = [(a, b) for a, b in zip(ours[2], theirs[2]) if a != b]
    return f"{len(wrong)} of {len(ours[2])} rows, first {str(wrong[0])[:600]}" if wrong else ""


def main(sf: str = "sf0.01", *names: str) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, failed = f"{ROOT}/{sf}", 0
    con, oracle = connect(sf_dir), entry.oracle_sql()
    for name, function in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracle:
                result = compare(spark, con, function, oracle[name], sf_dir) or "ok"
            else:
                result = f"rows only: {function(spark, sf_dir).count()}"
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:700]}"
        failed += result != "ok" and not result.startswith("rows only")
        print(f"{name:24s} {time.time() - start:6.1f}s {result}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
