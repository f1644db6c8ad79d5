"""Run registered queries and their oracles side by side: python -m checks.compare [sf_dir] [query ...]"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = connection.sql(sql)
    names = sorted(result.columns)
    return names, sorted(result.select(*names).fetchall(), key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(row) for row in df.select(*names).collect()), key=repr)


def main(sf_dir: str, wanted: list[str]) -> int:
    from checks.queries import ORACLES, QUERIES

    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in wanted or QUERIES:
        began = time.time()
        got_names, got = spark_rows(QUERIES[name](spark, sf_dir))
        took = time.time() - began
        began = time.time()
        want_names, want = oracle_rows(sf_dir, ORACLES[name])
        same = got_names == want_names and got == want
        failed += not same
        print(f"{'ok  ' if same else 'FAIL'} {name}: {len(got)} rows, spark {took:.1f}s, oracle {time.time() - began:.1f}s",
              flush=True)
        if not same:
            print("   columns", got_names, want_names)
            print("   only spark ", sorted(set(got) - set(want), key=repr)[:3])
            print("   only oracle", sorted(set(want) - set(got), key=repr)[:3])
            print("   rows", len(got), len(want))
    return failed


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(main(folder, sys.argv[2:]))
