"""Run registered queries and their SQL checks side by side: python -m checks.compare [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks import oracle, registry
from widefold.plans.small_side import clear_intermediates

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def canonical(rows: list[tuple], names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(value: object) -> str:
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
        return str(value)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, connection: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str:
    """'' when both results hold the same columns and rows, else what differs."""
    df = registry.build()[name](spark, sf_dir)
    ours = canonical([tuple(r) for r in df.collect()], df.columns)
    result = connection.execute(oracle.build()[name])
    names = [d[0] for d in result.description]
    theirs = canonical(result.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if ours == theirs:
        return ""
    only_ours = [r for r in ours if r not in set(theirs)][:3]
    only_theirs = [r for r in theirs if r not in set(ours)][:3]
    return f"{len(ours)} against {len(theirs)} rows; columns {sorted(names)}; ours {only_ours}; sql {only_theirs}"


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", os.environ.get("CHECKPOINT_DIR", "/tmp/checkpoints"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registry.build())
    spark, connection, failed = session(), connect(sf_dir), 0
    for name in names:
        begin = time.time()
        try:
            difference = compare(spark, connection, name, sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on
            difference = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(difference)
        print(f"{'FAIL' if difference else 'ok':5}{name:28}{time.time() - begin:6.2f}s {difference[:1500]}", flush=True)
    clear_intermediates(spark)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main())
