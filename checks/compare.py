"""Run queries next to their SQL and compare rows, column names and kinds of values.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import tempfile
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

RAW = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, decimal.Decimal):
        return ("decimal", value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def normal(rows, columns) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def expected(sf_dir: str, sql: str) -> tuple[list[str], list]:
    with duckdb.connect() as con:
        for name in RAW:
            con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
        cursor = con.execute(sql)
        return [d[0] for d in cursor.description], cursor.fetchall()


def difference(df: DataFrame, sf_dir: str, sql: str) -> str | None:
    """What differs first, or None."""
    columns, rows = expected(sf_dir, sql)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    got, want = normal(df.collect(), df.columns), normal(rows, columns)
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return None if got else "no rows"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="compare-"))  # one machine: all threads see it
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                wrong = difference(df, sf_dir, ORACLES[name])
            else:
                wrong = f"rows only: {df.count()}"
        except Exception as error:  # the run goes on to the other queries
            wrong = f"{type(error).__name__}: {str(error)[:600]}"
        bad += wrong is not None and not wrong.startswith("rows only")
        print(f"{name:34} {time.time() - start:6.2f}s  {wrong or 'same'}", flush=True)
    print(f"{bad} of {len(names)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
