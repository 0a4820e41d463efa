"""Compare Spark queries with their DuckDB SQL on one data folder.

    python -m catalog.compare /root/testdata/sf0.01 [query prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from catalog.oracle import ORACLES
from catalog.spark_queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float) and (math.isnan(value) or value == 0):
        return None if math.isnan(value) else 0.0
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str | None:
    """None if both sides agree, else what differs first."""
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    res = con.execute(ORACLES[name])
    names = [d[0] for d in res.description]
    want = rows_of(names, res.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{sorted(names)}: {a} != {b}"
    return None


def main() -> None:
    sf_dir, prefixes = sys.argv[1], tuple(sys.argv[2:])
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    bad = 0
    for name in QUERIES:
        if prefixes and not name.startswith(prefixes):
            continue
        if name not in ORACLES:
            print("NO-SQL", name, flush=True)
            continue
        start = time.time()
        try:
            found = difference(spark, con, name, sf_dir)
        except Exception as e:  # report and go on with the next query
            found = f"{type(e).__name__}: {str(e)[:500]}"
        bad += found is not None
        print("OK  " if found is None else "DIFF", name, round(time.time() - start, 2), found or "", flush=True)
    print("different:", bad)


if __name__ == "__main__":
    main()
