"""Long metrics: CSV scan with repair, append-only table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the long metrics table.
METRIC_COLS = ["model", "target", "window", "split", "metric", "value"]
STORE_SCHEMA = "batch bigint, run_id string, seq bigint, model string, target string, window string, split string, metric string, value double"


def _typed(df: DataFrame, name: str):
    kind = "double" if name == "value" else "string"
    return (F.col(name).try_cast(kind) if name in df.columns else F.lit(None).cast(kind)).alias(name)


def load_metrics_csv(spark: SparkSession, path: str | None) -> DataFrame:
    """Metrics of a CSV folder or file. A missing path gives no rows, a missing column
    NULLs; other columns are left out."""
    empty = spark.createDataFrame([], ", ".join(f"{c} {'double' if c == 'value' else 'string'}" for c in METRIC_COLS))
    if not path:
        return empty
    try:
        found = spark.read.option("header", True).csv(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return empty
        raise
    return found.select(*[_typed(found, c) for c in METRIC_COLS])


def append_metrics(long: DataFrame, path: str, run_id: str) -> None:
    """Append rows under a run id. ``batch`` is one more than the largest so far, ``seq`` keeps the order within it.

    A run id may come again; its rows are a later batch. One writer at a time.
    """
    spark = long.sparkSession
    try:
        last = read_metrics(spark, path).agg(F.max("batch")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        last = None
    long.select(
        F.lit((last or 0) + 1).cast("bigint").alias("batch"),
        F.lit(run_id).alias("run_id"),
        F.monotonically_increasing_id().alias("seq"),
        *[F.col(c) for c in METRIC_COLS],
    ).write.mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORE_SCHEMA).parquet(path)


class MetricsWriter:
    """Appends metric rows of one run to a table."""

    def __init__(self, spark: SparkSession, path: str, run_id: str):
        self.spark, self.path, self.run_id = spark, path, run_id

    def write(self, rows: Sequence[dict]) -> None:
        data = [tuple(r[c] for c in METRIC_COLS) for r in rows]
        kinds = ", ".join(f"{c} {'double' if c == 'value' else 'string'}" for c in METRIC_COLS)
        append_metrics(self.spark.createDataFrame(data, kinds), self.path, self.run_id)

    def write_one(self, *, model: str, target: str, window: str, split: str, metrics: dict) -> None:
        same = {"model": model, "target": target, "window": window, "split": split}
        self.write(
            [
                {**same, "metric": name, "value": None if v is None else float(v)}
                for name, v in metrics.items()
            ]
        )
