"""Tables between stages: series, features, predictions, capacity cases and metadata."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadtide.operators.features import GAP, SEG, TIME, FeatureSpec


def write_partitioned(df: DataFrame, path: str, by: Sequence[str] = ("split", "tag"), mode: str = "overwrite") -> None:
    """Parquet with one folder per partition value. Rebalancing gathers small folders in one
    writer and spreads a large one over several."""
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)


def write_series(ts3: DataFrame, path: str, mode: str = "overwrite") -> None:
    write_partitioned(ts3, path, ("split", "tag"), mode)


def read_series(spark: SparkSession, path: str, split: str | None = None, tag: str | None = None) -> DataFrame:
    """Series table; split and tag prune folders, and later selections prune columns."""
    df = spark.read.parquet(path)
    if split:
        df = df.filter(F.col("split") == split)
    return df.filter(F.col("tag") == tag) if tag else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def prediction_case(
    preds: DataFrame, metric: str, *, window: str, keys: Sequence[str] = (), time_col: str = "bucket_start"
) -> DataFrame:
    """Capacity case of a prediction table: readable times, numbers or 0."""
    number = {"y_true": F.col(metric), "y_pred": F.col("pred")}
    return (
        preds.select(
            *keys,
            F.col(time_col).try_cast("timestamp").alias("timestamp"),
            F.lit(metric).alias("metric"),
            F.lit(window).alias("window"),
            *[
                F.coalesce(F.nanvl(c.try_cast("double"), F.lit(0.0)), F.lit(0.0)).alias(n)
                for n, c in number.items()
            ],
        )
        .filter(F.col("timestamp").isNotNull())
    )


def between(df: DataFrame, start: str, end: str, time_col: str = "timestamp") -> DataFrame:
    """Half-open time range; on a table scan it reaches the file statistics."""
    kind = df.schema[time_col].dataType
    lo, hi = (F.lit(x).cast(kind) for x in (start, end))
    return df.filter((F.col(time_col) >= lo) & (F.col(time_col) < hi))


METADATA_SCHEMA = T.StructType(
    [
        T.StructField("tag", T.StringType()),
        T.StructField("time_col", T.StringType()),
        T.StructField("gap_col", T.StringType()),
        T.StructField("segment_col", T.StringType()),
        T.StructField("horizon_steps", T.IntegerType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("time_features", T.ArrayType(T.StringType())),
        T.StructField("hits_feature_cols", T.ArrayType(T.StringType())),
        T.StructField("bytes_feature_cols", T.ArrayType(T.StringType())),
        T.StructField("all_feature_cols", T.ArrayType(T.StringType())),
        T.StructField("lag_days", T.ArrayType(T.IntegerType())),
        T.StructField("roll_windows", T.ArrayType(T.StringType())),
        T.StructField("gap_policy", T.StringType()),
        T.StructField("generated_at", T.TimestampType()),
    ]
)
GAP_POLICY = "Rows inside an outage are no training rows. Lags and windows end where a segment ends. A feature may be absent, a label may not."


def feature_metadata(spark: SparkSession, tags: Sequence[str], spec: FeatureSpec) -> DataFrame:
    """One row per tag that says which columns a feature table holds."""
    rows = [
        (
            tag,
            TIME,
            GAP,
            SEG,
            spec.horizon_steps,
            dict(spec.labels),
            spec.time_cols,
            spec.feature_cols("hits"),
            spec.feature_cols("bytes_sum"),
            spec.all_cols,
            list(spec.lag_days),
            list(spec.roll_windows),
            GAP_POLICY,
            None,
        )
        for tag in tags
    ]
    return spark.createDataFrame(rows, METADATA_SCHEMA).withColumn("generated_at", F.current_timestamp())


def write_metadata(meta: DataFrame, path: str) -> None:
    meta.coalesce(1).write.mode("overwrite").json(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METADATA_SCHEMA).json(path)


def annotate(df: DataFrame, column: str, info: Mapping[str, object]) -> DataFrame:
    """Attach key-value metadata to a column; it travels with the schema into Parquet."""
    return df.withMetadata(column, json.loads(json.dumps(info)))
