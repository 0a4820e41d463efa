"""Access logs, as a batch scan and as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loadtide.functions import logline as L

LOG_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("datetime", T.TimestampType()),
        T.StructField("host", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("status", T.ShortType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("bytes_missing_flag", T.ByteType()),
    ]
)


def line_fields(lines: DataFrame, fmt: L.LineFormat = L.LineFormat()) -> DataFrame:
    """The five text fields of each readable line; other lines are dropped.

    The generator drops them, not a filter: a filter would be merged with later ones and
    pushed to the scan, and every copy would run the pattern again.
    """
    parts = lines.select(L.captures(F.col("value"), fmt.log_pattern, L.LINE_FIELDS).alias("p"))
    hit = F.when(L.matched(F.col("p"), L.LINE_FIELDS), F.array("p"))
    return parts.select(F.explode(hit).alias("f")).select(
        *[F.col("f")[i + 1].alias(name) for i, name in enumerate(L.LINE_FIELDS)]
    )


def split_request(fields: DataFrame, fmt: L.LineFormat = L.LineFormat()) -> DataFrame:
    """Replace ``request`` by method, url and version."""
    trimmed = F.trim(F.col("request"), F.lit(" \t\n\r\x0b\x0c"))
    split = fields.withColumn("_r", L.captures(trimmed, fmt.request_pattern, L.REQUEST_FIELDS))
    hit = L.matched(F.col("_r"), L.REQUEST_FIELDS)
    return split.select(
        *[c for c in fields.columns if c != "request"],
        *[
            F.when(hit, F.col("_r")[i + 1]).otherwise(F.lit(L.UNREADABLE)).alias(name)
            for i, name in enumerate(L.REQUEST_FIELDS)
        ],
    )


def parse_lines(
    lines: DataFrame, fmt: L.LineFormat = L.LineFormat(), with_offset: bool = False
) -> DataFrame:
    """Log lines (one ``value`` column) to typed events; works on batches and streams."""
    fields = split_request(line_fields(lines, fmt), fmt)
    size = L.byte_count(F.col("bytes"))
    columns = [
        L.instant(F.col("ts"), fmt.ts_format).alias("datetime"),
        "host",
        "method",
        "url",
        "version",
        F.col("status").try_cast("smallint").alias("status"),
        size.alias("bytes"),
        size.isNull().cast("tinyint").alias("bytes_missing_flag"),
    ]
    if with_offset:
        zone = F.regexp_extract(F.col("ts"), r"([+-]\d{2}:?\d{2})\s*$", 1)
        columns.append(F.when(zone != "", zone).alias("utc_offset"))
    return fields.select(*columns)


def coerce_events(df: DataFrame) -> DataFrame:
    """Cast loosely typed event columns to the event schema; what does not fit becomes NULL."""
    return df.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in LOG_EVENT_SCHEMA.fields]
    )


def scan_access_log(
    spark: SparkSession, paths: str | Sequence[str], fmt: L.LineFormat = L.LineFormat()
) -> DataFrame:
    """Events of one or many log files; input splits replace hand-made chunks."""
    return parse_lines(spark.read.text(paths), fmt)


def stream_access_log(
    spark: SparkSession,
    path: str,
    out: str,
    checkpoint: str,
    fmt: L.LineFormat = L.LineFormat(),
    max_files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Append events of newly arrived log files to a Parquet table, exactly once."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(path)
    return (
        parse_lines(lines, fmt)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
