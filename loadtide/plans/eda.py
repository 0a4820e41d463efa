"""The exploratory report as one set of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtide.functions.timegrid import DAY, step_seconds
from loadtide.operators import anomaly, explore, isoforest
from loadtide.operators.buckets import with_class_rates
from loadtide.operators.gaps import non_gap


def eda_tables(
    ts3: DataFrame, main_tag: str = "5m", utc_offset: str = "+00:00", trees: int = isoforest.TREES
) -> dict[str, DataFrame]:
    """Named report tables over a series table with ``split`` and ``tag`` columns."""
    main = ts3.filter(F.col("tag") == main_tag)
    train = with_class_rates(non_gap(main.filter(F.col("split") == "train")))
    half_day = DAY // 2 // step_seconds(main_tag)
    typed = anomaly.spike_types(train)
    flagged = isoforest.isolation_anomalies(explore.local_parts(typed, utc_offset), trees=trees)
    return {
        "tail_risk": explore.tail_risk(ts3),
        "trend": explore.chart_series(train),
        "hist_hits": explore.histogram(train, "hits"),
        "hist_bytes_sum": explore.histogram(train, "bytes_sum"),
        "heatmap_hits": explore.week_heatmap(train, utc_offset=utc_offset),
        "seasonal_means_hits": explore.seasonal_means(train, utc_offset=utc_offset),
        "acf_peaks_hits": explore.autocorrelation(train, "hits", [half_day, 2 * half_day]),
        "correlation": explore.correlation_pairs(train),
        "lag_correlation": explore.lag_correlation(train),
        "acf_hits": explore.autocorrelation(train, "hits"),
        "acf_bytes_sum": explore.autocorrelation(train, "bytes_sum"),
        "spike_type_counts": typed.groupBy("spike_type").agg(F.count(F.lit(1)).alias("count")),
        "anomalies": flagged.filter("if_is_anomaly = 1").select(
            "bucket_start", "if_score", "hits", "bytes_sum", "error_rate", "unique_hosts", "rate_4xx", "rate_5xx"
        ).orderBy(F.desc("if_score")),
        "tail_drift": explore.tail_drift(main),
    }
