"""The access log the checks run on: every row of ``events`` rendered as one log line (``whole``), or all but the rows two outages have lost.

Times are wall times at -04:00. Some lines are rendered broken, by the second they fall
on, so that all parse rules have rows to act on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadtide.operators.buckets import build_series
from loadtide.operators.capacity import policy_table, with_policy
from loadtide.operators.forecast import seasonal_naive
from loadtide.config import settings
from loadtide.session import materialize, pin_utc
from loadtide.sources.logs import parse_lines
from loadtide.sources.tables import prediction_case

OFFSET = "-04:00"
# Doubles are compared after rounding. Means of few values often end in an exact 5, which the
# last bit of a sum then rounds up or down; this shift, the same on both sides, avoids the tie.
NUDGE = 0.000001
OUTAGES = [("2024-01-09T14:52:01-04:00", "2024-01-11T04:36:13-04:00")]
# wall times: the known outage keeps a fifth of its events, the unknown one none
KNOWN_OUTAGE = ("2024-01-09 14:52:01", "2024-01-11 04:36:13")
UNKNOWN_OUTAGE = ("2024-01-16 02:00:00", "2024-01-16 20:00:00")
SPLIT_AT = "2024-01-23T00:00:00-04:00"

# capacities fit the load of the test tables, so that policies have something to decide
SCALING = {
    "capacity_per_instance": {
        "hits": {"5m": 0.4, "15m": 0.15},
        "bytes_sum": {"5m": 1500, "15m": 700},
    }
}
SCENARIOS: dict[str, dict] = {"default": {}, "calm": {"max_step_change_by_window": {"15m": 5}}, "guarded": {"max_step_change_by_window": {"15m": 30}}}

_stages: dict[tuple[str, str, str], DataFrame] = {}


def stage(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A derived table, written once per session and shared by the queries that read it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stages:
        pin_utc(spark)
        _stages[key] = materialize(build(), name)
    return _stages[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def log_lines(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """One line per event; unless ``whole``, without the events that the two outages have lost."""
    e = table(spark, sf_dir, "events")
    return _rendered(e if whole else _with_outages(e))


def _with_outages(e: DataFrame) -> DataFrame:
    inside = lambda span: (F.col("ts") >= F.lit(span[0]).cast("timestamp_ntz")) & (F.col("ts") < F.lit(span[1]).cast("timestamp_ntz"))
    return e.filter(~inside(UNKNOWN_OUTAGE) & ~(inside(KNOWN_OUTAGE) & (F.col("event_id") % 5 != 0)))


def _rendered(e: DataFrame) -> DataFrame:
    sec = F.second("ts")
    when = F.when(sec == 31, "99/Xxx/2024:00:00:00").otherwise(F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"))
    method = F.when(F.col("event_type").isin("purchase", "signup"), "POST").otherwise("GET")
    item = F.regexp_extract("props", r"(\d+)", 1)
    request = F.when(sec == 47, "BAD").otherwise(
        F.concat(method, F.lit(" /"), "event_type", F.lit("/"), item, F.lit(" HTTP/1.0"))
    )
    status = F.when(F.col("event_type") != "error", "200").when(F.col("value") < 30, "500").otherwise("404")
    size = F.when(sec.isin(7, 52), "-").otherwise(F.floor(F.col("value") * 100).cast("string"))
    line = F.concat(
        F.lit("u"), F.col("user_id").cast("string"), F.lit(".example.net - - ["), when, F.lit(' -0400] "'),
        request, F.lit('" '), status, F.lit(" "), size,
    )
    broken = F.concat(F.lit("garbage "), F.col("event_id").cast("string"))
    return e.select(F.when(sec == 13, broken).otherwise(line).alias("value"))


def events(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """The parsed log. A file of events can be one row group, which one task reads; the rows are dealt out before the far dearer parsing."""
    e = table(spark, sf_dir, "events")
    return parse_lines(_rendered((e if whole else _with_outages(e)).repartition(F.xxhash64(*e.columns))))


def keyed_events(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    return events(spark, sf_dir, whole).withColumn("service", F.regexp_extract("url", "^/([^/]+)", 1))


def with_split(df: DataFrame) -> DataFrame:
    test = F.col("datetime") >= F.lit(SPLIT_AT).cast("timestamp")
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def series(spark: SparkSession, sf_dir: str, split: str | None = None, tag: str | None = None, whole: bool = False) -> DataFrame:
    """The dense series of both splits on all grids, without keys."""

    def build() -> DataFrame:
        return build_series(with_split(events(spark, sf_dir, whole)), outages=OUTAGES, keys=["split"])

    df = stage(spark, sf_dir, "whole_series" if whole else "series", build)
    if split:
        df = df.filter(F.col("split") == split)
    if tag:
        df = df.filter(F.col("tag") == tag)
    return df.drop("split", "tag") if split and tag else df


def service_series(spark: SparkSession, sf_dir: str, split: str) -> DataFrame:
    """15-minute series per service."""

    def build() -> DataFrame:
        keyed = with_split(keyed_events(spark, sf_dir))
        return build_series(keyed, ["15m"], outages=OUTAGES, keys=["split", "service"])

    df = stage(spark, sf_dir, "service_series", build)
    return df.filter(F.col("split") == split).drop("split", "tag")


def service_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seasonal-naive predictions per service and target, long."""

    def build() -> DataFrame:
        train, test = (service_series(spark, sf_dir, s) for s in ("train", "test"))
        parts = [
            seasonal_naive(train, test, "15m", t, keys=["service"])
            .withColumnRenamed(t, "y")
            .withColumn("target", F.lit(t))
            for t in ("hits", "bytes_sum")
        ]
        return parts[0].unionByName(parts[1]).withColumn("window", F.lit("15m"))

    return stage(spark, sf_dir, "service_predictions", build)


def policies(spark: SparkSession) -> DataFrame:
    return policy_table(spark, {n: settings_scaling(o) for n, o in SCENARIOS.items()})


def settings_scaling(overrides: dict) -> dict:
    base = settings({"tags": [], "targets": [], "scaling": overrides})["scaling"]
    return {**base, **SCALING}


def service_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capacity case of every service and target under all scenarios."""

    def build() -> DataFrame:
        p = service_predictions(spark, sf_dir)
        parts = [
            prediction_case(
                p.filter(F.col("target") == t).withColumnRenamed("y", t), t, window="15m", keys=["service"]
            )
            for t in ("hits", "bytes_sum")
        ]
        return with_policy(parts[0].unionByName(parts[1]), policies(spark))

    return stage(spark, sf_dir, "service_case", build)
