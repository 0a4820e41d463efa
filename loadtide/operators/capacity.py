"""Capacity tables, sizing expressions, static evaluation and run summaries."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadtide.operators import blocks as B
from loadtide.operators.quantiles import exact_quantiles

SALTS = 32
PAIR_KEY = re.compile(
    r"""^\s*\(?\s*['"]?\s*(?P<metric>[^'"|,]+?)\s*['"]?\s*(?:__|\||,)\s*['"]?\s*(?P<window>[^'"|,()]+?)\s*['"]?\s*\)?\s*$"""
)


def capacity_entries(caps: Mapping[Any, Any]) -> dict[tuple[str, str], float]:
    """Capacity per (metric, window) from nested maps, pair keys or ``a__b``-like text keys."""
    if not isinstance(caps, Mapping):
        return {}
    nested = any(isinstance(v, Mapping) for v in caps.values())
    entries: dict[tuple[str, str], float] = {}
    for key, value in caps.items():
        if nested:
            if isinstance(value, Mapping):
                entries |= {(str(key), str(w)): float(v) for w, v in value.items()}
        elif isinstance(key, tuple) and len(key) == 2:
            entries[str(key[0]), str(key[1])] = float(value)
        elif isinstance(key, str) and (pair := PAIR_KEY.match(key)):
            entries[pair["metric"], pair["window"]] = float(value)
    return entries


POLICY_SCHEMA = (
    "scenario string, metric string, window string, units double, buffer double, win_minutes int, "
    "min_instances int, max_instances int, unit_cost double, step_limit int"
)


def policy_rows(scaling: Mapping[str, Any], scenario: str = "default") -> list[tuple]:
    """The parameters of a policy, one row per metric and window; ``step_limit`` is what `bounded_step` takes."""
    return [
        (
            scenario,
            metric,
            window,
            units,
            float(scaling.get("safety_buffer_by_metric", {}).get(metric, 0.2)),
            int(scaling["window_minutes"][window]),
            int(scaling["min_instances"]),
            int(scaling["max_instances"]),
            float(scaling["cost_per_instance_per_hour"]),
            int(scaling.get("max_step_change_by_window", {}).get(window, 10)),
        )
        for (metric, window), units in capacity_entries(scaling["capacity_per_instance"]).items()
    ]


def policy_table(spark: SparkSession, scenarios: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """Policies of all scenarios; each scenario is a full scaling section."""
    rows = [r for name, scaling in scenarios.items() for r in policy_rows(scaling, name)]
    return spark.createDataFrame(rows, POLICY_SCHEMA)


def with_policy(case: DataFrame, policies: DataFrame) -> DataFrame:
    """Attach the policies of a row's metric and window; a row without one is an error.

    There are few distinct metrics and windows, so rows are salted and policies repeated for each
    salt: a shuffled join has no hot key, and a small policy table is broadcast by its size.
    The check sits in a filter, which stays whatever columns are read later.
    """
    salt = F.pmod(F.xxhash64(*case.columns), F.lit(SALTS))
    spread = policies.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    joined = case.withColumn("_salt", salt).join(spread, ["metric", "window", "_salt"], "left").drop("_salt")
    missing = F.concat(
        F.lit("no capacity for "), F.coalesce("metric", F.lit("NULL")), F.lit("/"), F.coalesce("window", F.lit("NULL"))
    )
    known = F.when(F.col("units").isNotNull(), True).otherwise(F.raise_error(missing).cast("boolean"))
    return joined.where(known)


def clamp(value: Column, low: Column | int, high: Column | int) -> Column:
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    return F.greatest(low, F.least(high, value))


def required_instances(demand: Column, units: Column, buffer: Column, low: Column, high: Column) -> Column:
    """Instances for a demand with a safety margin, inside the allowed range."""
    load = F.greatest(F.lit(0.0), demand) / F.greatest(units, F.lit(1e-9))
    return clamp(F.ceil(load * (F.lit(1.0) + buffer)), low, high).cast("int")


def policy_required(demand: Column) -> Column:
    return required_instances(
        demand, F.col("units"), F.col("buffer"), F.col("min_instances"), F.col("max_instances")
    )


def bounded_step(instances: Column, target: Column, limit: Column, low: Column, high: Column) -> Column:
    """Move towards a target by at most ``limit``, inside the allowed range."""
    gap = target - instances
    move = F.when(gap > 0, F.least(gap, limit)).otherwise(-F.least(-gap, limit))
    return clamp(instances + move, low, high).cast("int")


def with_accounting(steps: DataFrame) -> DataFrame:
    """Capacity, head room, cost and violation columns from instance counts."""
    hours = F.col("win_minutes") / F.lit(60.0)
    cap = F.col("effective_instances") * F.col("units")
    room = F.col("capacity_total") - F.col("y_true")
    return (
        steps.withColumn("capacity_total", cap)
        .withColumn("headroom", room)
        .withColumns(
            {
                "under_provision": F.greatest(F.lit(0.0), -F.col("headroom")),
                "over_provision": F.greatest(F.lit(0.0), F.col("headroom")),
                "sla_violation": F.col("headroom") < 0,
                "cost_step": F.col("instances") * hours * F.col("unit_cost"),
                "server_hours_step": F.col("instances") * hours,
                "cost_rate_per_hour": F.col("instances") * F.col("unit_cost"),
            }
        )
    )


def static_size(
    case: DataFrame,
    *,
    keys: Sequence[str] = (),
    cutoff: str | None = None,
    share: float = 0.7,
    order: str = "timestamp",
) -> DataFrame:
    """Per series: whole part of the 95th percentile of the required instances.

    Rows before ``cutoff`` form the baseline; series without such rows use their first
    ``share``. Needs the policy columns.
    """
    ids = [*keys, "scenario", "metric", "window"]
    placed = B.positions(case, "_pos", order=order, keys=ids)
    early = F.col(order) < F.lit(cutoff).cast("timestamp") if cutoff else F.lit(False)
    size = case.groupBy(*[F.col(k).alias(f"_z_{k}") for k in ids]).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(early).alias("_early")
    )
    same = F.lit(True)
    for k in ids:
        same = same & F.col(k).eqNullSafe(F.col(f"_z_{k}"))
    first = F.col("_pos") <= F.floor(F.col("_n") * F.lit(share))
    chosen = F.when(F.col("_early") > 0, early).otherwise(first)
    base = placed.join(size, same).filter(chosen).select(*ids, policy_required(F.col("y_true")).alias("_need"))
    return exact_quantiles(base, {"static_n": ("_need", 0.95)}, ids).withColumn("static_n", F.col("static_n").cast("int"))


STEP_COLS = [
    "timestamp", "scenario", "metric", "window", "policy_mode", "y_true", "y_pred", "required_instances",
    "instances", "effective_instances", "capacity_total", "headroom", "under_provision", "over_provision",
    "sla_violation", "cost_step", "server_hours_step", "cost_rate_per_hour",
]


def static_policy(case: DataFrame, sizes: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """A fixed instance count per series, evaluated on every row."""
    ids = [*keys, "scenario", "metric", "window"]
    fixed = clamp(F.col("static_n"), F.col("min_instances"), F.col("max_instances")).cast("int")
    sized = case.join(sizes, ids)
    steps = sized.withColumns(
        {
            "policy_mode": F.lit("static"),
            "required_instances": policy_required(F.col("y_pred")),
            "instances": fixed,
            "effective_instances": fixed,
        }
    )
    return with_accounting(steps).drop("static_n")


def predictive_policy(case: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Each row holds what its forecast requires; the change against the row before is its action.

    ``from_instances`` is the count of the row before, the smallest allowed count at the start. The row
    before is found in time blocks with one row of halo.
    """
    ids = [*keys, "scenario", "metric", "window"]
    need = policy_required(F.col("y_pred"))
    placed = B.positions(case, "_pos", order="timestamp", keys=ids)
    halo = B.with_halo(placed.withColumn("instances", need), F.col("_pos"), ids, before=1, size=B.POSITION_BLOCK)
    last = F.coalesce(F.lag("instances").over(B.block_window(ids, "_pos")), F.col("min_instances"))
    held = B.owned(halo.withColumn("from_instances", last), "_pos")
    change = F.col("instances") - F.col("from_instances")
    out, back = change > 0, change < 0
    return with_accounting(
        held.withColumns(
            {
                "policy_mode": F.lit("predictive"),
                "required_instances": F.col("instances"),
                "effective_instances": F.col("instances"),
                "action": F.when(out, "scale_out").when(back, "scale_in").otherwise("hold"),
                "reason": F.when(out, "forecast needs more").when(back, "forecast needs less").otherwise("forecast needs as many"),
            }
        )
    )


def steps_view(steps: DataFrame, keys: Sequence[str] = (), *more: str) -> DataFrame:
    return steps.select(*keys, *STEP_COLS, *[c for c in more if c in steps.columns])


def scale_events(steps: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """The rows on which the instance count changed."""
    return steps.filter(F.col("instances") != F.col("from_instances")).select(
        *keys,
        "timestamp",
        "scenario",
        "metric",
        "window",
        "policy_mode",
        "action",
        "from_instances",
        F.col("instances").alias("to_instances"),
        (F.col("instances") - F.col("from_instances")).alias("delta"),
        "reason",
    )


def run_summary(steps: DataFrame, events: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Cost, size, violation and event figures per series, scenario and policy."""
    ids = [*keys, "scenario", "metric", "window", "policy_mode"]
    per_run = steps.groupBy(*ids).agg(
        F.sum("cost_step").alias("estimated_total_cost"),
        F.sum("server_hours_step").alias("total_server_hours"),
        F.avg("instances").alias("avg_instances"),
        F.max("instances").alias("peak_instances"),
        F.avg(F.col("sla_violation").cast("double")).alias("sla_violation_rate"),
        F.sum("under_provision").alias("total_under_provision"),
        F.max("under_provision").alias("max_under_provision"),
        F.count(F.lit(1)).alias("num_points"),
        (F.count(F.lit(1)) * F.first("win_minutes") / F.lit(60.0)).alias("_hours"),
    )
    per_events = events.groupBy(*[F.col(c).alias(f"_e_{c}") for c in ids]).agg(
        F.count(F.lit(1)).alias("_events")
    )
    same = F.lit(True)
    for c in ids:
        same = same & F.col(c).eqNullSafe(F.col(f"_e_{c}"))
    n = F.coalesce("_events", F.lit(0))
    return (
        per_run.join(per_events, same, "left")
        .withColumn("num_scale_events", n)
        .withColumn("events_per_hour", n / F.greatest(F.col("_hours"), F.lit(1e-9)))
        .drop("_hours", "_events", *[f"_e_{c}" for c in ids])
    )


def compare_policies(summary: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Saving of the predictive over the static run of the same series and scenario."""
    cost = {m: F.sum(F.when(F.col("policy_mode") == m, F.col("estimated_total_cost"))) for m in ("static", "predictive")}
    return (
        summary.groupBy(*keys, "scenario", "metric", "window")
        .agg(cost["static"].alias("static_cost"), cost["predictive"].alias("predictive_cost"))
        .withColumn("saving", F.col("static_cost") - F.col("predictive_cost"))
        .withColumn("saving_pct", F.col("saving") / F.greatest(F.col("static_cost"), F.lit(1e-9)))
    )


def daily_event_counts(events: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Scale-outs, scale-ins and their sum per date."""
    named = F.lower("action")
    return (
        events.groupBy(*keys, F.to_date("timestamp").alias("date"))
        .agg(
            F.count_if(named.contains("scale_out")).alias("scale_out"),
            F.count_if(named.contains("scale_in")).alias("scale_in"),
        )
        .withColumn("total", F.col("scale_out") + F.col("scale_in"))
    )


def instance_distribution(steps: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """How often, and for which share of the rows, each instance count was held."""
    levels = steps.groupBy(*keys, F.col("instances").cast("int").alias("instances")).agg(
        F.count(F.lit(1)).alias("count")
    )
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    return levels.withColumn("pct_time", F.col("count") / F.sum("count").over(whole))


def cumulative_cost(steps: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    ids = [*keys, "scenario", "metric", "window", "policy_mode"]
    return B.running_sum(steps, F.col("cost_step"), "cumulative_cost", order="timestamp", keys=ids)
