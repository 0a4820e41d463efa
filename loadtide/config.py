"""Settings with the defaults a load analysis starts from."""

from __future__ import annotations

import copy
from collections.abc import Mapping
from typing import Any

# Grid sizes, feature spec, model parameters and capacity knobs that must
# equal the published configuration for results to agree.
DEFAULTS: dict[str, Any] = {
    "tags": ["1m", "5m", "15m"],
    "targets": ["hits", "bytes_sum"],
    "gaps": {
        "outages": [("1995-08-01T14:52:01-04:00", "1995-08-03T04:36:13-04:00")],
        "unknown_gap_min_hours": 12,
    },
    "features": {
        "lag_days": [1, 2, 3, 4, 5, 6, 7],
        "roll_windows": ["1h", "6h", "1d"],
        "roll_use_std": True,
        "use_cyclic": True,
        "horizon_steps": 1,
        "require_cols": ["bucket_start", "hits", "bytes_sum", "is_gap"],
        "keep_raw_extra": [
            "unique_hosts",
            "err_4xx",
            "err_5xx",
            "error_rate",
            "is_missing_bucket",
            "is_gap_storm",
            "is_gap_unknown",
        ],
    },
    "modeling": {
        "cv": {"splits": 5, "test_days": 2, "gap_steps": 1, "patience": 50},
        "trees": {
            "max_depth": 6,
            "learning_rate": 0.05,
            "subsample": 0.9,
            "colsample": 0.9,
            "seed": 42,
            "max_iter": 100,
        },
    },
    "scaling": {
        "min_instances": 2,
        "max_instances": 50,
        "cost_per_instance_per_hour": 0.05,
        "window_minutes": {"1m": 1, "5m": 5, "15m": 15},
        "safety_buffer_by_metric": {"hits": 0.3, "bytes_sum": 0.3},
        "capacity_per_instance": {
            "hits": {"1m": 20, "5m": 100, "15m": 350},
            "bytes_sum": {"1m": 350000, "5m": 1200000, "15m": 3500000},
        },
        "max_step_change_by_window": {"1m": 6, "5m": 10, "15m": 15},
    },
}


def settings(overrides: Mapping[str, Any] | None = None) -> dict[str, Any]:
    """The defaults with nested overrides laid over them, checked."""
    merged = overlay(copy.deepcopy(DEFAULTS), overrides or {})
    check(merged)
    return merged


def overlay(base: dict[str, Any], top: Mapping[str, Any]) -> dict[str, Any]:
    for name, value in top.items():
        both_nested = isinstance(value, Mapping) and isinstance(base.get(name), dict)
        base[name] = overlay(base[name], value) if both_nested else value
    return base


def check(cfg: Mapping[str, Any]) -> None:
    from loadtide.functions.timegrid import step_seconds
    from loadtide.operators.capacity import capacity_entries

    for tag in cfg["tags"]:
        step_seconds(tag)
    scaling = cfg["scaling"]
    known = capacity_entries(scaling["capacity_per_instance"])
    for target in cfg["targets"]:
        for tag in cfg["tags"]:
            if (target, tag) not in known:
                raise ValueError(f"no capacity for {target} at {tag}")
    if not 0 < scaling["min_instances"] <= scaling["max_instances"]:
        raise ValueError("instance bounds must satisfy 0 < min <= max")
