"""Ordered classifications. The first matching band wins."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Band names, limits and action names that stored results use.
CRITICAL_FLOOR = 0.85
MEDIUM_SHARE = 0.5
RISK_LEVELS = ("critical", "high", "medium", "low")
ACTIONS = ("stop_and_inspect", "schedule_maintenance", "continue_monitoring")
SEVERITY_LIMITS = ((1440.0, "critical"), (240.0, "major"))
OUTCOME_CLASSES = ("true_positive", "false_positive", "false_negative", "true_negative")


def first_band(bands: list[tuple[Column, str]], rest: str) -> Column:
    """Label of the first true condition."""
    out = F.lit(rest)
    for cond, label in reversed(bands):
        out = F.when(cond, F.lit(label)).otherwise(out)
    return out


def risk_level(prob: Column, threshold: Column) -> Column:
    critical, high, medium, low = RISK_LEVELS
    return first_band(
        [
            (prob >= F.greatest(F.lit(CRITICAL_FLOOR), threshold), critical),
            (prob >= threshold, high),
            (prob >= threshold * MEDIUM_SHARE, medium),
        ],
        low,
    )


def recommended_action(prob: Column, threshold: Column) -> Column:
    stop, schedule, watch = ACTIONS
    return first_band(
        [(prob >= F.greatest(F.lit(CRITICAL_FLOOR), threshold), stop), (prob >= threshold, schedule)], watch
    )


def severity(downtime_minutes: Column) -> Column:
    return first_band([(downtime_minutes > limit, name) for limit, name in SEVERITY_LIMITS], "minor")


def outcome_class(alerted: Column, happened: Column) -> Column:
    tp, fp, fn, tn = OUTCOME_CLASSES
    return first_band([(alerted & happened, tp), (alerted, fp), (happened, fn)], tn)


def freshness(age_us: Column, limit_us: int) -> Column:
    """Missing is a state of its own; it is never an age of zero."""
    return first_band([(age_us.isNull(), "missing"), (age_us <= F.lit(limit_us), "fresh")], "stale")
