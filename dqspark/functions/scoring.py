"""Scoring, banding and risk expressions.

Fixed values (must equal the source application for identical results):
  quality score: incomplete -> 25; no issue -> 100; any anomaly -> 50;
                 any range check false -> 75; otherwise (issue flag NULL) -> 100
  health band on the average score: >= 95 excellent, >= 85 good, >= 70 fair, else poor
  risk: degrading and stddev > 10 -> 0.8; degrading -> 0.6;
        improving and stddev < 5 -> 0.2; otherwise 0.4
  critical entity: issue rate > 20, or status poor, or average score < 70
Our own choice (the source has only a stub): severity 25 -> critical,
50 and 75 -> high, 100 -> low.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import Rules
from .checks import is_incomplete

SCORE_INCOMPLETE = 25
SCORE_ANOMALY = 50
SCORE_INVALID = 75
SCORE_PERFECT = 100

BANDS = ((95.0, "excellent"), (85.0, "good"), (70.0, "fair"))
BAND_LOWEST = "poor"

DEFAULT_SEVERITY = ((25, "critical"), (50, "high"), (75, "high"), (100, "low"))


def _any(cols: list[Column]) -> Column | None:
    return reduce(lambda a, b: a | b, cols) if cols else None


def _invalid_terms(rules: Rules) -> list[Column]:
    return [F.col(f"{rules.prefix(n)}_valid") == F.lit(False) for n in rules.range_fields]


def _anomaly_terms(rules: Rules) -> list[Column]:
    return [F.col(f"{rules.prefix(m)}_anomaly") == F.lit(True) for m in rules.anomaly]


def has_issues(rules: Rules) -> Column:
    """Incomplete OR any range check false OR any anomaly, in 3-valued OR.

    A NULL validity flag (value missing on a non-required field) with all
    else fine gives NULL, not false.
    """
    return _any([is_incomplete(rules)] + _invalid_terms(rules) + _anomaly_terms(rules)).alias(
        "has_issues"
    )


def quality_score(rules: Rules) -> Column:
    expr = F.when(is_incomplete(rules), F.lit(SCORE_INCOMPLETE)).when(
        F.col("has_issues") == F.lit(False), F.lit(SCORE_PERFECT)
    )
    anomaly = _any([F.col(f"{rules.prefix(m)}_anomaly") for m in rules.anomaly])
    if anomaly is not None:
        expr = expr.when(anomaly, F.lit(SCORE_ANOMALY))
    invalid = _any(_invalid_terms(rules))
    if invalid is not None:
        expr = expr.when(invalid, F.lit(SCORE_INVALID))
    return expr.otherwise(F.lit(SCORE_PERFECT)).alias("quality_score")


def issue_rate(issues: Column, total: Column) -> Column:
    return issues / total * F.lit(100.0)


def health_status(avg_score: Column) -> Column:
    expr = None
    for lo, name in BANDS:
        cond = avg_score >= F.lit(lo)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(BAND_LOWEST))


def trend_direction(ma: Column, prev_ma: Column) -> Column:
    """Ties and declines degrade; the first day compares against 0."""
    return F.when(ma > prev_ma, F.lit("improving")).otherwise(F.lit("degrading"))


def issue_risk(direction: Column, spread: Column) -> Column:
    return (
        F.when((direction == F.lit("degrading")) & (spread > F.lit(10.0)), F.lit(0.8))
        .when(direction == F.lit("degrading"), F.lit(0.6))
        .when((direction == F.lit("improving")) & (spread < F.lit(5.0)), F.lit(0.2))
        .otherwise(F.lit(0.4))
    )


def is_critical(rate: Column, status: Column, avg_score: Column) -> Column:
    """NULL-safe: a NULL arm counts as not critical by that arm."""
    return (
        F.coalesce(rate > F.lit(20.0), F.lit(False))
        | F.coalesce(F.lower(status) == F.lit(BAND_LOWEST), F.lit(False))
        | F.coalesce(avg_score < F.lit(70.0), F.lit(False))
    )


def severity(score: Column, mapping=DEFAULT_SEVERITY) -> Column:
    expr = None
    for s, name in mapping:
        cond = score == F.lit(s)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr
