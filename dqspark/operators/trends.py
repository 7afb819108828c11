"""Trend analysis over daily metrics: 7-row moving averages, direction,
change and a rule-based risk estimate.

The windows are partitioned by entity over the *daily* table, whose size per
entity is the number of days, not the number of records, so no partition
grows with the data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scoring
from ..rules import Rules

MA_ROWS = 7


def trends(daily: DataFrame, rules: Rules) -> DataFrame:
    """``ma7_*`` over the last 7 *rows* (not calendar days) per entity,
    ``trend_direction`` against the previous row's ma7 (first row compares with 0,
    ties degrade) and ``quality_change`` = ma7 - previous ma7."""
    order = Window.partitionBy(rules.entity).orderBy("date")
    frame = order.rowsBetween(-(MA_ROWS - 1), Window.currentRow)
    with_ma = daily.select(
        "*",
        F.avg("avg_quality_score").over(frame).alias("ma7_quality_score"),
        F.avg("issue_rate").over(frame).alias("ma7_issue_rate"),
    )
    prev = F.lag("ma7_quality_score", 1, 0.0).over(order)
    with_prev = with_ma.withColumn("_prev_ma7", prev)
    return with_prev.select(
        *daily.columns,
        "ma7_quality_score",
        "ma7_issue_rate",
        scoring.trend_direction(F.col("ma7_quality_score"), F.col("_prev_ma7")).alias("trend_direction"),
        (F.col("ma7_quality_score") - F.col("_prev_ma7")).alias("quality_change"),
    )


def predict_risk(trend_df: DataFrame, rules: Rules) -> DataFrame:
    """P10: risk 0.8 / 0.6 / 0.4 / 0.2 from direction and score spread."""
    return trend_df.select(
        rules.entity,
        "date",
        "avg_quality_score",
        scoring.issue_risk(F.col("trend_direction"), F.col("quality_variance")).alias("predicted_issue_risk"),
        "trend_direction",
    )


def daily_report(assessed: DataFrame, rules: Rules, run_date=None, date_col: str | None = None):
    """Metrics and trends *as of* ``run_date``: history up to and
    including that date feeds the 7-row frames, only that date is emitted.
    ``run_date=None`` keeps every date.  On a date-partitioned lake, whose
    partition column is named by ``date_col``, the filter prunes partitions."""
    from .metrics import daily_metrics, date_column

    src = assessed
    if run_date is not None:
        d = date_column(rules, date_col)
        src = assessed.filter(d <= F.lit(run_date).cast("date"))
    t = trends(daily_metrics(src, rules, date_col), rules)
    if run_date is not None:
        t = t.filter(F.col("date") == F.lit(run_date).cast("date"))
    return t
