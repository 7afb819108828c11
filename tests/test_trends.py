"""Daily metrics, trends and risk on hand-made daily tables."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from dqspark import Rules
from dqspark.operators import daily_metrics, predict_risk, trends

R = Rules(required=("subject",), entity="entity", subject="subject", time="ts")


def daily_df(spark, values):
    schema = T.StructType(
        [
            T.StructField("entity", T.StringType()),
            T.StructField("date", T.DateType()),
            T.StructField("avg_quality_score", T.DoubleType()),
            T.StructField("issue_rate", T.DoubleType()),
            T.StructField("quality_variance", T.DoubleType()),
        ]
    )
    return spark.createDataFrame(values, schema)


def d(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


def test_trend_rules(spark):
    rows = [("E", d(0), 90.0, 10.0, 3.0), ("E", d(1), 90.0, 10.0, 12.0), ("E", d(2), 100.0, 0.0, None)]
    # 9 more days, with a gap (day 6 missing) to check the 7-row frame
    scores = [80.0, 85.0, 70.0, 95.0, 60.0, 99.0, 50.0, 75.0]
    days = [3, 4, 5, 7, 8, 9, 10, 11]
    rows += [("E", d(i), s, 100 - s, 1.0) for i, s in zip(days, scores)]
    out = {r["date"]: r for r in trends(daily_df(spark, rows), R).collect()}
    first = out[d(0)]
    assert first["ma7_quality_score"] == 90.0
    assert first["trend_direction"] == "improving" and first["quality_change"] == 90.0
    assert out[d(1)]["trend_direction"] == "degrading"  # equal averages degrade
    assert out[d(2)]["ma7_quality_score"] == pytest.approx(280 / 3)
    # the 8th row's frame drops the first row; the missing day does not widen it
    seq = [90.0, 90.0, 100.0] + scores
    all_days = [0, 1, 2] + days
    for idx, day in enumerate(all_days):
        window = seq[max(0, idx - 6): idx + 1]
        assert out[d(day)]["ma7_quality_score"] == pytest.approx(sum(window) / len(window))
    risk = {r["date"]: r["predicted_issue_risk"] for r in predict_risk(trends(daily_df(spark, rows), R), R).collect()}
    assert risk[d(0)] == 0.2  # improving, spread 3 < 5
    assert risk[d(1)] == 0.8  # degrading, spread 12 > 10
    assert risk[d(2)] == 0.4  # improving, spread NULL falls through


def test_daily_metrics_counts(spark):
    schema = "subject string, entity string, ts timestamp, has_issues boolean, quality_score int"
    base = dt.datetime(2024, 1, 1, 8)
    rows = [("a", "E", base, False, 100), ("b", "E", base, None, 100), ("c", "E", base + dt.timedelta(days=1), True, 25)]
    out = {r["date"]: r for r in daily_metrics(spark.createDataFrame(rows, schema), R).collect()}
    day1, day2 = out[dt.date(2024, 1, 1)], out[dt.date(2024, 1, 2)]
    assert day1["records_with_issues"] == 0 and day1["issue_rate"] == 0.0  # 0, not NULL
    assert day1["health_status"] == "excellent" and day1["quality_variance"] == 0.0
    assert day2["quality_variance"] is None  # one-row day
    assert day2["health_status"] == "poor" and day2["issue_rate"] == 100.0
