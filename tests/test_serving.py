"""Lookups over published tables: edge cases."""

import datetime as dt

from pyspark.sql import functions as F

from dqspark import Rules
from dqspark.operators import (
    critical_entities,
    current_status,
    fresh,
    issues_by_severity,
    latest_per_entity,
    metrics_by_status,
    metrics_for_entity,
    recent_issues,
    trend_lookup,
)

R = Rules(required=("subject",), entity="entity", subject="subject", time="ts")
DAILY = "entity string, date date, avg_quality_score double, issue_rate double, health_status string"


def _daily(spark):
    d = dt.date(2024, 1, 1)
    rows = [
        ("A", d, 96.0, 1.0, "excellent"),
        ("A", d + dt.timedelta(days=1), 60.0, 30.0, "poor"),
        ("B", d, 90.0, 25.0, "good"),
        ("C", d, 80.0, None, "fair"),
        (None, d + dt.timedelta(days=5), 10.0, 90.0, "poor"),
    ]
    return spark.createDataFrame(rows, DAILY)


def test_latest_and_lookups(spark):
    pub = latest_per_entity(_daily(spark), R)
    got = {r["entity"]: r for r in pub.collect()}
    assert set(got) == {"A", "B", "C"}  # NULL entity is not published
    assert got["A"]["date"] == dt.date(2024, 1, 2)
    assert metrics_for_entity(pub, R, "Z").count() == 0  # not found = empty
    assert [r["entity"] for r in metrics_by_status(pub, "POOR").collect()] == ["A"]
    crit = [r["entity"] for r in critical_entities(pub, R).collect()]
    assert crit == ["A", "B"]  # 30 > 25; C has NULL rate and is neither poor nor < 70


def test_trend_lookup_unknown(spark):
    tr = spark.createDataFrame([("A", dt.date(2024, 1, 1), "improving")], "entity string, date date, trend_direction string")
    out = {r["entity"]: r["trend_direction"] for r in trend_lookup(spark, tr, R, ["A", "Q"]).collect()}
    assert out == {"A": "improving", "Q": "unknown"}


def test_issue_limits_and_severity(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(f"s{i}", "E", 25 if i % 2 else 75, "critical" if i % 2 else "high", base + dt.timedelta(seconds=i)) for i in range(250)]
    iss = spark.createDataFrame(rows, "subject string, entity string, quality_score int, severity string, detected_at timestamp")
    assert recent_issues(iss, 1000).count() == iss.count()  # no cap but the caller's
    top = recent_issues(iss, 3).collect()
    assert [r["subject"] for r in top] == ["s249", "s248", "s247"]
    hi = issues_by_severity(iss, "HIGH", 5).collect()
    assert len(hi) == 5 and all(r["severity"] == "high" for r in hi)
    assert recent_issues(iss, -3).count() == 0


def test_current_status_and_ttl(spark):
    schema = "batch_id long, written_at timestamp, level string, entity string, records long, flagged_issues long, avg_quality_score double"
    t = dt.datetime(2024, 1, 1, 12, 0, 0)
    rows = [(1, t, "total", None, 10, 2, 90.0), (2, t + dt.timedelta(minutes=1), "total", None, 5, 1, 95.0),
            (2, t + dt.timedelta(minutes=1), "entity", "A", 5, 1, 95.0)]
    s = spark.createDataFrame(rows, schema)
    now = current_status(s).first()
    assert (now["status"], now["batch_id"], now["issues"]) == ("ok", 2, 5)
    stale = current_status(s, as_of=t + dt.timedelta(minutes=10), ttl_seconds=300).first()
    assert (stale["status"], stale["issues"]) == ("no_data", 0)
    empty = current_status(s.filter(F.lit(False))).first()
    assert (empty["status"], empty["issues"]) == ("no_data", 0)
    assert fresh(s, t + dt.timedelta(minutes=5), 300).count() == 2
