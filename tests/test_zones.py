"""The zone map of the issue table: lookups open few folders and miss nothing."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from dqspark import vitals_rules
from dqspark.operators import issue_json, issues_by_severity, recent_issues
from dqspark.plans.monitor import Monitor
from dqspark.sources.zones import forget_zones, newest_folders, write_zones, zones_path

SCHEMA = "day int, n int, severity string, detected_at timestamp"
START = dt.datetime(2024, 3, 1)


def written(spark, rows):
    root = tempfile.mkdtemp(prefix="dq-zones-")
    issues = spark.createDataFrame(rows, SCHEMA)
    issue_json(issues, ("day",)).write.partitionBy("day").json(f"{root}/issues")
    write_zones(issues, f"{root}/issues", "day")
    return issues.drop("day"), Monitor(spark, vitals_rules(), f"{root}/published", issues=f"{root}/issues")


def days(n, of_day=20, severity="high"):
    return [(d, d * 100 + i, severity, START + dt.timedelta(days=d, minutes=i)) for d in range(n) for i in range(of_day)]


def test_one_folder_of_thirty_is_opened(spark):
    rows = days(30) + [(3, -1, "critical", START + dt.timedelta(days=3))]
    issues, m = written(spark, rows)
    got = m.recent_issues(10)
    assert {f.split("day=")[1].split("/")[0] for f in got.inputFiles()} == {"29"}
    assert got.collect() == recent_issues(issues, 10).collect()
    got = m.issues_by_severity("CRITICAL", 1)
    assert {f.split("day=")[1].split("/")[0] for f in got.inputFiles()} == {"3"}
    assert [r.n for r in got.collect()] == [-1]
    assert m.issues_by_severity("none", 5).collect() == [] and m.recent_issues(0).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_lookups_equal_a_full_scan(spark, seed):
    """Days that overlap, ties, issues without a time or a severity."""
    rnd = random.Random(seed)

    def row(i):
        day = rnd.randrange(8)
        at = None if rnd.random() < 0.1 else START + dt.timedelta(days=day + rnd.choice([0, 0, 0, -2, 3]), hours=rnd.randrange(3))
        return (day, i, rnd.choice(["high", "critical", "Critical", None]), at)

    rows = [row(i) for i in range(90)]
    issues, m = written(spark, rows)
    for limit in (1, 7, 40, 85, 100):
        assert m.recent_issues(limit).collect() == recent_issues(issues, limit).collect()
        assert m.issues_by_severity("critical", limit).collect() == issues_by_severity(issues, "critical", limit).collect()


def test_a_folder_without_zones_is_opened(spark):
    """What a writer leaves that dies between a folder and its zones."""
    issues, m = written(spark, days(6))
    forget_zones(spark, m.issues_path, ["day=2"])
    assert newest_folders(spark, m.issues_path, 10) == ["day=2", "day=5"]
    assert m.recent_issues(10).collect() == recent_issues(issues, 10).collect()
    # zones of a folder that is gone name nothing to open
    spark.createDataFrame(days(7)[-20:], SCHEMA).transform(lambda d: write_zones(d, m.issues_path, "day") or d)
    assert "day=6" not in newest_folders(spark, m.issues_path, 10)
    assert spark.read.parquet(zones_path(m.issues_path)).filter(F.col("folder") == "day=6").count() == 1
