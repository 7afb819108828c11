"""The daily job date by date, mergeable states, and snapshots that readers can trust."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dqspark import Rules
from dqspark.operators import assess, daily_metrics, problem_subjects, trends
from dqspark.plans import incremental as I
from dqspark.plans.daily import run_daily
from dqspark.plans.monitor import Monitor
from dqspark.sources import snapshots as S, with_date, write_lake

RULES = Rules.from_dict(
    {"completeness": {"required_fields": ["who", "place"]}, "validity": {"x": {"min": 0, "max": 100}}, "anomaly_detection": {"z_score_threshold": 3, "fields": ["x"]}},
    entity="place", subject="who", time="at", window="1 day",
)


def records(seed=1, n=400, days=12):
    random.seed(seed)
    base = dt.datetime(2024, 5, 1)
    return [
        (i, random.choice(["a", "b", "c", None]), random.choice(["P", "Q", None]), random.choice([1.0, 50.0, 200.0, None]), None if i % 50 == 0 else base + dt.timedelta(days=random.randrange(days), minutes=i))
        for i in range(n)
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, "n int, who string, place string, x double, at timestamp")


def same(a, b):
    key = lambda r: repr([str(x) for x in r])
    cols = a.columns
    rows = [sorted([tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in d.select(*cols).collect()], key=key) for d in (a, b)]
    assert rows[0] == rows[1] and rows[0]


def test_date_by_date_equals_one_run(spark, tmp_path):
    scored = assess(frame(spark, records()), RULES)
    lake, state, out = f"{tmp_path}/lake", f"{tmp_path}/state", f"{tmp_path}/out"
    early = scored.filter("at < '2024-05-05'")
    write_lake(early, lake, RULES)
    first = I.run_daily_incremental(spark, lake, state, out, RULES)
    same(first.trends.drop("predicted_issue_risk", "written_at"), trends(daily_metrics(early, RULES), RULES))
    write_lake(scored.filter("at >= '2024-05-05' OR at IS NULL"), lake, RULES)
    assert I.dates_to_do(spark, lake, state) == [f"2024-05-{d:02d}" for d in range(5, 13)]
    for day in I.dates_to_do(spark, lake, state):
        I.run_daily_incremental(spark, lake, state, out, RULES, [day])
    last = I.run_daily_incremental(spark, lake, state, out, RULES, ["2024-05-07"])  # again: replaces its state
    same(last.trends.drop("predicted_issue_risk", "written_at"), trends(daily_metrics(scored, RULES), RULES))
    same(last.problems, problem_subjects(scored, RULES))
    assert I.dates_to_do(spark, lake, state) == []
    # a date's run opens that date's files only
    plan = I.changed(spark, lake, ["2024-05-07"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    files = I.changed(spark, lake, ["2024-05-07"]).select("_metadata.file_path").distinct().collect()
    assert files and all("date=2024-05-07" in r[0] or "HIVE_DEFAULT" in r[0] for r in files)


def test_states_merge(spark):
    scored = assess(frame(spark, records(2)), RULES)
    day = F.to_date("at")
    parts = [I.daily_state(scored.filter(F.col("n") % 3 == k), RULES, day) for k in range(3)]
    merged = I.merge_daily(parts[0].unionByName(parts[1]).unionByName(parts[2]), RULES)
    same(I.metrics_of(merged, RULES), daily_metrics(scored, RULES))


def test_reader_never_sees_half_a_version(spark, tmp_path):
    out = f"{tmp_path}/out"
    lake = f"{tmp_path}/lake"
    write_lake(assess(frame(spark, records(3)), RULES), lake, RULES)
    run_daily(spark, lake, out, RULES)
    m = Monitor(spark, RULES, out)
    before = S.current(spark, out)
    rows = m.all_metrics().count()
    # a writer dies half-way: some tables are there, no pointer
    dead = S.new_version(out)
    spark.range(1).write.parquet(f"{dead}/latest")
    assert S.current(spark, out) == before and m.all_metrics().count() == rows > 0
    held = m.all_metrics()  # resolved now
    run_daily(spark, lake, out, RULES)
    after = S.current(spark, out)
    assert after != before and held.count() == rows
    # a day later: the replaced version and what the dead writer left go, the one in force stays
    assert S.expire(spark, out, 3600) == 0
    day = int(dt.datetime.now().timestamp() + 86_400) * 1000
    assert S.expire(spark, out, 3600, as_of_millis=day) == 2
    assert S.current(spark, out) == after and m.all_metrics().count() == rows
    assert S.expire(spark, out, 3600, as_of_millis=day) == 0


def test_plain_folder_is_its_own_version(spark, tmp_path):
    assert S.current(spark, f"{tmp_path}/x") == f"{tmp_path}/x" and S.expire(spark, f"{tmp_path}/x", 1) == 0


def test_a_column_called_date_is_not_the_day(spark):
    rows = [(1, "a", "P", 1.0, dt.datetime(2024, 5, 1, 3))]
    scored = assess(frame(spark, rows).withColumn("date", F.lit("1999-12-31").cast("date")), RULES)
    assert [str(r.date) for r in daily_metrics(scored, RULES).collect()] == ["2024-05-01"]
    assert [str(r.date) for r in daily_metrics(scored, RULES, date_col="date").collect()] == ["1999-12-31"]
    with pytest.raises(ValueError, match="partition column"):
        with_date(scored, RULES)
