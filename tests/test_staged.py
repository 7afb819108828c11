"""Staged windows: whatever the order, lateness, replay or expiry, the lake holds every
record once, assessed over all records of its window."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from dqspark import Rules
from dqspark.operators import assess
from dqspark.streaming import StreamSinks, finish, start_assessment
from dqspark.streaming.staged import StagedWindows, landing_path, read_progress

RULES = Rules.from_dict(
    {
        "completeness": {"required_fields": ["who", "place", "x"]},
        "validity": {"x": {"min": 0, "max": 100}},
        "anomaly_detection": {"z_score_threshold": 1.5, "fields": ["x"]},
    },
    entity="place", subject="who", time="at",
)
SCHEMA = "n int, who string, place string, x double, at timestamp"
BASE = dt.datetime(2024, 5, 1, 8)


def records(seed, n=120):
    random.seed(seed)
    out = []
    for i in range(n):
        at = None if random.random() < 0.05 else BASE + dt.timedelta(seconds=random.randrange(7200))
        out.append((i, random.choice(["a", "b", None]), random.choice(["P", "Q", None]), random.choice([1.0, 2.0, 3.0, 90.0, 200.0, None]), at))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    cols = ["n", "place", F.round("x_mean", 9), F.round("x_zscore", 9), "x_anomaly", "has_issues", "quality_score"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def closed(spark, rows):
    """What a batch over all records says of the windows that the watermark has passed, and of records without a time."""
    newest = max(r[4] for r in rows if r[4])
    end = F.col("at") - F.expr("make_interval(0, 0, 0, 0, 0, 0, pmod(unix_micros(at), 300000000) / 1000000)") + F.expr("interval 5 minutes")
    return assess(frame(spark, rows), RULES).filter(F.col("at").isNull() | (end <= F.lit(newest - dt.timedelta(minutes=10))))


@pytest.mark.parametrize("seed,late_for", [(1, None), (2, "1 minute"), (3, None)])
def test_any_order_and_replay(spark, seed, late_for):
    rows = records(seed)
    root = tempfile.mkdtemp(prefix="dq-staged-")
    sinks = StreamSinks(lake=f"{root}/lake", issues=f"{root}/issues", summary=f"{root}/summary")
    batches = [rows[i::4] for i in range(4)]  # any batch has records of any window
    schema = frame(spark, rows).schema
    w = StagedWindows(spark, schema, RULES, sinks, f"{root}/ckpt", late_for=late_for)
    for k, batch in enumerate(batches):
        w(frame(spark, batch), k)
        if k in (1, 2):  # the process ends before the batch is committed; another one replays it
            w = StagedWindows(spark, schema, RULES, sinks, f"{root}/ckpt", late_for=late_for)
            w(frame(spark, batch), k)
    lake = spark.read.parquet(sinks.lake)
    assert rows_of(lake) == rows_of(closed(spark, rows))
    docs = spark.read.schema("value string").json(sinks.issues)
    assert docs.count() == lake.filter("has_issues").count()
    total = spark.read.parquet(sinks.summary).filter("level = 'total'").agg(F.sum("records")).first()[0]
    assert total == lake.count()
    w.assess_open()
    lake = spark.read.parquet(sinks.lake)
    assert rows_of(lake) == rows_of(assess(frame(spark, rows), RULES))
    progress = {r.batch_id: r for r in read_progress(spark, f"{root}/ckpt").collect()}
    assert sorted(progress) == [0, 1, 2, 3] and sum(r.records for r in progress.values()) == len(rows)
    assert progress[0].late_records == 0 < progress[3].late_records
    assert sum(r.timeless_records for r in progress.values()) == sum(r[4] is None for r in rows)


def test_run_that_goes_on_after_open_windows(spark):
    rows = records(4)
    root = tempfile.mkdtemp(prefix="dq-staged-")
    sinks = StreamSinks(lake=f"{root}/lake", issues=f"{root}/issues", summary=f"{root}/summary")
    seen = []
    for part in (rows[:50], rows[50:100], rows[100:]):
        seen += part
        frame(spark, part).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        q = start_assessment(stream, RULES, sinks, f"{root}/ckpt", trigger={"availableNow": True})
        finish(q, RULES, sinks, f"{root}/ckpt")
        assert rows_of(spark.read.parquet(sinks.lake)) == rows_of(assess(frame(spark, seen), RULES))
        total = spark.read.parquet(sinks.summary).filter("level = 'total'").agg(F.sum("records")).first()[0]
        assert total == len(seen)
        # each record is read from the source once
        assert sum(p["numInputRows"] for p in q.recentProgress) == len(part)


def test_landing_of_closed_windows_goes(spark):
    root = tempfile.mkdtemp(prefix="dq-staged-")
    sinks = StreamSinks(lake=f"{root}/lake")
    w = StagedWindows(spark, frame(spark, []).schema, RULES, sinks, f"{root}/ckpt", late_for="0 minutes")
    at = lambda m: BASE + dt.timedelta(minutes=m)
    w(frame(spark, [(0, "a", "P", 1.0, at(0)), (1, "a", "P", 3.0, at(40))]), 0)
    w(frame(spark, [(2, "a", "P", 5.0, at(80))]), 1)  # what batch 0 closed is dropped as batch 1 begins
    assert spark.read.parquet(landing_path(f"{root}/ckpt")).select("n").distinct().count() == 2
    w(frame(spark, [(3, "b", "P", 2.0, at(1))]), 2)  # its window's other record comes from the lake
    lake = {r.n: r for r in spark.read.parquet(sinks.lake).collect()}
    assert lake[0].x_mean == lake[3].x_mean == 1.5 and sorted(lake) == [0, 1, 3]


def test_empty_batches(spark):
    root = tempfile.mkdtemp(prefix="dq-staged-")
    w = StagedWindows(spark, frame(spark, []).schema, RULES, StreamSinks(lake=f"{root}/lake"), f"{root}/ckpt")
    w(frame(spark, []), 0)
    w.assess_open()
    assert read_progress(spark, f"{root}/ckpt").first().records == 0
