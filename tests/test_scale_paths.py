"""The size-checked broadcast, the salted fallback, NULL-time rows, lake
partition pruning and the daily job."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from dqspark.operators import assess, attach_anomalies, assess_rows
from dqspark.plans.daily import run_daily
from dqspark.sources.snapshots import current
from dqspark.sources import READINGS_RULES as R, event_readings, read_lake, write_lake

SF = "/root/testdata/sf0.01"
COLS = ["event_id", "m1_mean", "m1_stddev", "m1_zscore", "m1_anomaly", "m2_zscore", "has_issues", "quality_score"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_path_does_not_shuffle_rows(spark):
    a = assess(event_readings(spark, SF), R)
    plan = _plan(a)
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan  # raw rows never shuffle


def test_salted_path_equals_broadcast_path(spark):
    rows = assess_rows(event_readings(spark, SF), R)
    ref = attach_anomalies(rows, R)
    # every (day, type) group has ~60 rows: hot_rows=20 salts each into ~3-4 pieces
    salted = attach_anomalies(rows, R, broadcast_rows=0, hot_rows=20)
    plan = _plan(salted)
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    a = sorted(tuple(r) for r in ref.select(*COLS).collect())
    b = sorted(tuple(r) for r in salted.select(*COLS).collect())
    assert len(a) == 10000 and a == b
    # no hot group at all -> plain shuffle join, same answer
    plain = attach_anomalies(rows, R, broadcast_rows=0, hot_rows=10**9)
    assert sorted(tuple(r) for r in plain.select(*COLS).collect()) == a


def test_null_time_rows_are_kept(spark):
    ev = event_readings(spark, "/root/testdata/sf0.001")
    ev = ev.withColumn("ts", F.when(F.col("event_id") % 50 == 0, F.lit(None).cast("timestamp")).otherwise(F.col("ts")))
    a = assess(ev, R)
    assert a.count() == ev.count()
    nt = a.filter(F.col("ts").isNull())
    assert nt.count() == 20 and nt.filter(F.col("m1_mean").isNotNull()).count() == 0


def test_lake_partition_pruning_and_daily_job(spark):
    root = tempfile.mkdtemp(prefix="dq-lake-")
    a = assess(event_readings(spark, SF), R)
    write_lake(a, f"{root}/lake", R)
    lake = read_lake(spark, f"{root}/lake", "2024-01-10")
    plan = lake._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "<= 2024-01-10" in plan
    assert lake.select("date").distinct().count() == 10
    res = run_daily(spark, f"{root}/lake", f"{root}/out", R, run_date="2024-01-10", written_at=dt.datetime(2024, 1, 11))
    latest = spark.read.parquet(f"{current(spark, f'{root}/out')}/latest")
    assert latest.count() == 5 and {r[0] for r in latest.select("date").distinct().collect()} == {dt.date(2024, 1, 10)}
    tr = spark.read.parquet(f"{current(spark, f'{root}/out')}/trends")
    assert tr.select("date").distinct().count() == 1 and "predicted_issue_risk" in tr.columns
    assert spark.read.parquet(f"{current(spark, f'{root}/out')}/problems").count() == 10
    docs = spark.read.json(f"{current(spark, f'{root}/out')}/documents")
    assert docs.filter("kind = 'daily'").count() == 5 and docs.filter("kind = 'trend'").count() == 5
    assert '"healthStatus"' in docs.filter("kind = 'daily'").first()["value"]
    assert res.daily.agg(F.sum("total_records")).first()[0] == lake.count()


def test_comparison_from_daily_equals_direct(spark):
    from dqspark.operators import daily_metrics, entity_comparison, entity_comparison_from_daily

    a = assess(event_readings(spark, SF), R)
    direct = entity_comparison(a, R).collect()
    derived = entity_comparison_from_daily(daily_metrics(a, R), R).collect()
    assert [r["entity"] for r in direct] == [r["entity"] for r in derived]
    for x, y in zip(direct, derived):
        assert (x["total_records"], x["total_issues"]) == (y["total_records"], y["total_issues"])
        assert abs(x["avg_quality_score"] - y["avg_quality_score"]) < 1e-12
        assert abs(x["issue_rate"] - y["issue_rate"]) < 1e-12


def test_lake_write_splits_hot_dates(spark):
    root = tempfile.mkdtemp(prefix="dq-lake2-")
    a = assess(event_readings(spark, SF), R)
    write_lake(a, f"{root}/lake", R)
    lake = spark.read.parquet(f"{root}/lake")
    assert lake.count() == 10000
    assert len({f.rsplit("/", 2)[-2] for f in lake.inputFiles()}) == 30  # every date directory written


def test_salting_spreads_a_hot_group(spark):
    """Half of all rows in one (window, entity) group: on the shuffle path the
    group is split over several join tasks instead of one."""
    from dataclasses import replace

    rules = replace(R, window="30 days")
    ev = event_readings(spark, SF).withColumn(
        "entity", F.when(F.col("event_id") % 2 == 0, F.lit("hot")).otherwise(F.col("entity"))
    )
    rows = assess_rows(ev, rules)
    conf = {
        "spark.sql.adaptive.skewJoin.enabled": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    prev = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = attach_anomalies(rows, rules, broadcast_rows=0, hot_rows=500)
        per_task = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        ref = {r["event_id"]: r["m1_zscore"] for r in attach_anomalies(rows, rules).select("event_id", "m1_zscore").collect()}
        got = {r["event_id"]: r["m1_zscore"] for r in out.select("event_id", "m1_zscore").collect()}
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)
    assert sum(per_task) == 10000
    assert max(per_task) < 0.35 * 10000  # the 5,000-row hot group is not in one task
    assert got.keys() == ref.keys()
    assert all(abs((got[k] or 0) - (ref[k] or 0)) < 1e-9 for k in ref)


def test_chunked_broadcast_equals_broadcast(spark):
    """Statistics over the bound on a date-partitioned input: one broadcast
    join per day range over pruned scans, no record shuffle, same answer."""
    root = tempfile.mkdtemp(prefix="dq-chunk-")
    raw = event_readings(spark, SF).withColumn("ts", F.when(F.col("event_id") % 500 == 0, None).otherwise(F.col("ts")))
    raw.withColumn("date", F.to_date("ts")).write.partitionBy("date").parquet(f"{root}/raw")
    src = spark.read.parquet(f"{root}/raw")
    rows = assess_rows(src, R)
    ref = attach_anomalies(rows, R)
    # ~6 statistics rows per day: a bound of 50 gives 4 day ranges
    chunked = attach_anomalies(rows, R, broadcast_rows=50, partition_col="date")
    plan = _plan(chunked)
    assert plan.count("BroadcastHashJoin") >= 4
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert "PartitionFilters: [isnotnull(date" in plan
    import re

    # rows without a time: only the NULL partition is read
    assert re.search(r"PartitionFilters: \[isnull\(date(#\d+)?\)\]", plan)
    a = sorted((tuple(r) for r in ref.select(*COLS).collect()), key=str)
    b = sorted((tuple(r) for r in chunked.select(*COLS).collect()), key=str)
    assert len(b) == 10000 and a == b


def test_chunked_broadcast_with_multi_day_windows(spark):
    from dqspark.sources import LINEITEM_RULES as LR, lineitem_readings

    root = tempfile.mkdtemp(prefix="dq-chunk7-")
    lineitem_readings(spark, SF).withColumn("date", F.to_date("ship_ts")).write.partitionBy("date").parquet(f"{root}/li")
    rows = assess_rows(spark.read.parquet(f"{root}/li"), LR)
    cols = ["l_orderkey", "l_linenumber", "l_quantity_zscore", "l_discount_zscore", "has_issues", "quality_score"]
    ref = sorted(tuple(r) for r in attach_anomalies(rows, LR).select(*cols).collect())
    got = sorted(tuple(r) for r in attach_anomalies(rows, LR, broadcast_rows=200, partition_col="date").select(*cols).collect())
    assert len(got) == 60000 and got == ref


def test_chunked_plan_needs_a_true_date_column(spark):
    """A 'date' column that is not the date of the time column must not be
    trusted for pruning: the plan falls back to the salted join."""
    root = tempfile.mkdtemp(prefix="dq-chunkbad-")
    raw = event_readings(spark, SF).withColumn("date", F.date_add(F.to_date("ts"), 1))
    raw.write.partitionBy("date").parquet(f"{root}/raw")
    rows = assess_rows(spark.read.parquet(f"{root}/raw"), R)
    out = attach_anomalies(rows, R, broadcast_rows=50, partition_col="date")
    plan = _plan(out)
    assert plan.count("BroadcastHashJoin") < 4  # not the per-range plan
    ref = sorted((tuple(r) for r in attach_anomalies(rows, R).select(*COLS).collect()), key=str)
    assert sorted((tuple(r) for r in out.select(*COLS).collect()), key=str) == ref


def test_more_ranges_than_a_plan_holds(spark, monkeypatch):
    from dqspark.operators import assess as _  # noqa: F401
    import importlib

    mod = importlib.import_module("dqspark.operators.assess")
    monkeypatch.setattr(mod, "RANGES_PER_PLAN", 2)
    root = tempfile.mkdtemp(prefix="dq-lots-")
    raw = event_readings(spark, SF).withColumn("ts", F.when(F.col("event_id") % 500 == 0, None).otherwise(F.col("ts")))
    raw.withColumn("date", F.to_date("ts")).write.partitionBy("date").parquet(f"{root}/raw")
    rows = assess_rows(spark.read.parquet(f"{root}/raw"), R)
    ref = sorted((tuple(r) for r in attach_anomalies(rows, R).select(*COLS).collect()), key=str)
    got = attach_anomalies(rows, R, broadcast_rows=50, partition_col="date")
    assert sorted((tuple(r) for r in got.select(*COLS).collect()), key=str) == ref
    by_bytes = attach_anomalies(rows, R, broadcast_bytes=4000, partition_col="date")
    assert sorted((tuple(r) for r in by_bytes.select(*COLS).collect()), key=str) == ref


def test_hot_list_beyond_its_bound_leaves_no_key_unsplit(spark):
    rows = assess_rows(event_readings(spark, SF), R)
    ref = sorted((tuple(r) for r in attach_anomalies(rows, R).select(*COLS).collect()), key=str)
    got = attach_anomalies(rows, R, broadcast_rows=0, hot_rows=10, hot_list_rows=3)
    assert sorted((tuple(r) for r in got.select(*COLS).collect()), key=str) == ref


def test_lake_write_splits_one_ingestion_time(spark, tmp_path):
    """All rows of one moment: no range of (date, time) could split them."""
    df = spark.range(300_000).select(F.uuid().alias("patient_id"), F.timestamp_seconds(F.lit(1_700_000_000)).alias("ts"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    prev = spark.conf.get(key)
    spark.conf.set(key, "2m")
    try:
        write_lake(df, f"{tmp_path}/lake", R)
    finally:
        spark.conf.set(key, prev)
    back = spark.read.parquet(f"{tmp_path}/lake")
    assert back.count() == 300_000 and len(back.inputFiles()) > 2


def test_stream_reads_a_table_of_part_files(spark, tmp_path):
    from dqspark.streaming.queries import q_stream_assess

    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(map(tuple, q_stream_assess(spark, str(tmp_path)).collect()))
    assert got == sorted(map(tuple, q_stream_assess(spark, "/root/testdata/sf0.001").collect()))
    assert len(got) == 1000
