"""Every registered query against its DuckDB SQL twin (sf0.001), plus the
entry point and property checks on the assessed readings."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from dqspark.plans.oracle import oracle_sql
from dqspark.plans.queries import registry
from conftest import SF_SMALL
from oracle_compare import compare, duck

NAMES = sorted(registry())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle_or_is_known_rows_only():
    assert set(NAMES) == set(oracle_sql())
    assert set(NAMES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, con)
    if r.get("oracle") is None and name not in E.oracle_sql():
        assert r["rows"] > 0
        return
    assert r["rows"] == r["oracle_rows"], r
    assert r["cols_match"], r
    assert r["hash_match"], r


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "trend_direction" in df.columns


def test_fixture_fingerprint(spark):
    """Score distribution at sf0.001 (FIXTURES.md §4, computed independently)."""
    from dqspark.operators import assess
    from dqspark.sources import READINGS_RULES as R, event_readings

    a = assess(event_readings(spark, SF_SMALL), R)
    got = {(r[0], r[1]): r[2] for r in a.groupBy("has_issues", "quality_score").count().collect()}
    assert got == {(False, 100): 731, (None, 100): 51, (True, 75): 171, (True, 50): 2, (True, 25): 45}


def test_properties(spark):
    from dqspark.operators import assess, daily_metrics
    from dqspark.sources import READINGS_RULES as R, event_readings

    a = assess(event_readings(spark, "/root/testdata/sf0.01"), R)
    assert {r[0] for r in a.select("quality_score").distinct().collect()} <= {25, 50, 75, 100}
    assert a.filter(F.col("has_issues") & (F.col("quality_score") == 100)).count() == 0
    # z <= (n-1)/sqrt(n) for the window size n
    from dqspark.operators import window_stats
    from dqspark.functions.timewin import window_start

    ws = window_stats(event_readings(spark, "/root/testdata/sf0.01"), R).select("window_start", "entity", "n")
    j = a.withColumn("window_start", window_start(F.col("ts"), R.window)).join(ws, ["window_start", "entity"])
    bad = j.filter(F.col("m1_zscore") > (F.col("n") - 1) / F.sqrt(F.col("n")) + F.lit(1e-9))
    assert bad.count() == 0
    d = daily_metrics(a, R)
    assert d.filter((F.col("issue_rate") < 0) | (F.col("issue_rate") > 100)).count() == 0
    assert d.agg(F.sum("total_records")).first()[0] == a.count()


def test_queries_pin_utc_on_foreign_session(spark, con):
    """A caller's session in another time zone still gets UTC results."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = compare(spark, "daily_metrics", SF_SMALL, con)
        assert r["hash_match"], r
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
