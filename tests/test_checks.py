"""Truth tables for completeness, validity, z-score anomalies and the score,
on hand-written vital-sign rows (default rule set)."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from dqspark import vitals_rules
from dqspark.operators import assess, extract_issues

RULES = vitals_rules()
SCHEMA = T.StructType(
    [
        T.StructField("patient_id", T.StringType()),
        T.StructField("hospital", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("bp_systolic", T.IntegerType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("ingestion_time", T.TimestampType()),
    ]
)
BASE = dt.datetime(2024, 3, 1, 10, 0, 0)


def row(pid, hosp="H1", age=50, bp=120, temp=36.6, minute=0):
    return (pid, hosp, age, bp, temp, BASE + dt.timedelta(seconds=minute))


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r["patient_id"]: r for r in assess(df, RULES).collect()}


def test_row_cases(spark):
    rows = [
        row("clean"),
        row("neg_age", age=-5),
        row("extreme_bp", bp=300),
        row("bad_temp", temp=50.0),
        row("no_temp", temp=None),
        row("no_age", age=None),
        row("no_hosp", hosp=None),
        (None, None, None, None, None, BASE),
        row("", age=51),
        row("lo_bounds", age=0, bp=70, temp=35.0),
        row("hi_bounds", age=120, bp=250, temp=42.0),
    ]
    # pad the window so stats exist but no anomaly is possible (constant values)
    rows += [row(f"pad{i}") for i in range(5)]
    out = run(spark, rows)
    exp = {
        "clean": ("", 4, True, True, True, False, 100),
        "neg_age": ("", 4, False, True, True, True, 75),
        "extreme_bp": ("", 4, True, False, True, True, 75),
        "bad_temp": ("", 4, True, True, False, True, 75),
        "no_temp": ("", 4, True, True, None, None, 100),
        "no_age": ("age", 3, None, True, True, True, 25),
        "no_hosp": ("hospital", 3, True, True, True, True, 25),
        "": ("", 4, True, True, True, False, 100),
        "lo_bounds": ("", 4, True, True, True, False, 100),
        "hi_bounds": ("", 4, True, True, True, False, 100),
    }
    for pid, (mf, cs, av, bv, tv, hi, qs) in exp.items():
        r = out[pid]
        assert (r["missing_fields"], r["completeness_score"]) == (mf, cs), pid
        assert (r["age_valid"], r["bp_valid"], r["temp_valid"]) == (av, bv, tv), pid
        assert (r["has_issues"], r["quality_score"]) == (hi, qs), pid
    # no_hosp: NULL entity never matches window stats -> z = 0
    assert out["no_hosp"]["age_zscore"] == 0.0 and out["no_hosp"]["age_mean"] is None
    allnull = [r for k, r in out.items() if k is None][0]
    assert allnull["missing_fields"] == "patient_id,hospital,age,bp_systolic"
    assert allnull["completeness_score"] == 0 and allnull["quality_score"] == 25
    assert allnull["has_issues"] is True


@pytest.mark.parametrize(
    "n_normal,outlier,expect_anomaly,expect_score",
    [(11, 118, True, 50), (11, 500, True, 50), (9, 118, False, 100)],
)
def test_anomaly_threshold(spark, n_normal, outlier, expect_anomaly, expect_score):
    rows = [row(f"p{i}", age=50, minute=i) for i in range(n_normal)] + [row("out", age=outlier, minute=59)]
    r = run(spark, rows)["out"]
    n = n_normal + 1
    assert r["age_zscore"] == pytest.approx((n - 1) / n ** 0.5)
    assert r["age_anomaly"] is expect_anomaly
    if outlier > 120:
        assert r["age_valid"] is False  # anomaly (50) outranks invalid (75)
    assert r["quality_score"] == expect_score
    assert r["has_issues"] is expect_anomaly or outlier > 120


def test_single_row_and_constant_window(spark):
    one = run(spark, [row("solo", age=90)])["solo"]
    assert one["age_stddev"] is None and one["age_zscore"] == 0.0 and one["quality_score"] == 100
    const = run(spark, [row(f"c{i}", age=40) for i in range(15)])
    assert all(r["age_zscore"] == 0.0 and r["age_anomaly"] is False for r in const.values())


def test_windows_are_separate_per_entity_and_time(spark):
    # 11 rows at 50 plus an outlier in H1; the same outlier in H2 alone and in
    # the next 5-minute window must not be anomalous.
    rows = [row(f"a{i}", age=50, minute=i) for i in range(11)] + [row("a_out", age=118, minute=30)]
    rows += [row("b_out", hosp="H2", age=118, minute=30)]
    rows += [row("late_out", age=118, minute=400)]
    out = run(spark, rows)
    assert out["a_out"]["age_anomaly"] is True
    assert out["b_out"]["age_anomaly"] is False
    assert out["late_out"]["age_anomaly"] is False


def test_extract_issues_projection(spark):
    rows = [row("clean"), row("neg_age", age=-5), row("no_temp", temp=None)]
    df = assess(spark.createDataFrame(rows, SCHEMA), RULES)
    iss = extract_issues(df, RULES)
    assert iss.columns == [
        "patient_id", "hospital", "age", "bp_systolic", "temperature", "quality_score",
        "completeness_score", "age_valid", "bp_valid", "temp_valid", "age_anomaly", "bp_anomaly", "detected_at",
    ]
    got = [r["patient_id"] for r in iss.collect()]
    assert got == ["neg_age"]  # NULL has_issues is not an issue


def test_rules_from_dict_and_validation():
    from dqspark import Rules

    r = Rules.from_dict(
        {"completeness": {"required_fields": ["a"]}, "validity": {"a": {"min": 0, "max": 1}}},
        entity="e", subject="a", time="t",
    )
    assert r.range_fields == ("a",) and r.n_required == 1
    with pytest.raises(ValueError):
        Rules(required=())
    with pytest.raises(ValueError):
        Rules.from_dict({"completeness": {"required_fields": ["a"]}, "validity": {"a": {"min": 2, "max": 1}}})


def test_rules_from_alternative_layout():
    from dqspark import Rules

    spec = {
        "completeness": {"required_fields": ["patient_id", "age", "bp_systolic", "temperature"], "max_null_pct": 5},
        "validity": {"age": {"min": 0, "max": 150}, "bp_systolic": {"min": 50, "max": 250},
                     "temperature": {"min": 35.0, "max": 45.0}},
        "anomaly_detection": {"z_score_threshold": 3, "window_size": 1000},
    }
    r = Rules.from_dict(spec, anomaly=("age", "bp_systolic"))
    assert r.row_window == 1000 and r.max_null_pct == 5.0 and r.n_required == 4
    assert r.range_of("temperature").max == 45.0 and r.anomaly == ("age", "bp_systolic")
