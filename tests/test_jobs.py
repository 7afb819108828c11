"""Both job entry points, end to end, with a YAML rule file."""

import datetime as dt
import json
import os
import tempfile

import pytest

from dqspark import Rules, vitals_rules
from dqspark.jobs import main
from dqspark.operators import assess
from dqspark.sources.snapshots import current

YAML = """
completeness:
  required_fields:
    - patient_id
    - hospital
    - age
    - bp_systolic
validity:
  age: {min: 0, max: 120}
  bp_systolic: {min: 70, max: 250}
  temperature: {min: 35, max: 42}
anomaly_detection:
  z_score_threshold: 3
  fields: [age, bp_systolic]
prefixes: {age: age, bp_systolic: bp, temperature: temp}
"""


def test_yaml_rules_equal_default():
    with tempfile.NamedTemporaryFile("w", suffix=".yaml", delete=False) as fh:
        fh.write(YAML)
    assert Rules.from_yaml(fh.name) == vitals_rules()


def test_stream_then_daily_job(spark):
    root = tempfile.mkdtemp(prefix="dq-jobs-")
    with open(f"{root}/rules.yaml", "w") as fh:
        fh.write(YAML)
    os.makedirs(f"{root}/in")
    base = dt.datetime(2024, 2, 1)
    with open(f"{root}/in/a.json", "w") as fh:
        for i in range(3 * 24 * 12):  # 3 days, one record per 5 minutes
            rec = {"patient_id": f"P{i % 9}", "hospital": f"H{i % 2}", "age": 30 + i % 50, "bp_systolic": 120,
                   "temperature": 36.6, "timestamp": (base + dt.timedelta(minutes=5 * i)).isoformat()}
            fh.write(json.dumps(rec) + "\n")
    main(["stream", "--rules", f"{root}/rules.yaml", "--time", "timestamp", "--source", "text", "--input", f"{root}/in",
          "--lake", f"{root}/lake", "--summary", f"{root}/summary", "--checkpoint", f"{root}/ckpt",
          "--trigger", "available-now", "--state-partitions", "4"])
    lake = spark.read.parquet(f"{root}/lake")
    assert lake.count() > 700
    main(["daily", "--rules", f"{root}/rules.yaml", "--time", "timestamp", "--lake", f"{root}/lake", "--out", f"{root}/out"])
    latest = spark.read.parquet(f"{current(spark, f'{root}/out')}/latest")
    assert sorted(r["hospital"] for r in latest.collect()) == ["H0", "H1"]
    assert spark.read.parquet(f"{current(spark, f'{root}/out')}/daily").count() >= 4


PLAIN = """
completeness:
  required_fields: [patient_id, hospital, age, bp_systolic]
validity:
  age: {min: 0, max: 120}
  bp_systolic: {min: 70, max: 250}
  temperature: {min: 35, max: 42}
anomaly_detection:
  z_score_threshold: 3
"""


def test_plain_rule_file_checks_anomalies(spark, tmp_path):
    """A file that names no anomaly fields and no prefixes means the default ones."""
    (tmp_path / "rules.yaml").write_text(PLAIN)
    rules = Rules.from_yaml(str(tmp_path / "rules.yaml"))
    assert rules == vitals_rules()
    rows = [(f"P{i}", "H", 40 + i % 3, 120 + i % 5, dt.datetime(2024, 1, 1)) for i in range(60)] + [("P99", "H", 110, 121, dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "patient_id string, hospital string, age int, bp_systolic int, ingestion_time timestamp")
    scored = assess(df.selectExpr("*", "36.5D AS temperature"), rules)
    assert {"age_valid", "bp_valid", "temp_valid"} <= set(scored.columns)
    assert [r.patient_id for r in scored.filter("quality_score = 50").collect()] == ["P99"]


@pytest.mark.parametrize("odd", [{"anomaly": {}}, {"anomaly_detection": {"zscore": 3}}])
def test_unknown_rule_keys_are_refused(odd):
    with pytest.raises(ValueError, match="unknown"):
        Rules.from_dict({"completeness": {"required_fields": ["a"]}} | odd)


def _lines(n=118):
    base = dt.datetime(2024, 1, 1)
    good = [json.dumps({"patient_id": f"P{i}", "hospital": f"H{i % 2}", "age": 40 + i % 5, "bp_systolic": 120, "timestamp": (base + dt.timedelta(minutes=i)).isoformat()}) for i in range(n)]
    return good + ["not json", json.dumps({"patient_id": "P", "hospital": "H", "age": 1, "bp_systolic": 120, "timestamp": "nope"})]


@pytest.mark.parametrize("time", ["ingestion_time", "timestamp"])
def test_bounded_run_loses_and_doubles_nothing(spark, tmp_path, time):
    os.makedirs(f"{tmp_path}/in")
    job = ["stream", "--time", time, "--source", "text", "--input", f"{tmp_path}/in", "--lake", f"{tmp_path}/lake",
           "--issues", f"{tmp_path}/issues", "--immediate", f"{tmp_path}/now", "--checkpoint", f"{tmp_path}/ckpt",
           "--trigger", "available-now", "--state-partitions", "2", "--stream-salts", "2"]
    lines = _lines()
    for k, part in enumerate((lines[:70], lines[70:])):
        with open(f"{tmp_path}/in/{k}.txt", "w") as fh:
            fh.write("\n".join(part) + "\n")
        main(job)
        lake = spark.read.parquet(f"{tmp_path}/lake")
        assert lake.count() == (70, 120)[k]
        assert lake.filter("patient_id LIKE 'P_%'").select("patient_id").distinct().count() == (70, 118)[k]
    assert [r.quality_score for r in lake.filter("patient_id IS NULL").collect()] == [25]  # the malformed line
    assert spark.read.json(f"{tmp_path}/now").count() == 1


def test_stream_compact_and_incremental_daily_jobs(spark, tmp_path):
    """The lake is compacted between runs; the daily job reads new dates only; no job
    leaves intermediate tables."""
    from dqspark import session
    from dqspark.sources.lake import read_lake
    from dqspark.sources.snapshots import current

    os.makedirs(f"{tmp_path}/in")
    lake, out, state, before = f"{tmp_path}/lake", f"{tmp_path}/out", f"{tmp_path}/state", list(session._SCRATCH)
    stream = ["stream", "--time", "timestamp", "--source", "text", "--input", f"{tmp_path}/in", "--lake", lake,
              "--checkpoint", f"{tmp_path}/ckpt", "--trigger", "available-now", "--late-for", "1 hour"]
    daily = ["daily", "--time", "timestamp", "--lake", lake, "--out", out, "--state", state, "--expire-seconds", "0"]
    lines = _lines()
    for k, part in enumerate((lines[:70], lines[70:])):
        with open(f"{tmp_path}/in/{k}.txt", "w") as fh:
            fh.write("\n".join(part) + "\n")
        main(stream)
        main(["compact", "--lake", lake, "--min-files", "1", "--keep-seconds", "0"])
        assert not [f for _, _, names in os.walk(lake) for f in names if f.endswith(".parquet")]
        assert read_lake(spark, lake).count() == (70, 120)[k]
        main(daily + (["--redo", "2024-01-01"] if k else []))
        # dates are known by their folders, packed or not; records without a time are a group of their own
        trends = spark.read.parquet(f"{current(spark, out)}/trends")
        assert trends.agg({"total_records": "sum"}).first()[0] == read_lake(spark, lake).count()
    assert len([d for d in os.listdir(out) if d.startswith("v-")]) == 1
    assert session._SCRATCH == before
