"""Property test: ``assess`` equals a plain-Python model of the rules on
random rows (NULLs, out-of-range values, several entities and windows)."""

import datetime as dt
import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dqspark import vitals_rules
from dqspark.operators import assess

RULES = vitals_rules()
BASE = dt.datetime(2024, 6, 1, 9, 0, 0)
SCHEMA = "patient_id string, hospital string, age int, bp_systolic int, temperature double, ingestion_time timestamp"

row = st.tuples(
    st.one_of(st.none(), st.sampled_from(["p1", "p2", ""])),
    st.one_of(st.none(), st.sampled_from(["H1", "H2"])),
    st.one_of(st.none(), st.integers(-10, 140)),
    st.one_of(st.none(), st.integers(50, 270)),
    st.one_of(st.none(), st.sampled_from([30.0, 35.0, 36.6, 42.0, 45.5])),
    st.integers(0, 599),  # seconds after BASE: two 5-minute windows
)


def _or3(vals):
    if any(v is True for v in vals):
        return True
    if any(v is None for v in vals):
        return None
    return False


def model(rows):
    groups = {}
    for r in rows:
        if r[1] is not None:
            groups.setdefault((r[5] // 300, r[1]), []).append(r)
    stats = {}
    for k, rs in groups.items():
        for i, name in ((2, "age"), (3, "bp")):
            xs = [r[i] for r in rs if r[i] is not None]
            mean = statistics.fmean(xs) if xs else None
            sd = statistics.stdev(xs) if len(xs) > 1 else None
            stats[(k, name)] = (mean, sd)
    out = []
    for r in rows:
        comp = sum(v is not None for v in r[:4])
        valid = []
        for v, lo, hi in ((r[2], 0, 120), (r[3], 70, 250), (r[4], 35, 42)):
            valid.append(None if v is None else lo <= v <= hi)
        anomalies = []
        for i, name in ((2, "age"), (3, "bp")):
            mean, sd = stats.get(((r[5] // 300, r[1]), name), (None, None)) if r[1] is not None else (None, None)
            if sd is not None and sd > 0:
                z = None if r[i] is None else abs((r[i] - mean) / sd)
            else:
                z = 0.0
            anomalies.append(None if z is None else z > 3)
        issues = _or3([comp < 4] + [None if v is None else not v for v in valid] + anomalies)
        if comp < 4:
            score = 25
        elif issues is False:
            score = 100
        elif any(a is True for a in anomalies):
            score = 50
        elif any(v is False for v in valid):
            score = 75
        else:
            score = 100
        out.append((comp, tuple(valid), tuple(anomalies), issues, score))
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=40))
def test_assess_matches_model(spark, rows):
    data = [(i, *r[:5], BASE + dt.timedelta(seconds=r[5])) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "rid int, " + SCHEMA)
    got = {
        r["rid"]: (
            r["completeness_score"],
            (r["age_valid"], r["bp_valid"], r["temp_valid"]),
            (r["age_anomaly"], r["bp_anomaly"]),
            r["has_issues"],
            r["quality_score"],
        )
        for r in assess(df, RULES).collect()
    }
    exp = model(rows)
    for i, e in enumerate(exp):
        assert got[i] == e, (rows[i], got[i], e)
        assert got[i][4] in (25, 50, 75, 100)
        assert not (got[i][3] is True and got[i][4] == 100)
