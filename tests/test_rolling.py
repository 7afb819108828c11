"""Count-window z-score (X2) against a brute-force computation, with a hot
entity split over several sorted partitions and a window crossing them."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from dqspark import Range, Rules
from dqspark.operators import count_window_anomalies, count_window_step

RULES = Rules(
    required=("entity",),
    ranges=(("x", Range(0, 1000)),),
    anomaly=("x",),
    entity="entity",
    subject="id",
    time="ts",
    z_threshold=1.5,
)


def brute(pdf: pd.DataFrame, n: int) -> dict:
    out = {}
    for ent, g in pdf[pdf.entity.notna()].sort_values(["ts", "id"]).groupby("entity"):
        xs = g.x.to_numpy(dtype=float)
        for i, rid in enumerate(g.id):
            w = xs[max(0, i - n + 1): i + 1]
            w = w[~np.isnan(w)]
            mean = w.mean() if len(w) else None
            sd = w.std(ddof=1) if len(w) > 1 else None
            x = xs[i]
            if sd is not None and sd > 0:
                z = None if np.isnan(x) else abs(x - mean) / sd
            else:
                z = 0.0
            out[rid] = (mean, sd, z)
    for rid in pdf[pdf.entity.isna()].id:
        out[rid] = (None, None, 0.0)
    return out


@pytest.mark.parametrize("n", [1, 2, 7, 50])
def test_count_window_matches_brute_force(spark, n):
    rng = np.random.default_rng(7)
    rows = []
    base = dt.datetime(2024, 1, 1)
    for i in range(600):
        ent = "hot" if i % 3 == 0 else f"e{i % 11}"
        if i % 37 == 0:
            ent = None
        x = float(rng.normal(50, 10))
        if i % 41 == 0:
            x = None
        if i % 97 == 0:
            x = 400.0
        rows.append((i, ent, x, base + dt.timedelta(minutes=int(rng.integers(0, 100)))))
    pdf = pd.DataFrame(rows, columns=["id", "entity", "x", "ts"])
    df = spark.createDataFrame(rows, "id long, entity string, x double, ts timestamp")
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep 8 sorted partitions
    try:
        got = {r["id"]: r for r in count_window_anomalies(df, RULES, ("id",), window_rows=n).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)
    exp = brute(pdf, n)
    assert len(got) == 600
    for rid, (mean, sd, z) in exp.items():
        r = got[rid]
        for a, b in ((r["x_mean"], mean), (r["x_stddev"], sd), (r["x_zscore"], z)):
            if b is None:
                assert a is None, rid
            else:
                assert a == pytest.approx(b, rel=1e-9, abs=1e-9), rid
        assert r["x_anomaly"] == (None if z is None else z > 1.5)


@pytest.mark.parametrize("n", [1, 4, 50])
def test_repeated_rows_stay_as_many(spark, n):
    """Rows out are rows in, whatever repeats; equal rows share the statistics of the last of them."""
    rng = np.random.default_rng(n)
    base = dt.datetime(2024, 1, 1)
    rows = [(int(i % 20), f"e{i % 2}" if i % 9 else None, float(rng.integers(0, 5)), base + dt.timedelta(minutes=int(i % 20))) for i in range(50)]
    rows = rows * 3 + rows[:7]
    df = spark.createDataFrame(rows, "id long, entity string, x double, ts timestamp")
    got = count_window_anomalies(df, RULES, ("id",), window_rows=n).collect()
    assert sorted((r.id, r.entity, r.x, r.ts) for r in got if r.entity) == sorted(r for r in rows if r[1])
    assert len(got) == len(rows)
    ordered = {e: sorted([r for r in rows if r[1] == e], key=lambda r: (r[3], r[0], r[2])) for e in ("e0", "e1")}
    for r in got:
        if r.entity:
            own = ordered[r.entity]
            last = max(i for i, o in enumerate(own) if (o[3], o[0]) == (r.ts, r.id))
            w = np.array([o[2] for o in own[max(0, last - n + 1) : last + 1]])
            assert np.isclose(r.x_mean, w.mean())
            assert r.x_stddev is None if len(w) == 1 else np.isclose(r.x_stddev, w.std(ddof=1), atol=1e-7)


@pytest.mark.parametrize("n", [1, 7, 300])
def test_steps_equal_one_run(spark, n):
    """Three steps, entities that pause, null times, a tail longer than the history."""
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(240):
        ent = None if i % 31 == 0 else "hot" if i % 2 else f"e{i % 7}"
        at = None if i < 9 else base + dt.timedelta(minutes=i // 4)
        rows.append((i, ent, None if i % 13 == 0 else float(i * i % 101), at))
    schema = "id long, entity string, x double, ts timestamp"
    one = {r["id"]: r for r in count_window_anomalies(spark.createDataFrame(rows, schema), RULES, ("id",), n).collect()}
    got, tail = {}, None
    for part in (rows[:100], [r for r in rows[100:180] if r[1] != "e2"], [], [r for r in rows[100:180] if r[1] == "e2"] + rows[180:]):
        out, tail = count_window_step(spark.createDataFrame(part, schema), tail, RULES, ("id",), n)
        tail = spark.createDataFrame(tail.collect(), tail.schema)
        got |= {r["id"]: r for r in out.collect()}
        assert all(r[0] < n for r in tail.groupBy("entity").count().select("count").collect())
    assert got.keys() == one.keys()
    for i, r in one.items():
        for c in ("x_mean", "x_stddev", "x_zscore"):
            assert got[i][c] == pytest.approx(r[c], abs=1e-9), (i, c)
        assert got[i]["x_anomaly"] == r["x_anomaly"]


def test_step_refuses_rows_older_than_the_tail(spark):
    schema = "id long, entity string, x double, ts timestamp"
    at = lambda h: dt.datetime(2024, 1, 1, h)
    _, tail = count_window_step(spark.createDataFrame([(1, "a", 1.0, at(5)), (2, "b", 1.0, at(9))], schema), None, RULES, ("id",), 3)
    count_window_step(spark.createDataFrame([(3, "a", 2.0, at(6))], schema), tail, RULES, ("id",), 3)
    for late in ((3, "a", 2.0, at(4)), (1, "a", 1.0, at(5)), (3, "b", 2.0, None)):
        with pytest.raises(ValueError, match="not newer"):
            count_window_step(spark.createDataFrame([late], schema), tail, RULES, ("id",), 3)
