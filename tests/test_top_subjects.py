"""Top subjects by sketch: the exact rows, whether the sketch decides or not."""

import pytest
from pyspark.sql import functions as F

from dqspark import Rules
from dqspark.operators import metrics, problem_subjects, problem_subjects_sketch

RULES = Rules.from_dict({"completeness": {"required_fields": ["who"]}}, entity="place", subject="who", time="at")


def skewed(spark, pairs, heavy):
    """``pairs`` pairs of one record, and ``heavy`` pairs of 400 and more; nulls, clean records."""
    light = spark.range(pairs).selectExpr("concat('s', id) AS who", "IF(id % 5 = 0, NULL, concat('p', id % 3)) AS place", "true AS has_issues")
    heavy = spark.range(heavy).selectExpr("IF(id = 2, NULL, concat('h', id)) AS who", "'p' AS place", "explode(sequence(1, 400 + 10 * cast(id div 2 as int)))").drop("col").withColumn("has_issues", F.lit(True))
    clean = spark.range(5_000).selectExpr("'clean' AS who", "'p' AS place", "IF(id % 2 = 0, false, CAST(NULL AS boolean)) AS has_issues")
    return light.unionByName(heavy).unionByName(clean).repartition(7)


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("pairs,heavy,decides", [(20_000, 14, True), (20_000, 0, False), (300, 14, True), (300, 0, True), (0, 0, True)])
def test_same_rows_as_the_full_count(spark, monkeypatch, pairs, heavy, decides):
    seen = []
    decided = metrics._decided
    monkeypatch.setattr(metrics, "_decided", lambda *a: seen.append(decided(*a)) or seen[-1])
    monkeypatch.setattr(metrics, "FAN_IN", 2)
    df = skewed(spark, pairs, heavy)
    got = problem_subjects_sketch(df, RULES, k=10, tracked=1_024, candidates=500)
    assert rows(got) == rows(problem_subjects(df, RULES, 10))
    assert (seen[0] is not None) == decides


def test_more_asked_for_than_candidates(spark):
    df = skewed(spark, 50, 3)
    assert rows(problem_subjects_sketch(df, RULES, k=40, candidates=20)) == rows(problem_subjects(df, RULES, 40))
    assert rows(problem_subjects_sketch(df, RULES, k=0)) == []
