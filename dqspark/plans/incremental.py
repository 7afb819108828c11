"""The daily job over new dates only.

Two small state tables, partitioned by date, hold what the job needs of a date:

* ``daily``: per (entity, date) the count, the issues, the sum of the scores, the sum of
  their squared distances from the mean, least and greatest score;
* ``subjects``: flagged records per (subject, entity, date).

A run reads only the lake's new or changed dates and replaces their state; trends,
comparison, offenders and risk are computed from the states.  States of disjoint
rows merge (``merge_daily``): counts and sums add up, and two groups' squared
distances n1, m1, q1 and n2, m2, q2 become q1 + q2 + n1 n2 / (n1 + n2) (m1 - m2)^2.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scoring
from ..rules import Rules
from ..sources.lake import DATE, read_lake
from .daily import DailyResults, publish_results

_SUMS = ["total_records", "records_with_issues", "score_sum"]


def daily_state(assessed: DataFrame, rules: Rules, day: Column) -> DataFrame:
    """One mergeable row per (entity, date)."""
    score = F.col("quality_score")
    n = F.count(F.lit(1))
    return assessed.groupBy(rules.entity, day.alias(DATE)).agg(
        n.alias("total_records"), F.count_if(F.col("has_issues")).alias("records_with_issues"), F.sum(score.cast("double")).alias("score_sum"),
        (F.coalesce(F.var_pop(score), F.lit(0.0)) * n).alias("score_spread"), F.min(score).alias("min_quality_score"), F.max(score).alias("max_quality_score"),
    )


def merge_daily(states: DataFrame, rules: Rules) -> DataFrame:
    """States of disjoint rows as one per (entity, date): the spread of a union is the
    spreads' sum, and that of the parts' means around the common one."""
    keys = [rules.entity, DATE]
    mean = F.col("score_sum") / F.col("total_records")
    # the parts' means weighted by their rows: sum n m^2 - (sum n m)^2 / sum n, centred on one of the means
    base = states.groupBy(*keys).agg(F.min(mean).alias("_base")).toDF("_e", "_d", "_base")
    j = states.join(base, F.col(rules.entity).eqNullSafe(F.col("_e")) & F.col(DATE).eqNullSafe(F.col("_d")))
    off = mean - F.col("_base")
    merged = j.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in _SUMS], F.sum("score_spread").alias("_own"), F.sum(F.col("total_records") * off).alias("_s"),
        F.sum(F.col("total_records") * off * off).alias("_q"), F.min("min_quality_score").alias("min_quality_score"), F.max("max_quality_score").alias("max_quality_score"),
    )
    between = F.greatest(F.col("_q") - F.col("_s") * F.col("_s") / F.col("total_records"), F.lit(0.0))
    return merged.select(*keys, *_SUMS, (F.col("_own") + between).alias("score_spread"), "min_quality_score", "max_quality_score")


def metrics_of(state: DataFrame, rules: Rules) -> DataFrame:
    """A2, P8, P9 from the states: the columns of ``daily_metrics``."""
    n = F.col("total_records")
    return state.select(
        rules.entity, DATE, n, "records_with_issues", (F.col("score_sum") / n).alias("avg_quality_score"), "max_quality_score", "min_quality_score",
        F.when(n > 1, F.sqrt(F.col("score_spread") / (n - 1))).alias("quality_variance"),
        scoring.issue_rate(F.col("records_with_issues"), n).alias("issue_rate"),
    ).withColumn("health_status", scoring.health_status(F.col("avg_quality_score")))


def subject_state(assessed: DataFrame, rules: Rules, day: Column) -> DataFrame:
    return assessed.filter("has_issues").groupBy(rules.subject, rules.entity, day.alias(DATE)).agg(F.count(F.lit(1)).alias("count"))


def top_subjects(state: DataFrame, rules: Rules, k: int = 10) -> DataFrame:
    """A4, L2 from the states of all dates."""
    return (
        state.groupBy(rules.subject, rules.entity).agg(F.sum("count").alias("count"))
        .orderBy(F.desc("count"), F.asc_nulls_last(rules.subject), F.asc_nulls_last(rules.entity)).limit(k)
    )


def dates_to_do(spark: SparkSession, lake_path: str, state_path: str) -> list:
    """The lake's dates that have no state yet, from folder names alone."""
    lake = _dates(spark, lake_path)
    return sorted(lake - _dates(spark, f"{state_path}/daily"))


def _dates(spark: SparkSession, path: str) -> set[str]:
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(f"{path}/{DATE}=*")
    found = at.getFileSystem(sc._jsc.hadoopConfiguration()).globStatus(at) or []
    names = {s.getPath().getName().split("=", 1)[1] for s in found}
    return {n for n in names if not n.startswith("__")}


def update_states(assessed: DataFrame, state_path: str, rules: Rules) -> None:
    """Replace the states of the dates that ``assessed``, lake rows with their ``date``, has.
    A run that is repeated writes the same partitions."""
    day = F.col(DATE)
    for name, state in (("daily", daily_state(assessed, rules, day)), ("subjects", subject_state(assessed, rules, day))):
        # every date gets a partition, so one without issues counts as done too
        w = state.repartition(DATE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        w.partitionBy(DATE).parquet(f"{state_path}/{name}")


def read_state(spark: SparkSession, state_path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{state_path}/{name}").withColumn(DATE, F.col(DATE).cast("date"))


def run_daily_incremental(spark: SparkSession, lake_path: str, state_path: str, out_path: str, rules: Rules, dates: list | None = None, written_at=None) -> DailyResults:
    """Bring the states up to date and publish all results.  ``dates``: the dates to read
    (None: those without a state); name a date again when late records changed it."""
    todo = dates_to_do(spark, lake_path, state_path) if dates is None else [str(d) for d in dates]
    if todo or not _dates(spark, f"{state_path}/daily"):
        update_states(changed(spark, lake_path, todo), state_path, rules)
    state = read_state(spark, state_path, "daily")
    if _dates(spark, f"{state_path}/subjects"):
        subjects = read_state(spark, state_path, "subjects")
    else:  # no date has had an issue: there is no file to take the schema from
        subjects = subject_state(read_lake(spark, lake_path).limit(0), rules, F.col(DATE))
    problems = top_subjects(subjects, rules)
    return publish_results(spark, out_path, metrics_of(state, rules), problems, rules, written_at=written_at)


def changed(spark: SparkSession, lake_path: str, dates: list[str]) -> DataFrame:
    """The lake's rows of some dates, and those without a time, which belong to none and
    come in at any time; no other date's files are opened."""
    which = F.col(DATE).isin([F.lit(d).cast("date") for d in dates])
    return read_lake(spark, lake_path).filter(which | F.col(DATE).isNull())
