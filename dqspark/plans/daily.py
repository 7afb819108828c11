"""The daily batch job: lake scan -> daily metrics -> trends -> comparison,
problem subjects, risk -> published snapshots (S6, A2-A4, W1-W4, P10, S10, S11).

Each result is written once; the assessed input is read from the
date-partitioned lake with partition pruning when ``run_date`` is given.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scoring import issue_risk
from ..operators import (
    daily_documents,
    daily_metrics,
    entity_comparison,
    entity_comparison_from_daily,
    latest_per_entity,
    predict_risk,
    problem_subjects,
    trend_documents,
    trends,
)
from ..rules import Rules
from ..sources.lake import DATE, publish, read_lake, stamp
from ..sources.snapshots import commit, new_version


@dataclass
class DailyResults:
    daily: DataFrame
    trends: DataFrame
    comparison: DataFrame
    problems: DataFrame
    risk: DataFrame


def daily_results(assessed: DataFrame, rules: Rules, run_date=None, date_col: str | None = DATE) -> DailyResults:
    """Results of lake rows, whose ``date_col`` is the day of their time (None: derived
    from it)."""
    src = assessed
    if run_date is not None:
        day = F.col(date_col) if date_col else F.to_date(F.col(rules.time))
        src = assessed.filter(day <= F.lit(run_date).cast("date"))
    daily = daily_metrics(src, rules, date_col)
    tr = trends(daily, rules)
    if run_date is not None:
        tr = tr.filter(F.col("date") == F.lit(run_date).cast("date"))
    return DailyResults(
        daily=daily,
        trends=tr,
        comparison=entity_comparison(src, rules),
        problems=problem_subjects(src, rules),
        risk=predict_risk(tr, rules),
    )


def run_daily(
    spark: SparkSession,
    lake_path: str,
    out_path: str,
    rules: Rules,
    run_date=None,
    show: bool = False,
    written_at=None,
) -> DailyResults:
    """Compute and publish: ``daily`` (all days), ``latest`` (newest day per
    entity, S10), ``trends`` (with risk), ``comparison``, ``problems`` and
    ``documents`` (JSON key/value documents of the latest metrics and trends)."""
    assessed = read_lake(spark, lake_path, run_date)
    res = daily_results(assessed, rules, run_date)
    publish_results(spark, out_path, res.daily, res.problems, rules, run_date, written_at, show)
    return res


def publish_results(spark: SparkSession, out_path: str, daily: DataFrame, problems: DataFrame, rules: Rules, run_date=None, written_at=None, show: bool = False) -> DailyResults:
    """Write a version of all result tables and put it in force (``snapshots``)."""
    version = new_version(out_path)
    daily_path = f"{version}/daily"
    publish(daily, daily_path)
    daily = spark.read.parquet(daily_path)  # reuse the written table, not the lineage
    publish(stamp(latest_per_entity(daily, rules), written_at), f"{version}/latest")
    # each entity's latest trend up to the run date: one that was silent on that
    # day keeps its last
    tr = trends(daily, rules)
    if run_date is not None:
        tr = latest_per_entity(tr, rules)
    with_risk = tr.withColumn(
        "predicted_issue_risk", issue_risk(F.col("trend_direction"), F.col("quality_variance"))
    )
    publish(stamp(with_risk, written_at), f"{version}/trends")
    # the same, as key/value documents (what a cache consumer reads)
    latest = spark.read.parquet(f"{version}/latest")
    latest_trends = latest_per_entity(spark.read.parquet(f"{version}/trends"), rules)
    docs = daily_documents(latest, rules).withColumn("kind", F.lit("daily")).unionByName(
        trend_documents(latest_trends, rules).withColumn("kind", F.lit("trend"))
    )
    docs.write.mode("overwrite").json(f"{version}/documents")
    publish(entity_comparison_from_daily(daily, rules), f"{version}/comparison")  # no second lake scan
    publish(problems, f"{version}/problems")
    commit(spark, out_path, version)
    if show:  # S11: display only in the job entry point
        for name in ("daily", "latest", "trends", "comparison", "problems"):
            spark.read.parquet(f"{version}/{name}").show(truncate=False)
    read = lambda name: spark.read.parquet(f"{version}/{name}")
    return DailyResults(daily=read("daily"), trends=read("trends"), comparison=read("comparison"), problems=read("problems"), risk=predict_risk(read("trends"), rules))
