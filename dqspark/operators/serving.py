"""Lookups over published metrics, trends, issues and summaries.

These replace a key/value cache: each lookup is a DataFrame query over a
small published table (one row per entity, or a top-k over issues).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scoring
from ..rules import Rules


def latest_per_entity(df: DataFrame, rules: Rules, order_col: str = "date") -> DataFrame:
    """Newest row per non-NULL entity.  ``max_by`` is a partial
    aggregate, so this needs no sort and no per-entity window."""
    others = [c for c in df.columns if c != rules.entity]
    return (
        df.filter(F.col(rules.entity).isNotNull())
        .groupBy(rules.entity)
        .agg(F.max_by(F.struct(*others), F.col(order_col)).alias("_latest"))
        .select(rules.entity, *[F.col(f"_latest.{c}").alias(c) for c in others])
    )


def metrics_for_entity(published: DataFrame, rules: Rules, entity: str) -> DataFrame:
    """L3: the published row for one entity; empty result = not found."""
    return published.filter(F.col(rules.entity) == F.lit(entity))


def metrics_by_status(published: DataFrame, status: str) -> DataFrame:
    """Case-insensitive match on ``health_status``."""
    return published.filter(F.lower(F.col("health_status")) == F.lit(status.lower()))


def critical_entities(published: DataFrame, rules: Rules) -> DataFrame:
    """Issue rate > 20 or status poor or score < 70, highest rate first."""
    crit = scoring.is_critical(F.col("issue_rate"), F.col("health_status"), F.col("avg_quality_score"))
    return published.filter(crit).orderBy(F.desc_nulls_last("issue_rate"), F.asc(rules.entity))


def trend_lookup(spark: SparkSession, latest_trends: DataFrame, rules: Rules, entities: Iterable[str]) -> DataFrame:
    """Latest trend per requested entity; absent ones get direction 'unknown'."""
    keys = spark.createDataFrame([(e,) for e in entities], T.StructType([T.StructField(rules.entity, T.StringType())]))
    joined = keys.join(latest_trends, rules.entity, "left")
    cols = [c for c in latest_trends.columns if c not in (rules.entity, "trend_direction")]
    return joined.select(
        rules.entity,
        *cols,
        F.coalesce(F.col("trend_direction"), F.lit("unknown")).alias("trend_direction"),
    )


def _issue_order(issues: DataFrame, time_col: str):
    rest = [F.asc_nulls_last(c) for c in issues.columns if c != time_col]
    return [F.desc_nulls_last(time_col), *rest]


def recent_issues(issues: DataFrame, limit: int = 10, time_col: str = "detected_at") -> DataFrame:
    """Newest ``limit`` issues.  A top-k report."""
    return issues.orderBy(*_issue_order(issues, time_col)).limit(max(0, int(limit)))


def issues_by_severity(issues: DataFrame, severity: str, limit: int = 10, time_col: str = "detected_at") -> DataFrame:
    """The newest ``limit`` issues of one severity (case-insensitive)."""
    f = issues.filter(F.lower(F.col("severity")) == F.lit(severity.lower()))
    return f.orderBy(*_issue_order(f, time_col)).limit(max(0, int(limit)))


def fresh(df: DataFrame, as_of, ttl_seconds: int, written_col: str = "written_at") -> DataFrame:
    """Rows still inside their time-to-live at ``as_of``."""
    limit = F.lit(as_of).cast("timestamp") - F.make_dt_interval(secs=F.lit(ttl_seconds))
    return df.filter(F.col(written_col) > limit)


def current_status(summaries: DataFrame, as_of=None, ttl_seconds: int | None = None) -> DataFrame:
    """Newest batch-summary total; when none is (still) visible the
    result is one row ``status = 'no_data', issues = 0``.

    ``summaries`` is the S9 table: batch_id, written_at, level, entity,
    records, flagged_issues, avg_quality_score.
    """
    tot = summaries.filter(F.col("level") == F.lit("total"))
    if as_of is not None and ttl_seconds is not None:
        tot = fresh(tot, as_of, ttl_seconds)
    newest = tot.agg(
        F.max_by(
            F.struct("batch_id", "written_at", "records", "flagged_issues", "avg_quality_score"),
            F.col("batch_id"),
        ).alias("s")
    )
    return newest.select(
        F.when(F.col("s").isNull(), F.lit("no_data")).otherwise(F.lit("ok")).alias("status"),
        F.col("s.batch_id").alias("batch_id"),
        F.col("s.written_at").alias("written_at"),
        F.coalesce(F.col("s.records"), F.lit(0).cast("bigint")).alias("issues"),
        F.col("s.flagged_issues").alias("flagged_issues"),
        F.col("s.avg_quality_score").alias("avg_quality_score"),
    )


def status_breakdown(summaries: DataFrame) -> DataFrame:
    """The newest batch's summary per entity: records, flagged issues and
    mean score, as the status answer lists them beside the total."""
    newest = summaries.agg(F.max("batch_id").alias("_newest"))
    rows = summaries.filter(F.col("level") == F.lit("entity")).join(F.broadcast(newest), F.col("batch_id") == F.col("_newest"))
    return rows.drop("_newest", "level")


# Field names of the published documents, as the consumers of
# the source application read them.
#   daily metrics: hospital, avgQualityScore, issueRate, totalRecords, healthStatus, timestamp
#   trend: hospital, date, dailyScore, ma7Score, trendDirection, qualityChange, predictionRisk
DOC_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def daily_documents(published: DataFrame, rules: Rules, written_col: str = "written_at") -> DataFrame:
    """S10 document form: one JSON document per entity in ``value`` (keyed by
    the entity), from the latest-per-entity table stamped with ``written_at``."""
    doc = F.struct(
        F.col(rules.entity).alias("hospital"),
        F.col("avg_quality_score").alias("avgQualityScore"),
        F.col("issue_rate").alias("issueRate"),
        F.col("total_records").alias("totalRecords"),
        F.col("health_status").alias("healthStatus"),
        F.date_format(F.col(written_col), DOC_TS).alias("timestamp"),
    )
    return published.select(F.col(rules.entity).alias("key"), F.to_json(doc).alias("value"))


def trend_documents(trend_df: DataFrame, rules: Rules) -> DataFrame:
    """Trend documents (latest trend per entity, with its risk), keyed by entity."""
    doc = F.struct(
        F.col(rules.entity).alias("hospital"),
        F.date_format(F.col("date"), "yyyy-MM-dd").alias("date"),
        F.col("avg_quality_score").alias("dailyScore"),
        F.col("ma7_quality_score").alias("ma7Score"),
        F.col("trend_direction").alias("trendDirection"),
        F.col("quality_change").alias("qualityChange"),
        scoring.issue_risk(F.col("trend_direction"), F.col("quality_variance")).alias("predictionRisk"),
    )
    return trend_df.select(F.col(rules.entity).alias("key"), F.to_json(doc).alias("value"))
