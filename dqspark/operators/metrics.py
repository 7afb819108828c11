"""Aggregations over assessed records: daily metrics, entity comparison,
problem subjects, batch summaries and null-percentage checks.

Every aggregate used (count, count_if, sum, avg, min, max, stddev_samp,
max_by) has a partial form, so a hot entity is pre-aggregated map-side and
only one small row per group and task crosses the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import checks, scoring
from ..rules import Rules
from ..session import materialize_counted

DATE = "date"


def date_column(rules: Rules, date_col: str | None = None):
    """The day of a record: that of ``rules.time``, or a column that the caller names
    because it holds it (the lake's partition column, which prunes).  A column
    that happens to be called ``date`` is not taken for it."""
    return F.col(date_col).alias(DATE) if date_col else F.to_date(F.col(rules.time)).alias(DATE)


def daily_metrics(assessed: DataFrame, rules: Rules, date_col: str | None = None) -> DataFrame:
    """A2 + P8 + P9: one row per (entity, date); ``date_col``: see ``date_column``.

    ``records_with_issues`` counts ``has_issues = true`` and is 0 (not NULL)
    on clean days.  ``quality_variance`` is the sample standard deviation of
    the score (NULL on one-row days), kept under its historical name.
    """
    d = date_column(rules, date_col)
    return (
        assessed.groupBy(F.col(rules.entity), d)
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_if(F.col("has_issues")).alias("records_with_issues"),
            F.avg("quality_score").alias("avg_quality_score"),
            F.max("quality_score").alias("max_quality_score"),
            F.min("quality_score").alias("min_quality_score"),
            F.stddev_samp("quality_score").alias("quality_variance"),
        )
        .withColumn("issue_rate", scoring.issue_rate(F.col("records_with_issues"), F.col("total_records")))
        .withColumn("health_status", scoring.health_status(F.col("avg_quality_score")))
    )


def entity_comparison(assessed: DataFrame, rules: Rules) -> DataFrame:
    """A3 + L1: per entity totals and issue rate, highest rate first (entity breaks ties)."""
    return (
        assessed.groupBy(rules.entity)
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.sum(F.when(F.col("has_issues"), F.lit(1)).otherwise(F.lit(0))).alias("total_issues"),
            F.avg("quality_score").alias("avg_quality_score"),
        )
        .withColumn("issue_rate", scoring.issue_rate(F.col("total_issues"), F.col("total_records")))
        .orderBy(F.desc_nulls_last("issue_rate"), F.asc_nulls_last(rules.entity))
    )


def entity_comparison_from_daily(daily: DataFrame, rules: Rules) -> DataFrame:
    """A3 from the daily table instead of a second scan of the records.

    Exact: counts add up, and since scores are integers each day's score sum
    is ``round(avg * n)`` (exact while 100 * n < 2^53)."""
    return (
        daily.groupBy(rules.entity)
        .agg(
            F.sum("total_records").alias("total_records"),
            F.sum("records_with_issues").alias("total_issues"),
            F.sum(F.round(F.col("avg_quality_score") * F.col("total_records")).cast("bigint")).alias("_score_sum"),
        )
        .select(
            rules.entity,
            "total_records",
            "total_issues",
            (F.col("_score_sum") / F.col("total_records")).alias("avg_quality_score"),
            scoring.issue_rate(F.col("total_issues"), F.col("total_records")).alias("issue_rate"),
        )
        .orderBy(F.desc_nulls_last("issue_rate"), F.asc_nulls_last(rules.entity))
    )


def problem_subjects(assessed: DataFrame, rules: Rules, k: int = 10) -> DataFrame:
    """A4 + L2: the ``k`` (subject, entity) pairs with most flagged records.
    A top-k report: the limit is the feature.  Ties broken by subject, entity."""
    return (
        assessed.filter(F.col("has_issues"))
        .groupBy(rules.subject, rules.entity)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc_nulls_last(rules.subject), F.asc_nulls_last(rules.entity))
        .limit(k)
    )


#: Pairs that the sketch tracks; it takes up to 16 bytes for each of twice as many.
TRACKED = 1 << 16
CANDIDATES = 1_000
#: So many tasks' sketches are merged by one task, and theirs by another.
FAN_IN = 512


def problem_subjects_sketch(assessed: DataFrame, rules: Rules, k: int = 10, tracked: int = TRACKED, candidates: int = CANDIDATES) -> DataFrame:
    """``problem_subjects``, the same rows, for more (subject, entity) pairs than one would
    shuffle.  The flagged pairs are written once; each pass reads them.

    1. As 64-bit hashes they go through Spark's mergeable frequent-items sketch: one
       sketch of bounded size a task is shuffled, not its pairs.
    2. The ``candidates`` likeliest hashes' pairs are counted exactly.
    3. If the k-th of them has more flagged records than any other pair can have, they are
       the answer; else, as when counts are flat, all pairs are counted."""
    pair = [rules.subject, rules.entity]
    flagged, total = materialize_counted(assessed.filter(F.col("has_issues")).select(*pair, "has_issues"), "flagged-pairs")
    rows = _decided(flagged, rules, k, tracked, candidates, total) if 0 < k <= candidates else None
    if rows is None:
        return problem_subjects(flagged, rules, k)
    schema = problem_subjects(flagged, rules, k).schema
    return assessed.sparkSession.createDataFrame(rows, schema).orderBy(F.desc("count"), *[F.asc_nulls_last(c) for c in pair])


def _decided(flagged: DataFrame, rules: Rules, k: int, tracked: int, candidates: int, total: int) -> list | None:
    """The ``k`` rows, where the sketch can tell that no other pair belongs to them.

    The sketch's own error e says how much it may have dropped of any pair: one that
    it does not hold has at most e records; one that it does not report, as its
    least count is not over e, at most 2 e; one reported behind the ``candidates`` no
    more than the estimate of the last of them, as estimates are never too low."""
    if total == 0:
        return []
    pair = F.xxhash64(rules.subject, rules.entity)
    some = flagged.select(pair.alias("_pair"), F.floor(F.spark_partition_id() / FAN_IN).alias("_group")).groupBy("_group")
    state = some.agg(F.expr(f"approx_top_k_accumulate(_pair, {tracked})").alias("s")).agg(F.expr(f"approx_top_k_combine(s, {tracked})").alias("s"))
    # the sketch's published layout: bytes 16 to 31 are the rows it has seen and its error
    seen = state.select(F.expr(f"approx_top_k_estimate(s, {candidates})").alias("top"), F.expr("substring(s.sketch, 17, 16)").alias("head")).first()
    if seen is None or seen.head is None or len(seen.head) < 16 or int.from_bytes(seen.head[:8], "little") != total:
        return None
    error = int.from_bytes(seen.head[8:], "little")
    bound = max(2 * error, seen.top[-1]["count"] if len(seen.top) == candidates else 0)
    rows = problem_subjects(flagged.filter(pair.isin([r["item"] for r in seen.top])), rules, k).collect()  # k rows
    return rows if bound == 0 or (len(rows) == k and rows[-1]["count"] > bound) else None


def batch_summary(assessed: DataFrame, rules: Rules) -> DataFrame:
    """A5: record count, flagged count and mean score per entity plus one total
    row (``level = 'total'``), computed as a single ROLLUP so the total is a
    partial aggregate too (no global window, nothing collected)."""
    g = assessed.rollup(rules.entity).agg(
        F.grouping(rules.entity).alias("_g"),
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("has_issues")).alias("flagged_issues"),
        F.avg("quality_score").alias("avg_quality_score"),
    )
    return g.select(
        F.when(F.col("_g") == 1, F.lit("total")).otherwise(F.lit("entity")).alias("level"),
        rules.entity,
        "records",
        "flagged_issues",
        "avg_quality_score",
    )


def null_percentage(df: DataFrame, rules: Rules) -> DataFrame:
    """NULL share per required field against ``rules.max_null_pct``.
    One global partial aggregate, then unpivoted to (field, null_pct, passed)."""
    agg = df.agg(*[checks.null_percentage(f) for f in rules.required])
    stacked = agg.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(f).alias("field"), F.col(f"{f}_null_pct").alias("null_pct"))
                    for f in rules.required
                ]
            )
        ).alias("s")
    ).select("s.field", "s.null_pct")
    return stacked.withColumn("passed", F.col("null_pct") <= F.lit(float(rules.max_null_pct)))
