"""The monitoring lookups over the published tables, one method per lookup
the source application served over HTTP.  Every method returns a DataFrame
(empty = not found); nothing is collected here.

    m = Monitor(spark, rules, published="/shared/published", lake="/shared/lake",
                issues="/shared/issues", summary="/shared/summary")
    m.daily_metrics("Hospital_A").show()
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as ops
from ..operators.assess import ISSUE_TS
from ..rules import Rules
from ..sources.lake import read_lake
from ..sources.snapshots import current
from ..sources.zones import issue_schema, newest_folders

SUMMARY_TTL = 300
DAILY_TTL = 86_400


class Monitor:
    def __init__(
        self,
        spark: SparkSession,
        rules: Rules,
        published: str,
        lake: str | None = None,
        issues: str | None = None,
        summary: str | None = None,
        max_limit: int = 100,
    ) -> None:
        """``max_limit``: the most issues that one lookup answers with, as the
        service's callers expect; the operators have no such limit."""
        self.max_limit = max_limit
        self.spark, self.rules = spark, rules
        self.published, self.lake, self.issues_path, self.summary_path = published, lake, issues, summary

    def _published(self, name: str) -> DataFrame:
        """A table of the version that is in force at the call."""
        return self.spark.read.parquet(f"{current(self.spark, self.published)}/{name}")

    def _latest(self) -> DataFrame:
        return self._published("latest")

    def daily_metrics(self, entity: str) -> DataFrame:
        """L3: newest daily metrics of one entity."""
        return ops.metrics_for_entity(self._latest(), self.rules, entity)

    def all_metrics(self) -> DataFrame:
        """L4: newest daily metrics of every entity."""
        return self._latest()

    def metrics_by_status(self, status: str) -> DataFrame:
        """Entities whose newest health status matches (case-insensitive)."""
        return ops.metrics_by_status(self._latest(), status)

    def critical(self) -> DataFrame:
        """Critical entities, highest issue rate first."""
        return ops.critical_entities(self._latest(), self.rules)

    def trend(self, entity: str) -> DataFrame:
        """Newest trend of one entity; 'unknown' when there is none."""
        latest = ops.latest_per_entity(self._published("trends"), self.rules)
        return ops.trend_lookup(self.spark, latest, self.rules, [entity])

    def recent_issues(self, limit: int = 10) -> DataFrame:
        """Newest issues (at most ``max_limit``)."""
        limit = min(limit, self.max_limit)
        return ops.recent_issues(self._issue_rows(limit), limit)

    def issues_by_severity(self, severity: str, limit: int = 10) -> DataFrame:
        """Newest issues of one severity (at most ``max_limit``)."""
        limit = min(limit, self.max_limit)
        return ops.issues_by_severity(self._issue_rows(limit, severity), severity, limit)

    def current_status(self, as_of=None, ttl_seconds: int = SUMMARY_TTL) -> DataFrame:
        """Newest micro-batch summary still inside its time-to-live."""
        s = self.spark.read.parquet(self.summary_path)
        return ops.current_status(s, as_of if as_of is not None else F.current_timestamp(), ttl_seconds)

    def fresh_metrics(self, as_of=None, ttl_seconds: int = DAILY_TTL) -> DataFrame:
        """Published daily metrics still inside their time-to-live."""
        return ops.fresh(self._latest(), as_of if as_of is not None else F.current_timestamp(), ttl_seconds)

    def _issue_rows(self, limit: int, severity: str | None = None) -> DataFrame:
        """Issues as typed rows: the JSON documents of the folders that can hold one of
        the ``limit`` newest (``zones``), as they are when the lookup is made."""
        schema = issue_schema(self.spark, self.issues_path)
        if schema is None:  # no zones: the schema follows from the lake's
            schema = ops.with_severity(ops.extract_issues(read_lake(self.spark, self.lake), self.rules)).schema
        folders = newest_folders(self.spark, self.issues_path, limit, severity)
        if folders:  # a known schema: no pass over the documents to infer one
            docs = self.spark.read.schema("value string").json([f"{self.issues_path}/{name}" for name in folders])
        else:
            docs = self.spark.createDataFrame([], "value string")
        return docs.select(F.from_json("value", schema, {"timestampFormat": ISSUE_TS}).alias("d")).select("d.*")
