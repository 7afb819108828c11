"""Registered streaming queries: a bounded (availableNow) run of the streaming
pipeline over the ``events`` file, read back from the sinks it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_conf, scratch_path
from ..sources.tables import READINGS_RULES as R, readings_from_events, table
from ..plans.present import present
from ..operators import row_issues
from .pipeline import StreamSinks, finish, immediate_issues_writer, start_assessment


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a stream; it may be one file or a folder of part files.  A bounded
    run reads all of it in one batch: part files are in no order of time, and
    what a batch brings behind the watermark of earlier ones would be late."""
    schema = table(spark, sf_dir, "events").schema
    # a folder is watched for its files; a single file is picked from its parent by name
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/events.parquet")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(schema)
    if fs.getFileStatus(at).isDirectory():
        return reader.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def run_bounded(spark: SparkSession, sf_dir: str) -> str:
    """Run the pipeline once over what is in ``sf_dir``, to the last record."""
    ensure_conf(spark)
    root = scratch_path(spark, "stream-run")
    sinks = StreamSinks(lake=f"{root}/lake", issues=f"{root}/issues", summary=f"{root}/summary")
    q = start_assessment(
        readings_from_events(events_stream(spark, sf_dir)),
        R,
        sinks,
        checkpoint=f"{root}/checkpoint",
        trigger={"availableNow": True},
    )
    finish(q, R, sinks, f"{root}/checkpoint")
    return root


def q_stream_assess(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_bounded(spark, sf_dir)
    lake = spark.read.parquet(f"{root}/lake")
    return present(
        lake.select(
            "event_id", "entity", "m1_zscore", "m1_anomaly", "m2_zscore", "m2_anomaly",
            "has_issues", "quality_score",
        )
    )


def q_issues_immediate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-check issues as the stateless query writes them, batch by batch."""
    ensure_conf(spark)
    root = scratch_path(spark, "immediate-run")
    sinks = StreamSinks(lake=f"{root}/lake", immediate=f"{root}/issues")
    records = readings_from_events(events_stream(spark, sf_dir))
    q = immediate_issues_writer(records, R, sinks, f"{root}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    schema = row_issues(records, R).schema
    found = spark.read.schema(schema).json(sinks.immediate)
    return present(found.select("event_id", "entity", "missing_fields", "completeness_score", "quality_score"))


def q_stream_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-batch summaries (S9) added up over all micro-batches of the run:
    the sums do not depend on how rows were split into batches."""
    root = run_bounded(spark, sf_dir)
    s = spark.read.parquet(f"{root}/summary")
    return present(
        s.groupBy("level", "entity").agg(
            F.sum("records").alias("records"),
            F.sum("flagged_issues").alias("flagged_issues"),
            # scores are whole numbers, so a batch's mean gives back their sum
            (F.sum(F.round(F.col("avg_quality_score") * F.col("records"))) / F.sum("records")).alias("avg_quality_score"),
        )
    )
