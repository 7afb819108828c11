"""Parquet lake of assessed records, partitioned by date (S5/S6), and
published snapshot tables (S10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..rules import Rules
from .packs import DATE, MAX_RECORDS_PER_FILE, has_packs, read_packed



def with_date(df: DataFrame, rules: Rules) -> DataFrame:
    """Records with their partition column, the day of their time.  Records that have
    a column of that name for something else are refused: it can't be kept."""
    if DATE in df.columns:
        raise ValueError(f"the lake's partition column {DATE!r} is the day of {rules.time!r}; rename the records' own column")
    return df.withColumn(DATE, F.to_date(F.col(rules.time)))


def write_lake(assessed: DataFrame, path: str, rules: Rules, mode: str = "append") -> None:
    """Batch write.  ``rebalance`` brings a date's rows together, and AQE
    splits a hot date, even one of a single time, over several tasks by size
    (a range or hash partitioning would leave it in one)."""
    df = with_date(assessed, rules)
    (
        df.hint("rebalance", DATE)
        .write.mode(mode)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(DATE)
        .parquet(path)
    )


def read_lake(spark: SparkSession, path: str, run_date=None) -> DataFrame:
    """Scan the lake, compacted (``packs``) or not; with ``run_date`` only partitions up
    to that date are read (``PartitionFilters`` in the plan)."""
    df = read_packed(spark, path) if has_packs(spark, path) else spark.read.parquet(path)
    if run_date is not None:
        df = df.filter(F.col(DATE) <= F.lit(run_date).cast("date"))
    return df


def publish(df: DataFrame, path: str) -> None:
    """Write a table of a version that no reader sees before it is committed
    (``snapshots``)."""
    df.write.mode("overwrite").parquet(path)


def stamp(df: DataFrame, written_at=None) -> DataFrame:
    """Add ``written_at`` (the publish time, for TTL lookups)."""
    ts = F.current_timestamp() if written_at is None else F.lit(written_at).cast("timestamp")
    return df.withColumn("written_at", ts)


def compact_lake(spark: SparkSession, path: str, out: str, dates: list | None = None) -> None:
    """Rewrite the lake's dates (all, or ``dates``) without their per-batch
    directories: few files of up to ``MAX_RECORDS_PER_FILE`` rows per date in ``out``."""
    df = spark.read.parquet(path)
    if dates is not None:
        df = df.filter(F.col(DATE).isin(*[F.lit(d).cast("date") for d in dates]))
    w = df.drop("batch_id").hint("rebalance", DATE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    w.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy(DATE).parquet(out)
