"""Zone map of the issue table (L8, L9): what each of its folders holds.

For every folder of the issue table (one a window, or one a batch) there is a zone
folder of the same name with a row a severity: how many issues, and their least and
greatest time.  A lookup of the newest issues opens only the folders that can hold
one of them.

A writer removes a folder's zones before it replaces the folder, and writes them
anew afterwards; a folder without zones is always opened, so a writer that dies in
between costs time, never rows.  The issues' schema is kept beside the zones.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.assess import ISSUE_TIME

ZONES = "folder string, severity string, n bigint, timed bigint, least timestamp, greatest timestamp"
SCHEMA_FILE = "_issue_schema"


def zones_path(issues: str) -> str:
    return f"{issues}-zones"


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(sc._jsc.hadoopConfiguration())


def _folders(spark: SparkSession, path: str) -> set[str]:
    """Names of the partition folders, from one listing."""
    at, fs = _fs(spark, path)
    if not fs.exists(at):
        return set()
    return {s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory() and "=" in s.getPath().getName()}


def forget_zones(spark: SparkSession, issues: str, folders: list[str]) -> None:
    """Called before ``folders`` of the issue table are replaced."""
    for name in folders:
        at, fs = _fs(spark, f"{zones_path(issues)}/{name}")
        fs.delete(at, True)


def write_zones(rows: DataFrame, issues: str, part: str, time_col: str = ISSUE_TIME) -> None:
    """Zones of the folders that ``rows`` (issues with their severity and the partition
    column ``part``) have just been written to."""
    spark = rows.sparkSession
    zones = rows.groupBy(part, "severity").agg(
        F.count(F.lit(1)).alias("n"), F.count(time_col).alias("timed"),
        F.min(time_col).cast("timestamp").alias("least"), F.max(time_col).cast("timestamp").alias("greatest"),
    )
    zones = zones.withColumn("folder", F.concat(F.lit(f"{part}="), F.col(part).cast("string"))).repartition(part)
    zones.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(zones_path(issues))
    at, fs = _fs(spark, f"{zones_path(issues)}/{SCHEMA_FILE}")
    if not fs.exists(at):
        out = fs.create(at, True)
        out.write(bytearray(rows.drop(part).schema.json().encode()))
        out.close()


def issue_schema(spark: SparkSession, issues: str) -> T.StructType | None:
    """The issues' schema as their writer kept it; None where there are no zones."""
    at, fs = _fs(spark, f"{zones_path(issues)}/{SCHEMA_FILE}")
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        text = str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return T.StructType.fromJson(json.loads(text))


def newest_folders(spark: SparkSession, issues: str, limit: int, severity: str | None = None) -> list[str]:
    """The folders that hold the ``limit`` newest issues (of one severity), ties and
    issues without a time included.

    A folder's issues are all at least as new as its least time.  So the zones in
    descending order of it, up to ``limit`` issues, give a time that ``limit`` issues
    reach, and no folder whose greatest time is older is needed.  At most ``limit``
    zones and the names of the folders to open come to the driver.
    """
    there = _folders(spark, issues)
    zoned = _folders(spark, zones_path(issues)) & there
    if not zoned or limit <= 0:
        return sorted(there) if limit > 0 else []
    zones = spark.read.schema(ZONES).parquet(zones_path(issues))
    if severity is not None:
        zones = zones.filter(F.lower("severity") == F.lit(severity.lower()))
    have, reached = 0, None
    for z in zones.filter("timed > 0").orderBy(F.desc("least"), "folder").limit(limit).select("timed", F.unix_micros("least").alias("least")).collect():
        have += z.timed
        if have >= limit:
            reached = z.least
            break
    if reached is not None:
        zones = zones.filter(F.unix_micros("greatest") >= F.lit(reached))
    needed = {r[0] for r in zones.select("folder").distinct().collect()}
    return sorted((needed & there) | (there - zoned))
