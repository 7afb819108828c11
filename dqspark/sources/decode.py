"""Record sources: message stream (S1), JSON decode (S2), ingestion stamp (S3),
event-time parse (S4).

The decode works on any DataFrame with a ``value`` column (binary or string),
batch or streaming: a broker stream, a text file stream, or a table column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The vital-sign record layout (all fields nullable).
PATIENT_SCHEMA = T.StructType(
    [
        T.StructField("patient_id", T.StringType()),
        T.StructField("hospital", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("bp_systolic", T.IntegerType()),
        T.StructField("bp_diastolic", T.IntegerType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("heart_rate", T.IntegerType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

# ISO-8601 with an optional fraction of up to microseconds.
ISO_TS = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def topic_source(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    fmt: str = "kafka",
) -> DataFrame:
    """Subscribe to one topic.  Needs the broker connector on the classpath
    (not present in the test image); any other streaming source with a
    ``value`` column can be used instead (see ``text_stream``)."""
    return (
        spark.readStream.format(fmt)
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .load()
    )


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream of JSON lines, one record per line in column ``value``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def decode_records(
    raw: DataFrame,
    schema: T.StructType = PATIENT_SCHEMA,
    ts_field: str | None = "timestamp",
    ts_format: str = ISO_TS,
    ingest_col: str | None = "ingestion_time",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Decode ``value`` with a fixed schema (malformed text gives an
    all-NULL record, which later scores as incomplete), stamp the ingestion
    time (one value per micro-batch) and parse the event time leniently
    (unparseable text -> NULL instead of a failed job)."""
    data = F.from_json(F.col("value").cast("string"), schema, {"mode": "PERMISSIVE"})
    df = raw.select(*keep, data.alias("_data")).select(*keep, "_data.*")
    if ingest_col:
        df = df.withColumn(ingest_col, F.current_timestamp())
    if ts_field:
        df = df.withColumn(ts_field, F.try_to_timestamp(F.col(ts_field), F.lit(ts_format)))
    return df
