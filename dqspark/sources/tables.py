"""Readers that map the shared test tables onto the rule roles.

``event_readings`` turns ``events`` into vital-sign-like readings: subject,
entity, three measures and a time column.  A few deterministic fault
injections (every 97th entity, 29th m1, 17th m3 set to NULL; every 211th m2
multiplied by 20) make every completeness / validity / scoring branch occur;
no row is dropped.  The oracle SQL repeats the same projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..rules import Range, Rules


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Fixed values of the readings projection (must equal the oracle SQL).
NULL_ENTITY_EVERY = 97
NULL_M1_EVERY = 29
SPIKE_M2_EVERY = 211
SPIKE_M2_FACTOR = 20
NULL_M3_EVERY = 17


def readings_from_events(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    # Decode the JSON once in its own projection: Catalyst keeps a
    # non-cheap expression that is referenced several times un-inlined.
    events = events.select(
        "event_id", "user_id", "event_type", "value", "ts",
        F.from_json(F.col("props"), "k INT").getField("k").alias("_k"),
    )
    k = F.col("_k")
    return events.select(
        eid,
        F.col("user_id").cast("string").alias("subject"),
        F.when(eid % NULL_ENTITY_EVERY == 0, F.lit(None).cast("string")).otherwise(F.col("event_type")).alias("entity"),
        F.when(eid % NULL_M1_EVERY == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("m1"),
        F.when(eid % SPIKE_M2_EVERY == 0, k * F.lit(SPIKE_M2_FACTOR)).otherwise(k).alias("m2"),
        F.when(eid % NULL_M3_EVERY == 0, F.lit(None).cast("double")).otherwise(k.cast("double") / F.lit(2.0)).alias("m3"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(table(spark, sf_dir, "events"))


# Rules for the readings projection.
READINGS_RULES = Rules(
    required=("subject", "entity", "m1", "m2"),
    ranges=(("m1", Range(1.0, 150.0)), ("m2", Range(5.0, 95.0)), ("m3", Range(0.0, 45.0))),
    anomaly=("m1", "m2"),
    z_threshold=3.0,
    entity="entity",
    subject="subject",
    time="ts",
    window="1 day",
    watermark="10 minutes",
)


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents LEFT JOIN labels``: real NULLs for unlabelled documents.
    Only the four small columns are read (the text column is pruned)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return docs.join(labels, "doc_id", "left")


# Rules for labelled documents.  Documents carry no time
# column and no anomaly measure: only the row checks and the score apply.
DOCUMENT_RULES = Rules(
    required=("doc_id", "lang", "quality", "toxic"),
    ranges=(("n_chars", Range(1.0, 100000.0)), ("quality", Range(0.0, 1.0)), ("toxic", Range(0.0, 0.0))),
    anomaly=(),
    entity="lang",
    subject="doc_id",
    time="ts",
)


def lineitem_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_orderkey").cast("string").alias("order_id"),
        "l_returnflag",
        "l_quantity",
        "l_discount",
        "l_tax",
        F.col("l_shipdate").cast("timestamp").alias("ship_ts"),
    )


# Rules for the lineitem domain.
LINEITEM_RULES = Rules(
    required=("order_id", "l_returnflag", "l_quantity", "l_discount"),
    ranges=(("l_quantity", Range(1.0, 50.0)), ("l_discount", Range(0.0, 0.08)), ("l_tax", Range(0.0, 0.08))),
    anomaly=("l_quantity", "l_discount"),
    z_threshold=3.0,
    entity="l_returnflag",
    subject="order_id",
    time="ship_ts",
    window="7 days",
)
