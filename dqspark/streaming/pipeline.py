"""Streaming assessment pipeline.

By default windows are staged (``staged.py``): a micro-batch only appends its
records to a landing table, and windows that the watermark has passed are
assessed by the batch plan and written to all sinks.  With ``staged=False`` one
stateful query does the windowed anomaly join; then every micro-batch is
persisted and fanned out to the sinks inside ``foreachBatch``:

* lake      – assessed rows, partitioned by ``date`` and ``batch_id``, written
              with dynamic partition overwrite so a replayed batch replaces
              its own files (idempotent after a failure);
* issues    – flagged rows as JSON documents (``value``), per batch_id;
* summary   – per-entity and total counts / mean score, per batch_id (S9);
* console   – optional debug print of the issues (S8).

Keeping all sinks in one query means the source is read, and windows are held,
once and not once per sink.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assess, batch_summary, extract_issues, issue_json, row_issues, with_severity
from ..rules import Rules
from ..sources.lake import with_date
from ..sources.zones import forget_zones, write_zones
from .staged import OPEN, StagedWindows


@dataclass
class StreamSinks:
    lake: str
    issues: str | None = None
    summary: str | None = None
    issues_format: str = "json"  # "kafka" in production (needs the connector)
    issues_options: dict = field(default_factory=dict)
    console: bool = False
    immediate: str | None = None  # row-check issues at once, by a query of their own


def _overwrite_partitions(df: DataFrame, path: str, parts: list[str], fmt: str = "parquet", options: dict | None = None):
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.format(fmt).save(path)


def batch_writer(rules: Rules, sinks: StreamSinks, ingest_col: str | None = None):
    """The ``foreachBatch`` callback."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            # a date's rows come together (few files), and AQE splits a hot date
            # by size, also when all its rows have one ingestion time
            rows = with_date(batch, rules).withColumn("batch_id", F.lit(batch_id).cast("bigint")).hint("rebalance", "date")
            _overwrite_partitions(rows, sinks.lake, ["date", "batch_id"])
            issues = with_severity(extract_issues(batch, rules, ingest_col))
            if sinks.issues:
                payload = issue_json(issues).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
                if sinks.issues_format == "kafka":
                    if batch_id != OPEN:  # a topic gets them when their window closes
                        issue_json(issues).write.format("kafka").options(**sinks.issues_options).save()
                else:
                    forget_zones(batch.sparkSession, sinks.issues, [f"batch_id={batch_id}"])
                    _overwrite_partitions(payload, sinks.issues, ["batch_id"], "json", sinks.issues_options)
                    write_zones(issues.withColumn("batch_id", F.lit(batch_id).cast("bigint")), sinks.issues, "batch_id")
            if sinks.summary:
                summ = batch_summary(batch, rules).select(
                    F.lit(batch_id).cast("bigint").alias("batch_id"),
                    F.current_timestamp().alias("written_at"),
                    "*",
                )
                _overwrite_partitions(summ, sinks.summary, ["batch_id"])
            if sinks.console:
                issues.show(truncate=False)
        finally:
            batch.unpersist()

    return write


def start_assessment(
    records: DataFrame,
    rules: Rules,
    sinks: StreamSinks,
    checkpoint: str,
    trigger: dict | None = None,
    ingest_col: str | None = None,
    query_name: str | None = None,
    state_partitions: int | None = None,
    stream_salts: int | None = None,
    staged: bool = True,
    late_for: str | None = None,
):
    """Assess a streaming DataFrame and start the single fan-out query.

    ``trigger`` defaults to a 1-minute processing-time trigger; use
    ``{"availableNow": True}`` for a bounded run over what has arrived.
    Staged windows keep no state; ``late_for`` is how long they keep closed
    windows' records.  What follows is for ``staged=False``: the state layout is pinned by the checkpoint to the shuffle partition
    count at the first start: ``state_partitions`` sets it for this query
    only (default: the session's ``spark.sql.shuffle.partitions``).  Size it
    to the state, not to the batch jobs of the same session.
    """
    spark = records.sparkSession
    if staged and rules.anomaly:
        windows = StagedWindows(spark, records.schema, rules, sinks, checkpoint, ingest_col, late_for)
        w = records.writeStream.foreachBatch(windows).option("checkpointLocation", checkpoint)
        if query_name:
            w = w.queryName(query_name)
        q = w.trigger(**(trigger or {"processingTime": "1 minute"})).start()
        _STAGED[str(q.runId)] = windows
        return q
    drop_open_rows(spark, sinks)
    assessed = assess(records, rules, **({"stream_salts": stream_salts} if stream_salts else {}))
    w = assessed.writeStream.foreachBatch(batch_writer(rules, sinks, ingest_col)).option(
        "checkpointLocation", checkpoint
    )
    if query_name:
        w = w.queryName(query_name)
    w = w.outputMode("append").trigger(**(trigger or {"processingTime": "1 minute"}))
    if state_partitions is None:
        return w.start()
    key = "spark.sql.shuffle.partitions"
    prev = spark.conf.get(key)
    spark.conf.set(key, str(int(state_partitions)))
    try:
        return w.start()  # the query keeps a snapshot of the conf taken here
    finally:
        spark.conf.set(key, prev)


#: The callback of each staged query of this process, by its run.
_STAGED: dict[str, StagedWindows] = {}


def finish(q, rules: Rules, sinks: StreamSinks, checkpoint: str, ingest_col: str | None = None) -> None:
    """Wait for a bounded run, then assess what is left in open windows as it stands.
    A run that failed raises."""
    q.awaitTermination()
    windows = _STAGED.pop(str(q.runId), None)
    if q.exception() is not None:
        raise RuntimeError(f"assessment stream failed: {q.exception()}")
    if windows is None:
        write_open_rows(SparkSession.getActiveSession(), rules, sinks, checkpoint, ingest_col)
    else:
        windows.assess_open()


def issues_stream_writer(assessed: DataFrame, rules: Rules, checkpoint: str, fmt: str = "console", options: dict | None = None):
    """S7/S8 as their own streaming sink (not started): JSON issue documents to
    a broker topic (``fmt='kafka'``), a file sink, or the console."""
    issues = extract_issues(assessed, rules)
    out = issues if fmt == "console" else issue_json(issues)
    w = out.writeStream.format(fmt).option("checkpointLocation", checkpoint)
    if fmt == "console":
        w = w.option("truncate", "false")
    for k, v in (options or {}).items():
        w = w.option(k, v)
    return w


def await_any(spark: SparkSession, timeout: float | None = None) -> bool:
    """Block until any query ends (or ``timeout`` seconds).  Queries that
    ended before the call are forgotten first, so it waits for a new end."""
    spark.streams.resetTerminated()
    if timeout is None:
        spark.streams.awaitAnyTermination()
        return True
    return spark.streams.awaitAnyTermination(timeout)


def open_rows(spark: SparkSession, checkpoint: str, rules: Rules) -> DataFrame | None:
    """The records that wait in the join's state for their window to close, read
    from a stopped query's checkpoint; None if the query keeps no such state."""
    operators = spark.read.format("state-metadata").load(checkpoint).filter("operatorName = 'symmetricHashJoin'")
    found = operators.select("operatorId").distinct().collect()  # one: the anomaly join
    if not found:
        return None
    state = spark.read.format("statestore").option("operatorId", found[0][0]).option("joinSide", "left").load(checkpoint)
    return state.select("value.*").withColumnRenamed("_event_ts", rules.time).drop("_w", "_salt")


def write_open_rows(spark: SparkSession, rules: Rules, sinks: StreamSinks, checkpoint: str, ingest_col: str | None = None) -> None:
    """End of a bounded run: assess the records of open windows as they stand and
    write them under ``batch_id = -1``.  They stay in the checkpoint; the next
    run on it removes this partition first, so no record is ever there twice."""
    rows = open_rows(spark, checkpoint, rules)
    if rows is not None:
        batch_writer(rules, sinks, ingest_col)(assess(rows, rules), OPEN)


def drop_open_rows(spark: SparkSession, sinks: StreamSinks) -> None:
    """Remove what ``write_open_rows`` has written."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    if sinks.issues:
        forget_zones(spark, sinks.issues, [f"batch_id={OPEN}"])
    places = [f"{sinks.lake}/date=*/batch_id={OPEN}", *[f"{p}/batch_id={OPEN}" for p in (sinks.issues, sinks.summary) if p]]
    for place in places:
        at = jvm.org.apache.hadoop.fs.Path(place)
        fs = at.getFileSystem(conf)
        for found in fs.globStatus(at) or []:
            fs.delete(found.getPath(), True)


def immediate_issues_writer(records: DataFrame, rules: Rules, sinks: StreamSinks, checkpoint: str):
    """Issues that need no window, missing and out-of-range values, in the
    micro-batch that reads them (not started): row checks keep no state."""
    found = row_issues(records, rules).writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    return found.format("json").option("path", sinks.immediate)


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_stream(
    spark: SparkSession,
    raw: DataFrame,
    rules: Rules,
    sinks: StreamSinks,
    checkpoint: str,
    trigger: dict | None = None,
    rocksdb_state: bool = True,
    wait: bool = True,
    state_partitions: int | None = None,
    stream_salts: int | None = None,
    staged: bool = True,
    late_for: str | None = None,
):
    """The streaming job: raw ``value`` messages (a broker topic via ``topic_source`` or
    any other stream) -> decode -> assess -> sinks.  A bounded run
    (``availableNow``) that is waited for ends with the windows that are still
    open (``finish``); one that isn't bounded waits until any of its queries ends
    (``await_any``), and stops the others.

    Without ``staged``, RocksDB keeps large window state off the JVM heap
    (``rocksdb_state``): the provider is set for the start of this query only.
    """
    from ..sources.decode import decode_records

    records = decode_records(raw)
    ingest = "ingestion_time"
    extra = None
    if sinks.immediate:
        extra = immediate_issues_writer(records, rules, sinks, f"{checkpoint}-immediate").trigger(**(trigger or {"processingTime": "10 seconds"})).start()
    provider = "spark.sql.streaming.stateStore.providerClass"
    own = None if staged or not rocksdb_state or spark.conf.get(provider, None) else provider
    if own:
        spark.conf.set(own, ROCKSDB_PROVIDER)
    try:  # the query keeps a snapshot of the conf taken at its start
        q = start_assessment(
            records, rules, sinks, checkpoint, trigger, ingest_col=ingest, query_name="dq-assessment",
            state_partitions=state_partitions, stream_salts=stream_salts, staged=staged, late_for=late_for,
        )
    finally:
        if own:
            spark.conf.unset(own)
    if wait and (trigger or {}).get("availableNow"):
        finish(q, rules, sinks, checkpoint, ingest)
        if extra is not None:
            extra.awaitTermination()
            if extra.exception() is not None:
                raise RuntimeError(f"issue stream failed: {extra.exception()}")
    elif wait:
        running = [x for x in (q, extra) if x is not None]
        while all(x.isActive for x in running):
            await_any(spark, 60)
        for x in running:
            x.stop()
            if x.exception() is not None:
                raise RuntimeError(f"stream failed: {x.exception()}")
    return q
