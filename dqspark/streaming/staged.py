"""Windowed assessment of a stream without join state.

Every micro-batch appends its records, as they are, to a landing table that is
partitioned by window (``win``, its start in microseconds) and batch.  Windows
that the watermark has passed are assessed by the batch plan and written to the
lake, one partition a window, so the source is read once and nothing waits in
a state store.

* A record whose window had been closed before (T5) is no loss: its window is
  assessed again, over all its records, and its partition replaced.
* A bounded run ends by assessing the windows that are still open, as they
  stand (``assess_open``); when they close later, their partitions are replaced.
* A replayed batch writes the same landing partitions and the same windows.
* Records without a time belong to no window; they are assessed at once.

``progress`` keeps one row a batch: how far the watermark is, and how many records
arrived, were late or had no time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.timewin import duration_micros, window_start
from ..operators import assess, batch_summary, extract_issues, issue_json, with_severity
from ..rules import Rules
from ..session import scratch_scope
from ..sources.lake import read_lake, with_date
from ..sources.zones import forget_zones, write_zones

WINDOW, BATCH, PART = "win", "batch_id", "part"
NO_WINDOW = "__HIVE_DEFAULT_PARTITION__"
NOTHING_CLOSED = -(1 << 62)
#: ``batch_id`` of the summary of windows that were open when a bounded run ended.
OPEN = -1
PROGRESS = f"{BATCH} bigint, records bigint, late_records bigint, timeless_records bigint, max_time bigint, closed_until bigint, written_at timestamp"


def landing_path(checkpoint: str) -> str:
    return f"{checkpoint}-landing"


def progress_path(checkpoint: str) -> str:
    return f"{checkpoint}-progress"


def read_progress(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row for each batch that is done."""
    return spark.read.schema(PROGRESS).parquet(progress_path(checkpoint))


class StagedWindows:
    """The ``foreachBatch`` callback, and what a bounded run ends with."""

    def __init__(self, spark: SparkSession, schema, rules: Rules, sinks, checkpoint: str, ingest_col: str | None = None, late_for: str | None = None):
        """``schema``: of the records.  ``late_for``: how long behind the watermark the
        landing table keeps a closed window (None: for good); a record that is
        later still has its window's other records fetched from the lake."""
        self.spark, self.schema, self.rules, self.sinks, self.checkpoint, self.ingest_col = spark, schema, rules, sinks, checkpoint, ingest_col
        self.names = schema.names
        self.width, self.delay = duration_micros(rules.window), duration_micros(rules.watermark)
        self.late_for = None if late_for is None else duration_micros(late_for)
        self.last: tuple[int, int, int] | None = None  # batch, greatest time, closed until
        self.held: set[int] | None = None  # windows in the landing table
        if sinks.summary:
            self._drop(f"{sinks.summary}/{BATCH}={OPEN}")  # what an earlier run said of open windows

    # -- tables

    def _files(self, path: str):
        sc = self.spark.sparkContext
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(sc._jsc.hadoopConfiguration())

    def _drop(self, path: str) -> None:
        at, fs = self._files(path)
        fs.delete(at, True)

    def _folder(self, window: int) -> str:
        return f"{landing_path(self.checkpoint)}/{WINDOW}={window}"

    def _held(self) -> set[int]:
        """The landing table's windows: its folders, listed when a run starts."""
        if self.held is None:
            at, fs = self._files(f"{landing_path(self.checkpoint)}/{WINDOW}=*")
            names = [s.getPath().getName().split("=", 1)[1] for s in fs.globStatus(at) or []]
            self.held = {int(n) for n in names if n.lstrip("-").isdigit()}
        return self.held

    def _records(self, windows: list[int], timeless_of: int | None = None) -> DataFrame:
        """Landed records of the windows; no other folder is opened or listed."""
        folders = [self._folder(w) for w in windows]
        if timeless_of is not None:
            folders.append(f"{landing_path(self.checkpoint)}/{WINDOW}={NO_WINDOW}/{BATCH}={timeless_of}")
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        return self.spark.read.schema(f"{fields}, {WINDOW} bigint, {BATCH} bigint").option("basePath", landing_path(self.checkpoint)).parquet(*folders)

    def _before(self, batch_id: int) -> tuple[int, int]:
        """Greatest time and closing so far, as the last batch left them."""
        if self.last is None or self.last[0] != batch_id - 1:
            at, fs = self._files(progress_path(self.checkpoint))
            row = read_progress(self.spark, self.checkpoint).filter(F.col(BATCH) < batch_id).agg(F.max("max_time"), F.max("closed_until")).first() if fs.exists(at) else (None, None)
            self.last = (batch_id - 1, *[NOTHING_CLOSED if x is None else x for x in row])
        return self.last[1], self.last[2]

    # -- one batch

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        newest, closed = self._before(batch_id)
        self._forget(newest)
        held = self._held()
        t = F.col(self.rules.time).cast("timestamp")
        start = F.unix_micros(window_start(t, self.rules.window))
        # a window's records come together in few files; a hot window is split by size
        rows = batch.select(*self.names, start.alias(WINDOW), F.lit(batch_id).cast("bigint").alias(BATCH)).hint("rebalance", WINDOW)
        late = F.col(WINDOW) + self.width <= F.lit(closed)
        seen = Observation(f"landed-{batch_id}")
        rows = rows.observe(
            seen, F.count(F.lit(1)).alias("n"), F.count_if(t.isNull()).alias("timeless"), F.count_if(late).alias("late"),
            F.max(F.unix_micros(t)).alias("newest"), F.collect_set(WINDOW).alias("windows"),
        )
        _overwrite(rows, landing_path(self.checkpoint), [WINDOW, BATCH])
        got = seen.get
        if got["newest"] is not None:
            newest = max(newest, got["newest"])
        now_closed = max(closed, newest - self.delay)
        again = sorted(w for w in got["windows"] if w + self.width <= closed)
        self._reopen([w for w in again if w not in held], batch_id)
        held.update(got["windows"])
        due = sorted(w for w in held if closed < w + self.width <= now_closed)
        if due or again or got["timeless"]:
            new = F.col(WINDOW).isin(due) | (F.col(BATCH) == batch_id)
            self._write(due + again, batch_id, new, timeless=got["timeless"] > 0)
        of = lambda x: None if x <= NOTHING_CLOSED // 2 else x
        row = (batch_id, got["n"], got["late"], got["timeless"], of(newest), of(now_closed))
        done = self.spark.createDataFrame([row], PROGRESS.rsplit(",", 1)[0]).withColumn("written_at", F.current_timestamp())
        done.coalesce(1).write.mode("overwrite").parquet(f"{progress_path(self.checkpoint)}/of={batch_id}")
        self.last = (batch_id, newest, now_closed)

    def _write(self, *what, **how) -> None:
        with scratch_scope(self.spark):  # a stream without end must not pile up statistics tables
            self._assess(*what, **how)

    def _assess(self, windows: list[int], batch_id: int, new=None, timeless: bool = False, final: bool = True) -> None:
        """Assess whole windows and replace their partitions in all sinks.  ``new``: which
        records are reported for the first time (None: all); not ``final``: the
        windows are still open, so no topic is told of them."""
        sinks, rules = self.sinks, self.rules
        part = F.when(F.col(WINDOW).isNull(), F.concat(F.lit("b"), F.col(BATCH).cast("string"))).otherwise(F.concat(F.lit("w"), F.col(WINDOW).cast("string")))
        first = F.lit(True) if new is None else F.coalesce(new, F.lit(False))
        records = self._records(windows, batch_id if timeless else None)
        rows = assess(records.select(*self.names, BATCH, part.alias(PART), first.alias("_new")), rules).persist()
        try:
            _overwrite(with_date(rows.drop("_new"), rules).hint("rebalance", "date", PART), sinks.lake, ["date", PART])
            fresh = rows.filter("_new")
            if sinks.issues and sinks.issues_format == "kafka":
                if final:
                    issue_json(with_severity(extract_issues(fresh, rules, self.ingest_col))).write.format("kafka").options(**sinks.issues_options).save()
            elif sinks.issues:
                parts = [f"w{w}" for w in windows] + ([f"b{batch_id}"] if timeless else [])
                forget_zones(self.spark, sinks.issues, [f"{PART}={p}" for p in parts])
                # a window may have had issues that it has no more
                for w in windows:
                    self._drop(f"{sinks.issues}/{PART}=w{w}")
                also = (BATCH, PART)
                issues = with_severity(extract_issues(rows, rules, self.ingest_col, also))
                _overwrite(issue_json(issues, also), sinks.issues, [PART], "json", sinks.issues_options)
                write_zones(issues.drop(BATCH), sinks.issues, PART)
            if sinks.summary:
                s = batch_summary(fresh, rules).select(F.lit(batch_id).cast("bigint").alias(BATCH), F.current_timestamp().alias("written_at"), "*")
                _overwrite(s, sinks.summary, [BATCH])
            if sinks.console:
                with_severity(extract_issues(fresh, rules, self.ingest_col)).show(truncate=False)
        finally:
            rows.unpersist()

    # -- late records, open windows, expiry

    def _reopen(self, windows: list[int], batch_id: int) -> None:
        """Windows whose landed records have been dropped get them back from the lake.
        A replayed batch finds them there already and leaves them."""
        gone = []
        for w in windows:
            at, fs = self._files(self._folder(w))
            if all(s.getPath().getName() == f"{BATCH}={batch_id}" for s in fs.listStatus(at)):
                gone.append(w)
        at, fs = self._files(self.sinks.lake)
        if not gone or not fs.exists(at):
            return
        lake = read_lake(self.spark, self.sinks.lake).filter(F.col(PART).isin([f"w{w}" for w in gone]) & (F.col(BATCH) != batch_id))
        raw = lake.select(*self.names, F.expr(f"cast(substring({PART}, 2) as bigint)").alias(WINDOW), F.col(BATCH).cast("bigint").alias(BATCH))
        _overwrite(raw, landing_path(self.checkpoint), [WINDOW, BATCH])

    def _forget(self, newest: int) -> None:
        """Drop landed windows that closed longer than ``late_for`` ago.  Called as a batch
        begins, when all that earlier batches closed is committed."""
        if self.late_for is None:
            return
        for w in [w for w in self._held() if w + self.width <= newest - self.delay - self.late_for]:
            self._drop(self._folder(w))
            self.held.discard(w)

    def assess_open(self) -> None:
        """End of a bounded run: assess the windows that are still open as they stand."""
        closed = self.last[2] if self.last else self._before(1 << 60)[1]
        windows = sorted(w for w in self._held() if w + self.width > closed)
        if windows:
            self._write(windows, OPEN, final=False)


def _overwrite(df: DataFrame, path: str, parts: list[str], fmt: str = "parquet", options: dict | None = None) -> None:
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.format(fmt).save(path)
