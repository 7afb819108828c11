"""Record assessment: completeness, validity, windowed z-score anomalies, score.

``assess_rows`` is stateless (no shuffle, usable on any stream at once);
``assess`` adds the windowed anomaly statistics and the quality score.  Both
work on batch and streaming DataFrames; only the anomaly join differs:

* batch  – statistics per (tumbling window, entity) are aggregated with
  partial (map-side) aggregation, written once to the shared work folder
  (their row count observed during the write), and joined back by broadcast
  when that count is under a bound, so raw rows never shuffle and a hot
  entity costs nothing extra.  Above the bound the join shuffles and the hot
  (window, entity) groups are salted (see ``_salted_join``).
* stream – one watermark, statistics as a windowed streaming aggregate,
  joined back with a stream-stream left join on (window, entity, salt).
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import checks, scoring
from ..functions.timewin import window_end, window_start
from ..rules import Rules
from ..session import materialize_counted, scratch_path

# Broadcast bounds for the window-statistics side.  Bytes count a row's fixed
# columns and its entity string.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 128 << 20
# A (window, entity) group above this many rows is split over several join tasks.
DEFAULT_HOT_ROWS = 5_000_000
# Streaming: records of one (window, entity) are spread over this many join
# state partitions.
DEFAULT_STREAM_SALTS = 8

WIN = "_w"


def assess_rows(df: DataFrame, rules: Rules) -> DataFrame:
    """Missing flags, missing list, completeness score, range validity."""
    df = df.select(
        "*",
        *checks.missing_flags(rules),
        checks.missing_fields(rules),
        checks.completeness_score(rules),
    )
    return df.select("*", *checks.validity_flags(rules))


def _stat_aggs(rules: Rules):
    aggs = [F.count(F.lit(1)).alias("n")]
    for m in rules.anomaly:
        p = rules.prefix(m)
        aggs.append(F.avg(F.col(m)).alias(f"{p}_mean"))
        aggs.append(F.stddev_samp(F.col(m)).alias(f"{p}_stddev"))
    return aggs


def stat_columns(rules: Rules) -> list[str]:
    out = []
    for m in rules.anomaly:
        p = rules.prefix(m)
        out += [f"{p}_mean", f"{p}_stddev"]
    return out


def window_stats(df: DataFrame, rules: Rules) -> DataFrame:
    """Per (tumbling window of ``rules.time``, entity): row count, mean and
    sample stddev of each anomaly measure.  Columns: window_start, window_end,
    <entity>, n, <p>_mean, <p>_stddev ...  (a NULL entity forms its own group;
    rows without a time belong to no window)."""
    t = F.col(rules.time)
    return (
        df.filter(t.isNotNull())
        .groupBy(window_start(t, rules.window).alias("window_start"), F.col(rules.entity))
        .agg(*_stat_aggs(rules))
        .select(
            "window_start",
            window_end(F.col("window_start"), rules.window).alias("window_end"),
            rules.entity,
            "n",
            *stat_columns(rules),
        )
    )


def _with_scores(df: DataFrame, rules: Rules) -> DataFrame:
    df = df.select("*", *checks.anomaly_columns(rules))
    df = df.select("*", scoring.has_issues(rules))
    return df.select("*", scoring.quality_score(rules))


def _salted_join(rows: DataFrame, stats: DataFrame, rules: Rules, hot_rows: int, hot_list_rows: int) -> DataFrame:
    """Shuffle join for when the statistics side is too big to broadcast.

    Groups with more than ``hot_rows`` rows are split: their rows get a salt in
    [0, k), a hash of the row, so a recomputed task salts as the lost one did,
    and their single stats row is replicated k times: a hot (window, entity)
    lands on k tasks instead of one.  A hot-key list beyond ``hot_list_rows``
    is not broadcast; then every group is salted alike, by what the largest
    one needs.
    """
    keys = [WIN, rules.entity]
    salts = F.ceil(F.col("n") / F.lit(hot_rows)).cast("int")
    hot = stats.filter(F.col("n") > F.lit(hot_rows)).select(*keys, salts.alias("_salts"))
    found = hot.agg(F.count(F.lit(1)).alias("n"), F.max("_salts").alias("most")).first()
    if found["n"] == 0:
        return rows.join(stats.drop("n"), keys, "left")
    mark = F.xxhash64(*[F.col(c) for c in rows.columns])
    if found["n"] > max(hot_list_rows, 1):
        rows = rows.withColumn("_salt", F.pmod(mark, F.lit(found["most"])).cast("int"))
        stats = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(found["most"] - 1)))).drop("n")
        return rows.join(stats, keys + ["_salt"], "left").drop("_salt")
    hot_side = F.broadcast(hot)
    rows = rows.join(hot_side, keys, "left").withColumn("_salt", F.pmod(mark, F.coalesce(F.col("_salts"), F.lit(1))).cast("int")).drop("_salts")
    stats = (
        stats.join(hot_side, keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - F.lit(1))))
        .drop("_salts", "n")
    )
    return rows.join(stats, keys + ["_salt"], "left").drop("_salt")


# Every executor may end up caching each range's broadcast relation (spillable), so
# at most this many ranges share one plan; more are worked off one lot after another.
RANGES_PER_PLAN = 16
# Days of statistics that are listed on the driver at most (over 270 years).
MAX_DAYS = 100_000


def _day_chunks(stats: DataFrame, broadcast_rows: int):
    """Contiguous day ranges of window starts, each holding at most
    ``broadcast_rows`` statistics rows.  Reads one row per day of statistics
    (bounded by the time span and ``MAX_DAYS``, not the data).  None when a
    single day is over the bound, or times are spread over more days."""
    per_day = (
        stats.groupBy(F.to_date(F.col(WIN)).alias("d")).agg(F.count(F.lit(1)).alias("c")).orderBy("d").limit(MAX_DAYS + 1).collect()
    )
    if len(per_day) > MAX_DAYS:
        return None
    chunks, lo, acc, prev = [], None, 0, None
    for d, c in per_day:
        if c > broadcast_rows:
            return None
        if lo is not None and acc + c > broadcast_rows:
            chunks.append((lo, prev))
            lo, acc = None, 0
        if lo is None:
            lo = d
        acc += c
        prev = d
    if lo is not None:
        chunks.append((lo, prev))
    return chunks


def _chunked_broadcast_join(rows: DataFrame, stats: DataFrame, rules: Rules, chunks, part_col: str) -> DataFrame:
    """One broadcast join per day range, each over a scan pruned to the dates
    that range's windows can cover (``part_col`` is a partition column equal
    to the date of ``rules.time`` on every row, checked by the caller),
    unioned: the input is read once in total and never shuffled.  Rows
    without a time keep NULL statistics; the ranges and that remainder
    partition the rows exactly, so none is lost or doubled."""
    import datetime as dt

    from ..functions.timewin import duration_micros

    # how many dates past its start day a window can reach (windows are
    # epoch-aligned): none when the window divides a day, length - 1 day for
    # whole days, else rounded up
    w_us, day_us = duration_micros(rules.window), 86_400_000_000
    if day_us % w_us == 0:
        span_days = 0
    elif w_us % day_us == 0:
        span_days = w_us // day_us - 1
    else:
        span_days = -(-w_us // day_us)
    keys = [WIN, rules.entity]
    stats = stats.drop("n")

    def joined(lo, hi) -> DataFrame:
        w_lo, w_hi = F.lit(lo).cast("timestamp"), F.lit(hi + dt.timedelta(days=1)).cast("timestamp")
        cond = (
            F.col(part_col).between(F.lit(lo), F.lit(hi + dt.timedelta(days=span_days)))
            & (F.col(WIN) >= w_lo)
            & (F.col(WIN) < w_hi)
        )
        side = stats.filter((F.col(WIN) >= w_lo) & (F.col(WIN) < w_hi))
        return rows.filter(cond).join(F.broadcast(side), keys, "left")

    # ``part_col`` was checked to equal the date of ``rules.time`` on every
    # row, so the rows no range takes are exactly those without a time: the
    # NULL partition (pruned, not a second full scan)
    rest = rows.filter(F.col(part_col).isNull()).select(
        "*", *[F.lit(None).cast("double").alias(c) for c in stat_columns(rules)]
    )
    if len(chunks) <= RANGES_PER_PLAN:
        return reduce(DataFrame.unionByName, [joined(*c) for c in chunks], rest.select(*joined(*chunks[0]).columns))
    # lot by lot into one table in the shared folder: each row is read, joined
    # and written once, and only a lot's statistics are in memory at a time
    path = scratch_path(rows.sparkSession, "assessed-ranges")
    names = joined(*chunks[0]).columns
    rest.select(*names).write.parquet(path)
    for i in range(0, len(chunks), RANGES_PER_PLAN):
        lot = reduce(DataFrame.unionByName, [joined(*c) for c in chunks[i : i + RANGES_PER_PLAN]])
        lot.select(*names).write.mode("append").parquet(path)
    return rows.sparkSession.read.schema(lot.select(*names).schema).parquet(path)


def attach_anomalies(
    df: DataFrame,
    rules: Rules,
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    hot_rows: int = DEFAULT_HOT_ROWS,
    stream_salts: int = DEFAULT_STREAM_SALTS,
    hot_list_rows: int = DEFAULT_BROADCAST_ROWS,
    partition_col: str | None = None,
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """J1 + W5/W6: join window statistics back to every record, add z-scores and
    anomaly flags.  Records with a NULL entity match no statistics (z = 0).

    Statistics within ``broadcast_rows`` and ``broadcast_bytes``: one broadcast join.  Above it, when
    the caller names ``partition_col`` (a date partition column holding the
    date of ``rules.time``, as in the lake): one broadcast join per day range
    (``_chunked_broadcast_join``).  Otherwise, or when a single day is over
    the bound: a salted shuffle join."""
    if df.isStreaming:
        return _with_scores(_attach_stream(df, rules, stream_salts), rules)
    cols = df.columns
    rows = df.withColumn(WIN, window_start(F.col(rules.time), rules.window))
    src, part_check = rows, None
    if partition_col and partition_col in cols:
        # verified in the statistics scan itself: the partition column is the
        # date of the time column on every row (what the range plan relies on)
        part_check = Observation("partition-date-check")
        mismatch = ~F.col(partition_col).eqNullSafe(F.to_date(F.col(rules.time)))
        src = rows.observe(part_check, F.count_if(mismatch).alias("bad"))
    entity_bytes = Observation("window-stats-bytes")
    grouped = src.filter(F.col(WIN).isNotNull()).groupBy(WIN, rules.entity).agg(*_stat_aggs(rules))
    size = F.coalesce(F.sum(F.octet_length(F.col(rules.entity).cast("string"))), F.lit(0))
    stats, n_stats = materialize_counted(grouped.observe(entity_bytes, size.alias("bytes")), "window-stats")
    row_bytes = 32 + 16 * len(rules.anomaly) + int(entity_bytes.get["bytes"]) / max(n_stats, 1)
    broadcast_rows = min(broadcast_rows, int(broadcast_bytes / row_bytes))
    chunks = None
    if n_stats > broadcast_rows and part_check is not None and int(part_check.get["bad"]) == 0:
        chunks = _day_chunks(stats, broadcast_rows)
    if n_stats <= broadcast_rows:
        joined = rows.join(F.broadcast(stats.drop("n")), [WIN, rules.entity], "left")
    elif chunks:
        joined = _chunked_broadcast_join(rows, stats, rules, chunks, partition_col)
    else:
        joined = _salted_join(rows, stats, rules, hot_rows, hot_list_rows)
    out = joined.select(*cols, *stat_columns(rules))
    return _with_scores(out, rules)


def _attach_stream(df: DataFrame, rules: Rules, salts: int = DEFAULT_STREAM_SALTS) -> DataFrame:
    """Streaming plan: a single watermark on ``rules.time``; statistics are a
    windowed append-mode aggregate joined back on (window, entity).

    The join buffers every record of an open window in state until the window
    closes.  To keep a hot entity from filling one state partition, records
    carry a deterministic salt in [0, salts) and each (tiny) statistics row is
    replicated once per salt; the join key is (window, entity, salt).

    Rows without a time belong to no window: they pass by the join with NULL
    statistics, as in a batch, and are never dropped.

    The original time column is carried as a copy taken before the watermark
    and restored after the join, because a stream-stream join output may hold
    only one event-time column (the window key).
    """
    cols = df.columns
    t = rules.time
    e = (
        df.withColumn("_event_ts", F.col(t))
        .withWatermark(t, rules.watermark)
        .withColumn(WIN, F.window(F.col(t), rules.window))
    )
    stats = e.groupBy(WIN, rules.entity).agg(*_stat_aggs(rules)).drop("n")
    keys = [WIN, rules.entity]
    if salts > 1:
        e = e.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salts)).cast("int"))
        stats = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        keys = keys + ["_salt"]
    joined = e.drop(t).join(stats, keys, "left").withColumnRenamed("_event_ts", t)
    out = joined.select(*cols, *stat_columns(rules))
    timeless = df.filter(F.col(t).isNull()).select(*cols, *[F.lit(None).cast("double").alias(c) for c in stat_columns(rules)])
    return out.unionByName(timeless)


def assess(df: DataFrame, rules: Rules, **kw) -> DataFrame:
    """Full assessment: P1-P7 plus anomalies; batch or streaming."""
    if not rules.anomaly:
        return score_only(assess_rows(df, rules), rules)
    if df.isStreaming:
        # only the raw columns wait in the join's state; the checks follow
        joined = _attach_stream(df, rules, kw.get("stream_salts", DEFAULT_STREAM_SALTS))
        checked = assess_rows(joined, rules)
        stats = stat_columns(rules)
        return _with_scores(checked.select(*[c for c in checked.columns if c not in stats], *stats), rules)
    return attach_anomalies(assess_rows(df, rules), rules, **kw)


def score_only(df: DataFrame, rules: Rules) -> DataFrame:
    """P5/P6 on rows that already carry validity and anomaly columns."""
    df = df.select("*", scoring.has_issues(rules))
    return df.select("*", scoring.quality_score(rules))


ISSUE_TIME = "detected_at"
#: Times in issue documents, to the microsecond.
ISSUE_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def extract_issues(assessed: DataFrame, rules: Rules, ingest_col: str | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """Rows flagged ``has_issues = true`` (NULL is not an issue), projected
    to subject, entity, measures, scores, flags and ``detected_at``; ``also``: columns
    that stay beside them, such as a partition's."""
    measures = []
    for name in list(rules.required) + list(rules.range_fields):
        if name not in (rules.subject, rules.entity) and name not in measures:
            measures.append(name)
    flags = [f"{rules.prefix(n)}_valid" for n in rules.range_fields]
    flags += [f"{rules.prefix(m)}_anomaly" for m in rules.anomaly]
    return assessed.filter(F.col("has_issues")).select(
        rules.subject,
        rules.entity,
        *measures,
        "quality_score",
        "completeness_score",
        *flags,
        F.col(ingest_col or rules.time).alias(ISSUE_TIME),
        *also,
    )


def row_issues(df: DataFrame, rules: Rules) -> DataFrame:
    """Issues that the row alone shows, without any window: records that are
    incomplete or out of range, all their columns and checks with the score
    they have without anomalies.  Stateless, for any stream."""
    return score_only(assess_rows(df, replace(rules, anomaly=())), replace(rules, anomaly=())).filter(F.col("has_issues"))


def with_severity(issues: DataFrame, mapping=scoring.DEFAULT_SEVERITY) -> DataFrame:
    """Severity label from the quality score."""
    return issues.withColumn("severity", scoring.severity(F.col("quality_score"), mapping))


def issue_json(issues: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """S7 payload: one JSON document per issue in column ``value`` (NULL fields omitted),
    beside the columns ``also``, which are not part of it."""
    document = F.struct(*[c for c in issues.columns if c not in also])
    return issues.select(F.to_json(document, {"timestampFormat": ISSUE_TS}).alias("value"), *also)


__all__ = [
    "assess_rows",
    "assess",
    "attach_anomalies",
    "window_stats",
    "score_only",
    "extract_issues",
    "row_issues",
    "with_severity",
    "issue_json",
]
