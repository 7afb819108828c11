"""Z-score against the last N rows of the same entity (count window).

A per-entity window function would put a whole entity - possibly a third of
the data - into one task.  Instead:

1. sort the key and the measures, no other column, globally by (entity, time,
   tie-break); the range shuffle splits a hot entity over many partitions;
2. number rows consecutively: ``monotonically_increasing_id`` gives
   (partition, position); a table with one row per partition turns it into a
   global index ``g`` (the narrow numbered rows are written once to the shared
   work folder, so a recomputed task cannot renumber them);
3. cut ``g`` into blocks of N rows and also copy every narrow row into the
   next block; the window of N rows ending at ``g``
   then lies inside group (entity, block(g)), which holds at most 2N rows;
4. inside each group, running count / sum / sum of squares of the values
   centred on the group mean (a growing frame, O(1) per row) and
   ``lag(..., N)`` give the sums over exactly the last N rows; only each
   group's own rows are kept;
5. rows that are equal in (entity, time, tie-break) are peers and share the
   statistics of the last of them, whose window holds them all, so each key has
   one row of statistics;
6. these join the full rows by (entity, time, tie-break), so the full rows are
   shuffled once, evenly, and never copied or multiplied.

Rows with a NULL entity get no statistics (z = 0), as in the time-window check.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.checks import zscore
from ..rules import Rules
from ..session import materialize
from .assess import stat_columns

_POS_BITS = 33  # monotonically_increasing_id = partition << 33 | position


def count_window_anomalies(
    df: DataFrame,
    rules: Rules,
    order_cols: tuple[str, ...],
    window_rows: int | None = None,
) -> DataFrame:
    """Add ``<p>_mean``, ``<p>_stddev``, ``<p>_zscore``, ``<p>_anomaly`` for each
    anomaly measure over the last ``window_rows`` rows (this row included) of
    the same entity, in order (``rules.time``, *order_cols*).  ``order_cols``
    should make the order unique (e.g. an event id).  Where they don't, as when
    rows are repeated, equal rows count one by one but share the statistics of
    the last; among them the order is that of the measures."""
    n = int(window_rows or rules.row_window)
    ent, t = rules.entity, rules.time
    cols = df.columns
    keyed = df.filter(F.col(ent).isNotNull())
    nulls = df.filter(F.col(ent).isNull())

    key = list(dict.fromkeys([ent, t, *order_cols]))
    narrow = keyed.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)], *[F.col(m).cast("double").alias(f"_v_{m}") for m in rules.anomaly])
    keys = [f"_k{i}" for i in range(len(key))]
    numbered = materialize(
        narrow.orderBy(*keys, *[f"_v_{m}" for m in rules.anomaly]).withColumn("_mid", F.monotonically_increasing_id()),
        "rowwin-numbered",
    )
    pid = F.shiftright(F.col("_mid"), _POS_BITS)
    pos = F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    # One row per partition: bounded by the partition count, not the data.
    counts = numbered.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        "_pid",
        F.coalesce(
            F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_off"),
    )
    g = numbered.withColumn("_pid", pid).join(F.broadcast(offsets), "_pid").withColumn("_g", F.col("_off") + pos)

    # every row goes to its own block, and to the next one as history
    blk = F.floor(F.col("_g") / F.lit(n))
    copies = F.explode(F.array(F.struct(blk.alias("_grp"), F.lit(True).alias("_own")), F.struct((blk + 1).alias("_grp"), F.lit(False).alias("_own"))))
    both = g.drop("_mid", "_pid", "_off").withColumn("_copy", copies).select("*", "_copy._grp", "_copy._own").drop("_copy")

    w_order = Window.partitionBy("_k0", "_grp").orderBy("_g")
    running = w_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # Values are centred on their group's mean before the running sums: the
    # variance is shift-invariant, and the sums then carry no mean^2 term
    # that would cancel against a small window variance.
    both = both.select("*", *[F.avg(f"_v_{m}").over(whole).alias(f"_m_{m}") for m in rules.anomaly])
    sums = []
    for m in rules.anomaly:
        x = F.col(f"_v_{m}") - F.col(f"_m_{m}")
        sums += [
            F.count(x).over(running).alias(f"_c_{m}"),
            F.sum(x).over(running).alias(f"_s_{m}"),
            F.sum(x * x).over(running).alias(f"_q_{m}"),
        ]
    acc = both.select("*", *sums)
    lagged = []
    for m in rules.anomaly:
        for k in ("c", "s", "q"):
            lagged.append(F.coalesce(F.lag(f"_{k}_{m}", n).over(w_order), F.lit(0)).alias(f"_{k}0_{m}"))
    acc = acc.select("*", *lagged).filter(F.col("_own"))

    stats = []
    for m in rules.anomaly:
        p = rules.prefix(m)
        cnt = F.col(f"_c_{m}") - F.col(f"_c0_{m}")
        s = F.col(f"_s_{m}") - F.col(f"_s0_{m}")
        q = F.col(f"_q_{m}") - F.col(f"_q0_{m}")
        mean = F.when(cnt > 0, F.col(f"_m_{m}") + s / cnt)
        var = F.when(cnt > 1, F.greatest((q - s * s / cnt) / (cnt - 1), F.lit(0.0)))
        stats += [mean.alias(f"{p}_mean"), F.sqrt(var).alias(f"{p}_stddev")]
    names = stat_columns(rules)
    last = F.max_by(F.struct(*names), F.col("_g")).alias("_last")
    found = acc.select(*keys, "_g", *stats).groupBy(*keys).agg(last).select(*keys, "_last.*")
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(key, keys)]
    keyed_out = keyed.join(found, reduce(and_, same)).select(*cols, *[c for c in found.columns if c not in keys])

    null_stats = []
    for m in rules.anomaly:
        p = rules.prefix(m)
        null_stats += [F.lit(None).cast("double").alias(f"{p}_mean"), F.lit(None).cast("double").alias(f"{p}_stddev")]
    out = keyed_out.unionByName(nulls.select(*cols, *null_stats))

    flags = []
    for m in rules.anomaly:
        p = rules.prefix(m)
        z = zscore(F.col(m), F.col(f"{p}_mean"), F.col(f"{p}_stddev"))
        flags += [z.alias(f"{p}_zscore"), (z > F.lit(float(rules.z_threshold))).alias(f"{p}_anomaly")]
    return out.select("*", *flags)


def count_window_step(
    new: DataFrame,
    tail: DataFrame | None,
    rules: Rules,
    order_cols: tuple[str, ...],
    window_rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """X2 without the history: ``new`` rows (a day's, say) with the columns of
    ``count_window_anomalies``, and the tail that the next step starts from.

    ``tail`` (None: there is no history) holds each entity's last ``window_rows`` - 1
    rows, keys and measures only, so a step sorts the new rows and one window an
    entity, however long the history.  The windows of steps in order are those of one run
    over all rows.  New rows must come after their entity's tail in (``rules.time``,
    *order_cols*), nulls first; a row that is older, or equal to the tail's last (its
    statistics would be shared with rows already reported), stops the step.
    Entities without new rows keep their tail; rows with a NULL entity are in none."""
    n = int(window_rows or rules.row_window)
    order = list(dict.fromkeys([rules.time, *order_cols]))
    kept = list(dict.fromkeys([rules.entity, *order, *rules.anomaly]))
    old = new.select(*kept).limit(0) if tail is None else tail.select(*kept)
    if tail is not None:
        _refuse_late(new, old, rules.entity, order)
    mark = "_is_new"
    rows = new.withColumn(mark, F.lit(True)).unionByName(old.withColumn(mark, F.lit(False)), allowMissingColumns=True)
    out = count_window_anomalies(rows, rules, order_cols, n).filter(mark).drop(mark)

    # WindowGroupLimit keeps n - 1 rows an entity and task before the shuffle
    both = new.select(*kept).filter(F.col(rules.entity).isNotNull()).unionByName(old)
    last = Window.partitionBy(rules.entity).orderBy(*[F.desc_nulls_last(c) for c in order], *[F.desc_nulls_last(F.col(m).cast("double")) for m in rules.anomaly])
    return out, both.withColumn("_back", F.row_number().over(last)).filter(F.col("_back") < n).drop("_back")


def _refuse_late(new: DataFrame, tail: DataFrame, entity: str, order: list[str]) -> None:
    """Two partial aggregates, a row an entity each; structs compare field by field,
    nulls first, as the sort does."""
    at = F.struct(*order)
    first = new.filter(F.col(entity).isNotNull()).groupBy(entity).agg(F.min(at).alias("_first"))
    last = tail.groupBy(entity).agg(F.max(at).alias("_last"))
    late = first.join(last, entity).filter(F.col("_first") <= F.col("_last")).select(entity).first()
    if late is not None:
        raise ValueError(f"rows of {late[0]!r} are not newer than its tail; run its history again")
