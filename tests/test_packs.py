"""Compaction in place: rows stay the same whatever is packed, written again, swept or
lost half-way, and the number of files is bounded."""

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

import dqspark.sources.packs as packs
from dqspark.operators import assess
from dqspark.sources.lake import read_lake
from dqspark.sources.packs import compact, has_packs, packs_path, resolve, sweep
from dqspark.sources.snapshots import commit
from dqspark.streaming import StreamSinks
from dqspark.streaming.staged import StagedWindows
from test_staged import RULES, frame, records, rows_of


def staged(spark, root, late_for=None):
    sinks = StreamSinks(lake=f"{root}/lake")
    return StagedWindows(spark, frame(spark, []).schema, RULES, sinks, f"{root}/ckpt", late_for=late_for), sinks.lake


def files(*parts):
    return glob.glob(os.path.join(*parts, "**", "*.parquet"), recursive=True)


def test_compaction_between_batches(spark):
    rows = records(11)
    root = tempfile.mkdtemp(prefix="dq-packs-")
    w, lake = staged(spark, root, late_for="0 minutes")  # late records fetch their window from the packs
    ordered = sorted(rows[:80], key=lambda r: (r[4] is None, str(r[4])))
    for k, batch in enumerate((ordered[:40], ordered[40:], rows[80:])):
        w(frame(spark, batch), k)
        before = rows_of(read_lake(spark, lake)) if k else None
        assert compact(spark, lake, min_files=1)
        if k:
            assert rows_of(read_lake(spark, lake)) == before
        if k == 1:
            assert sweep(spark, lake, 0) > 0 and not files(lake)
            assert rows_of(read_lake(spark, lake)) == before
    w(frame(spark, rows[80:]), 2)  # the last batch is replayed after it was packed
    w.assess_open()
    assert rows_of(read_lake(spark, lake)) == rows_of(assess(frame(spark, rows), RULES))
    compact(spark, lake, min_files=1)
    sweep(spark, lake, 0)
    assert rows_of(read_lake(spark, lake)) == rows_of(assess(frame(spark, rows), RULES))
    days = {r[4].date() if r[4] else None for r in rows}
    assert not files(lake) and len(files(packs_path(lake), "packs")) <= 8 * len(days)
    assert compact(spark, lake, min_files=1) == [] and sweep(spark, lake, 0) == 0


def test_few_small_files_are_left(spark):
    root = tempfile.mkdtemp(prefix="dq-packs-")
    w, lake = staged(spark, root)
    w(frame(spark, records(3)), 0)
    w.assess_open()
    assert compact(spark, lake, min_files=10_000) == [] and not has_packs(spark, lake)


def test_window_written_while_it_is_packed(spark, monkeypatch):
    rows = records(5)
    root = tempfile.mkdtemp(prefix="dq-packs-")
    w, lake = staged(spark, root)
    w(frame(spark, rows[:60]), 0)
    w.assess_open()
    write, calls = packs._pack, []

    def meanwhile(*a):
        out = write(*a)
        if not calls:  # written and packed, not yet committed
            calls.append(1)
            w(frame(spark, rows[60:]), 1)
            w.assess_open()
        return out

    monkeypatch.setattr(packs, "_pack", meanwhile)
    compact(spark, lake, min_files=1)
    assert rows_of(read_lake(spark, lake)) == rows_of(assess(frame(spark, rows), RULES))


def test_writer_that_dies_and_writer_that_is_second(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="dq-packs-")
    w, lake = staged(spark, root)
    w(frame(spark, records(7)), 0)
    w.assess_open()
    want = rows_of(read_lake(spark, lake))
    state = resolve(spark, lake)
    lost = packs._pack(spark, lake, state, sorted({d for d, _ in state.folders}))  # never committed
    assert rows_of(read_lake(spark, lake)) == want and not has_packs(spark, lake)
    compact(spark, lake, min_files=1)
    assert commit(spark, packs_path(lake), lost, over=state.version) is False
    assert rows_of(read_lake(spark, lake)) == want
    sweep(spark, lake, 0)
    assert rows_of(read_lake(spark, lake)) == want
    assert len(glob.glob(f"{packs_path(lake)}/packs/*/date=*")) == len({d for d, _ in state.folders})


def test_dates_prune_packs_and_folders(spark):
    root = tempfile.mkdtemp(prefix="dq-packs-")
    df = spark.range(40).selectExpr("id", "date_add(date'2024-01-01', cast(id % 4 as int)) AS date", "concat('w', id % 8) AS part")
    df.write.partitionBy("date", "part").parquet(f"{root}/lake")
    compact(spark, f"{root}/lake", min_files=1, dates=["2024-01-01", "2024-01-02"])
    got = read_lake(spark, f"{root}/lake", "2024-01-01")
    assert got._jdf.queryExecution().executedPlan().toString().count("PartitionFilters: [isnotnull(date") == 2
    assert sorted(r.id for r in got.collect()) == list(range(0, 40, 4))
    assert read_lake(spark, f"{root}/lake").agg(F.count("id"), F.countDistinct("id")).first()[:] == (40, 40)


def test_lake_without_inner_folders_is_refused(spark):
    root = tempfile.mkdtemp(prefix="dq-packs-")
    spark.range(4).selectExpr("id", "date'2024-01-01' AS date").write.partitionBy("date").parquet(f"{root}/lake")
    with pytest.raises(ValueError, match="below the date"):
        compact(spark, f"{root}/lake", min_files=1)
