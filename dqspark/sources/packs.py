"""Compaction of the lake in place, under a running stream.

The stream writes a folder of small files for each window (or batch) of a date and
replaces the folder as a whole when the window is assessed again.  ``compact`` writes
a date's folders into a few large files, a pack; a manifest, versioned like a publish
(``snapshots``), says of each packed folder which files it was packed from.

* A folder whose files the manifest names counts by its pack.
* A folder with any other file has been written since: it counts as it stands, and
  what the packs hold of it does not.

So writers need not know of packs, and a compaction that overlaps with a re-assessed
window, or dies half-way, changes no result.  ``sweep`` removes the small files, old
packs and old manifests once no reader can be at them.

The lake's layout is ``date=<day>/<column>=<value>/<files>``; lakes whose dates have no
folders inside are refused, as files are added to those, not replaced.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .snapshots import POINTERS, _fs, _pointers, _target, commit, current, expire, new_version

DATE, PACK = "date", "pack"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
MANIFEST = "day string, inner string, pack string, files array<string>, packed_at timestamp, row_schema string"
MAX_RECORDS_PER_FILE = 5_000_000
#: A date is compacted when that many small files of it are not in a pack.
MIN_FILES = 8
ATTEMPTS = 3


def packs_path(lake: str) -> str:
    return f"{lake}-packed"


@dataclass
class LakeState:
    """What the lake holds, resolved once: rows read through it are of one moment."""

    version: str  # of the manifest; the packs' root where there is none
    schema: T.StructType
    inner: str | None  # partition column below the date
    live: DataFrame | None  # rows of the folders that are not in a pack
    folders: dict = field(default_factory=dict)  # (day, inner) -> file names of those folders
    packed: DataFrame | None = None  # rows that count by their pack
    manifest: DataFrame | None = None  # of those rows

    def rows(self) -> DataFrame:
        parts = [p for p in (self.live, self.packed) if p is not None]
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _layout(files: list[str]) -> tuple[str | None, dict]:
    """Name of the inner partition column, and the file names by (day, inner value)."""
    names, found = set(), defaultdict(set)
    for f in files:
        day, inner, name = f.rsplit("/", 3)[1:]
        if not day.startswith(f"{DATE}=") or "=" not in inner:
            raise ValueError(f"no folder below the date: {f}")
        column, value = inner.split("=", 1)
        names.add(column)
        found[unquote(day.split("=", 1)[1]), unquote(value)].add(unquote(name))
    if len(names) > 1:
        raise ValueError(f"folders below the date by different columns: {sorted(names)}")
    return (names.pop() if names else None), dict(found)


def _folder_key(inner: str):
    return F.concat_ws("/", F.coalesce(F.col(DATE).cast("string"), F.lit(NO_DATE)), F.col(inner).cast("string"))


def has_packs(spark: SparkSession, lake: str) -> bool:
    at, fs = _fs(spark, f"{packs_path(lake)}/{POINTERS}")
    return fs.exists(at)


def resolve(spark: SparkSession, lake: str) -> LakeState:
    """The driver holds the names of the small files that have not been swept, as Spark's
    own listing does, and one path a packed date."""
    root = packs_path(lake)
    version = current(spark, root)
    if version == root:
        live = spark.read.parquet(lake)
        inner, folders = _layout(live.inputFiles())
        return LakeState(version, live.schema, inner, live, folders)
    manifest = spark.read.schema(MANIFEST).parquet(version)
    kept = T.StructType.fromJson(json.loads(manifest.agg(F.max_by("row_schema", "packed_at")).first()[0]))
    there = spark.read.schema(kept).parquet(lake).inputFiles()
    schema = spark.read.parquet(lake).schema if there else kept
    inner, listed = _layout(there)
    inner = inner or schema.names[-1]
    live, folders = None, {}
    if listed:
        seen = spark.createDataFrame([(d, i, sorted(names)) for (d, i), names in listed.items()], "day string, inner string, now array<string>")
        whole = F.size(F.array_except("now", "files")) == 0
        in_packs = {(r.day, r.inner) for r in seen.join(manifest, ["day", "inner"]).filter(whole).select("day", "inner").collect()}
        written = sorted(k for k in listed if k not in in_packs)
        if written:
            live = spark.read.schema(schema).option("basePath", lake).parquet(*[f"{lake}/{DATE}={d}/{inner}={i}" for d, i in written])
            folders = _layout(live.inputFiles())[1]
            again = spark.createDataFrame([k for k in written], "day string, inner string")
            manifest = manifest.join(again, ["day", "inner"], "left_anti")
    at = [(r.pack, r.day) for r in spark.read.schema(MANIFEST).parquet(version).select("pack", "day").distinct().collect()]
    fields = T.StructType([f for f in schema.fields if f.name != DATE] + [T.StructField(PACK, T.StringType()), schema[DATE]])
    packed = spark.read.schema(fields).option("basePath", f"{root}/packs").parquet(*[f"{root}/packs/{PACK}={p}/{DATE}={d}" for p, d in sorted(at)])
    if folders:
        again = spark.createDataFrame([(f"{d}/{i}",) for d, i in folders], "_folder string")
        packed = packed.withColumn("_folder", _folder_key(inner)).join(again, "_folder", "left_anti")
    return LakeState(version, schema, inner, live, folders, packed.select(*schema.names), manifest)


def read_packed(spark: SparkSession, lake: str) -> DataFrame:
    """The lake's rows, from packs and folders; a filter on ``date`` prunes both."""
    return resolve(spark, lake).rows()


def compact(spark: SparkSession, lake: str, min_files: int = MIN_FILES, dates: list | None = None) -> list[str]:
    """Pack every date (of ``dates``, if given) that has ``min_files`` small files; the
    days that were packed.  A date that was packed before is packed anew with what
    has been written since.  If a file vanishes while it is read, as its window was
    assessed again, or another compaction is first, it is done over."""
    for left in reversed(range(ATTEMPTS)):
        state = resolve(spark, lake)
        small = defaultdict(int)
        for (day, _), names in state.folders.items():
            small[day] += len(names)
        days = sorted(d for d, n in small.items() if n >= min_files and (dates is None or d in {str(x) for x in dates}))
        if not days:
            return []
        try:
            version = _pack(spark, lake, state, days)
        except Exception as e:
            if left and ("FileNotFound" in str(e) or "FILE_NOT_EXIST" in str(e) or "PATH_NOT_FOUND" in str(e)):
                continue
            raise
        if commit(spark, packs_path(lake), version, over=state.version):
            return days
    raise RuntimeError(f"{lake}: other compactions were first {ATTEMPTS} times")


def _pack(spark: SparkSession, lake: str, state: LakeState, days: list[str]) -> str:
    """Write the days' pack and the manifest that names it."""
    root, pack = packs_path(lake), uuid.uuid4().hex
    timed = [F.lit(d).cast("date") for d in days if d != NO_DATE]
    chosen = F.col(DATE).isin(timed) if timed else F.lit(False)
    if NO_DATE in days:
        chosen = chosen | F.col(DATE).isNull()
    rows = state.rows().filter(chosen).hint("rebalance", DATE)
    rows.write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy(DATE).parquet(f"{root}/packs/{PACK}={pack}")
    new = spark.createDataFrame([(d, i, sorted(names)) for (d, i), names in state.folders.items() if d in days], "day string, inner string, files array<string>")
    held = [F.lit(pack).alias("pack"), "files", F.current_timestamp().alias("packed_at"), F.lit(state.schema.json()).alias("row_schema")]
    manifest = new.select("day", "inner", *held)
    if state.manifest is not None:
        # folders that have been written again and are not packed now lose their entry only
        # if their date is packed: its old pack goes
        old = spark.read.schema(MANIFEST).parquet(state.version)
        packed = state.manifest.filter(F.col("day").isin(days))
        manifest = manifest.unionByName(packed.select("day", "inner", *held)).unionByName(old.filter(~F.col("day").isin(days)))
    version = new_version(root)
    manifest.write.parquet(version)
    return version


def sweep(spark: SparkSession, lake: str, keep_seconds: float, as_of_millis: int | None = None) -> int:
    """Remove what no reader is at that began less than ``keep_seconds`` ago: small files
    packed before that, manifests replaced before that, and packs that no manifest
    left names.  ``keep_seconds`` must exceed the time of a compaction or a query.  Returns
    how many small files went."""
    root = packs_path(lake)
    now = as_of_millis if as_of_millis is not None else int(spark.sparkContext._jvm.java.lang.System.currentTimeMillis())
    limit = now - int(keep_seconds * 1000)
    expire(spark, root, keep_seconds, now)
    held = _pointers(spark, root)
    if not held:
        return 0
    manifest = spark.read.schema(MANIFEST).parquet(current(spark, root))
    schema = T.StructType.fromJson(json.loads(manifest.select("row_schema").first()[0]))
    inner, listed = _layout(spark.read.schema(schema).parquet(lake).inputFiles())
    gone = 0
    if listed:
        seen = spark.createDataFrame([(d, i, sorted(names)) for (d, i), names in listed.items()], "day string, inner string, now array<string>")
        old = (F.size(F.array_except("now", "files")) == 0) & (F.unix_millis("packed_at") <= F.lit(limit))
        for r in seen.join(manifest, ["day", "inner"]).filter(old).select("day", "inner", "now").collect():
            for name in r.now:
                at, fs = _fs(spark, f"{lake}/{DATE}={r.day}/{inner}={r.inner}/{name}")
                gone += bool(fs.delete(at, False))
            at, fs = _fs(spark, f"{lake}/{DATE}={r.day}/{inner}={r.inner}")
            if fs.exists(at) and not fs.listStatus(at):
                fs.delete(at, False)
    named = set()
    for p in held:
        named |= {(r.pack, r.day) for r in spark.read.schema(MANIFEST).parquet(f"{root}/{_target(spark, p)}").select("pack", "day").distinct().collect()}
    at, fs = _fs(spark, f"{root}/packs/{PACK}=*/{DATE}=*")
    for s in fs.globStatus(at) or []:
        pack, day = s.getPath().getParent().getName().split("=", 1)[1], s.getPath().getName().split("=", 1)[1]
        if (pack, day) not in named and s.getModificationTime() <= limit:
            fs.delete(s.getPath(), True)
    return gone
