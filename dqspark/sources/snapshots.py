"""Published snapshots that readers can trust.

A publish writes all its tables into a version folder of its own and then, last, a
pointer that names the folder: ``_versions/<number>``, written under another name
and renamed.  A reader resolves the newest pointer once and reads that version's
tables to the end, whatever is published meanwhile; a writer that dies half-way
leaves the older version in force.  Old versions expire by age.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

POINTERS = "_versions"


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(sc._jsc.hadoopConfiguration())


def _pointers(spark: SparkSession, root: str) -> list:
    """Statuses of the pointers, oldest first."""
    at, fs = _fs(spark, f"{root}/{POINTERS}")
    if not fs.exists(at):
        return []
    return sorted((s for s in fs.listStatus(at) if s.getPath().getName().isdigit()), key=lambda s: int(s.getPath().getName()))


def _target(spark: SparkSession, pointer) -> str:
    path = pointer.getPath()
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def new_version(root: str) -> str:
    """The folder that a publish writes its tables to."""
    return f"{root}/v-{uuid.uuid4().hex}"


def commit(spark: SparkSession, root: str, version: str, over: str | None = None) -> bool:
    """Make a written version the one in force.  ``over``: the version it was made from;
    False if that is no longer in force, and nothing is done."""
    name = version.rsplit("/", 1)[1]
    held = _pointers(spark, root)
    if over is not None and over != (f"{root}/{_target(spark, held[-1])}" if held else root):
        return False
    number = int(held[-1].getPath().getName()) + 1 if held else 1
    tmp, fs = _fs(spark, f"{root}/{POINTERS}/.{name}")
    out = fs.create(tmp, True)
    out.write(bytearray(name.encode()))
    out.close()
    while True:
        at, _ = _fs(spark, f"{root}/{POINTERS}/{number:012d}")
        if not fs.exists(at) and fs.rename(tmp, at):
            return True
        if over is not None:
            fs.delete(tmp, False)
            return False
        number += 1  # another publish was first; the last one to commit is in force


def current(spark: SparkSession, root: str) -> str:
    """The folder of the version in force; ``root`` itself where nothing is versioned."""
    held = _pointers(spark, root)
    return f"{root}/{_target(spark, held[-1])}" if held else root


def expire(spark: SparkSession, root: str, keep_seconds: float, as_of_millis: int | None = None) -> int:
    """Remove versions that were replaced longer than ``keep_seconds`` ago (a reader may
    still be at a younger one), and folders of that age that no pointer names: what
    a writer that died has left.  The version in force stays.  Returns how many went."""
    now = as_of_millis if as_of_millis is not None else int(spark.sparkContext._jvm.java.lang.System.currentTimeMillis())
    limit = now - int(keep_seconds * 1000)
    held = _pointers(spark, root)
    named = {_target(spark, p): p for p in held}
    replaced = {_target(spark, p): n.getModificationTime() for p, n in zip(held, held[1:])}
    gone = 0
    at, fs = _fs(spark, root)
    for s in fs.listStatus(at) if fs.exists(at) else []:
        name = s.getPath().getName()
        if not name.startswith("v-") or (held and name == _target(spark, held[-1])):
            continue
        if replaced.get(name, s.getModificationTime()) <= limit:
            if name in named:
                fs.delete(named[name].getPath(), False)
            fs.delete(s.getPath(), True)
            gone += 1
    return gone
