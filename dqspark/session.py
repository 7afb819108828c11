"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so windows and dates agree with the data,
# AQE for runtime partition coalescing / skew splitting / join re-planning.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "dqspark") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(REQUIRED_CONF)
    conf.update(
        {
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.ui.enabled": "false",
            # call-site capture on every DataFrame/Column call is for
            # interactive debugging; it costs several JVM round trips each
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        }
    )
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_conf(spark: SparkSession) -> None:
    """Apply the session-level settings the operators assume (idempotent)."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session's ``spark.checkpoint.dir`` (set by the cluster).
    Only when it is unset and the master is local (tests) is a fresh local
    folder created and registered; on a cluster, executors would write to
    their own disks, so there it is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, and no dir configured
        sc = None
    if sc is not None:
        d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
        if d:
            return d.rstrip("/")
    master = getattr(sc, "master", None) or spark.conf.get("spark.master", "")
    if sc is None or not re.match(r"local(\[|$)", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    d = tempfile.mkdtemp(prefix="dqspark-ckpt-")
    sc.setCheckpointDir(d)
    return (sc.getCheckpointDir() or d).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared work folder; ``drop_scratch`` removes it."""
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


@contextmanager
def scratch_scope(spark: SparkSession):
    """Removes the intermediate tables that were made inside, at its end: for
    jobs, whose results are written by then."""
    before = len(_SCRATCH)
    try:
        yield
    finally:
        drop_scratch(spark, _SCRATCH[before:])


def drop_scratch(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete intermediate tables of this process (all, or ``paths``)."""
    jvm = spark.sparkContext._jvm
    for p in list(_SCRATCH if paths is None else paths):
        at = jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        _SCRATCH.remove(p)


def materialize(df, name: str):
    """Write ``df`` as a Parquet table in the shared work folder and return it
    read back: one job computes it, later jobs reuse it, and its lineage is
    cut, so a lost executor does not recompute the upstream plan."""
    return materialize_counted(df, name)[0]


def materialize_counted(df, name: str):
    """``materialize`` that also returns the row count, observed while the
    table is written (no second job)."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    path = scratch_path(df.sparkSession, name)
    obs = Observation(f"{name}-rows")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    # read back with the known schema: no footer read for schema inference
    return df.sparkSession.read.schema(df.schema).parquet(path), int(obs.get["rows"])


__all__ = ["local_session", "ensure_conf", "work_dir", "scratch_path", "materialize", "materialize_counted", "scratch_scope", "drop_scratch"]
