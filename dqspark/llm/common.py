"""Helpers of the corpus operators: reading a table, keeping an intermediate one, dropping rows by id."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, materialize_counted, scratch_path

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and
    not lost with an executor."""
    return materialize(df, name)


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under the operator's own names; other columns, whatever
    they are called, go no further."""
    return df.select(*[df[f"`{c}`"].alias(name) for name, c in columns.items()])


def small_batches(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows, ``rows`` at a time, so a task holds few texts as Python objects at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", broadcast_rows: int = 2_000_000) -> DataFrame:
    """The rows of ``docs`` whose id is not among ``ids`` (one column); rows
    with a null id stay.  Up to ``broadcast_rows`` different ids (about 20 MB)
    are broadcast; more are joined by shuffle."""
    gone = unused(docs, "gone")
    ids = ids.toDF(gone).filter(F.col(gone).isNotNull()).distinct()
    ids, n = materialize_counted(ids, "dropped-ids")
    return docs.join(F.broadcast(ids) if n <= broadcast_rows else ids, docs[f"`{id_col}`"] == F.col(gone), "left_anti")


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with underscores in front of it, such that ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def sql_type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


__all__ = ["F", "table", "keep", "materialize_counted", "scratch_path", "only", "small_batches", "sql_type", "unused", "without_ids"]
