"""Output presentation for comparisons: doubles rounded, times as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, digits)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, TS_TEXT)
        cols.append(c.alias(f.name))
    return df.select(*cols)
