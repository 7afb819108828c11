"""Best-fit packing of token sequences by hierarchical residual packing.

Each group of pieces is packed best-fit on its own.  Bins that are nearly full
are done; the others go up as items, each as long as what it holds, to the
group that several groups share, where best-fit runs again, and so on up a
tree until one group is left.

Best-fit leaves at most one bin of a group half full or less, and two bins that are
fuller never go together.  So a round has at most ``fan`` items that can go into
another bin, and all rounds above a group ask it for at most ``fan`` bins each.  Of
bins that are equally full a group therefore passes up only so many as all rounds
above could fill; the others are done, and no round would have changed them.  A task
gets at most ``fan * capacity / 2 * fan * rounds`` bins, however large the corpus is.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import F, keep, materialize_counted, only, small_batches, sql_type
from .encoder import encoder

CAPACITY = 4096
EOS = 1


def pieces_of(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, eos: int = EOS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids, with the
    end id behind them, cut at each ``capacity`` ids.  A null text is empty."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in small_batches(batches):
            row, piece, length, crc = [], [], [], []
            for i, ids in enumerate(e.lists(b.column(1).to_pylist())):
                ids = np.append(ids, np.uint32(eos)).astype("<u4")
                for k in range(0, len(ids), capacity):
                    part = ids[k : k + capacity]
                    row.append(i)
                    piece.append(k // capacity)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            n = np.array(piece, dtype=np.int64)
            cols = [b.column(0).take(pa.array(row, pa.int64())), pa.array(n.astype(np.int32)), pa.array(n * capacity), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    src = only(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    return src.mapInArrow(cut, f"doc_id {sql_type(src, 'doc_id')}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Best-fit of ``lengths`` in the given order: bin and offset of each, and each
    bin's level.  An item goes to the fullest bin that it fits into."""
    bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    mask = 0  # bit r: a bin with r left
    level: list[int] = []
    where, offset = [], []
    for n in lengths:
        m = mask >> n
        if m:
            r = n + ((m & -m).bit_length() - 1)
            b = bins[r].pop()
            if not bins[r]:
                mask &= ~(1 << r)
        else:
            b, r = len(level), capacity
            level.append(0)
        where.append(b)
        offset.append(level[b])
        level[b] += n
        if r > n:
            bins[r - n].append(b)
            mask |= 1 << (r - n)
    return where, offset, level


def hosts_kept(fan: int, rounds: int) -> int:
    """How many equally full bins of a group the ``rounds`` above it can fill at most."""
    return fan * rounds


def _round(depth: int, hosts: int, capacity: int, near_full: float):
    """One group's best-fit; bins that are not done go up as items, ``hosts`` of each
    level (0: the last round)."""

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "item"], ascending=[False, True], kind="stable")
        where, offset, levels = best_fit(pdf["length"].tolist(), capacity)
        lv = np.array(levels)
        order = np.argsort(lv, kind="stable")
        ranks = np.empty(len(lv), dtype=np.int64)
        ranks[order] = np.arange(len(lv)) - np.searchsorted(lv[order], lv[order])
        done = (lv >= near_full * capacity) | (ranks >= hosts)
        where = np.array(where)
        grp = int(pdf["grp"].iloc[0])
        number = ((depth + 1) << 57) + (grp << 26) + where
        return pd.DataFrame({"item": pdf["item"].to_numpy(), "grp": grp, "bin": number, "offset": offset, "level": lv[where], "done": done[where]})

    return fit


def pack(pieces: DataFrame, key: str = "key", length: str = "length", capacity: int = CAPACITY, near_full: float = 0.995, group_size: int = 40_000, fan: int = 8) -> DataFrame:
    """(key, sequence_id, offset) of every piece: gapless places in sequences of
    at most ``capacity``.

    ``key`` must tell pieces apart (any 64-bit whole number from 0); lengths
    are from 1 to ``capacity``; ``near_full`` is over 0.5.  Ties are broken by key, so
    equal input packs equally.
    """
    items, n = materialize_counted(only(pieces, item=key, length=length).select(F.col("item").cast("long"), F.col("length").cast("int")), "pack-items")
    full = items.filter(F.col("length") >= capacity).select(F.col("item").alias("key"), (-F.col("item") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    groups = max(1, math.ceil(n / group_size))
    level = items.filter(F.col("length") < capacity).withColumn("grp", F.pmod(F.xxhash64("item"), F.lit(groups)))
    placed = None
    schema = "item bigint, grp bigint, bin bigint, offset bigint, level int, done boolean"
    depth = 0
    while True:
        last = groups == 1
        rounds, left = 0, groups
        while left > 1:
            rounds, left = rounds + 1, math.ceil(left / fan)
        step = keep(level.groupBy("grp").applyInPandas(_round(depth, hosts_kept(fan, rounds), capacity, near_full), schema), "pack-round")
        if placed is None:
            placed = step.select(F.col("item").alias("key"), "bin", "offset", "done")
        else:
            up = step.select(F.col("item").alias("bin"), F.col("bin").alias("_bin"), F.col("offset").alias("_offset"), F.col("done").alias("_done"))
            placed = placed.join(up, "bin", "left").select(
                "key", F.coalesce("_bin", "bin").alias("bin"), (F.col("offset") + F.coalesce("_offset", F.lit(0))).alias("offset"), F.coalesce("_done", "done").alias("done")
            )
        if last:
            break
        groups = math.ceil(groups / fan)
        depth += 1
        level = step.filter(~F.col("done")).groupBy("bin").agg(F.first("level").alias("length"), F.first("grp").alias("grp")).select(F.col("bin").alias("item"), "length", F.floor(F.col("grp") / fan).alias("grp"))
    return full.unionByName(placed.select("key", F.col("bin").alias("sequence_id"), "offset"))


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, eos: int = EOS, **options) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): all documents
    packed into as few sequences of at most ``capacity`` ids as best-fit finds.

    Only documents longer than ``capacity`` are cut.  Null text: empty, so a
    piece of the end id alone.  Null and repeated ids keep their own rows; an
    empty table packs into nothing; other columns are not read.
    """
    cut = keep(pieces_of(docs, path, id_col, text_col, capacity, eos).withColumn("key", F.monotonically_increasing_id()), "pack-pieces")
    places = pack(cut, "key", "length", capacity, **options)
    return cut.join(places, "key").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
