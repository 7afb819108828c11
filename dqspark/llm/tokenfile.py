"""Token ids in binary files of patched frame-of-reference blocks.

A file is a run of pages; a page holds whole documents' ids in ascending id
order, in blocks of 128 ids.  Each block keeps its minimum; the differences
from it are packed at the width that ``percentile`` of them fit into, and the
high bits of the others stand in an exception list.  The page's index gives
every block's first bit, first exception, minimum and width, so one block can
be read without the others.

Page layout (little endian; a line end follows each page, as Spark's text
writer needs one, and Spark's own commit then guards the files):
    magic 8s, shard u4, page u4, n_docs u4, n_ids u8, n_blocks u4, n_exceptions u4, packed_bytes u4, id_bytes u4
    doc ids (JSON list, id_bytes), ids per document u4 * n_docs
    block minimum u4, block width u1, first exception u4 (each * n_blocks)
    exception place in block u1, exception high bits u4 (each * n_exceptions)
    packed bits (each block takes 16 * width bytes)
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W

from .common import F, keep, only, scratch_path, small_batches, sql_type
from .encoder import encoder

BLOCK = 128
HEAD = struct.Struct("<8sIIIQIIII")
MAGIC = b"PFOR\x01ids"
EOS = 1


def pack_blocks(ids: np.ndarray, percentile: float = 0.9) -> tuple[np.ndarray, ...]:
    """Patched frame-of-reference blocks of ``ids`` (unsigned 32-bit): block minimum,
    width and first exception, exceptions' places and high bits, packed bits.
    The last block is filled up with its minimum."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    v = np.zeros(blocks * BLOCK, dtype=np.uint32)
    v[:n] = ids
    if n < len(v):
        v[n:] = ids[(blocks - 1) * BLOCK :].min()
    v = v.reshape(blocks, BLOCK)
    low = v.min(axis=1)
    v = v - low[:, None]
    cut = np.partition(v, int(percentile * (BLOCK - 1)), axis=1)[:, int(percentile * (BLOCK - 1))]
    width = np.where(cut > 0, np.floor(np.log2(np.maximum(cut, 1))).astype(np.int64) + 1, 0).astype(np.uint8)
    high = (v.astype(np.uint64) >> width[:, None].astype(np.uint64)).astype(np.uint32)
    blk, place = np.nonzero(high)
    first = np.searchsorted(blk, np.arange(blocks)).astype(np.uint32)
    out = [b""] * blocks
    for w in np.unique(width):
        if w == 0:
            continue
        at = np.flatnonzero(width == w)
        part = (v[at] & np.uint32((1 << int(w)) - 1)).astype("<u4")
        bits = np.unpackbits(part.view(np.uint8).reshape(len(at), BLOCK, 4), axis=2, count=int(w), bitorder="little")
        rows = np.packbits(bits.reshape(len(at), -1), axis=1, bitorder="little")
        for i, r in zip(at.tolist(), rows):
            out[i] = r.tobytes()
    return low, width, first, place.astype(np.uint8), high[blk, place], b"".join(out)


def unpack_blocks(n: int, low: np.ndarray, width: np.ndarray, first: np.ndarray, place: np.ndarray, high: np.ndarray, packed: bytes) -> np.ndarray:
    """The inverse of ``pack_blocks``."""
    blocks = len(low)
    v = np.zeros((blocks, BLOCK), dtype=np.uint32)
    size = width.astype(np.int64) * (BLOCK // 8)
    start = np.cumsum(size) - size
    raw = np.frombuffer(packed, dtype=np.uint8)
    for w in np.unique(width):
        if w == 0:
            continue
        at = np.flatnonzero(width == w)
        rows = raw[start[at][:, None] + np.arange(int(w) * BLOCK // 8)]
        bits = np.unpackbits(rows, axis=1, bitorder="little").reshape(len(at), BLOCK, int(w))
        full = np.zeros((len(at), BLOCK, 4), dtype=np.uint8)
        got = np.packbits(bits, axis=2, bitorder="little")
        full[:, :, : got.shape[2]] = got
        v[at] = full.reshape(len(at), -1).view("<u4")
    blk = np.repeat(np.arange(blocks), np.diff(np.append(first.astype(np.int64), len(place))))
    v[blk, place] |= high << width[blk].astype(np.uint32)
    return (v + low[:, None]).reshape(-1)[:n]


def write_page(shard: int, page: int, doc_ids: list, sizes: np.ndarray, ids: np.ndarray, percentile: float = 0.9) -> bytes:
    names = json.dumps(doc_ids).encode()
    low, width, first, place, high, packed = pack_blocks(ids, percentile)
    head = HEAD.pack(MAGIC, shard, page, len(sizes), len(ids), len(low), len(place), len(packed), len(names))
    parts = (names, sizes.astype("<u4"), low.astype("<u4"), width, first.astype("<u4"), place, high.astype("<u4"))
    return b"".join([head, *(p if isinstance(p, bytes) else p.tobytes() for p in parts), packed])


def read_pages(data: bytes) -> Iterator[tuple[int, int, list, np.ndarray, np.ndarray]]:
    """(shard, page, doc ids, ids per document, ids) of every page of a file."""
    at = 0
    while at < len(data):
        magic, shard, page, n_docs, n_ids, blocks, exc, packed, names = HEAD.unpack_from(data, at)
        if magic != MAGIC:
            raise ValueError("not a page of token ids")
        at += HEAD.size
        doc_ids = json.loads(data[at : at + names])
        at += names

        def take(kind: str, n: int, at=at) -> tuple[np.ndarray, int]:
            a = np.frombuffer(data, dtype=kind, count=n, offset=at)
            return a, at + a.nbytes

        sizes, at = take("<u4", n_docs)
        low, at = take("<u4", blocks, at)
        width, at = take("u1", blocks, at)
        first, at = take("<u4", blocks, at)
        place, at = take("u1", exc, at)
        high, at = take("<u4", exc, at)
        yield shard, page, doc_ids, sizes, unpack_blocks(n_ids, low, width, first, place, high, data[at : at + packed])
        at += packed + 1


def write_ids(
    docs: DataFrame, path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", eos: int = EOS, shard_rows: int = 4096, page_ids: int = 1 << 20, percentile: float = 0.9
) -> None:
    """Encode every text (null: empty), add the end id, and write the ids to
    ``folder`` in ascending id order: shard after shard, page after page.

    Rows are dealt to shards by ranges of the id; equal ids keep together,
    ordered by text; null ids come first.  ``doc_id`` must be a whole number
    or a string.  An empty table gives no pages.
    """
    src = only(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    shards = max(1, -(-src.select("doc_id").count() // shard_rows))

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        shard = TaskContext.get().partitionId()
        names: list = []
        parts: list[np.ndarray] = []
        size = page = 0
        for b in small_batches(batches):
            for d, ids in zip(b.column(0).to_pylist(), e.lists(b.column(1).to_pylist())):
                names.append(d)
                parts.append(np.append(ids, np.uint32(eos)))
                size += len(parts[-1])
                if size >= page_ids:
                    yield _page(shard, page, names, parts, percentile)
                    names, parts, size, page = [], [], 0, page + 1
        if names:
            yield _page(shard, page, names, parts, percentile)

    dealt = src.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(pages, "value binary").select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\n").text(folder)


def _page(shard: int, page: int, names: list, parts: list[np.ndarray], percentile: float) -> pa.RecordBatch:
    sizes = np.fromiter(map(len, parts), dtype=np.uint32, count=len(parts))
    return pa.RecordBatch.from_arrays([pa.array([write_page(shard, page, names, sizes, np.concatenate(parts), percentile)], pa.binary())], names=["value"])


def read_ids(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of
    ``folder``; ``start`` counts the ids of all documents before it."""
    kind = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "string": pa.string()}[id_type]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0):
                shard, names, n, crc = [], [], [], []
                for s, _, doc_ids, sizes, ids in read_pages(data.as_py()):
                    ids = ids.astype("<u4")
                    ends = np.cumsum(sizes, dtype=np.int64)
                    names += doc_ids
                    n += sizes.tolist()
                    shard += [s] * len(doc_ids)
                    crc += [zlib.crc32(ids[i:j].tobytes()) for i, j in zip((ends - sizes).tolist(), ends.tolist())]
                size = np.array(n, dtype=np.int64)
                before = np.cumsum(size) - size
                cols = [pa.array(shard, pa.int32()), pa.array(names, kind), pa.array(before), pa.array(size), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["shard", "doc_id", "before", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder).select("content")
    rows = keep(files.mapInArrow(read, f"shard int, doc_id {id_type}, before bigint, n_tokens bigint, ids_crc32 bigint"), "token-rows")
    # one row per shard: its ids, and those of all shards before it
    total = rows.groupBy("shard").agg(F.sum("n_tokens").alias("ids"))
    total = total.select("shard", (F.sum("ids").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, 0)) - F.col("ids")).alias("base"))
    return rows.join(total, "shard").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def write_and_read(docs: DataFrame, path: str, **options) -> DataFrame:
    """Write ``docs`` to fresh files in the shared folder and read them back."""
    folder = scratch_path(docs.sparkSession, "token-ids")
    write_ids(docs, path, folder, **options)
    return read_ids(docs.sparkSession, folder, sql_type(docs, options.get("id_col", "doc_id")))
