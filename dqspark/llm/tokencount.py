"""Token counts by a map-side two-tier lookup.

First tier: a compact hash table of frequent pieces and their token counts,
broadcast to every worker: sorted 64-bit hashes, the pieces' bytes beside them to
tell a hit from a collision, and the counts.  Second tier: each worker's own
cache, filled by the tokenizers library when a piece is met for the first
time.  No piece is ever shuffled, and every text is tokenized in one pass.

The table is chosen from about ``SAMPLE_ROWS`` rows drawn at random.  It only
saves work: counts are exact and don't depend on it.
"""

from __future__ import annotations

import heapq
import uuid
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import F, only, small_batches, sql_type
from .encoder import BatchEncoder

TABLE_SIZE = 32_768
SAMPLE_ROWS = 4_096
PER_ROW = 256  # pieces passed on for each row drawn
HELD = 500_000  # pieces that a task tallies at a time
WIDTH = 32  # bytes of a piece in the table


def sampled_pieces(docs: DataFrame, path: str, text_col: str = "text", rows: int = SAMPLE_ROWS, per_row: int = PER_ROW) -> DataFrame:
    """(piece binary, n long): pieces of about ``rows`` rows drawn at random.  A task
    passes on its most frequent ones, ``per_row`` for each row it has drawn, so
    the result has about ``rows * per_row`` rows at most, however large ``docs`` is."""
    src = only(docs, text=text_col)
    fraction = min(1.0, rows / max(1, src.count()))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = BatchEncoder(path)
        seen: Counter = Counter()
        drawn = 0
        for b in small_batches(batches):
            drawn += b.num_rows
            for keys, n in e.tally(b.column(0).to_pylist()):
                for k, c in zip(keys, n.tolist()):
                    if len(k) <= WIDTH:
                        seen[k] += c
                if len(seen) > HELD:
                    seen = Counter(dict(seen.most_common(HELD // 2)))
        top = heapq.nlargest(drawn * per_row, ((n, k) for k, n in seen.items()))
        yield pa.RecordBatch.from_arrays([pa.array([k for _, k in top], pa.binary()), pa.array([n for n, _ in top], pa.int64())], names=["piece", "n"])

    return src.withColumn("text", F.col("text").cast("string")).sample(fraction, seed=9).mapInArrow(tally, "piece binary, n bigint")


class PieceTable(NamedTuple):
    """Pieces in the order of their hashes, as arrays: 44 bytes each."""

    hashes: np.ndarray  # uint64
    words: np.ndarray  # the bytes, filled up with zeros, as WIDTH / 8 words of 64 bits
    sizes: np.ndarray  # of the pieces in bytes, uint8
    tokens: np.ndarray  # uint16

    def find(self, a: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Tokens of each piece ``a[start:end]``, -1 where the table hasn't got it."""
        out = np.full(len(start), -1, dtype=np.int64)
        short = np.flatnonzero(end - start <= WIDTH)
        if len(self.hashes) and len(short):
            words, sizes = _words(a, start[short], end[short])
            h = _hashes(words, sizes)
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = (self.hashes[at] == h) & (self.sizes[at] == sizes) & (self.words[at] == words).all(axis=1)
            out[short[hit]] = self.tokens[at[hit]]
        return out


def _words(a: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    places = np.arange(WIDTH, dtype=np.int64)
    sizes = end - start
    held = a[np.minimum(start[:, None] + places, len(a) - 1)]
    held[places >= sizes[:, None]] = 0
    return np.ascontiguousarray(held).view(np.uint64), sizes.astype(np.uint8)


def _hashes(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    h = sizes.astype(np.uint64) + np.uint64(1)
    for j in range(words.shape[1]):
        h = (h ^ words[:, j]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def piece_table(pieces: list[bytes], tokens: list[int]) -> PieceTable:
    """``pieces`` are different, of ``WIDTH`` bytes at most."""
    buf = np.frombuffer(b"".join(pieces) or b"\0", dtype=np.uint8)
    end = np.cumsum(np.array([len(p) for p in pieces], dtype=np.int64))
    words, sizes = _words(buf, np.concatenate(([0], end))[:-1], end)
    h = _hashes(words, sizes)
    order = np.argsort(h, kind="stable")
    return PieceTable(h[order], words[order], sizes[order], np.array(tokens, dtype=np.uint16)[order])


class TableCounter(BatchEncoder):
    """Counts that ask the table first, then this worker's cache, then the library."""

    def __init__(self, path: str, table: PieceTable):
        super().__init__(path)
        self.table = table

    def _counts_of(self, texts: list[bytes]) -> np.ndarray:
        buf = b"\n".join(texts) + b"\n"
        a = np.frombuffer(buf, dtype=np.uint8)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        start, end, odd = self._cuts(a, begins)
        if not len(start):
            return np.zeros(len(texts), np.int64)
        border = np.searchsorted(start, np.append(begins, len(a)))
        first, place = self._unique(a, start, end)
        n = self.table.find(a, start[first], end[first])
        missed = np.flatnonzero(n < 0)
        if len(missed):
            at = first[missed]
            got = self._each([buf[s:e] for s, e in zip(start[at].tolist(), end[at].tolist())], odd[at])
            n[missed] = np.fromiter(map(len, got), dtype=np.int64, count=len(got)) // 4
        return np.diff(np.concatenate(([0], np.cumsum(n[place])))[border])


_HELD: dict[str, TableCounter] = {}


def _counter(path: str, table, name: str) -> TableCounter:
    """This worker process's counter for the table ``name``, kept between tasks."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = TableCounter(path, table.value)
    return _HELD[name]


def frequent_table(docs: DataFrame, path: str, text_col: str = "text", size: int = TABLE_SIZE, rows: int = SAMPLE_ROWS) -> PieceTable:
    """The ``size`` most frequent pieces of a sample, with their token counts."""
    found = sampled_pieces(docs, path, text_col, rows).toArrow().group_by("piece").aggregate([("n", "sum")])
    top = found.sort_by([("n_sum", "descending"), ("piece", "ascending")]).slice(0, size)
    pieces = top.column("piece").to_pylist()
    tokens = [len(g) // 4 for g in BatchEncoder(path).encode_pieces(pieces)]
    return piece_table(pieces, tokens)


def count_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512, table_size: int = TABLE_SIZE, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    ``path``: a tokenizers file.  Counts are the library's without added
    special tokens.  A null text counts as empty: 0 bytes, 0 tokens.  Null and
    repeated ids keep their rows; other columns are not read; an empty table
    gives no rows; very long texts are counted a few MB at a time.  What is
    broadcast has at most ``table_size`` pieces of 44 bytes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent_table(docs, path, text_col, table_size, sample_rows))
    name = uuid.uuid4().hex

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _counter(path, shared, name)
        for b in small_batches(batches, 2048):
            text = b.column(1)
            n = e.counts(text.to_pylist())
            size = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(n, pa.int64()), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    src = only(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    return src.mapInArrow(count, f"doc_id {sql_type(src, 'doc_id')}, n_bytes bigint, n_tokens bigint, over_limit boolean")
