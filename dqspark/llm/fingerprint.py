"""Document fingerprints by content-defined chunking.

A gear hash of the last 32 bytes is rolled over the UTF-8 text (all positions
at once: the sum doubles its reach in five steps).  A chunk ends where the
hash's top bits are zero: eight bits between ``LEAST`` and ``NORMAL`` bytes,
four beyond, and at ``MOST`` at the latest, which keeps lengths near normal.
Borders depend on nearby text only, so an insertion changes few chunks.  The
fingerprint is the set of chunk digests, each with its length; containment of
one document in another is the shared chunks' length over its own chunks'.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W

from .common import F, keep, only, sql_type

LEAST, NORMAL, MOST = 16, 64, 255
STRICT_BITS, LOOSE_BITS = 8, 4
PAD = b"\xff" * 32  # 0xFF is in no UTF-8 text; its gear value is 0, so texts don't reach into each other
SLICE_BYTES = 2_000_000


def _gear() -> np.ndarray:
    g = np.random.default_rng(97).integers(0, 1 << 32, 256, dtype=np.uint32)
    g[0xFF] = 0
    return g


GEAR = _gear()


def _candidates(buf: bytes) -> tuple[list[int], list[int]]:
    """Ends (place behind the byte) where the hash's top eight, and top four bits are zero."""
    h = GEAR[np.frombuffer(buf, dtype=np.uint8)]
    for reach in (1, 2, 4, 8, 16):
        h[reach:] += h[:-reach] << np.uint32(reach)
    loose = np.flatnonzero(h < np.uint32(1 << (32 - LOOSE_BITS)))
    strict = loose[h[loose] < (1 << (32 - STRICT_BITS))]
    return (strict + 1).tolist(), (loose + 1).tolist()


def _chunks(buf: bytes, begin: int, end: int, strict: list[int], loose: list[int]) -> dict[int, int]:
    """Digest -> length of the chunks of buf[begin:end]."""
    out: dict[int, int] = {}
    digest = xxhash.xxh3_64_intdigest
    at, ns, nl = begin, len(strict), len(loose)
    while at < end:
        cut = min(at + MOST, end)
        i = bisect_left(strict, at + LEAST)
        if i < ns and strict[i] < at + NORMAL:
            cut = min(strict[i], cut)
        else:
            i = bisect_left(loose, at + NORMAL)
            if i < nl and loose[i] < cut:
                cut = loose[i]
        out[digest(buf[at:cut]) & 0xFFFFFFFFFFFF] = cut - at
        at = cut
    return out


def chunk_sets(texts: list[bytes]) -> list[dict[int, int]]:
    """The chunk set of each text; a few MB are hashed at a time."""
    out: list[dict[int, int]] = []
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= SLICE_BYTES):
            size += len(texts[j])
            j += 1
        buf = PAD.join(texts[i:j])
        strict, loose = _candidates(buf) if buf else ([], [])
        at = 0
        for t in texts[i:j]:
            out.append(_chunks(buf, at, at + len(t), strict, loose))
            at += len(t) + len(PAD)
        i = j
    return out


def as_bytes(chunks: dict[int, int]) -> bytes:
    """A chunk set as bytes: six of the digest and one of the length, in digest order; empty for no chunk."""
    a = np.fromiter(chunks.keys(), dtype=np.uint64, count=len(chunks)) << np.uint64(8)
    a |= np.fromiter(chunks.values(), dtype=np.uint64, count=len(chunks))
    a.sort()
    return a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def containment(own: dict[int, int], other: dict[int, int]) -> float:
    """Share of ``own``'s length that ``other`` holds too; 1 for two empty sets, 0 if only ``own`` is empty."""
    if not own:
        return 0.0 if other else 1.0
    return sum(n for d, n in own.items() if d in other) / sum(own.values())


def _compare(rows: list[tuple]) -> pa.RecordBatch:
    """Result rows of (id, text, next text)."""
    names, out = [], []
    edited = []
    for d, t, nxt in rows:
        half = len(t) // 2
        edited.append((t[: len(t) - half] + nxt[:half]).encode())
        names.append(d)
    plain = [t.encode() for _, t, _ in rows]
    sets = chunk_sets(plain + edited + [nxt.encode() for _, _, nxt in rows[-1:]])
    n = len(rows)
    for i, (d, t, nxt) in enumerate(rows):
        own, ed = sets[i], sets[n + i]
        following = sets[i + 1] if i + 1 < n else sets[2 * n]
        out.append((len(t), hashlib.sha256(edited[i]).hexdigest(), as_bytes(own), as_bytes(ed), containment(own, ed), containment(own, following)))
    cols = list(zip(*out))
    return pa.RecordBatch.from_arrays(
        [pa.array(names), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), *[pa.array(c, pa.binary()) for c in cols[2:4]], *[pa.array(c, pa.float64()) for c in cols[4:]]],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def _runs(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Consecutive rows, a few MB at a time."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[1])
        if size >= SLICE_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def fingerprint_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_rows: int = 4096) -> DataFrame:
    """Per document (doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next): its fingerprint (base64), that of its
    edited text (the last half of its code points replaced by as many of the
    next document's first), and the containment of its own in that and in the
    next document's.

    Next: in descending id order; after the last comes the first.  Equal ids
    are ordered by text; null ids come last.  A null text is empty; an empty
    text has an empty fingerprint.  The only row of a table is its own next.
    Ids must be whole numbers or strings; other columns are not read.
    """
    src = only(docs, doc_id=id_col, text=text_col).select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = sql_type(src, "doc_id")
    parts = max(1, -(-src.select("doc_id").count() // part_rows))
    result = f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
    fields = [x.split(" ")[0] for x in result.split(", ")]
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "string": pa.string()}[kind]

    def shaped(b: pa.RecordBatch, edge: list) -> pa.RecordBatch:
        n = b.num_rows
        cols = [b.column(0).cast(id_type), *b.columns[1:]]
        return pa.RecordBatch.from_arrays([*cols, *[pa.nulls(n, t) for t in (pa.int32(), pa.bool_(), pa.string())]], names=[*fields, *edge])

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows whose next is in the same part; the part's first and last text for the others."""
        part = TaskContext.get().partitionId()
        edge = ["part", "last", "text"]
        held: tuple | None = None
        first: tuple | None = None

        def pairs():
            nonlocal held, first
            for b in batches:
                for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if held is None:
                        first = row
                    else:
                        yield (*held, row[1])
                    held = row

        for run in _runs(pairs()):
            yield shaped(_compare(run), edge)
        if first is not None:
            ends = [first, held]
            cols = [pa.array([d for d, _ in ends], id_type), *[pa.nulls(2, t) for t in (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([part, part], pa.int32()), pa.array([False, True]), pa.array([t for _, t in ends], pa.string())], names=[*fields, *edge])

    dealt = src.repartitionByRange(parts, F.desc_nulls_last("doc_id")).sortWithinPartitions(F.desc_nulls_last("doc_id"), "text")
    found = keep(dealt.mapInArrow(inside, result + ", part int, last boolean, text string"), "chunk-sets")

    # the last row of each part goes with the first of the next part that has rows
    order = W.orderBy("part")
    heads = found.filter(~F.col("last")).select("part", "text")
    after = heads.select("part").select("part", F.coalesce(F.lead("part").over(order), F.min("part").over(W.partitionBy(F.lit(1)))).alias("next_part"))
    ends = found.filter("last").select("part", "doc_id", "text").join(after, "part").join(heads.select(F.col("part").alias("next_part"), F.col("text").alias("next_text")), "next_part")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                one = _compare([row])
                yield pa.RecordBatch.from_arrays([one.column(0).cast(id_type), *one.columns[1:]], names=fields)

    all_rows = found.filter("last IS NULL").select(*fields).unionByName(ends.select("doc_id", "text", "next_text").mapInArrow(across, result))
    return all_rows.withColumns({c: F.base64(c) for c in ("fingerprint", "edited_fingerprint")})
