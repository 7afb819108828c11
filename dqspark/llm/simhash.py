"""SimHash near-duplicates by an inverted index over fingerprint bytes.

Two 64-bit fingerprints that differ in at most 3 bits agree in at least 5 of
their 8 bytes.  The index lists fingerprints under the bytes they have at four
given places; the 14 sets of four places that ``cover`` finds are chosen so that any
5 of the 8 places hold one of them, so every pair that reaches the guaranteed
count meets in some list.  In a list the pair's equal positional bytes are
tallied; pairs that reach the count are verified by their bit distance.  A
list gives only a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import F, keep, materialize_counted, only, small_batches, sql_type, unused

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
RUN_BYTES = 4_000_000
MAX_BITS = 3
HOT_LIST = 4096


def cover(bits: int) -> list[tuple[int, ...]]:
    """Sets of byte places such that any 8 - ``bits`` of the 8 places hold one of
    them: greedy over sets of one place fewer."""
    count = 8 - bits
    left = set(combinations(range(8), count))
    out: list[tuple[int, ...]] = []
    while left:
        best = max(combinations(range(8), max(1, count - 1)), key=lambda s: sum(set(s) <= set(x) for x in left))
        out.append(best)
        left = {x for x in left if not set(best) <= set(x)}
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp long) of every row: bit i is 1 if set in over half of the
    shingles' XXH64 (seed 42).  Words are runs of other than ASCII white space,
    with A-Z lower-cased; repeats count; fewer words than ``shingle`` are one
    shingle; no words (or a null text) give 0."""
    return _marked(docs, id_col, text_col, shingle).select("doc_id", "fp")


def _marked(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, mark, fp): ``mark``, a hash of the text, tells rows of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            fp = fingerprints_of(b.column(2).to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(fp.view(np.int64))], names=["doc_id", "mark", "fp"])

    src = only(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    return src.select("doc_id", _mark("text"), "text").mapInArrow(run, f"doc_id {sql_type(src, 'doc_id')}, mark bigint, fp bigint")


def _mark(text: str):
    return F.xxhash64(F.col(text).cast("string")).alias("mark")


def _word_runs(text: bytes, k: int) -> Iterator[list[bytes]]:
    """The words, a few MB of text at a time, such that each ``k`` successive words
    are in one run together; fewer words in all are one run."""
    held: list[bytes] = []
    at, first = 0, True
    while at < len(text):
        cut = _SPACE.search(text, at + RUN_BYTES) if len(text) - at > RUN_BYTES else None
        end = cut.start() if cut else len(text)
        held += text[at:end].split()
        at = end
        if len(held) >= k or (first and at == len(text) and held):
            yield held
            held, first = held[len(held) - k + 1 :] if k > 1 else [], False


def fingerprints_of(texts: list[str | None], shingle: int = 3) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), dtype=np.uint64)
    for i, t in enumerate(texts):
        ones, total = np.zeros(64, dtype=np.int64), 0
        for words in _word_runs(t.encode().lower() if t else b"", shingle):
            k = min(shingle, len(words))
            text = b" ".join(words)
            end = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
            start = np.concatenate(([0], end[:-1] + 1))
            h = np.array([digest(text[s:e], 42) for s, e in zip(start[: len(words) - k + 1].tolist(), end[k - 1 :].tolist())], dtype="<u8")
            total += len(h)
            for at in range(0, len(h), 1 << 16):
                ones += np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        if total:
            out[i] = np.packbits(2 * ones > total, bitorder="little").view("<u8")[0]
    return out


def _forest(fp: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the fingerprints, each within ``bits`` of its parent."""
    need = 8 - bits
    by = fp.view(np.uint8).reshape(-1, 8)
    left = np.arange(len(fp))
    out: list[tuple[int, int]] = []
    while len(left):
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            x = front.pop()
            shared = (by[left] == by[x]).sum(axis=1)  # the tally of positional bytes
            near = shared >= need
            near[near] = np.bitwise_count(fp[left[near]] ^ fp[x]) <= bits
            found = left[near]
            out += [(x, int(y)) for y in found]
            front += found.tolist()
            left = left[~near]
    return out


def _runs(key: np.ndarray, fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal keys (rows come sorted by key)."""
    need = 8 - bits
    edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    size = np.diff(edge)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    short = np.repeat(size <= 16, size)
    left = np.repeat(edge[1:], size) - np.arange(len(key))  # rows of the run from here on
    for d in range(1, 16):
        i = np.flatnonzero(short & (left > d))
        if not len(i):
            break
        x = fp[i] ^ fp[i + d]
        i = i[(x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1) >= need]
        i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= bits]
        a.append(i)
        b.append(i + d)
    for r in np.flatnonzero(size > 16):
        links = _forest(fp[edge[r] : edge[r + 1]], bits)
        if links:
            x, y = np.array(links).T
            a.append(x + edge[r])
            b.append(y + edge[r])
    return fp[np.concatenate(a)], fp[np.concatenate(b)]


def links(fps: DataFrame, bits: int = MAX_BITS, hot: int = HOT_LIST) -> DataFrame:
    """(a, b): links between different fingerprints (column fp, distinct) that
    join all that lie within ``bits`` bits of one another.

    A list longer than ``hot`` is divided into blocks, and each pair of blocks
    is searched by its own: rows come once for each block they meet.
    """
    sets = cover(bits)
    # places count from the lowest byte, as numpy sees them
    byte = [F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(0xFF)) for p in range(8)]

    def key(i: int, s: tuple[int, ...]):
        k = F.lit(i).cast("long")
        for p in s:
            k = F.shiftleft(k, 8).bitwiseOR(byte[p])
        return k

    listed = fps.select("fp", F.explode(F.array(*[key(i, s) for i, s in enumerate(sets)])).alias("key"))
    counted = listed.groupBy("key").count().filter(F.col("count") > 1)
    # the lists with more than one row; n blocks each
    lists = listed.join(counted, "key").select("key", "fp", F.ceil(F.col("count") / hot).cast("int").alias("n"))
    mine = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    pairs = lists.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    pairs = pairs.select("key", "fp", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def found(k, f):
            a, b = _runs(k, f, bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        k = np.zeros(0, np.int64)
        f = np.zeros(0, np.uint64)
        for b in batches:
            k = np.concatenate((k, b.column(0).to_numpy(zero_copy_only=False)))
            f = np.concatenate((f, b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
            whole = int(np.searchsorted(-(k != k[-1]).astype(np.int8), 0)) if len(k) else 0  # rows before the last run
            if whole:
                yield found(k[:whole], f[:whole])
                k, f = k[whole:], f[whole:]
        if len(k):
            yield found(k, f)

    group = F.xxhash64("key", "i", "j")
    dealt = pairs.select(group.alias("grp"), "fp").repartition("grp").sortWithinPartitions("grp", "fp")
    return dealt.mapInArrow(search, "a bigint, b bigint").distinct()


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) reaches.

    Large-star and small-star steps in turn: every node links its larger
    neighbours, then its smaller ones, to the smallest of its neighbourhood,
    until nothing changes.  Rounds are written to the shared folder.
    """
    def star(e: DataFrame, both: bool) -> DataFrame:
        if both:
            e = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = e.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        j = e.join(low, "a")
        if both:  # large star: each larger neighbour to the smallest
            out = j.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:  # small star: each smaller neighbour, and the node itself, to the smallest
            out = j.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low.select("a", F.col("low").alias("b")))
        return out.filter(F.col("a") != F.col("b")).distinct()

    # a link always from the larger to the smaller node
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") != F.col("b")).distinct()
    now, n = materialize_counted(now.withColumn("mark", F.xxhash64("a", "b")), "links")
    mark = now.agg(F.sum(F.col("mark") % 1_000_000_007)).first()[0] if n else 0
    for _ in range(max_rounds):
        if not n:
            break
        nxt = star(star(now.select("a", "b"), True), False).withColumn("mark", F.xxhash64("a", "b"))
        now, m = materialize_counted(nxt, "links")
        new = now.agg(F.sum(F.col("mark") % 1_000_000_007)).first()[0]
        if (m, new) == (n, mark):
            break
        n, mark = m, new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = MAX_BITS, hot: int = HOT_LIST) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row: 16 hex digits, and the
    smallest id that links of at most ``bits`` differing bits reach.

    Documents with equal fingerprints are one node, so copies cost nothing.
    Texts without words have fingerprint zero and link like any other.  Null
    ids keep their rows; they count for no component's smallest id.  An empty
    table gives an empty result; other columns are not read.
    """
    rows = _labelled(docs, id_col, text_col, shingle, bits, hot)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id"))


def _labelled(docs: DataFrame, id_col: str, text_col: str, shingle: int, bits: int, hot: int) -> DataFrame:
    """(doc_id, mark, fp, first): ``first``, the smallest (doc_id, mark) of the component
    (null where all ids are)."""
    if not 0 <= bits <= 6:
        raise ValueError("bits must be from 0 to 6")
    fps = keep(_marked(docs, id_col, text_col, shingle), "simhash")
    own = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "mark"))
    nodes = keep(fps.groupBy("fp").agg(F.min(own).alias("low")), "simhash-nodes")
    found = components(links(nodes.select("fp"), bits, hot))
    # nodes in components of more than one, with their component's smallest id
    member = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
    joined = nodes.join(member.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    low = joined.groupBy("root").agg(F.min("low").alias("first"))
    label = joined.select("fp", "root").join(low, "root").select("fp", "first")
    return fps.join(label, "fp").select("doc_id", "mark", "fp", "first")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = MAX_BITS, hot: int = HOT_LIST, broadcast_rows: int = 2_000_000) -> DataFrame:
    """The rows of ``docs`` less near-duplicates: of each component the row with the
    smallest id stays; of several rows of that id, the one whose text has the smallest
    hash.  Rows of one id with texts that are no near-copies all stay, as do rows with a
    null id.  Up to ``broadcast_rows`` dropped rows (about 40 MB) are broadcast."""
    found = keep(_labelled(docs, id_col, text_col, shingle, bits, hot).filter("doc_id IS NOT NULL").select("doc_id", "mark", "first"), "near-duplicates")
    own = F.struct("doc_id", "mark")
    g_id, g_mark, mark = unused(docs, "gone_id"), unused(docs, "gone_mark"), unused(docs, "text_mark")
    gone, n = materialize_counted(found.filter(own != F.col("first")).select(F.col("doc_id").alias(g_id), F.col("mark").alias(g_mark)).distinct(), "near-duplicates-gone")
    rows = docs.withColumn(mark, _mark(f"`{text_col}`"))
    same = (rows[f"`{id_col}`"] == F.col(g_id)) & (F.col(mark) == F.col(g_mark))
    left = rows.join(F.broadcast(gone) if n <= broadcast_rows else gone, same, "left_anti")
    if not found.groupBy("doc_id", "mark").count().filter("count > 1").isEmpty():
        # whole rows that repeat: one of each stays
        named = left.filter(left[f"`{id_col}`"].isNotNull()).dropDuplicates([id_col, mark])
        left = named.unionByName(left.filter(left[f"`{id_col}`"].isNull()))
    return left.drop(mark)
