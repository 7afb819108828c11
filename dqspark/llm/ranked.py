"""Ranked lexical search over k2-treaps.

The term-document grid is cut into blocks of documents.  Each block is a
compressed quadtree (k = 2): level by level, a cell that holds a posting has
four bits for its quadrants and, coded as the difference to its parent's, the
greatest impact within it, so values fall from the root to the leaves, whose
values are exact.  An item's terms are rows of the grid; their paths go down
together over ranges of documents, the range with the highest bound (weight
times cell maximum, summed over the rows) first.  A range whose bound is under
the ``k`` best scores so far is left alone, so results are exact.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W

from .common import F, keep, materialize_counted, only, scratch_path, small_batches, sql_type

BLOCK_POSTINGS = 400_000  # a block ends behind the document that reaches this
BLOCK_DOCS = 1 << 16
SLICE_BYTES = 8_000_000
LOT_BYTES = 32 << 20  # text of the items that are searched for at once
MERGE_WAYS = 64
ROW_GROUP_BYTES = 4 << 20
WIDTH = 256  # document ranges that are opened at once

# What separates terms, and the scoring formula.
#   terms are runs of bytes outside 00-2F 3A-40 5B-60 7B-7F, A-Z lower-cased
#   m = 100 - 25 + (25 * n * N) div L
#   impact = (1000000000 * tf) div (1000 * tf + 12 * m)
#   weight = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))
_SEPARATORS = [(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)]
_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + bytes(c for a, b in _SEPARATORS for c in range(a, b + 1)),
    b"abcdefghijklmnopqrstuvwxyz" + b" " * sum(b - a + 1 for a, b in _SEPARATORS),
)
_BITS = np.array([bin(x).count("1") for x in range(16)], dtype=np.int32)


def _term_runs(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a whole text, a few MB of it at a time."""
    buf = text.encode().translate(_FOLD) if text else b""
    at = 0
    while at < len(buf):
        end = buf.find(b" ", at + SLICE_BYTES) if len(buf) - at > SLICE_BYTES else -1
        end = len(buf) if end < 0 else end
        yield buf[at:end].split()
        at = end


def terms_of(text: str | None) -> Counter:
    """How often each term occurs."""
    found: Counter = Counter()
    for run in _term_runs(text):
        found.update(run)
    return found


def _impacts(tf: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """The part of the score that a posting gives for each unit of weight."""
    longest = int(n.max(initial=0))
    kind = np.int64 if 25 * longest * docs < 1 << 62 and longest < 1 << 32 else object
    m = 75 + (25 * n.astype(kind) * docs) // max(total, 1)
    tf = tf.astype(kind)
    return ((1_000_000_000 * tf) // (1000 * tf + 12 * m)).astype(np.int64)


def _spread(x: np.ndarray) -> np.ndarray:
    """Each bit moved to twice its place."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


@dataclass
class Treap:
    """``masks[l]``: the quadrants of each cell of level l; ``diffs[l]``: what the
    maximum of each cell of level l + 1 lacks to its parent's."""

    root: int
    masks: list[np.ndarray]
    diffs: list[np.ndarray]

    @staticmethod
    def build(rows: np.ndarray, cols: np.ndarray, values: np.ndarray) -> Treap:
        """Of postings, each (row, col) once; there must be one at least."""
        height = max(1, int(max(rows.max(), cols.max())).bit_length())
        code = (_spread(rows) << np.uint64(1)) | _spread(cols)
        order = np.argsort(code)
        code, values = code[order], values[order]
        masks, diffs = [], []
        for _ in range(height):
            up = code >> np.uint64(2)
            first = np.flatnonzero(np.concatenate(([True], up[1:] != up[:-1])))
            most = np.maximum.reduceat(values, first)
            masks.append(np.bitwise_or.reduceat(np.uint8(1) << (code & np.uint64(3)).astype(np.uint8), first))
            diff = np.repeat(most, np.diff(np.append(first, len(code)))) - values
            top = int(diff.max())
            diffs.append(diff.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32))
            code, values = up[first], most
        return Treap(int(values[0]), masks[::-1], diffs[::-1])

    def opened(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For each level the maxima of its cells, and each cell's first child."""
        values, starts = [np.array([self.root], dtype=np.int32)], []
        for mask, diff in zip(self.masks, self.diffs):
            n = _BITS[mask]
            starts.append((np.cumsum(n) - n).astype(np.int32))
            values.append(np.repeat(values[-1], n) - diff.astype(np.int32))
        return values, starts


class Searcher:
    """Searches of one block."""

    def __init__(self, treap: Treap):
        self.masks = treap.masks
        self.height = len(treap.masks)
        self.values, self.starts = treap.opened()

    def best(self, rows: np.ndarray, weights: np.ndarray, k: int, floor: int = 1, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
        """(score, col) of the ``k`` best columns with a score of ``floor`` or more:
        highest first, of equal ones the lower column."""
        weights = weights.astype(np.int64)
        top = np.zeros((1, len(rows)), dtype=np.int64)
        # one pool of open ranges a level: bounds, columns, and each row's cell (-1: none)
        pools: list[list | None] = [None] * (self.height + 1)
        pools[0] = [weights.sum(keepdims=True) * self.values[0][0], np.zeros(1, dtype=np.int64), top]
        score, col = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while True:
            level = max((p[0].max(), -i) for i, p in enumerate(pools) if p is not None) if any(p is not None for p in pools) else None
            if level is None or level[0] < floor:
                break
            level = -level[1]
            bound, cols, cells = pools[level]
            pools[level] = None
            if len(bound) > width:
                order = np.lexsort((cols, -bound))
                rest = order[width:]
                rest = rest[bound[rest] >= floor]
                if len(rest):
                    pools[level] = [bound[rest], cols[rest], cells[rest]]
                take = order[:width]
                bound, cols, cells = bound[take], cols[take], cells[take]
            row_bit = (rows >> (self.height - level - 1)) & 1
            mask = np.where(cells >= 0, self.masks[level][cells], 0)
            start = self.starts[level][cells]
            for side in (0, 1):
                q = (2 * row_bit + side).astype(np.int64)
                there = (mask >> q) & 1 == 1
                child = np.where(there, start + _BITS[mask & ((1 << q) - 1)], -1)
                bounds = (np.where(there, self.values[level + 1][child], 0) * weights).sum(axis=1)
                good = bounds >= floor
                if not good.any():
                    continue
                new = [bounds[good], 2 * cols[good] + side, child[good]]
                if level + 1 < self.height:
                    had = pools[level + 1]
                    pools[level + 1] = new if had is None else [np.concatenate(x) for x in zip(had, new)]
                else:
                    score, col = np.concatenate((score, new[0])), np.concatenate((col, new[1]))
            if len(score) > k:
                order = np.lexsort((col, -score))[:k]
                score, col = score[order], col[order]
                floor = max(floor, int(score[-1]))
        order = np.lexsort((col, -score))[:k]
        return score[order], col[order]


#: A block's row: terms are bytes in a row with where each ends, so a block is a few long values.
INDEX = "block long, docs long, total long, ids array<{id}>, terms binary, ends binary, df binary, root bigint, masks array<binary>, diffs array<binary>, widths array<int>"


def statistics(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """N, the documents with at least one term, and L, all their terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = total = 0
        for b in small_batches(batches):
            for t in b.column(0).to_pylist():
                length = sum(map(len, _term_runs(t)))
                n, total = n + (length > 0), total + length
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total], pa.int64())], names=["n", "total"])

    src = only(docs, text=text_col).select(F.col("text").cast("string").alias("text"))
    r = src.mapInArrow(count, "n bigint, total bigint").agg(F.sum("n"), F.sum("total")).first()
    return int(r[0] or 0), int(r[1] or 0)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_postings: int = BLOCK_POSTINGS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The index of all rows of ``docs``, written to the shared folder: one row a
    block (ids in ascending order, terms by falling frequency, the treap).

    Documents without a term are in no block.  Rows of a repeated id are
    documents of their own; null ids come behind the others.  Nothing is
    shuffled: a block holds successive rows of one input split.
    """
    src = only(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    n_docs, total = statistics(src)
    kind = sql_type(src, "doc_id")
    names = INDEX.format(id=kind)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        lengths: list[int] = []
        sizes: list[int] = []
        vocabulary: dict[bytes, int] = {}
        term, tf = array("i"), array("q")

        def flush() -> pa.RecordBatch:
            place = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i]) if ids[i] is not None else (True, 0))
            rank = np.empty(len(ids), dtype=np.int64)
            rank[place] = np.arange(len(ids))
            at, size = np.frombuffer(term, dtype=np.int32), np.array(sizes)
            df = np.bincount(at, minlength=len(vocabulary))
            words = list(vocabulary)
            by_df = np.argsort(-df, kind="stable")
            words = [words[i] for i in by_df.tolist()]
            row = np.empty(len(df), dtype=np.int64)
            row[by_df] = np.arange(len(df))
            value = _impacts(np.frombuffer(tf, dtype=np.int64), np.repeat(np.array(lengths), size), n_docs, total)
            t = Treap.build(row[at], np.repeat(rank, size), value)
            ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int32, count=len(words)), dtype=np.int32)
            one = {
                "block": number, "docs": n_docs, "total": total, "ids": [ids[i] for i in place], "root": t.root,
                "terms": b"".join(words), "ends": ends.tobytes(), "df": df[by_df].astype(np.int32).tobytes(),
                "masks": [m.tobytes() for m in t.masks], "diffs": [d.tobytes() for d in t.diffs], "widths": [d.itemsize for d in t.diffs],
            }
            return pa.RecordBatch.from_pylist([one], schema=pa.schema(list(kinds.items())))

        number = TaskContext.get().partitionId() << 32
        for b in small_batches(batches):
            kinds = {
                "block": pa.int64(), "docs": pa.int64(), "total": pa.int64(), "ids": pa.list_(b.schema.field(0).type), "terms": pa.binary(), "ends": pa.binary(), "df": pa.binary(), "root": pa.int64(),
                "masks": pa.list_(pa.binary()), "diffs": pa.list_(pa.binary()), "widths": pa.list_(pa.int32()),
            }
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = terms_of(text)
                if not found:
                    continue
                ids.append(doc_id)
                sizes.append(len(found))
                lengths.append(sum(found.values()))
                term.extend([vocabulary.setdefault(w, len(vocabulary)) for w in found])
                tf.extend(found.values())
                if len(term) >= block_postings or len(ids) >= block_docs:
                    yield flush()
                    ids, lengths, sizes, vocabulary, term, tf = [], [], [], {}, array("i"), array("q")
                    number += 1
        if ids:
            yield flush()

    # a block is one long row, so a row group of a few blocks: writer and reader hold one group at a time
    path = scratch_path(docs.sparkSession, "ranked-index")
    found = src.mapInArrow(build, names)
    w = found.write.option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.block.size.row.check.min", 1).option("parquet.block.size.row.check.max", 1)
    w.option("parquet.page.size.row.check.min", 1).option("parquet.enable.dictionary", "false").parquet(path)
    return docs.sparkSession.read.schema(found.schema).parquet(path)


def _treap_of(row: dict) -> Treap:
    widths = {1: np.uint8, 2: np.uint16, 4: np.uint32}
    diffs = [np.frombuffer(d, dtype=widths[w]) for d, w in zip(row["diffs"], row["widths"])]
    return Treap(row["root"], [np.frombuffer(m, dtype=np.uint8) for m in row["masks"]], diffs)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks one at a time."""
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1)


def _terms(b: pa.RecordBatch) -> pa.Array:
    """The terms of one block."""
    ends = np.frombuffer(b.column("ends")[0].as_py(), dtype=np.int32)
    offsets = np.concatenate((np.zeros(1, np.int32), ends))
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), b.column("terms")[0].as_buffer()])


def document_frequencies(index: DataFrame, terms: list[bytes]) -> dict[bytes, int]:
    """In how many documents each of ``terms`` (as many as a lot of items has) occurs."""
    shared = index.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(shared.value, pa.binary())
        seen = np.zeros(len(wanted), dtype=np.int64)
        for b in _blocks(batches):
            at = pc.index_in(_terms(b), value_set=wanted)
            here = at.is_valid().to_numpy(zero_copy_only=False)
            seen[at.drop_null().to_numpy()] += np.frombuffer(b.column("df")[0].as_py(), dtype=np.int32)[here]
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(seen[found], pa.int64())], names=["at", "df"])

    found = index.select("terms", "ends", "df").mapInArrow(count, "at bigint, df bigint").groupBy("at").agg(F.sum("df").alias("df"))
    return {terms[r["at"]]: r["df"] for r in found.collect()}


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def _found(index: DataFrame, queries, k: int, floors: dict[int, int]) -> DataFrame:
    """(item, doc_id, score): every task's ``k`` best documents of each item."""
    shared = index.sparkSession.sparkContext.broadcast((queries, floors))
    kind = index.schema["ids"].dataType.elementType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (terms, items), floor = shared.value
        wanted = pa.array(terms, pa.binary())
        least = dict(floor)  # a task's later blocks know its earlier ones' scores
        best: dict[int, tuple[np.ndarray, list]] = {}
        kinds = pa.int64()
        for b in _blocks(batches):
            row = {c: b.column(c)[0].as_py() for c in ("root", "masks", "diffs", "widths")}
            block = Searcher(_treap_of(row))
            ids = b.column("ids").flatten()
            kinds = ids.type
            rows = np.full(len(wanted), -1, dtype=np.int64)
            at = pc.index_in(_terms(b), value_set=wanted)
            here = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
            rows[at.drop_null().to_numpy()] = here
            for item, numbers, weights in items:
                r = rows[numbers]
                some = r >= 0
                if not some.any():
                    continue
                score, col = block.best(r[some], weights[some], k, least.get(item, 1))
                if not len(score):
                    continue
                old = best.get(item)
                named = ids.take(pa.array(col)).to_pylist()
                if old is not None:
                    score, named = np.concatenate((old[0], score)), old[1] + named
                    order = sorted(range(len(score)), key=lambda i: (-score[i], named[i] is None, named[i] or 0))[:k]
                    score, named = score[order], [named[i] for i in order]
                best[item] = (score, named)
                if len(score) == k:
                    least[item] = max(least.get(item, 1), int(score[-1]))
        sizes = [len(s) for s, _ in best.values()]
        cols = [
            pa.array(np.repeat(np.array(list(best), dtype=np.int64), sizes), pa.int64()),
            pa.array(list(chain.from_iterable(named for _, named in best.values())), kinds),
            pa.array(np.concatenate([np.zeros(0, np.int64), *[s for s, _ in best.values()]]), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(cols, names=["item", "doc_id", "score"])

    cols = ["ids", "terms", "ends", "root", "masks", "diffs", "widths"]
    return index.select(*cols).mapInArrow(search, f"item bigint, doc_id {kind}, score bigint")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each item, in two steps, so that no task gets more of an
    item than ``MERGE_WAYS`` times ``k`` rows or its share of the tasks'."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    ways = found.withColumn("way", F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGE_WAYS)))
    first = ways.withColumn("rank", F.row_number().over(W.partitionBy("item", "way").orderBy(*order))).filter(F.col("rank") <= k)
    return first.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k).select("item", "rank", "doc_id", "score")


def search_index(index: DataFrame, items: DataFrame, k: int = 20, id_col: str = "item_id", text_col: str = "text", lot_bytes: int = LOT_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each row of ``items``
    with a score above 0; equal scores by ascending id, null ids last.

    Repeated items, also rows of one id, are each searched for; items without
    a term, or with a null text, find nothing.  Items are worked off in lots
    of about ``lot_bytes`` of text, of which the terms and weights are
    broadcast.  One block is searched first: its scores are a lower bound for
    all others.
    """
    src = only(items, item_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string")).filter("text IS NOT NULL")
    named, n = materialize_counted(src.withColumn("item", F.monotonically_increasing_id()), "ranked-items")
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    lots = max(1, math.ceil(size / lot_bytes))
    first = index.select("block", "docs").first()
    out = None
    for lot in range(lots if n and first is not None else 0):
        mine = named.filter(F.pmod(F.xxhash64("item"), F.lit(lots)) == lot).select("item", "text").collect()
        counts = [(r["item"], terms_of(r["text"])) for r in mine]
        terms = sorted(set(chain.from_iterable(c for _, c in counts)))
        df = document_frequencies(index, terms)
        number = {t: i for i, t in enumerate(terms)}
        w = {t: weight(first["docs"], df[t]) for t in terms if t in df}
        queries = []
        for item, c in counts:
            held = sorted(t for t in c if w.get(t, 0) > 0)
            if held:
                queries.append((item, np.array([number[t] for t in held]), np.array([w[t] * c[t] for t in held], dtype=np.int64)))
        sought = (terms, queries)
        seed = _found(index.filter(F.col("block") == first["block"]), sought, k, {}).groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).filter(F.col("n") == k)
        floors = {r["item"]: r["least"] for r in seed.collect()}
        got = _ranked(_found(index, sought, k, floors), k)
        out = got if out is None else keep(out, "ranked-lots").unionByName(got)
    if out is None:
        kind = index.schema["ids"].dataType.elementType.simpleString()
        out = index.sparkSession.createDataFrame([], f"item bigint, rank int, doc_id {kind}, score bigint")
    return named.select("item", "item_id").join(out, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", **options) -> DataFrame:
    """Index ``docs`` and rank them for every row of ``items`` (see ``build_index``
    and ``search_index``).  Null and empty texts have no term; an empty table
    on either side gives an empty result; other columns are not read."""
    return search_index(build_index(docs, id_col, text_col, **options), items, k, item_id_col, item_text_col)
