"""Ranked search against scores of every document."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from dqspark.llm import ranked as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k=20):
    rows = [(i, terms(t)) for i, t in docs]
    rows = [(i, w) for i, w in rows if w]
    n_docs, total = len(rows), sum(len(w) for _, w in rows)
    df = {}
    for _, w in rows:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        found = []
        for i, w in rows:
            m = 75 + (25 * len(w) * n_docs) // total
            score = sum(R.weight(n_docs, df[t]) * ((1_000_000_000 * w.count(t)) // (1000 * w.count(t) + 12 * m)) for t in terms(text) if t in w)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, score long, terms string")


def items_of(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "item_id long, text string, doc_id int")


def some(seed, n):
    random.seed(seed)
    words = [f"w{i}" for i in range(60)] + ["Élan", "élan", "ÉLAN", "über-x", "Ab1", "zz's", "日本語", "a_b"]
    return [(i * 3, " ".join(random.choices(words, [1 / (1 + j) for j in range(len(words))], k=random.randrange(0, 30)))) for i in range(n)]


@pytest.mark.parametrize("block_docs", [7, 1000])
def test_every_document_scored(spark, block_docs):
    docs = some(1, 150) + [(900, None), (901, ""), (902, "... -"), (None, "w1 w2 w3"), (6, "w1 w2"), (6, "w1 w2"), (903, "w5 " * 1000)]
    items = [(1, "w1 w2 w2 W3"), (2, None), (3, "élan ÉLAN Élan a_b"), (4, "nothing here"), (5, "日本語 über w50"), (5, "w5"), (6, ""), (None, "w7 w8 w9 w10")]
    got = R.search(docs_of(spark, docs), items_of(spark, items), k=20, block_docs=block_docs)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute(docs, items)


def test_lots_and_ties(spark):
    docs = [(i, "same text of all") for i in range(50, 0, -1)]
    items = [(1, "same text"), (2, "all"), (3, "of other")]
    index = R.build_index(docs_of(spark, docs), block_docs=8)
    one = sorted(tuple(r) for r in R.search_index(index, items_of(spark, items), k=5).collect())
    assert one == sorted(tuple(r) for r in R.search_index(index, items_of(spark, items), k=5, lot_bytes=8).collect())
    # a term of every document has weight 0 or more; equal scores go by id
    assert one == brute(docs, items, 5)


def test_empty_tables(spark):
    docs, items = docs_of(spark, [(1, "a b")]), items_of(spark, [(1, "a")])
    assert R.search(docs.limit(0), items).collect() == []
    assert R.search(docs, items.limit(0)).collect() == []
    assert R.search(docs.withColumn("text", F.lit(None).cast("string")), items).collect() == []


def test_treap_keeps_every_posting():
    rng = np.random.default_rng(0)
    grid = rng.integers(1, 1 << 20, (40, 21)) * (rng.random((40, 21)) < 0.2)
    rows, cols = np.nonzero(grid)
    s = R.Searcher(R.Treap.build(rows, cols, grid[rows, cols]))
    for picked in ([3], [0, 5, 39], list(range(40))):
        w = rng.integers(1, 50, len(picked))
        want = sorted([(-int(x), c) for c, x in enumerate((grid[picked] * w[:, None]).sum(axis=0)) if x > 0])[:6]
        score, col = s.best(np.array(picked), w, 6, width=3)
        assert [(-int(a), int(b)) for a, b in zip(score, col)] == want
    # maxima never rise on the way down
    for level, start in enumerate(s.starts):
        n = R._BITS[s.masks[level]]
        assert (np.repeat(s.values[level], n) >= s.values[level + 1]).all()


def test_long_texts_go_in_runs(monkeypatch):
    monkeypatch.setattr(R, "SLICE_BYTES", 10)
    text = "Ab1 cd-ef ÉG x " * 40 + "y" * 100
    assert R.terms_of(text) == __import__("collections").Counter(w.encode() for w in terms(text))
