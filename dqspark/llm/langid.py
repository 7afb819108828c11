"""Language identification in two steps: family, then language within it.

Features are a text's byte n-grams (1 to 4 bytes of the lower-cased letters,
with a space between words), hashed into ``BUCKETS`` places; a text's weight
at a place is its share of the text's n-grams.  Linear support vector machines
tell families apart, one against another; then, within the winning family, one
language against another.  Votes decide, margins break ties.  Machines are
fitted on a bounded sample, each by its own task; scoring sums weights over all n-grams
of the whole text and stores no vectors.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W

from .common import F, keep, only, small_batches, sql_type

BUCKETS = 1 << 12
SAMPLE = 500  # training rows of a language, at most
UNKNOWN = "und"
SLICE_BYTES = 1_000_000

# Families of language codes; a code that isn't listed is a family of its own.
#   germanic: en de nl sv da no is af    romance: fr es it pt ro ca gl
#   slavic: ru uk pl cs sk bg sr hr sl   indic: hi mr ne bn gu pa
FAMILIES = {
    "germanic": "en de nl sv da no is af",
    "romance": "fr es it pt ro ca gl",
    "slavic": "ru uk pl cs sk bg sr hr sl",
    "indic": "hi mr ne bn gu pa",
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def family(lang: str) -> str:
    return _FAMILY.get(lang, lang)


def _normal(text: str | None) -> bytes:
    """Lower-cased letters with one space around each word; empty if there is no letter."""
    if not text:
        return b""
    s = _NOT_LETTERS.sub(" ", text.lower()).strip()
    return f" {s} ".encode() if any(map(str.isalpha, s)) else b""  # what is left may be signs for numbers


def _codes(buf: bytes) -> Iterator[np.ndarray]:
    """The place of the n-gram that begins at each byte, for n from 1 to 4."""
    a = np.frombuffer(buf, dtype=np.uint8).astype(np.uint32)
    code = np.zeros(len(a), dtype=np.uint32)
    for n in range(1, 5):
        code = code[: len(a) - n + 1] * np.uint32(257) + a[n - 1 :] + np.uint32(n)
        yield (code * np.uint32(2654435761)) >> np.uint32(32 - 12)


def vector(text: str | None) -> np.ndarray:
    """Shares of the places, for fitting."""
    buf = _normal(text)
    v = np.zeros(BUCKETS)
    for code in _codes(buf) if buf else ():
        v += np.bincount(code, minlength=BUCKETS)
    return v / max(1.0, v.sum())


def margins(texts: list[str | None], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text: the machines' sums of weights (columns of ``weights``) by
    share, and whether it has a letter.  Whole texts, a few MB at a time."""
    out = np.zeros((len(texts), weights.shape[1]))
    some = np.zeros(len(texts), dtype=bool)
    held: list[bytes] = []
    index: list[int] = []
    size = 0

    def flush():
        buf = b"\0\0\0\0".join(held) + b"\0\0\0\0"
        length = np.fromiter(map(len, held), dtype=np.int64, count=len(held))
        start = np.concatenate(([0], np.cumsum(length + 4)[:-1]))
        sums = np.zeros((len(held), weights.shape[1]))
        for n, code in enumerate(_codes(buf), 1):
            for k in range(weights.shape[1]):
                total = np.concatenate(([0.0], np.cumsum(weights[code, k])))
                stop = np.maximum(start + length - n + 1, start)
                sums[:, k] += total[stop] - total[start]
        grams = sum(np.maximum(length - n + 1, 0) for n in range(1, 5))
        np.add.at(out, index, sums)
        np.add.at(counts, index, grams)

    counts = np.zeros(len(texts))
    for i, t in enumerate(texts):
        b = _normal(t)
        if not b:
            continue
        some[i] = True
        for at in range(0, len(b), SLICE_BYTES):
            part = b[at : at + SLICE_BYTES + 3]  # n-grams across the border count once, but for shorter ones
            if size and size + len(part) > SLICE_BYTES:
                flush()
                held, index, size = [], [], 0
            held.append(part)
            index.append(i)
            size += len(part)
    if held:
        flush()
    return out / np.maximum(counts, 1)[:, None], some


class Machines:
    """Fitted linear machines: pairs of families, then pairs of languages of one family."""

    def __init__(self, languages: list[str]):
        self.languages = sorted(languages)
        self.families = sorted({family(x) for x in languages})
        self.pairs = [("family", *p) for p in combinations(self.families, 2)]
        for f in self.families:
            self.pairs += [("language", *p) for p in combinations([x for x in self.languages if family(x) == f], 2)]
        self.weights = np.zeros((BUCKETS, len(self.pairs)))
        self.bias = np.zeros(len(self.pairs))

    def _choose(self, m: np.ndarray, level: str, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Winner by votes, then by sum of margins; and its chance among them."""
        votes = np.zeros((len(m), len(names)))
        total = np.zeros((len(m), len(names)))
        for k, (at, a, b) in enumerate(self.pairs):
            if at == level and a in names and b in names:
                i, j = names.index(a), names.index(b)
                votes[:, i] += m[:, k] > 0
                votes[:, j] += m[:, k] <= 0
                total[:, i] += m[:, k]
                total[:, j] -= m[:, k]
        best = np.lexsort((np.broadcast_to(-np.arange(len(names)), votes.shape), total, votes), axis=1)[:, -1]
        rows = np.arange(len(m))
        share = np.exp(np.clip(total - total[rows, best][:, None], -50, 50))
        return best, 1 / share.sum(axis=1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score (0 to 1: the family's chance times the language's in it) of each text."""
        sums, some = margins(texts, self.weights)
        m = sums + self.bias
        score = np.zeros(len(texts))
        out = np.full(len(texts), UNKNOWN, dtype=object)
        if not self.languages or not some.any():
            return out.tolist(), score
        best, chance = self._choose(m, "family", self.families)
        for i, f in enumerate(self.families):
            rows = np.flatnonzero(some & (best == i))
            names = [x for x in self.languages if family(x) == f]
            won, inner = self._choose(m[rows], "language", names)
            out[rows] = np.array(names, dtype=object)[won]
            score[rows] = chance[rows] * inner
        return out.tolist(), score


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", order_col: str = "doc_id", sample: int = SAMPLE) -> Machines:
    """Machines fitted on at most ``sample`` rows of each language, the first by a
    hash of ``order_col``; rows of null language or text don't count.  The
    number of languages is taken to be small (tens)."""
    src = only(docs, text=text_col, lang=lang_col, at=order_col).filter("lang IS NOT NULL AND text IS NOT NULL")
    src = src.withColumn("rank", F.xxhash64(F.col("at").cast("string"))).select("lang", "text", "rank")
    # the sample: a threshold on the hash first, so only about twice the sample is sorted
    sizes = src.groupBy("lang").count()
    share = sizes.select("lang", F.least(F.lit(1.0), F.lit(2.0 * sample) / F.col("count")).alias("share"))
    some = src.join(F.broadcast(share), "lang").filter((F.shiftrightunsigned("rank", 11) / F.lit(float(1 << 53))) < F.col("share"))
    top = some.withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy("rank", "text"))).filter(F.col("n") <= sample)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            for i in range(0, len(texts), 256):
                lists = pa.array([vector(t).astype(np.float32) for t in texts[i : i + 256]], pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([*[c.slice(i, len(lists)) for c in b.columns[:2]], lists], names=["lang", "rank", "features"])

    rows = keep(top.select("lang", "rank", "text").mapInArrow(vectors, "lang string, rank bigint, features array<float>"), "langid-sample")
    model = Machines([r[0] for r in rows.select("lang").distinct().collect()])
    if not model.pairs:
        return model
    # each machine is fitted by a task of its own, on at most ``sample`` rows of each of its languages
    sides = []
    for k, (level, a, b) in enumerate(model.pairs):
        for x in model.languages:
            side = family(x) if level == "family" else x
            if side in (a, b) and (level == "family" or family(x) == family(a)):
                sides.append((x, k, 1.0 if side == a else -1.0))
    parts = rows.join(F.broadcast(docs.sparkSession.createDataFrame(sides, "lang string, machine int, label double")), "lang")
    for r in parts.groupBy("machine").applyInPandas(_fitted, "machine int, weights array<double>, bias double").collect():
        model.weights[:, r["machine"]] = r["weights"]
        model.bias[r["machine"]] = r["bias"]
    return model


def _fitted(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["lang", "rank"], kind="stable")
    w, bias = svm(np.stack(pdf["features"].to_list()).astype(np.float64), pdf["label"].to_numpy())
    return pd.DataFrame({"machine": [int(pdf["machine"].iloc[0])], "weights": [w], "bias": [bias]})


def svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 100) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine: squared hinge loss, both sides of
    equal weight, by Nesterov's accelerated gradient on standardised features."""
    mean, sd = x.mean(axis=0), x.std(axis=0)
    scale = np.where(sd > 0, 1 / np.maximum(sd, np.median(sd[sd > 0]) if (sd > 0).any() else 1), 0)
    z = (x - mean) * scale
    size = np.sqrt((z**2).sum(axis=1).max()) or 1.0
    z = np.hstack([z / size, np.ones((len(z), 1))]).astype(np.float32)
    y = y.astype(np.float32)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w, ahead, t = np.zeros(z.shape[1], np.float32), np.zeros(z.shape[1], np.float32), 1.0
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (z @ ahead))
        grad = np.float32(penalty) * ahead - 2 * ((weight * y * slack) @ z)
        new = ahead - grad / np.float32(4 + penalty)  # rows are at most sqrt(2) long
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead = new + np.float32((last - 1) / t) * (new - w)
        w = new
    out = w[:-1].astype(np.float64) * scale / size
    return out, float(w[-1] - out @ mean)


def identify(docs: DataFrame, model: Machines, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row: a fitted language, or ``und`` and 0
    for a null text or one without letters.  Only the text is looked at."""
    weights = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 1024):
            lang, score = weights.value.predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    src = only(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    return src.mapInArrow(run, f"doc_id {sql_type(src, 'doc_id')}, lang_pred string, score double")


def identified(docs: DataFrame, model: Machines, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is known: a
    null text, or one without letters, is rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 1024):
            lang, _ = shared.value.predict(b.column(at).to_pylist())
            yield b.filter(pa.array([x != UNKNOWN for x in lang], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(id_column) -> "F.Column":
    """Whether a row is kept from fitting: crc32 of the id's digits leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))
