"""Fingerprints, SimHash near-duplicates, line dedup and the web archive."""

import base64
import hashlib
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash

from dqspark.llm.common import table
from dqspark.llm import fingerprint, linededup, simhash, warc

ODD = [(1, "a b c d e"), (2, None), (3, ""), (4, " \n\t"), (5, "a B c d e"), (5, "a B c d e"), (None, "a b c d e"), (8, "one"), (9, "é ü ß x y z " * 500)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, fp string, part int, mark int")


# -- chunk fingerprints


def test_chunks_follow_the_text():
    rng = np.random.default_rng(1)
    base = bytes(rng.integers(97, 123, 20_000, dtype=np.uint8))
    a, b, c = fingerprint.chunk_sets([base, b"inserted " + base, base[:10_000] + base[10_100:]])
    assert fingerprint.containment(a, b) > 0.97 and fingerprint.containment(a, c) > 0.95
    assert sum(a.values()) == len(base) and max(a.values()) <= fingerprint.MOST
    # a text is cut alike alone and among others
    assert fingerprint.chunk_sets([base]) == [a]
    assert fingerprint.containment({}, {}) == 1 and fingerprint.containment({}, a) == 0 and fingerprint.containment(a, {}) == 0


def test_borders_by_the_rolled_hash():
    rng = np.random.default_rng(2)
    text = bytes(rng.integers(32, 127, 3000, dtype=np.uint8))
    h, cut, begin = 0, [], 0
    for i, x in enumerate(text):
        h = ((h << 1) + int(fingerprint.GEAR[x])) & 0xFFFFFFFF
        n = i + 1 - begin
        if n >= 255 or (n >= 64 and h < 1 << 28) or (16 <= n < 64 and h < 1 << 24):
            cut.append(text[begin : i + 1])
            begin = i + 1
    cut.append(text[begin:])
    want = {xxhash.xxh3_64_intdigest(p) & 0xFFFFFFFFFFFF: len(p) for p in cut if p}
    assert fingerprint.chunk_sets([text]) == [want]


@pytest.mark.parametrize("part_rows", [2, 100])
def test_fingerprint_pairs(spark, part_rows):
    got = fingerprint.fingerprint_pairs(frame(spark, ODD), part_rows=part_rows).collect()
    rows = sorted(((d, t or "") for d, t in ODD), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for i, (d, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        own, ed, fol = fingerprint.chunk_sets([t.encode(), edited.encode(), nxt.encode()])
        text = [base64.b64encode(fingerprint.as_bytes(x)).decode() for x in (own, ed)]
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), *text, fingerprint.containment(own, ed), fingerprint.containment(own, fol)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_fingerprint_edges(spark):
    assert fingerprint.fingerprint_pairs(frame(spark, []).limit(0)).collect() == []
    (one,) = fingerprint.fingerprint_pairs(frame(spark, [(1, "abcd")])).collect()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1


# -- SimHash


def test_cover_holds_every_guaranteed_match():
    for bits in range(0, 7):
        sets = [set(s) for s in simhash.cover(bits)]
        assert all(any(s <= set(x) for s in sets) for x in combinations(range(8), 8 - bits))


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    k = min(3, len(words))
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_long_texts_in_runs(monkeypatch):
    monkeypatch.setattr(simhash, "RUN_BYTES", 10)
    rng = np.random.default_rng(8)
    texts = ["", "  ", "a", " a b ", "a b c", "one two   ", "x" * 50, *(" ".join(rng.choice(["a", "Bb", "ccc", "", "\t", "d" * 20], n)) for n in range(1, 40))]
    assert simhash.fingerprints_of(texts).tolist() == [brute_fingerprint(t) for t in texts]


@pytest.mark.parametrize("hot", [4096, 4])
def test_near_duplicates(spark, hot):
    rng = np.random.default_rng(4)
    rows = list(ODD)
    base = [" ".join(rng.choice(["aa", "bb", "cc", "dd", "ee", "ff", "gg"], 900)) for _ in range(12)]
    for i in range(120):
        words = base[i % 12].split()
        words[int(rng.integers(900))] = "zz" if i >= 12 else words[0]
        rows.append((100 + i, " ".join(words)))
    got = simhash.near_duplicates(frame(spark, rows), hot=hot).collect()
    fps = [brute_fingerprint(t) for _, t in rows]
    assert sorted((r.doc_id or -1, r.fingerprint) for r in got) == sorted((d or -1, f"{f:016x}") for (d, _), f in zip(rows, fps))
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(set(fps)), 2):
        if (a ^ b).bit_count() <= 3:
            parent[find(a)] = find(b)
    low = defaultdict(list)
    for (d, _), f in zip(rows, fps):
        if d is not None:
            low[find(f)].append(d)
    assert len(low) < len({d for d, _ in rows}) - 40
    for r in got:
        assert r.component_id == min(low[find(int(r.fingerprint, 16))])


def test_forest_links_a_large_list():
    rng = np.random.default_rng(9)
    center = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    fp = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) for c in center]))
    links = simhash._forest(fp, 3)
    assert len(links) == len(fp) - 3
    assert all((int(fp[a]) ^ int(fp[b])).bit_count() <= 3 for a, b in links)


def test_simhash_edges(spark):
    assert simhash.near_duplicates(frame(spark, []).limit(0)).collect() == []
    left = simhash.drop_near_duplicates(frame(spark, ODD))
    assert left.columns == ["doc_id", "text", "fp", "part", "mark"]
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted([1, 2, 8, 9, None], key=repr)


# -- line dedup


def brute_lines(rows, min_docs=3, own_docs=None, short_lines=False):
    def templates(line):
        raw = [x for x in re.split("[ \t\r\f\x0b]+", line) if x]
        w = ["<*>" if re.search("[0-9]", x) else x for x in raw]
        n = len(w)
        if not n or (not short_lines and (n < 4 or sum(x != "<*>" for x in w) < 2)):
            return set()
        if sum(x != "<*>" for x in w) < 2:
            return {("exact", *raw)}
        half = -(-(n - 3) // 2)
        out = {("own", *w)}
        if n >= 4 and n - half >= 6:
            out |= {("second", n, *w[: half + 3]), ("first", n, *w[:3], *w[half + 3 :])}
        return out

    seen = defaultdict(list)
    for d, t in rows:
        for x in set().union(*(templates(line) for line in t.split("\n"))) if t is not None else ():
            seen[x].append(d)
    first = {x: min(e for e in d if e is not None) for x, d in seen.items() if len(d) >= (own_docs or min_docs if x[0] in ("own", "exact") else min_docs) and any(e is not None for e in d)}
    out = []
    for d, t in rows:
        lines = [] if t is None else t.split("\n")
        left = [x for x in lines if d is None or not any(k in first and d > first[k] for k in templates(x))]
        out.append((d, None if t is None else "\n".join(left), len(lines), len(lines) - len(left)))
    return out


LINES = [
    (1, "Order 17 shipped to Berlin today\nAll rights reserved by the owner\nalpha"),
    (2, "Order 18 shipped to Berlin today\nunlike any other line here"),
    (3, "Order x99 shipped to Berlin today\r\nalpha\nalpha\nalpha\nAll  rights\treserved by the owner"),
    (4, "All rights reserved by the owner\nWelcome back to our little web shop dear Anna"),
    (5, "Welcome back to our little web shop dear Bob\nsame same same same\nsame same same same"),
    (6, "Welcome back to our little web shop dear Carla\n\n1 2 3 4 5\n"),
    (7, "1 2 3 4 5\n\nalpha"),
    (7, "1 2 3 4 5\n\nalpha"),
    (8, None),
    (9, ""),
    (None, "All rights reserved by the owner\nz"),
    (10, "Hello you good old friend of ours\nWelcome back to that other shop of ours dear\n" * 3),
]


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 0, "broadcast_bytes": 0}])
def test_drop_lines(spark, limits):
    got = linededup.drop_lines(frame(spark, LINES), **limits).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_lines(LINES), key=repr)
    texts = {r.doc_id: r.text for r in got}
    assert texts[1].startswith("Order 17") and texts[3] == "alpha\nalpha\nalpha" and texts[6] == "\n1 2 3 4 5\n"


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 0, "broadcast_bytes": 0}])
def test_drop_lines_as_registered(spark, limits):
    """The rule that op5 and the pipeline run, against brute force."""
    rule = {"short_lines": True, "own_docs": linededup.OWN_DOCS}
    rows = LINES + [(i + 100, t) for i, t in SHORT] + [(i + 200, t) for i, t in TWICE]
    got = linededup.drop_lines(frame(spark, rows), **rule, **limits).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_lines(rows, **rule), key=repr)
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    want = brute_lines([(r.doc_id, r.text) for r in docs.collect()], **rule)
    assert sorted(tuple(r) for r in linededup.drop_lines(docs, **rule, **limits).collect()) == sorted(want)


def test_drop_lines_whole_rows(spark):
    docs = frame(spark, LINES)
    got = linededup.drop_lines(docs, whole_rows=True)
    assert got.columns == docs.columns and got.count() == len(LINES)
    assert linededup.drop_lines(docs.limit(0)).collect() == []


SHORT = [
    (1, "All rights reserved.\nChapter 7 begins\n1 2 3\nalpha\n本文無空格的一行很長的文字\n\n "),
    (2, "All  rights reserved.\nChapter 8 begins\n1 2 4\nalpha\n本文無空格的一行很長的文字\n\n "),
    (3, "All rights reserved.\r\nChapter 9 begins\n1 2 3\nbeta\n本文無空格的一行很長的文字\n\n "),
    (4, "1\t2 3\nPage 7\nalpha"),
    (5, "Page 8\nPage 7\ngamma"),
    (6, "Page 7\ngamma"),
]


def test_drop_short_lines(spark):
    got = {r.doc_id: r.text for r in linededup.drop_lines(frame(spark, SHORT), short_lines=True).collect()}
    assert got == {1: SHORT[0][1], 2: "1 2 4\n\n ", 3: "beta\n\n ", 4: "Page 7", 5: "Page 8\ngamma", 6: "gamma"}


TWICE = [
    (1, "The committee met in room 12 to hear the report of the treasurer on the year\nWelcome back to our little web shop dear Anna\nsmall"),
    (2, "other\nThe committee met in room 14 to hear the report of the treasurer on the year\nWelcome back to our little web shop dear Bob\nsmall"),
    (3, "A passage that only this document has and that nothing else repeats\nsmall\nsmall"),
]


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 0, "broadcast_bytes": 0}])
def test_drop_whole_lines_from_two_documents_on(spark, limits):
    got = {r.doc_id: r.text for r in linededup.drop_lines(frame(spark, TWICE), short_lines=True, own_docs=2, **limits).collect()}
    # half-variable templates still need three documents
    assert got == {1: TWICE[0][1], 2: "other\nWelcome back to our little web shop dear Bob", 3: "A passage that only this document has and that nothing else repeats"}


# -- web archive


def test_archive(spark):
    rows = [(1, "http://a/", "x"), (2, None, "x"), (3, "http://b/", None), (4, "", ""), (None, "u", "x"), (2, "http://z/", "x"), (5, "q\r\nw", "é" * 300), (9, "n", "x")]
    pages = spark.createDataFrame([(*r, b"", 0) for r in rows], "page_id long, url string, html string, payload binary, sha256 int")
    got = warc.archive_and_read(pages).collect()
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        best = max(j for j, _, k in rows if j is not None and (k or "") == (h or ""))
        same = i is None or i == best
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if same else "revisit", None if same else best))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    small = warc.archive_and_read(pages, min_revisit_bytes=2).collect()
    assert {r.record_type for r in small} == {"response"}
    assert warc.archive_and_read(pages.limit(0)).collect() == []


def test_url_that_looks_like_a_header(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/?WARC-Type: revisit", "body"), (None, "u", "x"), (None, "v", "x")], "page_id long, url string, html string")
    warc.write_archive(pages, f"{tmp_path}/warc", written_at="2024-05-06 07:08:09")
    records = {r.rec_id: bytes(r.record).decode() for r in warc.read_records(spark, f"{tmp_path}/warc").filter("rec_id IS NOT NULL").collect()}
    assert records[1].endswith("\r\n\r\nbody\r\n\r\n") and "WARC-Date: 2024-05-06T07:08:09Z\r\n" in records[1]
    ids = [re.search("WARC-Record-ID: (.*?)\r", bytes(r.record).decode())[1] for r in warc.read_records(spark, f"{tmp_path}/warc").collect()]
    assert len(set(ids)) == 3


def test_lost_payload_stops_the_reader(spark, tmp_path):
    pages = spark.createDataFrame([(1, "a", "one"), (2, "b", "two")], "page_id long, url string, html string")
    folder = f"{tmp_path}/warc"
    warc.write_archive(pages, folder)
    kept = spark.read.parquet(f"{folder}/payloads").filter("payload = cast('one' AS binary)").collect()
    spark.createDataFrame(kept, "sha256 binary, payload binary").write.mode("overwrite").parquet(f"{folder}/payloads")
    for read in (warc.read_records, warc.read_archive):
        with pytest.raises(Exception, match="no payload"):
            read(spark, folder).collect()


def test_hot_payload_is_spread(spark, tmp_path):
    """Ranking rows of one id deals them by id as well, so a payload's rows are many keys."""
    pages = spark.range(20_000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.lit("").alias("html"))
    got = warc.archive_and_read(pages).groupBy("record_type", "refers_to").count().collect()
    assert {(r.record_type, r.refers_to, r["count"]) for r in got} == {("response", None, 1), ("revisit", 19_999, 19_999)}


def test_records_come_back_whole(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "body"), (2, "http://b/", "body")], "page_id long, url string, html string")
    folder = f"{tmp_path}/warc"
    warc.write_archive(pages, folder)
    assert spark.read.parquet(f"{folder}/payloads").count() == 1
    records = {r.rec_id: bytes(r.record).decode() for r in warc.read_records(spark, folder).collect()}
    head, block = records[2].split("\r\n\r\n", 1)
    assert block == "body\r\n\r\n" and "WARC-Type: response" in head and "WARC-Target-URI: http://b/" in head and "Content-Length: 4" in head
    head, block = records[1].split("\r\n\r\n", 1)
    assert block == "\r\n\r\n" and "WARC-Refers-To: <urn:page:2>" in head
