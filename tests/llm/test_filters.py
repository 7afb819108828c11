"""Decontamination, URL filter, language ID and the pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from dqspark.llm import decontaminate, langid, queries, urlfilter
from dqspark.llm.common import table

ITEM = "Anna walked 5 km on Monday, then Anna met Bob who ate 7 apples with Anna at the station near the river bank"
OTHER = "So Carl walked 9 km on Friday, then Carl met Dora who ate 2 apples with Carl at the station near the river bank ok"
MIXED = "so Carl walked 9 km on Friday, then Eve met Dora who ate 2 apples with Fred at the station x y"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id long, text string, hash int, words string")


def bench_of(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "item_id long, text string, place int")


def test_reparameterised_question(spark):
    docs = docs_of(spark, [(1, OTHER), (2, MIXED), (3, None), (4, "nothing of it"), (5, "See: " + ITEM + "!"), (5, "See: " + ITEM + "!"), (None, ITEM), (7, "")])
    got = decontaminate.contaminated(docs, bench_of(spark, [(1, ITEM), (2, None), (3, ""), (4, "an entirely different text of more than eight words here")])).collect()
    assert {(r.doc_id, r.item_id, r.same_values) for r in got} == {(1, 1, False), (5, 1, True), (None, 1, True)}
    assert all(r.coverage > 0.9 for r in got)


@pytest.mark.parametrize("rows", [0, 1000])
def test_short_items_and_no_broadcast(spark, rows):
    docs = docs_of(spark, [(1, "we say: pay the ferryman twice now, friend"), (2, "pay the other man twice")])
    got = decontaminate.contaminated(docs, bench_of(spark, [(1, "Pay the ferryman twice now")]), broadcast_rows=rows).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(1, 1)]


SUM = "Compute 12 + 45 - 7 * 3 + 8 / 2 - 1"


@pytest.mark.parametrize("rows", [0, 1000])
def test_items_dense_in_values_are_searched_as_they_stand(spark, rows):
    docs = docs_of(spark, [(1, "As asked: compute 12 + 45 - 7 * 3 + 8 / 2 - 1."), (2, "Compute 13 + 45 - 7 * 3 + 8 / 2 - 1"), (3, "12 45 7 3 8 2 1")])
    got = decontaminate.contaminated(docs, bench_of(spark, [(1, SUM), (2, "12 30")]), broadcast_rows=rows).collect()
    assert [(r.doc_id, r.item_id, r.windows, r.coverage, r.same_values) for r in got] == [(1, 1, 1, 1.0, True)]


PASSAGE = "every autumn the old keeper {} walked slowly along the northern shore and counted the grey seals that were resting there before {} wrote the total into the log that {} had bought in the town"
FRUIT = "the farmer bought {} apples and {} pears from the small market near the bridge"


def test_one_contradicting_value_costs_its_windows_only(spark):
    docs = docs_of(spark, [(1, PASSAGE.format("Anna", "Eve", "Bob")), (2, PASSAGE.format("Carl", "Dora", "Carl")), (3, FRUIT.format(5, 5)), (4, FRUIT.format(3, 4))])
    got = decontaminate.contaminated(docs, bench_of(spark, [(1, PASSAGE.format("Anna", "Anna", "Bob")), (2, PASSAGE.format("Anna", "Anna", "Anna")), (3, FRUIT.format(3, 4))])).collect()
    found = {(r.doc_id, r.item_id): r for r in got}
    assert {k: r.same_values for k, r in found.items() if k != (1, 2) and k != (2, 1)} == {(1, 1): True, (2, 2): False, (3, 3): False, (4, 3): True}
    assert 0.25 <= found[1, 1].coverage < 1 and 0.25 <= found[2, 2].coverage < 1 and found[3, 3].coverage == 1
    # Eve's place is in eight windows
    n = len(PASSAGE.split()) - 7
    assert found[1, 1].windows == n - 8 and found[2, 2].windows == n - 8


def test_decontamination_of_empty_tables(spark):
    docs, bench = docs_of(spark, [(1, ITEM)]), bench_of(spark, [(1, ITEM)])
    assert decontaminate.contaminated(docs.limit(0), bench).collect() == []
    assert decontaminate.contaminated(docs, bench.limit(0)).collect() == []


def test_planted_passages_and_no_other(spark):
    sf = "/root/testdata/sf0.01"
    got = {(r.doc_id, r.item_id) for r in queries.op1_decontaminate(spark, sf).collect()}
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    want = {(d, b.item_id) for b in table(spark, sf, "benchmark").collect() for d, t in texts.items() if b.text in t}
    assert got == want and got


def test_template_words(spark):
    x = spark.createDataFrame([("In 2023, Anna paid $5.50 for 3km, but Bob left 20% of 1,000 cats.",)], "t string")
    words = x.select(decontaminate._words(F.col("t"))).first()[0]
    n, u, p = decontaminate.NUMBER, decontaminate.UNIT, decontaminate.NAME
    assert words == ["in", n + "2023", p + "anna", "paid", u + "$", n + "5.50", "for", n + "3", u + "km", "but", p + "bob", "left", n + "20", u + "%", "of", n + "1,000", "cats"]


URLS = [
    (1, "HTTP://WWW.Example.COM/en/1?x=1#y", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    (2, "http://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
    (3, "http://com", "com", "", None, "allow"),
    (4, "foo", "", "", None, "allow"),
    (5, None, "", "", None, "allow"),
    (6, "x://Ä.net/es/é?q", "Ä.net", "/es/é", "net/es/", "block"),
    (7, "http://notexample.org/en/", "notexample.org", "/en/", None, "allow"),
    (8, "http://com:80/a", "com:80", "/a", None, "allow"),
    (8, "http://bad.shop.org/win?prize", "bad.shop.org", "/win", None, "block"),
    (None, "http://bad.shop.org/win?prize", "bad.shop.org", "/win", None, "block"),
    (9, "http://bad.other.org/lose", "bad.other.org", "/lose", None, "allow"),
]


def test_url_filter(spark):
    pages = spark.createDataFrame([(r[0], r[1], 1, "r") for r in URLS], "page_id long, url string, host int, rule string")
    labelled = [(f"http://bad.shop{i}.org/win?prize", True) for i in range(9)] + [(f"http://good.shop{i}.org/win?prize", False) for i in range(9)]
    labelled += [(f"http://bad.site{i}.org/lose", False) for i in range(9)] + [(None, True), ("http://bad.shop.org/win", None)]
    known = spark.createDataFrame(labelled, "url string, blocked boolean")
    got = urlfilter.filter_urls(pages, known, queries.URL_RULES, min_support=0.1, min_confidence=0.9).collect()
    want = [(i, h, p, rule, verdict) for i, _, h, p, rule, verdict in URLS]
    assert sorted([tuple(r)[:5] for r in got], key=repr) == sorted(want, key=repr)
    assert urlfilter.filter_urls(pages.limit(0), known.limit(0), queries.URL_RULES).collect() == []
    assert {r.verdict for r in urlfilter.filter_urls(pages, known.limit(0), []).collect()} == {"allow"}


def test_mined_rules_match_by_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    urls = table(spark, sf, "pages").select("url")
    rules = spark.createDataFrame([(1, ["h:com", "p:en"], 0.7, 0.1), (2, ["h:blog", "h:net", "p:es"], 0.9, 0.1), (3, ["nowhere"], 1.0, 0.1)], "rule_id long, items array<string>, confidence double, support double")
    got = {r.url: r.confidence for r in urlfilter.matched(urls, rules).collect()}
    want = {}
    for r in urls.withColumn("t", urlfilter.tokens_of(F.col("url"))).collect():
        found = [c for items, c in ((["h:com", "p:en"], 0.7), (["h:blog", "h:net", "p:es"], 0.9)) if set(items) <= set(r.t)]
        if found:
            want[r.url] = max(found)
    assert got == want and want


@pytest.fixture(scope="module")
def model(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    return langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))), sample=120)


def test_language_id_held_out(spark, model):
    docs = table(spark, "/root/testdata/sf0.01", "documents").filter(langid.held_out(F.col("doc_id")))
    got = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count() and np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_id_edges(spark, model):
    rows = [(1, None), (2, ""), (3, "12 !?"), (4, "the " * 5), (4, "the " * 5), (None, "und der die das"), (6, "der die das und " * 200_000)]
    got = langid.identify(docs_of(spark, rows), model).collect()
    assert sorted((r.doc_id or 0 for r in got)) == [0, 1, 2, 3, 4, 4, 6]
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id in (1, 2, 3))
    assert next(r.lang_pred for r in got if r.doc_id == 6) == "de"
    kept = langid.identified(docs_of(spark, rows), model)
    assert kept.columns == ["doc_id", "text", "hash", "words"] and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 4, 4, 6]
    nobody = langid.fit(docs_of(spark, rows).withColumn("lang", F.lit(None).cast("string")), sample=10)
    assert {r.lang_pred for r in langid.identify(docs_of(spark, rows), nobody).collect()} == {"und"}


def test_margins_of_long_texts(monkeypatch):
    rng = np.random.default_rng(0)
    weights = rng.normal(size=(langid.BUCKETS, 2))
    texts = ["Ein Satz, der hier steht.", None, "été " * 300, "x"]
    whole, some = langid.margins(texts, weights)
    for i, t in enumerate(texts):
        assert np.allclose(whole[i], langid.vector(t) @ weights)
    assert some.tolist() == [True, False, True, True]


def test_rows_of_one_id_are_told_apart(spark):
    """Stages that drop rows drop a text, not all that has its id; no column name is in their way."""
    import corpus_pipeline as C

    sf = "/root/testdata/sf0.001"
    item = table(spark, sf, "benchmark").first().text
    clean = "a quiet text of its own that no other document repeats in any of its words at all " * 2
    rows = [(1, clean), (2, clean), (2, "quite another text that has the id of a copy but nothing else in common with it, is it"), (3, f"{clean} {item}"), (3, "third text with an id that it shares with a contaminated one and which is clean"), (None, item), (None, clean), (4, "repeated whole row of this table that is there twice"), (4, "repeated whole row of this table that is there twice")]
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], "doc_id long, text string, gone int, _gone int, gone_id int, row_key int")
    left = C.near_duplicates(spark, docs, sf)
    assert left.columns == docs.columns
    kept = sorted([(r.doc_id, r.text) for r in left.collect()], key=repr)
    assert kept == sorted([r for i, r in enumerate(rows) if i not in (1, 8)], key=repr)
    left = C.decontaminate(spark, docs, sf)
    assert left.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in left.collect()], key=repr) == sorted([r for i, r in enumerate(rows) if i not in (3, 5)], key=repr)


def test_pipeline(spark):
    import corpus_pipeline as C

    sf = "/root/testdata/sf0.001"
    assert [f for _, f in C.STAGES] == [C.language_id, C.line_dedup, C.near_duplicates, C.decontaminate, C.packing]
    docs = table(spark, sf, "documents")
    odd = spark.createDataFrame([(10_001, None, "en", "s", 0), (10_002, "", "en", "s", 0), (10_003, "12 34", None, None, None)], docs.schema)
    now, sizes = docs.unionByName(odd), []
    for name, stage in C.STAGES[:-1]:
        now = C.keep(stage(spark, now, sf), f"test-{name}")
        assert now.columns == docs.columns
        sizes.append(now.count())
    assert sizes[0] == docs.count() == sizes[1] >= sizes[2] >= sizes[3] > 0
    assert now.filter("n_chars != char_length(text)").count() == 0
    items = [r.text for r in table(spark, sf, "benchmark").collect()]
    assert not [1 for r in now.collect() if any(b in r.text for b in items)]
    out = C.packing(spark, now, sf)
    assert out.select("doc_id").distinct().count() == sizes[3]
    assert C.language_id(spark, docs.limit(0), sf).count() == 0


def test_rules_stand_on_enough_rows_and_add_something(spark):
    """Against all token sets of the labelled rows, counted one by one."""
    from itertools import combinations

    rows = [("http://a.org/x/y", True)] * 6 + [("http://a.org/x", True)] * 2 + [("http://a.org/z", False)] * 6 + [("http://b.org/once", True)] * 4
    labelled = spark.createDataFrame(rows, "url string, blocked boolean")
    sets = [(set(t[0].split("://")[1].replace("/", " p:").split()), t[1]) for t in rows]
    sets = [({f"h:{p}" for p in next(w for w in s if not w.startswith("p:")).split(".")} | {w for w in s if w.startswith("p:")}, b) for s, b in sets]
    base = sum(b for _, b in sets) / len(sets)
    found = {}
    for items in {frozenset(c) for s, _ in sets for k in range(1, len(s) + 1) for c in combinations(s, k)}:
        with_it = [b for s, b in sets if items <= s]
        sure = sum(with_it) / len(with_it)
        if sum(with_it) >= 5 and sure >= 0.6 and sure / base >= 1.2:
            found[items] = sure
    want = {r: c for r, c in found.items() if not any(q < r and d >= c for q, d in found.items())}
    got = {frozenset(r["items"]): r["confidence"] for r in urlfilter.mine(labelled).collect()}
    assert got.keys() == want.keys() and all(abs(got[r] - want[r]) < 1e-9 for r in want)
    assert frozenset({"p:once"}) not in got and urlfilter.mine(labelled.limit(4)).collect() == []
