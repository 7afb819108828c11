"""Benchmark decontamination by template windows.

Numbers, units and names are replaced by typed placeholders, so a question
that was asked again with other values keeps its template.  Windows of
``WIDTH`` template tokens of the benchmark are hash-joined to those of every
document.  Along each alignment (document place minus item place) a value of
the item stands for the document value it meets most often; windows in which
it meets another are left out.  Two values of the item may be one in the
document.  A document is contaminated by an item of which the windows that are
left cover at least ``min_coverage``.

Native: DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, materialize_counted, only

WIDTH = 8
MIN_WORDS = 5  # of a window, that are not placeholders; others are compared with their values
MIN_COVERAGE = 0.25
#: Benchmark windows up to this many (about 300 bytes each) are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 200_000

NUMBER, UNIT, NAME = "\ue000", "\ue001", "\ue002"  # private-use characters
_SLOT = f"[{NUMBER}-{NAME}]"
# Units that follow a number.
_UNITS = (
    "km|cm|mm|nm|kg|mg|ml|kb|mb|gb|tb|hz|khz|mhz|ghz|kwh|kw|mph|kmh|lbs?|oz|ft|"
    "meters?|metres?|miles?|inch(?:es)?|feet|grams?|kilos?|liters?|litres?|hours?|minutes?|seconds?|"
    "days?|weeks?|months?|years?|dollars?|euros?|pounds?|cents?|percent|degrees?|usd|eur|gbp|[mglshw]"
)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def template_text(text: Column) -> Column:
    """Lower-cased text in which a slot's value has its placeholder's mark in front.

    A number is a run of digits with inner points or commas that no letter
    touches; a unit one of the listed words, a percent or a currency sign next
    to a number; a name a capitalised word that another word or a comma comes
    before on the line, so the first word of a sentence is not one.
    """
    # each pattern starts with the class that is rarest, and looks behind only there
    def numbers(t: Column) -> Column:
        t = F.regexp_replace(t, rf"([0-9](?<![\p{{L}}\p{{N}}{NAME}][0-9])[0-9]*(?:[.,][0-9]+)*)(?![\p{{N}}])", f" {NUMBER}$1 ")
        t = F.regexp_replace(t, rf"(?i)({NUMBER}[0-9.,]+ ) ?({_UNITS})(?![\p{{L}}\p{{N}}])", f"$1 {UNIT}$2 ")
        t = F.regexp_replace(t, rf"({NUMBER}[0-9.,]+ ) ?([%€$£°])", f"$1 {UNIT}$2 ")
        return F.regexp_replace(t, rf"([€$£]) ?(?= {NUMBER})", f" {UNIT}$1 ")

    for mark in (NUMBER, UNIT, NAME):
        text = F.replace(text, F.lit(mark), F.lit(" "))
    named = F.regexp_replace(text, r"(\p{Lu}(?<=[\p{Ll}\p{N},;] \p{Lu})[\p{L}\p{M}]+)", NAME + "$1")
    return F.lower(_let(named, lambda t: F.when(t.rlike("[0-9]"), numbers(t)).otherwise(t)))


#: What divides words: all signs and spaces, but for those inside a number and those marked as units.
_BETWEEN = rf"(?:[^a-z\p{{L}}\p{{M}}\p{{N}}{NUMBER}-{NAME}](?<!{UNIT}.)(?<![0-9][.,](?=[0-9])))+"


def _words(text: Column) -> Column:
    return F.filter(F.split(template_text(text), _BETWEEN), lambda w: w != "")


def _with_windows(src: DataFrame, width: int, keys: list[str], min_words: int) -> DataFrame:
    """Keys, place and hash of each window of ``width`` template words (a slot is
    its mark alone), and the text's words with their values; texts with fewer
    words have none.  A window with fewer plain words than it needs is hashed
    with its values, so it is only found as it stands.

    Words are hashed in the array, windows after it is exploded: generate, hash
    and a broadcast join then run in one generated loop, and the arrays are
    only carried along by those that are joined.
    """
    d = src.select(*keys, _words(F.col("text")).alias("words"))
    mark = lambda w: F.when(w < NUMBER, w).when(w.rlike(f"^{_SLOT}"), F.substring(w, 1, 1)).otherwise(w)
    d = d.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(mark(w))))
    # outer: else an inferred filter on the array parses every text once more
    d = d.select(*keys, "words", "hashes", F.posexplode_outer("hashes").alias("place", "first")).filter(F.col("place") <= F.size("hashes") - width)
    rest = [F.get("hashes", F.col("place") + k) for k in range(1, width)]
    marks = [F.xxhash64(F.lit(m)) for m in (NUMBER, UNIT, NAME)]
    slots = reduce(add, [h.isin(*marks).cast("int") for h in (F.col("first"), *rest)])
    values = F.xxhash64(F.lit("exact"), *[F.get("words", F.col("place") + k) for k in range(width)])
    return d.select(*keys, "words", "place", F.when(width - slots >= _least(width, min_words), F.xxhash64("first", *rest)).otherwise(values).alias("hash"))


def _least(width: int, min_words: int) -> int:
    """Plain words that a window needs to go by its template: one of placeholders
    says nothing; shorter items need all but a few words."""
    return min(min_words, max(1, width - 3))


def _item_windows(items: DataFrame, width: int, min_words: int) -> DataFrame:
    w = _with_windows(items, width, ["item_id"], min_words).withColumn("said", F.slice("words", F.col("place") + 1, width))
    plain = F.size(F.filter("said", lambda x: ~x.rlike(f"^{_SLOT}")))
    w = w.select("item_id", F.col("place").alias("item_place"), "hash", "said", (plain < _least(width, min_words)).alias("exact"))
    places = lambda c: F.size(F.collect_set(c).over(Window.partitionBy("item_id")))
    return w.withColumn("of", places(F.col("item_place"))).withColumn("of_templates", places(F.when(~F.col("exact"), F.col("item_place"))))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
    min_words: int = MIN_WORDS,
    min_coverage: float = MIN_COVERAGE,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(doc_id, item_id, windows, coverage, slots, same_values): each document and
    benchmark item that it holds; ``same_values`` is false for a question asked
    again with other values (in the windows that count).

    Items shorter than ``width`` words are searched by windows of their own
    length.  Windows with fewer than ``min_words`` plain words are found only
    with the item's own values; ``coverage`` is the share of all windows or of
    the other ones, whichever is larger.  Null or empty texts and items hold nothing.  Null ids: a null
    document id is reported as null; items with a null id are searched, too.
    Equal ids count as one document (item).  Other columns are not read.
    """
    src = only(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string")).filter("text IS NOT NULL AND text != ''")
    items = only(benchmark, item_id=item_col, text=item_text_col).withColumn("text", F.col("text").cast("string"))
    sized = items.withColumn("n", F.least(F.size(_words(F.col("text"))), F.lit(width))).filter("text IS NOT NULL")
    found = None
    for n in sorted(r[0] for r in sized.filter("n > 0").select("n").distinct().collect()):  # at most ``width`` numbers
        part, rows = materialize_counted(_item_windows(sized.filter(F.col("n") == n).drop("n"), n, min_words), "item-windows")
        if not rows:
            continue
        side = F.broadcast(part) if rows <= broadcast_rows else part
        there = F.slice("words", F.col("place") + 1, n)
        hits = _with_windows(src, n, ["doc_id"], min_words).join(side, "hash").select("doc_id", "item_id", "item_place", "of", "of_templates", "exact", (F.col("place") - F.col("item_place")).alias("along"), _slots(F.col("said"), there, F.col("item_place")).alias("slots"))
        one = _consistent(keep(hits, "window-hits"))
        found = one if found is None else found.unionByName(one)
    if found is None:
        kind, item_kind = src.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"doc_id {kind}, item_id {item_kind}, windows bigint, coverage double, slots bigint, same_values boolean")
    # of all windows or of those that values don't bind, whichever is more: a question asked
    # again with other values can only hold the latter
    of_templates = F.when(F.col("of_templates") > 0, F.col("templates") / F.col("of_templates"))
    out = found.withColumn("coverage", F.greatest(F.col("windows") / F.col("of"), of_templates)).filter(F.col("coverage") >= min_coverage)
    return out.select("doc_id", "item_id", "windows", "coverage", "slots", "same_values")


def _slots(said: Column, there: Column, place: Column) -> Column:
    """(at, said, there) of each slot of a window: its place in the item, the
    item's value and the document's."""
    pairs = F.transform(F.arrays_zip(said.alias("said"), there.alias("there")), lambda p, i: F.struct((place + i).alias("at"), p["said"].alias("said"), p["there"].alias("there")))
    return F.filter(pairs, lambda p: p["said"].rlike(f"^{_SLOT}"))


def _chosen(slots: Column) -> Column:
    """(said, there, n) of the item values that have one document value more often
    than any other; between equals the item's own value goes first, and else none."""
    pairs = F.array_distinct(F.transform(slots, lambda p: F.struct(p["said"].alias("said"), p["there"].alias("there"))))
    often = lambda q: 2 * F.size(F.filter(slots, lambda p: (p["said"] == q["said"]) & (p["there"] == q["there"])))
    counted = F.transform(pairs, lambda q: F.struct(q["said"].alias("said"), q["there"].alias("there"), (often(q) + (q["said"] == q["there"]).cast("int")).alias("n")))
    rival = lambda q, r: (r["said"] == q["said"]) & (r["there"] != q["there"]) & (r["n"] >= q["n"])
    return _let(counted, lambda c: F.filter(c, lambda q: ~F.exists(c, lambda r: rival(q, r))))


def _consistent(hits: DataFrame) -> DataFrame:
    """(doc_id, item_id, windows, of, templates, of_templates, slots, same_values) over
    the windows whose slots have their item value's chosen document value on the
    alignment.  What is gathered for an alignment is bounded by the item's length."""
    line = hits.groupBy("doc_id", "item_id", "along").agg(F.max("of").alias("of"), F.max("of_templates").alias("of_templates"), F.collect_set(F.struct("item_place", "exact", "slots")).alias("windows"))

    def agreeing(slots: Column) -> Column:
        different = lambda *side: F.size(F.array_distinct(F.transform(slots, lambda p: F.struct(*[p[x].alias(x) for x in side]))))
        held = lambda c, p: F.exists(c, lambda q: (q["said"] == p["said"]) & (q["there"] == p["there"]))
        some = _let(_chosen(slots), lambda c: F.filter("windows", lambda w: F.forall(w["slots"], lambda p: held(c, p))))
        # mostly each value has one value only
        return F.when(different("said", "there") == different("said"), F.col("windows")).otherwise(some)

    good = line.withColumn("windows", _let(F.array_distinct(F.flatten("windows.slots")), agreeing)).filter(F.size("windows") > 0)
    good = good.withColumn("slots", F.array_distinct(F.transform(F.flatten("windows.slots"), lambda p: F.struct(p["said"].alias("said"), p["there"].alias("there")))))
    same = F.forall("slots", lambda p: p["said"] == p["there"])
    each = good.select("doc_id", "item_id", "of", "of_templates", same.alias("same"), F.size("slots").alias("n"), F.posexplode("windows").alias("i", "place"))
    return each.groupBy("doc_id", "item_id").agg(
        F.size(F.collect_set("place.item_place")).cast("bigint").alias("windows"), F.max("of").alias("of"),
        F.size(F.collect_set(F.when(~F.col("place.exact"), F.col("place.item_place")))).alias("templates"), F.max("of_templates").alias("of_templates"),
        F.sum(F.when(F.col("i") == 0, F.col("n")).otherwise(0)).alias("slots"), F.min("same").alias("same_values"),
    )
