"""URL filtering by listed rules and by association rules mined from labels.

Spark's FP-growth finds combinations of URL tokens that go with the label
``block`` often enough (support) and reliably enough (confidence).  A rule is
indexed under its rarest token only; a URL meets the rules listed under its
tokens, and a rule that it holds in full blocks it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, only

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = "label=block"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Different tokens of a URL: host labels (h:), path words (p:), query and
    fragment words (q:); words of digits alone are left out."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*([?#].*)$", 1), F.lit(""))

    def words(c: Column, by: str, mark: str) -> Column:
        kept = F.filter(F.split(F.translate(c, _UPPER, _LOWER), by), lambda x: (x != "") & ~x.rlike("^[0-9]+$"))
        return F.transform(kept, lambda x: F.concat(F.lit(mark), x))

    host, path = host_of(url), path_of(url)
    return F.array_distinct(F.concat(words(host, r"\.", "h:"), words(path, "[^a-z0-9_-]+", "p:"), words(rest, "[^a-z0-9_=-]+", "q:")))


def listed(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest of the listed (verdict, host/path) rules that fits: struct
    (length, rule, verdict), or null.  The list comes with the query and is
    taken to be short (hundreds)."""
    if not rules:
        return F.lit(None).cast("struct<length:int,rule:string,verdict:string>")
    every = []
    for verdict, rule in rules:
        h, slash, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        every.append(F.when(fits, F.struct(F.lit(len(rule)).alias("length"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.greatest(*every) if len(every) > 1 else every[0]


def mine(labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.6, min_lift: float = 1.2, min_count: int = 5) -> DataFrame:
    """(rule_id, items, confidence, support): token combinations that go with
    ``block``, from rows (url, blocked boolean).  All labelled rows count; a rule
    stands on at least ``min_count`` blocked ones, however few rows there are.  A
    rule that holds another rule's tokens and is no more reliable is left out
    (``pruned``)."""
    items = labelled.filter("blocked IS NOT NULL AND url IS NOT NULL").select(F.concat(tokens_of(F.col("url")), F.when(F.col("blocked"), F.array(F.lit(BLOCK))).otherwise(F.array().cast("array<string>"))).alias("items"))
    items = keep(items, "url-items")
    schema = "rule_id bigint, items array<string>, confidence double, support double"
    n = items.count()
    if n < min_count or not n:
        return labelled.sparkSession.createDataFrame([], schema)
    # half a row less, as the miner rounds support * rows up
    support = max(min_support, (min_count - 0.5) / n)
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.filter((F.size("consequent") == 1) & (F.col("consequent")[0] == BLOCK) & (F.col("lift") >= min_lift))
    rules = rules.select(F.xxhash64(F.array_sort("antecedent")).alias("rule_id"), F.array_sort("antecedent").alias("items"), "confidence", "support")
    return keep(pruned(keep(rules, "url-all-rules")), "url-rules")


def pruned(rules: DataFrame) -> DataFrame:
    """``rules`` but for those that hold all tokens of a smaller one at least as
    reliable.  What a URL is judged does not change: it holds the smaller one too."""
    held = rules.select("rule_id", "items", "confidence", F.explode("items").alias("token"))
    often = held.groupBy("token").count()
    small = held.join(often, "token").groupBy("rule_id", "items", "confidence").agg(F.min_by("token", F.struct("count", "token")).alias("token"))
    small = small.select("token", F.col("items").alias("few"), F.col("confidence").alias("sure"))
    beaten = held.join(small, "token").filter((F.size("few") < F.size("items")) & (F.col("sure") >= F.col("confidence")) & (F.size(F.array_except("few", "items")) == 0))
    return rules.join(beaten.select("rule_id").distinct(), "rule_id", "left_anti")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, confidence) of the different ``urls`` that hold all tokens of a mined
    rule; the best rule's confidence."""
    tokens = keep(urls.select("url").filter("url IS NOT NULL").distinct().withColumn("tokens", tokens_of(F.col("url"))), "url-tokens")
    # the inverted index: each rule under its rarest token
    often = tokens.select(F.explode("tokens").alias("token")).groupBy("token").count()
    places = rules.select("rule_id", "items", "confidence", F.explode("items").alias("token")).join(often, "token", "left")
    index = places.groupBy("rule_id", "items", "confidence").agg(F.min_by("token", F.struct(F.coalesce("count", F.lit(0)), "token")).alias("token"))
    met = tokens.withColumn("token", F.explode("tokens")).join(index, "token")
    return met.filter(F.size(F.array_except("items", "tokens")) == 0).groupBy("url").agg(F.max("confidence").alias("confidence"))


def filter_urls(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", **mining) -> DataFrame:
    """(page_id, host, path, rule, verdict, confidence) of every row.

    Listed rules come first, the longest that fits; else a URL that holds a
    mined rule is blocked and any other allowed.  A null URL, or one without
    ``://``, has empty host and path and is allowed unless a mined rule says
    otherwise.  ``labelled``: (url, blocked boolean); null labels don't count.
    Null and repeated ids keep their rows; other columns are not read.
    """
    src = only(pages, page_id=id_col, url=url_col).withColumn("url", F.col("url").cast("string"))
    blocked = matched(src, mine(labelled, **mining))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    out = src.join(blocked, "url", "left").withColumn("host", host).withColumn("path", path)
    out = out.withColumn("hit", listed(F.col("host"), F.col("path"), rules))
    mined = F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", mined).alias("verdict"), F.when(F.col("hit").isNull(), F.col("confidence")).alias("confidence"))
