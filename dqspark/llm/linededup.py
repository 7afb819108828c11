"""Line deduplication by a log-template tree of fixed depth.

Lines are parsed as logs are: variable fields (words with a digit) become
``<*>``; the first level of the tree is the number of words, the next ones the
leading words.  A leaf's lines that also agree in the first, or in the second
half of their other words share a template, in which the other half is
variable, so at least half of the words agree.  A template that recurs in
``min_docs`` documents or more is dropped from every document but the first; one
of a whole line, in which no half is variable, in ``own_docs`` or more.

Native: DataFrame functions only.  Templates are told apart by 63 bits of a hash.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, materialize_counted, only

LEADING = 3
MIN_DOCS = 3
OWN_DOCS = 2  # the same for whole lines, where a caller asks for that
MIN_WORDS = 4  # shorter lines are kept, or with ``short_lines`` have their own template only
MIN_FIXED = 6  # words that a template with a variable half must fix
#: Recurring templates up to this many (16 bytes each) are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 2_000_000
#: Places of dropped lines up to this size are broadcast.
BROADCAST_BYTES = 64 << 20
VARIABLE = "<*>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words_of(line: Column, n: Column) -> Column:
    """The first ``n`` words of a line, the last -n for a negative ``n``."""
    return F.call_function("substring_index", line, F.lit(" "), n)


def _spaced(text: Column) -> Column:
    """The text with one space between words."""
    odd = reduce(or_, [F.contains(text, F.lit(x)) for x in ("\t", "\r", "\f", "\x0b", "  ")])
    return F.when(odd, F.regexp_replace(text, "[ \t\r\f\x0b]+", " ")).otherwise(text)


def _mask(spaced: Column) -> Column:
    """The text with ``<*>`` for words with a digit."""
    return F.when(spaced.rlike("[0-9]"), F.regexp_replace(spaced, r"(?<![^ \n])[^ \n0-9]*+[0-9][^ \n]*", VARIABLE)).otherwise(spaced)


def line_templates(text: Column, leading: int = LEADING, min_words: int = MIN_WORDS, min_fixed: int = MIN_FIXED, short_lines: bool = False) -> Column:
    """For each line of ``text`` the hashes of the templates that it belongs to:
    its own with variable fields masked, then those with a variable second
    and first half; none for lines of few words, or with ``short_lines`` the
    line's own too, unmasked if fewer than two words are plain; none for an
    empty line.  The lowest bit says whether the template is of the whole line."""
    whole, part = lambda h: h.bitwiseOR(F.lit(1)), lambda h: h.bitwiseAND(F.lit(-2))
    length = lambda c, part: F.char_length(c) - F.char_length(F.replace(c, F.lit(part)))

    def templates(line: Column, n: Column, unmasked: Column) -> Column:
        half = F.ceil((n - leading) / 2).cast("int")  # words of the first half behind the leading ones
        plain = n - length(line, VARIABLE) / len(VARIABLE)
        own = whole(F.xxhash64(F.lit("own"), line))

        def both(h: Column) -> Column:
            second = part(F.xxhash64(F.lit("second varies"), n, _words_of(line, h + leading)))
            first = part(F.xxhash64(F.lit("first varies"), n, F.substring_index(line, " ", leading), _words_of(line, h + leading - n)))
            return F.array(own, second, first)

        none = F.array().cast("array<bigint>")
        wide = n - half >= min_fixed  # words that are fixed with the first half variable; never more than with the second
        if short_lines:
            exact = whole(F.xxhash64(F.lit("exact"), F.trim(unmasked)))
            return F.when(line == "", none).when(plain < 2, F.array(exact)).when(wide & (n >= min_words), _let(half, both)).otherwise(F.array(own))
        return F.when((n < min_words) | (plain < 2), none).when(wide, _let(half, both)).otherwise(F.array(own))

    each = lambda line, unmasked: _let(F.trim(line), lambda x: _let(length(x, " ") + 1, lambda n: templates(x, n, unmasked)))
    return _let(_spaced(text), lambda t: F.zip_with(F.split(_mask(t), "\n"), F.split(t, "\n"), each))


def parsed_lines(docs: DataFrame, **parsing) -> DataFrame:
    """(doc_id, mark, templates): the templates of each line of every row of
    (doc_id, text); ``mark`` tells rows of one id apart by their text."""
    return docs.select("doc_id", F.xxhash64("text").alias("mark"), line_templates(F.col("text"), **parsing).alias("templates"))


def recurring(parsed: DataFrame, min_docs: int = MIN_DOCS, own_docs: int | None = None) -> DataFrame:
    """(template, first_doc) of the templates in ``min_docs`` parsed rows or more,
    those of whole lines in ``own_docs``; ``first_doc``: the smallest id.  A row counts a template once, so counting
    needs no pair of row and template."""
    each = parsed.select("doc_id", F.explode_outer(F.array_distinct(F.flatten("templates"))).alias("template")).filter("template IS NOT NULL")
    counted = each.groupBy("template").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc"))
    least = F.when(F.col("template").bitwiseAND(F.lit(1)) == 1, min_docs if own_docs is None else own_docs).otherwise(min_docs)
    return counted.filter(F.col("n") >= least).select("template", "first_doc")


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, broadcast_rows: int = BROADCAST_ROWS, own_docs: int | None = None, **parsing) -> DataFrame:
    """(doc_id, mark, places): the lines (from 0) that each row of (doc_id, text)
    loses.  Texts are parsed once, into a table of hashes."""
    parsed = keep(parsed_lines(docs, **parsing), "lines-parsed")
    known, n = materialize_counted(recurring(parsed, min_docs, own_docs), "line-templates")
    lines = parsed.select("doc_id", "mark", F.posexplode_outer("templates").alias("place", "of_line"))
    lines = lines.select("doc_id", "mark", "place", F.explode_outer("of_line").alias("template")).filter("template IS NOT NULL")
    met = lines.join(F.broadcast(known) if n <= broadcast_rows else known, "template")
    return met.filter(F.col("doc_id") > F.col("first_doc")).groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set("place")).alias("places"))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, broadcast_rows: int = BROADCAST_ROWS, broadcast_bytes: int = BROADCAST_BYTES, whole_rows: bool = False, own_docs: int | None = None, **parsing) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) of every row: the text without the lines
    whose template recurs.  With ``whole_rows`` the columns of ``docs`` instead,
    its text column cleaned.

    The rows with a template's smallest id keep its lines, so nothing is lost
    from the corpus altogether.  Lines end at line feeds; lines of fewer than
    ``min_words`` words, or with fewer than two that aren't variable, stay
    unless ``short_lines`` is set: then they go by their own template, those
    with fewer than two plain words (also a line in a script without spaces)
    by all their words as they stand.  ``own_docs`` (None: ``min_docs``) is the
    number of documents from which a template of the whole line goes.
    A line that repeats within one document only stays.  Repeated rows count
    as documents of their own and are treated alike.  A null text has no lines
    and stays null; an empty text has one empty line.  Rows with a null id are
    counted, but keep all their lines.  Other columns are not looked at.
    """
    src = only(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    gone = keep(dropped_lines(src.filter("text IS NOT NULL"), min_docs, broadcast_rows, own_docs, **parsing), "dropped-lines")
    size = gone.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("places")), F.lit(0))).first()
    # 40 bytes a row and 4 a line; more are joined by a hash of the id, without sorting texts
    gone = F.broadcast(gone) if 40 * size[0] + 4 * size[1] <= broadcast_bytes else gone.hint("shuffle_hash")
    whole = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    rows = whole.select("row", F.col(f"row.`{id_col}`").alias("doc_id"), F.col(f"row.`{text_col}`").cast("string").alias("text")) if whole_rows else src
    rows = rows.withColumn("mark", F.xxhash64("text")).join(gone, ["doc_id", "mark"], "left")
    lines = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "places")
    cleaned = _let(lines, lambda all_lines: F.array_join(F.transform(left, lambda i: F.get(all_lines, i)), "\n"))
    text = F.when(F.col("places").isNull(), F.col("text")).otherwise(cleaned)
    if whole_rows:
        return rows.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
    n = F.coalesce(F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"))) + 1, F.lit(0))
    return rows.select("doc_id", text.alias("text"), n.alias("n_lines"), F.coalesce(F.size("places"), F.lit(0)).alias("n_dropped"))
