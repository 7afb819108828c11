"""The corpus operators' registered queries: each applies its operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import toxicity
from .common import F, table
from .decontaminate import contaminated
from .fingerprint import fingerprint_pairs
from .langid import fit, held_out, identify
from .linededup import OWN_DOCS, drop_lines
from .packing import pack_documents
from .ranked import search
from .simhash import near_duplicates
from .tokencount import count_tokens
from .tokenfile import write_and_read
from .turnrepair import damaged, digests, repair
from .urlfilter import filter_urls, path_of
from .warc import archive_and_read

Query = Callable[[SparkSession, str], DataFrame]


#: The listed rules of op7, (verdict, host/path).
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_pairs(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, bits=3)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_lines(table(spark, sf_dir, "documents"), short_lines=True, own_docs=OWN_DOCS)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is that of the document whose number its path ends with:
    low quality or toxic is blocked."""
    pages = table(spark, sf_dir, "pages")
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(?:[./]|$)", 1)
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    known = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max(F.coalesce(bad, F.lit(False))).alias("blocked"))
    labelled = pages.select("url", F.when(number != "", number.cast("long")).alias("doc_id")).join(known, "doc_id").select("url", "blocked")
    return filter_urls(pages, labelled, URL_RULES)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_and_read(table(spark, sf_dir, "pages"), min_revisit_bytes=0).withColumnRenamed("rec_id", "page_id")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(repair(damaged(table(spark, sf_dir, "conversations")), present=F.col("present")))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = toxicity.held_out(F.col("doc_id"))
    model = toxicity.fit(toxicity.with_labels(docs.filter(~held), table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def registry() -> dict[str, Query]:
    return {f.__name__: f for f in (
            op1_decontaminate, op2_token_file, op3_fingerprints, op4_simhash, op5_line_dedup, op6_packing,
            op7_url_filter, op8_warc, op9_token_counts, op10_language_id, op11_turn_repair, op12_ranked_search, op13_toxicity, pipeline,
        )}


#: op5: templates as strings where the operator has their hashes.
_LINE_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS place, unnest(string_split(text, chr(10))) AS line FROM documents
),
words AS (
  SELECT doc_id, place, list_filter(string_split(regexp_replace(line, '[ \t\r\f\v]+', ' ', 'g'), ' '), lambda x: x <> '') AS raw FROM lines
),
masked AS (
  SELECT *, list_transform(raw, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS w FROM words
),
sized AS (
  SELECT *, len(w) AS n, CAST(ceil((len(w) - 3) / 2) AS BIGINT) AS half, len(list_filter(w, lambda x: x <> '<*>')) AS plain FROM masked
),
parsed AS (
  SELECT doc_id, place, unnest(CASE
    WHEN n = 0 THEN []
    WHEN plain < 2 THEN ['whole exact ' || array_to_string(raw, ' ')]
    WHEN n >= 4 AND n - half >= 6 THEN ['whole own ' || array_to_string(w, ' '),
      'part second ' || n || ' ' || array_to_string(w[1:half + 3], ' '),
      'part first ' || n || ' ' || array_to_string(w[1:3], ' ') || ' | ' || array_to_string(w[half + 4:n], ' ')]
    ELSE ['whole own ' || array_to_string(w, ' ')] END) AS template
  FROM sized
),
known AS (
  SELECT template, min(doc_id) AS first_doc FROM parsed GROUP BY template
  HAVING count(DISTINCT doc_id) >= CASE WHEN starts_with(template, 'whole ') THEN 2 ELSE 3 END
),
gone AS (
  SELECT DISTINCT p.doc_id, p.place FROM parsed p JOIN known k USING (template) WHERE p.doc_id > k.first_doc
),
left_over AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.place) AS text, count(*) AS n
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.place = g.place WHERE g.place IS NULL GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(o.text, '') END AS text,
       CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS INTEGER) AS n_lines,
       CAST(coalesce(len(string_split(d.text, chr(10))), 0) - coalesce(o.n, 0) AS INTEGER) AS n_dropped
FROM documents d LEFT JOIN left_over o ON d.doc_id = o.doc_id
"""

_WARC_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS best,
         CAST(CAST(unhex(sha1(coalesce(html, ''))) AS BIT) AS VARCHAR) AS bits
  FROM pages
)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + list_sum(
         list_transform(range(5), lambda j: CASE WHEN substr(bits, CAST(i * 5 + j + 1 AS INTEGER), 1) = '1' THEN CAST(power(2, 4 - j) AS INTEGER) ELSE 0 END)) AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> best THEN best END AS refers_to
FROM p
"""


#: op11: the four states' cheapest ways row by row, with their audits and repaired turns.
_REPAIR_SQL = r"""
WITH RECURSIVE hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
      [4294967295] || list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT)),
      lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
    ), 4294967295) % 20 AS way
  FROM conversations
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN way = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN way = 1 THEN '' WHEN way = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN way = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE way <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
         regexp_replace(text, '^[ 	

]+|[ 	

]+$', '', 'g') AS inner_text
  FROM damaged
),
faulty AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS initial, CASE
    WHEN inner_text = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN right(inner_text, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed
),
-- states: 0 nothing yet, 1 behind s, 2 behind u, 3 behind a
inserts(q0, q, audit, added) AS (
  SELECT q, q, '', CAST([] AS VARCHAR[]) FROM range(4) t(q)
  UNION ALL
  SELECT q0, CASE WHEN q = 2 THEN 3 ELSE 2 END, audit || 'I', added || [CASE WHEN q = 2 THEN 'assistant:' ELSE 'user:' END] FROM inserts WHERE length(audit) < 3
),
dp(conv_id, i, q, cost, audit, turns) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, CAST(0 AS BIGINT), '', CAST([] AS VARCHAR[]) FROM conversations
  UNION ALL
  SELECT conv_id, i, q, cost, audit, turns FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) AS best FROM (
      SELECT d.conv_id, f.i, CASE e.edit WHEN 'D' THEN n.q WHEN 'R' THEN CASE WHEN n.q = 2 THEN 3 ELSE 2 END
               ELSE CASE f.initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END END AS q,
             d.cost + 3 * length(n.audit) + e.cost + CASE WHEN e.edit <> 'D' AND f.fault = 'truncated' THEN 3 ELSE 0 END AS cost,
             d.audit || n.audit || e.edit AS audit,
             d.turns || n.added || CASE e.edit WHEN 'D' THEN CAST([] AS VARCHAR[])
               WHEN 'R' THEN [CASE WHEN n.q = 2 THEN 'assistant:' ELSE 'user:' END || f.text] ELSE [f.role || ':' || f.text] END AS turns
      FROM dp d JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM d.conv_id AND f.i = d.i + 1
      JOIN inserts n ON n.q0 = d.q
      JOIN (VALUES ('D', 4), ('R', 3), ('K', 0)) e(edit, cost) ON e.edit = 'D' OR (f.fault NOT IN ('blank', 'duplicate') AND (
        e.edit = 'R' OR (f.initial = 's' AND n.q = 0) OR (f.initial = 'u' AND n.q <> 2) OR (f.initial = 'a' AND n.q = 2)))
    )
  ) WHERE best = 1
),
ended AS (
  SELECT d.conv_id, d.cost + 3 * length(n.audit) AS cost, d.audit || n.audit AS audit, d.turns || n.added AS turns
  FROM dp d JOIN (SELECT conv_id, max(i) AS last FROM dp GROUP BY conv_id) l ON l.conv_id IS NOT DISTINCT FROM d.conv_id AND l.last = d.i
  JOIN inserts n ON n.q0 = d.q AND n.q IN (0, 3)
),
chosen AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) AS best FROM ended) WHERE best = 1
),
pairs AS (
  SELECT conv_id, fault, turn, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair, i FROM faulty
),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM pairs GROUP BY conv_id
)
SELECT c.conv_id, CAST(coalesce(n.gaps, 0) AS BIGINT) AS gaps, coalesce(n.blank, 0) AS blank, coalesce(n.duplicate, 0) AS duplicate, coalesce(n.truncated, 0) AS truncated,
       coalesce(n.illegal, 0) AS illegal, CAST(c.cost AS BIGINT) AS cost, c.audit, sha256(array_to_string(c.turns, chr(10))) AS repaired_sha256
FROM chosen c LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
"""

_RANKED_SQL = r"""
WITH doc_terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
),
item_terms AS (
  SELECT item_id, term, count(*) AS q FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
  ) GROUP BY item_id, term
),
sizes AS (SELECT doc_id, count(*) AS n FROM doc_terms GROUP BY doc_id),
corpus AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
postings AS (
  SELECT doc_id, term, count(*) AS tf FROM doc_terms WHERE term IN (SELECT term FROM item_terms) GROUP BY doc_id, term
),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * max(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM postings, corpus GROUP BY term
),
impacts AS (
  SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // total)) AS impact
  FROM postings JOIN sizes USING (doc_id), corpus
),
scored AS (
  SELECT item_id, doc_id, CAST(sum(q * w * impact) AS BIGINT) AS score
  FROM item_terms JOIN weights USING (term) JOIN impacts USING (term) GROUP BY item_id, doc_id
),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    """The queries that DuckDB's SQL can express.  It has no look-behind (op1),
    none of the tokenizers (op2, op6, op9, pipeline), chunk hashes (op3), XXH64
    (op4), FP-growth (op7) or fitted machines (op10)."""
    return {"op5_line_dedup": _LINE_SQL, "op8_warc": _WARC_SQL, "op11_turn_repair": _REPAIR_SQL, "op12_ranked_search": _RANKED_SQL}
