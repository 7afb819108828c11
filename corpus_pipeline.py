"""The corpus pipeline: from documents to packed training sequences.

Each stage calls one operator of ``dqspark.llm``, is written as Parquet to the
shared folder, and is read again as the next one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqspark.llm.common import keep, table, unused, without_ids
from dqspark.llm.decontaminate import contaminated
from dqspark.llm.langid import fit, held_out, identified
from dqspark.llm.linededup import OWN_DOCS, drop_lines
from dqspark.llm.packing import pack_documents
from dqspark.llm.simhash import drop_near_duplicates


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter, and null texts, go.
    Repeated rows are judged alike."""
    return identified(docs, fit(docs.filter(~held_out(F.col("doc_id")))))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines whose template recurs; ``n_chars`` counts anew."""
    out = drop_lines(docs, whole_rows=True, short_lines=True, own_docs=OWN_DOCS)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id; texts of
    one id that are no near-copies all stay, as do rows without an id."""
    return drop_near_duplicates(docs, shingle=3, bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.  Id and text together name a document: of
    one id's texts only those that hold an item go; null ids are judged alike."""
    key = unused(docs, "row_key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    found = contaminated(keyed, table(spark, sf_dir, "benchmark"), id_col=key).select("doc_id")
    return without_ids(keyed, found, key).drop(key)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of packed sequences."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

#: SQL can express neither the fitted machines nor the packing; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
