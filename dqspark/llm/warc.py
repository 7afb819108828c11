"""A content-addressed web archive.

Payloads are stored once, under their SHA-256; exact record headers are
stored apart, one row per record.  Reading joins them back into the original
records and checks every payload against both of its digests.  Two payloads
under one digest would have to differ in SHA-1 or length too, or writing stops.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import F, keep, materialize_counted, only, scratch_path, sql_type

# The record's layout (WARC 1.1).
#   version line, then named fields, each ended by CR LF; an empty line; the block; two empty lines
VERSION = "WARC/1.1"
CRLF = "\r\n"
SHARED_ROWS = 500_000  # digests of several records that are broadcast (about 60 bytes each); more are joined by shuffle
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rec_id, url) with the payload's length, SHA-256 and SHA-1 (base32)."""
    for b in batches:
        data = [x or b"" for x in b.column(2).to_pylist()]
        facts = [pa.array(list(map(len, data)), pa.int64()), pa.array([hashlib.sha256(d).digest() for d in data], pa.binary()), pa.array([base64.b32encode(hashlib.sha1(d).digest()).decode() for d in data], pa.string())]
        yield pa.RecordBatch.from_arrays([*b.columns[:2], *facts], names=["rec_id", "url", "payload_bytes", "sha256", "sha1"])


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", min_revisit_bytes: int = 0, written_at: str | None = None) -> None:
    """One record per row of ``pages``; payload: the body in UTF-8 (null: empty).

    Of records with equal payloads of at least ``min_revisit_bytes``, the one
    with the largest id is the response and the others revisit it; shorter
    payloads are responses each.  Rows with a null id are responses, too, and
    never referred to; equal ids with equal payloads are one response and
    revisits of that id.  A null url leaves the target field out; a null id is
    named by a hash of url, digest and place.  ``written_at`` (None: now) dates
    the records.  Writes ``folder/payloads`` (sha256, payload) and
    ``folder/headers``.
    """
    src = only(pages, rec_id=id_col, url=url_col, body=body_col)
    kind = sql_type(src, "rec_id")
    src = src.select("rec_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("body").cast("string").cast("binary"), F.lit(b"")).alias("body"))
    rows = keep(src.mapInArrow(_digests, f"rec_id {kind}, url string, payload_bytes bigint, sha256 binary, sha1 string"), "warc-digests")

    facts = rows.groupBy("sha256").agg(F.count(F.lit(1)).alias("rows"), F.max("rec_id").alias("response_id"), F.min("sha1").alias("sha1"), F.max("sha1").alias("sha1_max"), F.min("payload_bytes").alias("n"), F.max("payload_bytes").alias("n_max"))
    same = (F.col("sha1") == F.col("sha1_max")) & (F.col("n") == F.col("n_max"))
    facts = facts.withColumn("verified", F.when(same, F.lit(True)).otherwise(F.raise_error(F.lit("different payloads under one SHA-256")).cast("boolean")))
    # repeated ids first, dealt by digest and id: a hot payload's rows are many keys there.
    # Only digests of several records are met again; a hot one's rows are joined by
    # broadcast, or by a join that Spark can split
    ranked = rows.select("rec_id", "url", "payload_bytes", "sha256", "sha1", (F.row_number().over(_same_id()) > 1).alias("twin"))
    several, n = materialize_counted(facts.filter("rows > 1").select("sha256", "response_id", "verified"), "warc-several")
    heads = ranked.join(F.broadcast(several) if n <= SHARED_ROWS else several, "sha256", "left")
    revisit = (F.col("payload_bytes") >= min_revisit_bytes) & F.col("rec_id").isNotNull() & F.col("verified") & ((F.col("rec_id") < F.col("response_id")) | F.col("twin"))
    heads = heads.withColumn("revisit", F.coalesce(revisit, F.lit(False))).withColumn("refers_to", F.when(F.col("revisit"), F.col("response_id")))
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit(CRLF))
    uuid = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    text = F.concat(
        F.lit(VERSION + CRLF),
        line("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.coalesce(uuid(F.col("rec_id")), F.concat(F.lit("<urn:unnamed:"), F.hex(F.xxhash64("url", "sha256", F.monotonically_increasing_id())), F.lit(">")))),
        line("WARC-Date", F.date_format(F.current_timestamp() if written_at is None else F.lit(written_at).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.coalesce(line("WARC-Target-URI", F.regexp_replace("url", "[\r\n]", " ")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(F.col("revisit"), F.concat(line("WARC-Refers-To", uuid(F.col("refers_to"))), F.lit(f"WARC-Profile: {REVISIT_PROFILE}{CRLF}"))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(F.col("revisit"), F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
        F.lit(CRLF),
    )
    heads.select("rec_id", "sha256", text.cast("binary").alias("header")).write.parquet(f"{folder}/headers")
    # the store: the bytes of one row of each digest, the largest id's.  Rows meet
    # under a hash of id and digest: the copies of a hot payload are not brought
    # together, and one shuffle of the payloads serves the join and the choice
    # among equal rows.  Reading checks every payload against its digests.
    spot = lambda rec_id, digest: F.xxhash64(rec_id, digest).alias("spot")
    best = facts.filter("verified").select(spot(F.col("response_id"), F.col("sha256")), "sha256")
    bodies = src.select("rec_id", F.unhex(F.sha2("body", 256)).alias("sha256"), F.col("body").alias("payload"))
    chosen = bodies.select(spot(F.col("rec_id"), F.col("sha256")), "sha256", "payload").join(best, ["spot", "sha256"], "left_semi")
    chosen.dropDuplicates(["spot", "sha256"]).select("sha256", "payload").write.parquet(f"{folder}/payloads")


def _same_id():
    from pyspark.sql import Window

    return Window.partitionBy("sha256", "rec_id").orderBy("url")


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Payload facts, recomputed from the stored bytes; stops if they don't belong to their address."""
    for b in batches:
        sha, n, b32 = [], [], []
        for key, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if hashlib.sha256(data).digest() != key:
                raise ValueError("a stored payload does not have its SHA-256")
            sha.append(key)
            n.append(len(data))
            b32.append(base64.b32encode(hashlib.sha1(data).digest()).decode())
        yield pa.RecordBatch.from_arrays([pa.array(sha, pa.binary()), pa.array(n, pa.int64()), pa.array(b32, pa.string())], names=["sha256", "payload_bytes", "payload_digest"])


def _field(name: str):
    """A named field of ``header``, null if it has none.  Values hold no line ends, so
    a field begins behind one."""
    return F.nullif(F.regexp_extract(F.col("header").cast("string"), rf"\n{name}: ([^\r\n]*)\r\n", 1), F.lit(""))


def _lost(kind: str):
    return F.raise_error(F.concat(F.lit("no payload in the store for SHA-256 "), F.hex("sha256"))).cast(kind)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """(rec_id, record binary, refers_to_address): the original records, header and
    block; a revisit's block is empty, as it was written."""
    heads = spark.read.parquet(f"{folder}/headers")
    store = spark.read.parquet(f"{folder}/payloads")
    block = F.when(_field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.coalesce(F.col("payload"), _lost("binary")))
    return heads.join(store, "sha256", "left").select("rec_id", F.concat("header", block, F.lit((CRLF * 2).encode())).alias("record"))


def read_archive(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    """(rec_id, payload_bytes, payload_digest, record_type, refers_to) from the files:
    type and reference parsed from each header, bytes and digest from the stored
    payload, which is verified and must have the digest that the header names."""
    heads = spark.read.parquet(f"{folder}/headers")
    store = spark.read.parquet(f"{folder}/payloads").select("sha256", "payload")
    facts = store.mapInArrow(_verify, "sha256 binary, payload_bytes bigint, payload_digest string")
    parsed = heads.select(
        "rec_id",
        "sha256",
        _field("WARC-Type").alias("record_type"),
        F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "").alias("named"),
        F.regexp_extract(F.coalesce(_field("WARC-Refers-To"), F.lit("")), "<urn:page:(.*)>", 1).alias("ref"),
    )
    out = parsed.join(facts, "sha256", "left").withColumn("payload_digest", F.coalesce("payload_digest", _lost("string")))
    digest = F.when(F.col("named") == F.col("payload_digest"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("a header's digest is not its payload's")))
    return out.select("rec_id", "payload_bytes", digest.alias("payload_digest"), "record_type", F.when(F.col("ref") != "", F.col("ref")).cast(id_type).alias("refers_to"))


def archive_and_read(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to a fresh archive in the shared folder and read it back."""
    folder = scratch_path(pages.sparkSession, "warc")
    write_archive(pages, folder, **options)
    return read_archive(pages.sparkSession, folder, sql_type(pages, options.get("id_col", "page_id")))
