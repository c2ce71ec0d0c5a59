"""A content-addressed archive of WARC records.

Two tables make up an archive: ``payloads`` holds the bytes of every distinct payload once, zstd
compressed, under the SHA-256 of the bytes themselves, and ``headers`` holds each record's header block exactly as it stands in a WARC
file, with the payload's digest. Joining the two gives back every record byte for byte. A payload
that does not hash to its digest stops the read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import release
from tidemark.session import checkpoint_root

#: Payloads with fewer bytes are stored as full records however often they occur.
MIN_SHARED = 100
#: Fixed values of the WARC 1.1 format.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Header fields with line breaks would end the field; they are percent-encoded.
_URI = "replace(replace(coalesce(url, ''), '\\r', '%0D'), '\\n', '%0A')"


def records(pages: DataFrame, min_shared: int = MIN_SHARED) -> DataFrame:
    """(page_id, payload, digest, header): one record per row of ``pages``, before archiving.

    Of rows with equal payloads of at least ``min_shared`` bytes, those with the smallest page_id
    are responses and all others revisits that refer to it; null ids come last. Rows that share
    that smallest id are all responses, as each is the page itself. Null html is an empty payload.
    """
    rows = pages.selectExpr(
        "cast(page_id as bigint) as page_id", "url", "coalesce(html, '') as payload",
    ).selectExpr("*", "octet_length(payload) as bytes", "sha2(payload, 256) as digest")
    # Counted where the pages are read, so a payload that a third of them share is no hot key here.
    firsts = rows.filter(f"bytes >= {min_shared}").groupBy("digest").agg(
        F.min("page_id").alias("first_id")
    )
    typed = rows.join(firsts, "digest", "left").selectExpr(
        "*", "first_id is null or page_id <=> first_id as full"
    )
    return typed.selectExpr(
        "page_id", "payload", "digest",
        "concat('WARC/1.1\\r\\nWARC-Type: ', if(full, 'response', 'revisit'), "
        "'\\r\\nWARC-Record-ID: <urn:page:', coalesce(cast(page_id as string), ''), '>"
        "\\r\\nWARC-Target-URI: ', " + _URI + f", '\\r\\nWARC-Date: {DATE}"
        "\\r\\nWARC-Payload-Digest: sha256:', digest, "
        "'\\r\\nWARC-Payload-Length: ', bytes, "
        "if(full, '', concat('\\r\\nWARC-Refers-To: <urn:page:', first_id, '>"
        f"\\r\\nWARC-Profile: {PROFILE}')), "
        "'\\r\\nContent-Type: text/html; charset=utf-8\\r\\nContent-Length: ', "
        "if(full, bytes, 0), '\\r\\n\\r\\n') as header",
    )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = [press.compress(x.as_py().encode("utf-8", "surrogatepass"))
                  for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())],
                                         names=["digest", "packed"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (header, digest, packed) with the payload, held against its digest."""
    open_ = zstandard.ZstdDecompressor()
    for batch in batches:
        payloads = []
        for digest, packed in zip(batch.column(1), batch.column(2)):
            payload = open_.decompress(packed.as_py())
            if hashlib.sha256(payload).hexdigest() != digest.as_py():
                raise ValueError(f"payload does not match its digest: {digest}")
            payloads.append(payload.decode("utf-8", "surrogatepass"))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(payloads, pa.string())],
            names=["header", "digest", "payload"])


def write_archive(pages: DataFrame, path: str | None = None, min_shared: int = MIN_SHARED) -> str:
    """Write both tables under ``path`` (by default a new folder in the checkpoint folder)."""
    spark = pages.sparkSession
    path = path or f"{checkpoint_root(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    found = records(pages, min_shared)
    found.select("digest", "header").write.parquet(f"{path}/headers")
    payloads = pages.selectExpr("coalesce(html, '') as payload").selectExpr(
        "sha2(payload, 256) as digest", "payload"
    ).mapInArrow(_packed, "digest string, packed binary")
    payloads.dropDuplicates(["digest"]).write.parquet(f"{path}/payloads")
    release(spark)
    return path


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(header, digest, payload): every record with the full payload it has or refers to."""
    payloads = spark.read.parquet(f"{path}/payloads")
    return spark.read.parquet(f"{path}/headers").join(payloads, "digest", "left").selectExpr(
        "header", "digest",
        "coalesce(packed, raise_error(concat('payload is missing: ', digest))) as packed",
    ).mapInArrow(_unpacked, "header string, digest string, payload string")


def record_text(archive: DataFrame) -> DataFrame:
    """(record): the text of each record as it stands in a WARC file, revisits without payload."""
    return archive.selectExpr(
        "concat(header, if(header like '%\\nWARC-Type: response\\r%', payload, ''), '\\r\\n\\r\\n')"
        " as record"
    )


def export_warc(archive: DataFrame, path: str) -> None:
    """Plain WARC files, one per task, that any WARC reader can open."""
    record_text(archive).selectExpr("left(record, length(record) - 4) as value").write.option(
        "lineSep", "\r\n\r\n"
    ).text(path)


def field(name: str) -> str:
    """SQL text: one field of a header block, or null."""
    return f"nullif(regexp_extract(header, r'\\r\\n{name}: ([^\\r]*)\\r\\n', 1), '')"


def read_back(archive: DataFrame) -> DataFrame:
    """What the archive says of each page, parsed from its headers and payloads."""
    ids = {n: f"cast(nullif(regexp_extract({field(n)}, '<urn:page:(.*)>', 1), '') as bigint)"
           for n in ("WARC-Record-ID", "WARC-Refers-To")}
    return archive.selectExpr(
        f"{ids['WARC-Record-ID']} as page_id",
        "cast(octet_length(payload) as bigint) as payload_bytes",
        f"substring({field('WARC-Payload-Digest')}, 8) as payload_digest",
        f"{field('WARC-Type')} as record_type", f"{ids['WARC-Refers-To']} as refers_to",
        f"{field('WARC-Target-URI')} as url",
    )
