"""Content-addressed WARC archive.

A record is a header block, an empty line, a payload and two line ends. The
archive keeps both apart: ``payloads`` holds the bytes of each payload once, under
its SHA-256, and ``headers`` the exact header bytes of every record with that
digest. Joining them gives the original records back byte for byte. Digests are
computed again from the stored bytes: a payload that does not have its digest, or that is
missing where a record holds it, stops the read.

Records that repeat a payload of some size are ``revisit`` records that refer to
the one kept. Payload copies of one task are merged before their bytes move.

Archives go in and out as WARC files. Reading cuts a file, in splits if it is not compressed, where a
record may begin, and checks every piece against its Content-Length; only files where that does not fit,
as where a payload holds a record itself, are read again from their start by the lengths.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm.common import scratch

#: Payloads below this many bytes are never revisits.
MIN_REVISIT = 100
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_END = "\r\n\r\n"
#: How a record begins, and bytes of records a file aims at.
VERSION, FILE_BYTES = "WARC/1.", 1 << 26
#: Date of records whose capture time is not known.
NO_DATE = "1970-01-01T00:00:00Z"


@dataclass(frozen=True)
class Archive:
    headers: DataFrame
    payloads: DataFrame


def _pages(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))


def page_records(pages: DataFrame) -> DataFrame:
    """``(page_id, url, size, digest, refers_to)``: one record per page, nulls as empty payloads.

    ``refers_to`` is the smallest page_id with an equal payload, for payloads of
    at least ``MIN_REVISIT`` bytes and other pages than that one; else null. A
    null page_id never keeps a payload that another page could keep.
    """
    rows = _pages(pages).select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("size"))
    first = (
        rows.where(F.col("size") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    refers = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    return rows.join(first, "digest", "left").select("page_id", "url", "size", "digest", refers.alias("refers_to"))


def _uri(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))


def page_header(date: str = NO_DATE) -> Column:
    """Header bytes of a page's record: response, or revisit of the page it refers to."""
    revisit = F.col("refers_to").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _uri(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        # line ends in an address would end the header early
        line("WARC-Target-URI", F.regexp_replace("url", "[\r\n]", " ")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(
            revisit,
            F.concat(line("WARC-Refers-To", _uri(F.col("refers_to"))), line("WARC-Profile", F.lit(REVISIT_PROFILE))),
        ).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("size")).cast("string")),
        F.lit("\r\n"),
    ).cast("binary")


def store(headers: DataFrame, payloads: DataFrame, path: str) -> Archive:
    """Write an archive under ``path``.

    ``headers (record_id, header, digest, holds)`` has a row per record, ``holds``
    if the record itself contains its payload; ``payloads (digest, payload)`` may
    bring the same bytes any number of times, they are stored once.
    """
    headers.write.option("compression", "zstd").parquet(f"{path}/headers")
    once = payloads.groupBy("digest").agg(F.any_value("payload").alias("payload"))  # equal by their digest
    once.write.option("compression", "zstd").parquet(f"{path}/payloads")
    return open_archive(headers.sparkSession, path)


def open_archive(spark: SparkSession, path: str) -> Archive:
    return Archive(spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads"))


def verified(payloads: DataFrame) -> DataFrame:
    """``(digest, payload, payload_bytes)`` of ``payloads``; reading any of the last two checks the digest."""
    wrong = F.raise_error(F.concat(F.lit("payload does not have its digest "), F.col("digest")))
    right = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(wrong.cast("binary"))
    return payloads.select("digest", right.alias("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))


def rebuild(archive: Archive) -> DataFrame:
    """``(record_id, header, digest, holds, payload, payload_bytes, record)`` of every record.

    ``payload`` is the full payload, of revisits too; ``record`` the exact bytes of the original record. A
    record that holds a payload the archive has lost stops the read. A revisit of a payload that was never
    in the archive has none; its record is whole without. A repeated header gives its record again.
    """
    lost = F.raise_error(F.concat(F.lit("payload is missing: "), F.col("digest"))).cast("binary")
    rows = archive.headers.join(verified(archive.payloads), "digest", "left")
    rows = rows.withColumn("payload", F.when(F.col("payload").isNull() & F.col("holds"), lost).otherwise(F.col("payload")))
    body = F.when(F.col("holds"), F.col("payload")).otherwise(F.lit("").cast("binary"))
    return rows.withColumn("record", F.concat("header", body, F.lit(RECORD_END).cast("binary")))


def field(header: Column, name: str) -> Column:
    """Value of a header line; empty if the header has none."""
    return F.trim(F.regexp_extract(header.cast("string"), rf"(?im)^{re.escape(name)}:([^\r\n]*)", 1))


def write_files(archive: Archive, path: str, file_bytes: int = FILE_BYTES, compression: str = "none") -> None:
    """WARC files of an archive's records, each of about ``file_bytes`` before ``compression``.

    Records move only to meet their payload; a file ends after as many records as its bytes hold on average.
    Compression is that of whole files; only plain ones are read in splits. No records give no files.
    """
    length = F.regexp_extract(F.col("header").cast("string"), r"(?i)\r\ncontent-length: *([0-9]+)", 1).cast("long")
    sums = archive.headers.agg(F.sum(length + F.octet_length("header") + len(RECORD_END)).alias("size"), F.count("*").alias("n")).first()
    each = max(1, sums["n"] * file_bytes // max(1, sums["size"] or 0))
    body = F.expr(f"substring(record, 1, octet_length(record) - {len(RECORD_END)})").cast("string")
    writer = rebuild(archive).select(body.alias("value")).write.option("maxRecordsPerFile", each)
    writer.option("lineSep", RECORD_END).option("compression", compression).text(path)


_RECORD = "file string, header binary, payload binary, digest string, holds boolean"


def _fields(header: bytes) -> dict[bytes, bytes]:
    lines = header.split(b"\r\n")[1:]
    return {k.lower().strip(): v.strip() for k, _, v in (x.partition(b":") for x in lines if b":" in x)}


def _by_length(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records of whole files, found by their lengths alone."""
    import hashlib

    for frame in batches:
        for name, data in zip(frame["path"], frame["content"]):
            if data[:2] == b"\x1f\x8b":
                data = gzip.decompress(data)
            rows, at = [], 0
            while at < len(data):
                end = data.find(b"\r\n\r\n", at) + 4
                fields = _fields(data[at:end]) if end > 3 else {}
                if b"content-length" not in fields or not data.startswith(VERSION.encode(), at):
                    raise ValueError(f"{name}: no record at byte {at}")
                size = int(fields[b"content-length"])
                payload = data[end : end + size]
                if len(payload) < size or data[end + size : end + size + 4] != RECORD_END.encode():
                    raise ValueError(f"{name}: record at byte {at} is cut off")
                holds = fields.get(b"warc-type") != b"revisit"
                known = fields.get(b"warc-payload-digest", b"").decode().partition(":")[2]
                rows.append((name, data[at:end], payload, hashlib.sha256(payload).hexdigest() if holds else known, holds))
                at = end + size + 4
            yield pd.DataFrame(rows, columns=["file", "header", "payload", "digest", "holds"])


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``(file, header, payload, digest, holds)`` of every record of WARC files, plain or gzipped.

    ``digest`` is that of the payload read; of a revisit that of its header. Files that are damaged or cut off
    stop the read. Files are read record by record; one whose payloads hold beginnings of records is
    read whole by one task.
    """
    begin = RECORD_END + VERSION
    pieces = spark.read.option("lineSep", begin).text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    whole = F.when(F.startswith("value", F.lit(VERSION)), F.col("value")).otherwise(F.concat(F.lit(VERSION), "value"))
    head = F.concat(F.substring_index("value", RECORD_END, 1), F.lit(RECORD_END)).cast("binary")
    rows = (
        pieces.select("file", whole.alias("value"))
        .select("file", head.alias("header"), F.col("value").cast("binary").alias("value"))
        .withColumn("size", F.expr("try_cast(regexp_extract(cast(header as string), '(?i)\r\ncontent-length: *([0-9]+)', 1) as bigint)"))
    )
    rest = F.octet_length("value") - F.octet_length("header") - F.col("size")
    # the last record of a file still has its end
    ended = F.expr("substring(value, -4, 4)") == F.lit(RECORD_END).cast("binary")
    fits = F.coalesce((rest == 0) | ((rest == len(RECORD_END)) & ended), F.lit(False))
    # files whose payloads hold beginnings of records, or that are damaged
    again = [r["file"] for r in rows.where(~fits).select("file").distinct().collect()]
    plain = rows.where(~F.col("file").isin(again)) if again else rows
    holds = field(F.col("header"), "WARC-Type") != "revisit"
    payload = F.expr("substring(value, cast(octet_length(header) + 1 as int), cast(size as int))")
    known = F.substring_index(field(F.col("header"), "WARC-Payload-Digest"), ":", -1)
    read = plain.select("file", "header", payload.alias("payload"), holds.alias("holds")).select(
        "file", "header", "payload", F.when(F.col("holds"), F.sha2("payload", 256)).otherwise(known).alias("digest"), "holds"
    )
    if not again:
        return read
    files = spark.read.format("binaryFile").load(again).select("path", "content")
    return read.unionByName(files.mapInPandas(_by_length, _RECORD))


def archive_pages(pages: DataFrame) -> Archive:
    """The archive of a page table, in the shared folder.

    A null url or html is empty, repeated rows are records of their own with the
    same payload (those beyond the first with a smaller page_id are revisits; rows
    that share the smallest page_id are all responses). An empty table gives an
    empty archive; other columns are not kept.
    """
    headers = page_records(pages).select(
        F.coalesce(F.col("page_id").cast("string"), F.lit("null")).alias("record_id"),
        page_header().alias("header"),
        "digest",
        F.col("refers_to").isNull().alias("holds"),
    )
    return store(headers, _pages(pages).select("digest", "payload"), scratch(pages.sparkSession, "warc"))
