"""WARC archives without repeated payloads.

Headers (id, payload length, payload digest) are shuffled by digest; of records with equal payloads of
at least ``LEAST`` bytes the one with the largest id is the response, and the others become revisit
records that refer to it. Archives are written with fresh headers by Spark's text writer, whose line
separator is the end of a WARC record, so that its commit protocol covers lost tasks. Each file is one
gzip member with a bounded number of records. Reading goes by Content-Length, never by separators.

Defined cases: a null payload is an empty one; a null URL is written as ``about:blank``; blanks and
control characters in a URL are percent-encoded; a null id ranks below every other id, and a group
without any id has responses only; rows that tie for the largest id are all responses; an empty table
gives archives without records; further columns are not looked at.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.llm import common
from layerwright.session import cut_lineage, fresh_path

#: Payload bytes from which a repeated payload is written once.
LEAST = 1000
#: Records in one archive file.
RECORDS_PER_FILE = 4000

END = "\r\n"
RECORD_END = END + END
_ID = "<tag:layerwright,2025:page/"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def headers(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Per page its id, payload length and digest, and the key that names the row."""
    payload = common.text_or_empty(html)
    return pages.select(
        F.col(page_id).alias("page_id"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("payload_digest"),
        common.row_key(F.col(page_id), payload).alias("row_key"),
    )


def revisits(found: DataFrame, least: int = LEAST) -> DataFrame:
    """Of the headers those that become revisit records, with the id of their response."""
    originals = cut_lineage(
        found.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 AND original IS NOT NULL")
        .drop("copies")
    )
    return (
        found.join(originals, "payload_digest")
        .where(~F.col("page_id").eqNullSafe(F.col("original")))
        .select("row_key", "original")
    )


def record_id(page_id: Column) -> Column:
    named = F.coalesce(F.url_encode(page_id.cast("string")), F.lit(""))
    return F.concat(F.lit(_ID), named, F.lit(">"))


def _page_of(identifier: str, kind) -> Column:
    named = F.substring_index(F.substring_index(F.col(identifier), _ID, -1), ">", 1)
    return F.url_decode(F.nullif(named, F.lit(""))).cast(kind)


def _lines(*fields: tuple[str, Column | str]) -> Column:
    parts = []
    for name, value in fields:
        parts += [F.lit(name), F.lit(value) if isinstance(value, str) else value, F.lit(END)]
    return F.concat(*parts, F.lit(END))


def write(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = LEAST,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write one record per page to a new folder, repeated payloads as revisit records."""
    found = cut_lineage(headers(pages, page_id, html))
    again = cut_lineage(revisits(found, least).dropDuplicates(["row_key"]))
    payload = common.text_or_empty(html)
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.regexp_replace(F.coalesce(F.col(url), F.lit("about:blank")), "[\\x00-\\x20\\x7F]", "%20").alias(
            "url"
        ),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
        common.row_key(F.col(page_id), payload).alias("row_key"),
    ).join(again, "row_key", "left")
    http = _lines(
        ("HTTP/1.1 200 OK", ""),
        ("Content-Type: ", "text/html; charset=utf-8"),
        ("Content-Length: ", F.octet_length("payload").cast("string")),
    )
    new = F.col("original").isNull()
    block = F.concat(http, F.when(new, F.col("payload")).otherwise(""))
    kind = F.when(
        new, F.concat(F.lit("response"), F.lit(END))
    ).otherwise(
        F.concat(
            F.lit(f"revisit{END}WARC-Profile: {_PROFILE}{END}WARC-Refers-To: "),
            record_id(F.col("original")),
            F.lit(END),
        )
    )
    now = F.date_format(F.to_utc_timestamp(F.now(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    head = F.concat(
        F.lit(f"WARC/1.1{END}WARC-Type: "),
        kind,
        _lines(
            ("WARC-Record-ID: ", record_id(F.col("page_id"))),
            ("WARC-Date: ", now),
            ("WARC-Target-URI: ", F.col("url")),
            ("WARC-Payload-Digest: sha1:", F.col("digest")),
            ("Content-Type: ", "application/http; msgtype=response"),
            ("Content-Length: ", F.octet_length("block").cast("string")),
        ),
    )
    (
        rows.withColumn("block", block)
        .select(F.concat(head, F.col("block")).alias("value"))
        .write.option("lineSep", RECORD_END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


def parse(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of one archive."""
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("the archive ends within a record")
        yield fields, block


RECORD = (
    "record_id string, record_type string, refers_to_id string, target_uri string, "
    "declared_digest string, payload binary"
)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives in a folder; the payload of a revisit record is null."""
    common.importable(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    names = RECORD.replace(",", "").split()[::2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for fields, block in parse(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer()))):
                    new = fields["warc-type"] == "response"
                    rows.append(
                        (
                            fields["warc-record-id"],
                            fields["warc-type"],
                            fields.get("warc-refers-to"),
                            fields.get("warc-target-uri"),
                            fields.get("warc-payload-digest", "").removeprefix("sha1:"),
                            block.partition(b"\r\n\r\n")[2] if new else None,
                        )
                    )
                    size += len(block)
                    if size > 8_000_000:
                        yield _batch(rows, names)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, names)

    return files.mapInArrow(run, RECORD)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.string()] * 5 + [pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows), types)], names
    )


def resolve(records: DataFrame, columns: list[str]) -> DataFrame:
    """Records with the named columns of their response, for a revisit those of the one it refers to."""
    asked = records.select(
        *[c for c in records.columns if c not in columns],
        F.coalesce("refers_to_id", "record_id").alias("response_id"),
    )
    responses = records.where("record_type = 'response'").select(
        F.col("record_id").alias("response_id"), *columns
    )
    return asked.join(cut_lineage(responses.dropDuplicates(["response_id"])), "response_id", "left")


def round_trip(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Write the pages to archives in the shared folder, read them back and resolve the revisits.

    Per page: page_id, payload_bytes and payload_digest of the payload as read, record_type, refers_to.
    """
    spark = pages.sparkSession
    folder = fresh_path(spark, "warc")
    write(pages, folder, page_id, url, html)
    records = cut_lineage(
        read(spark, folder).select(
            "record_id",
            "record_type",
            "refers_to_id",
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.sha1("payload").alias("payload_digest"),
        )
    )
    kind = pages.schema[page_id].dataType
    revisited = resolve(
        records.where("record_type = 'revisit'").unionByName(records.where(_original(records))),
        ["payload_bytes", "payload_digest"],
    ).where("record_type = 'revisit'")
    return (
        records.where("record_type = 'response'")
        .unionByName(revisited.drop("response_id"))
        .select(
            _page_of("record_id", kind).alias("page_id"),
            "payload_bytes",
            "payload_digest",
            "record_type",
            _page_of("refers_to_id", kind).alias("refers_to"),
        )
    )


def _original(records: DataFrame) -> Column:
    """Responses that a revisit record can refer to."""
    return (F.col("record_type") == "response") & (F.col("payload_bytes") >= LEAST)
