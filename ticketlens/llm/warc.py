"""WARC archives with resolved revisits, on native expressions only.

Records with equal payloads are found by their headers: (page, payload digest,
payload length) is all that is grouped. Of each group the page with the
largest id keeps its payload as a ``response`` record, the others become
``revisit`` records that refer to it. Groups of one page, by far the most,
need no decision, so the table of decisions holds repeated payloads only; it
is written to the shared folder and the join reads it from there, so that
Spark may broadcast it if it is small and otherwise split a payload that many
pages share over several tasks.

Archives are written by Spark's text writer, one row for each record and the
blank lines that end a record as the line separator, so that tasks that are
repeated leave one result, on any store that Spark reaches. Like the parts of
a MIME message, records begin with a boundary line that is drawn anew for each
set of archives (here an extension field, which WARC allows): it is no part
of any payload, so the reader splits on it and payloads stay what they are,
byte for byte.

Defined cases: null html is the empty payload; a null url gives no target
field; line ends in a url are percent-encoded; repeated rows give a record
each, and all those with the group's largest page id are responses; rows
without a page id always are responses and never referred to; an empty table
gives empty archives. Extra columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import scratch_path, written

VERSION = "WARC/1.1"
END = "\r\n\r\n"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: four times 40 bits as 8 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), _DIGITS, _BASE32)


def captures(pages: DataFrame) -> DataFrame:
    """Page id, url, payload, its digest and its length in bytes."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
    ).select(
        "*",
        base32_sha1(F.col("payload").cast("binary")).alias("digest"),
        F.octet_length("payload").cast("long").alias("bytes"),
    )


def originals(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Digest, length and largest page id of each payload that several records have."""
    return (
        headers.where(F.col("bytes") >= min_bytes)
        .groupBy("digest", "bytes")
        .agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
        .where("n > 1 AND original IS NOT NULL")
        .select("digest", "bytes", "original")
    )


def resolved(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Captures with ``original``: the page whose record they revisit, or null."""
    found = written(originals(captures(pages).select("page_id", "digest", "bytes"), min_bytes), "originals")
    return (
        captures(pages)
        .join(found, ["digest", "bytes"], "left")
        .withColumn("original", F.expr("CASE WHEN original <> page_id THEN original END"))
    )


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def records(captured: DataFrame, boundary: str) -> DataFrame:
    """``record_type`` and ``value``, the record's text without the end that the writer adds."""
    original, url = F.col("original"), F.col("url")
    revisit = original.isNotNull()

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(name + ": "), value, F.lit("\r\n"))

    one_line = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    kind = F.when(revisit, "revisit").otherwise("response")
    header = F.concat(
        F.lit(f"{VERSION}\r\nX-Boundary: {boundary}\r\n"),
        field("WARC-Type", kind),
        field("WARC-Record-ID", _record_id(F.col("page_id"))),
        field("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.when(url.isNull(), "").otherwise(field("WARC-Target-URI", one_line)),
        F.when(
            revisit,
            F.concat(
                field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                field("WARC-Refers-To", _record_id(original)),
            ),
        ).otherwise(""),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        field("Content-Type", F.lit("text/html; charset=utf-8")),
        field("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string")),
    )
    body = F.when(revisit, "").otherwise(F.col("payload"))
    return captured.select(kind.alias("record_type"), F.concat(header, F.lit("\r\n"), body).alias("value"))


def write_archives(captured: DataFrame, path: str | None = None, compression: str = "gzip") -> tuple[str, str]:
    """Write resolved captures as archives; return their folder and boundary."""
    path = path or scratch_path(captured.sparkSession, "warc")
    boundary = uuid.uuid4().hex
    (
        records(captured, boundary)
        .write.partitionBy("record_type")
        .option("lineSep", END)
        .option("compression", compression)
        .text(path)
    )
    return path, boundary


def read_archives(spark: SparkSession, path: str, boundary: str) -> DataFrame:
    """Records of archives: the header's fields and the payload as it was."""
    start = f"{VERSION}\r\nX-Boundary: {boundary}\r\n"
    rows = (
        spark.read.schema("value string, record_type string")
        .option("lineSep", END + start)
        .text(path)
        # The first record of a file has its start, the last one its end.
        .select(F.when(F.startswith("value", F.lit(start)), F.substring("value", len(start) + 1, 2**31 - 1)).otherwise(F.col("value")).alias("value"))
        .where(F.col("value") != "")
        .select(F.substring_index("value", END, 1).alias("header"), "value")
    )

    def field(name: str, pattern: str) -> Column:
        return F.regexp_extract("header", rf"(?:^|\n){name}: {pattern}", 1)

    length = field("Content-Length", r"(\d+)").cast("long")
    rest = F.expr("substring(CAST(value AS BINARY), octet_length(header) + 5)")
    return rows.select(
        field("WARC-Record-ID", r"<urn:page:(-?\d+)>").alias("page"),
        field("WARC-Type", r"(\w+)").alias("record_type"),
        field("WARC-Payload-Digest", r"sha1:(\w+)").alias("payload_digest"),
        field("WARC-Refers-To", r"<urn:page:(-?\d+)>").alias("refers"),
        field("WARC-Target-URI", r"([^\r\n]*)").alias("url"),
        length.alias("length"),
        F.substring(rest, F.lit(1), length.cast("int")).alias("payload"),
    ).select(
        F.expr("CASE WHEN page <> '' THEN CAST(page AS BIGINT) END").alias("page_id"),
        "record_type",
        "payload_digest",
        F.expr("CASE WHEN refers <> '' THEN CAST(refers AS BIGINT) END").alias("refers_to"),
        F.expr("CASE WHEN url <> '' THEN url END").alias("url"),
        "length",
        "payload",
    )


def inventory(spark: SparkSession, path: str, boundary: str) -> DataFrame:
    """One row per record read back; revisits take length and digest of the response they refer to.

    Digest and length of responses are those of the payload that was read,
    not those that its header claims.
    """
    found = read_archives(spark, path, boundary)
    responses = found.where("record_type = 'response'").select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    referred = (
        found.where("record_type = 'response'")
        .select(F.col("page_id").alias("refers_to"), F.col("length").alias("payload_bytes"), "payload_digest")
        .where("refers_to IS NOT NULL")
    )
    revisits = found.where("record_type = 'revisit'").select("page_id", "refers_to", "payload_digest", "record_type")
    # Repeated rows of an original are several equal responses; a revisit needs one of them.
    wanted = revisits.select("refers_to", "payload_digest").distinct()
    one = referred.join(wanted, ["refers_to", "payload_digest"], "left_semi").distinct()
    return responses.unionByName(
        revisits.join(one, ["refers_to", "payload_digest"]).select(
            "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
        )
    )


def deduplicated(pages: DataFrame, min_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Write the pages' archives, revisits resolved, and return what they hold."""
    return inventory(pages.sparkSession, *write_archives(resolved(pages, min_bytes), path))


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (
    SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS hex,
        CASE WHEN count(*) OVER (PARTITION BY payload) > 1 THEN max(page_id) OVER (PARTITION BY payload) END AS original
    FROM p
)
SELECT page_id, payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('{_BASE32}', CAST(
        (CAST('0x' || substr(hex, CAST((i // 8) * 10 + 1 AS BIGINT), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
    CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN original <> page_id THEN original END AS refers_to
FROM d
"""
