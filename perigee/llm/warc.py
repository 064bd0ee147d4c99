"""WARC archives: write captures, read records back, and assemble transactions.

A capture is three records: request, response (or revisit) and metadata, where the first and
last name the second in WARC-Concurrent-To. Of captures with equal payloads one is the
response, that with the largest page_id; the others are revisits that refer to it.

Writing is one scan: records are composed by SQL expressions, equal payloads meet as digests
(combined before the shuffle), and Spark's text writer puts the records, ended as WARC asks for,
into gzipped files of bounded size in a folder that all executors share. Reading parses each
file by the records' lengths. Records of a capture meet by a three-row aggregation.

Record ids are <urn:page:ID#ROW>, where ROW tells captures of one page apart; a revisit refers
to <urn:page:ID>.

Defined results. Null html: an empty payload. Null url: no WARC-Target-URI. Null page_id: kept,
smallest in comparisons. Rows repeating both page_id and payload are equal captures, all of the
same type. An empty table gives an archive without records and an empty result. Extra columns
are ignored. Payloads of any length are kept whole.
"""

from __future__ import annotations

import base64
import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Records in one file at most; files are read as a whole.
RECORDS_PER_FILE = 3000
END = "\r\n\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def base32_of_hex(digest: Column) -> Column:
    """The base32 form of a SHA-1 given in hex: every five hex digits are four characters."""
    def letter(i):
        group = F.conv(F.substr(digest, F.floor(i / 4).cast("int") * 5 + 1, F.lit(5)), 16, 10).cast("int")
        shifted = F.floor(group / F.pow(F.lit(2), 15 - 5 * (i % 4))).cast("int")
        return F.substr(F.lit(_BASE32), shifted % 32 + 1, F.lit(1))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), letter), "")


def _record(kind: str | Column, record_id: Column, block: Column, content_type: str, *headers: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: <"), record_id, F.lit(">")),
        F.concat(F.lit("WARC-Date: "), F.col("date")), F.concat(F.lit("WARC-Target-URI: "), F.col("uri")), *headers,
        F.lit(f"Content-Type: {content_type}"), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def captures(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """page_id, url, html, digest (hex), size and refers_to (page_id of the response, for revisits)."""
    given = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    )
    keyed = given.withColumn("digest", F.sha1("html")).withColumn("size", F.octet_length("html").cast("long"))
    same = (
        keyed.where(F.col("size") >= revisit_from).groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.min("page_id").alias("other"), F.count("page_id").alias("known"), F.count(F.lit(1)).alias("rows"))
        .where("first <> other or known < rows").select("digest", "first")
    )
    return keyed.join(same, "digest", "left").withColumn("refers_to", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))).drop("first")


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", revisit_from: int = 0) -> None:
    """Write a capture per row of ``pages`` (page_id, url, html) as gzipped WARC files into ``path``."""
    rows = captures(pages, revisit_from).select(
        "html", "size", "refers_to", base32_of_hex(F.col("digest")).alias("digest"), F.lit(date).alias("date"),
        F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("uri"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("none")).alias("page"),
        F.monotonically_increasing_id().cast("string").alias("row"),
    )
    main = F.concat(F.lit("urn:page:"), F.col("page"), F.lit("#"), F.col("row"))
    concurrent = F.concat(F.lit("WARC-Concurrent-To: <"), main, F.lit(">"))
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"))
    again = F.col("refers_to").isNotNull()
    head = F.concat(F.lit(_HTTP), F.col("size").cast("string"), F.lit(END))
    refers = F.when(again, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))
    profile = F.when(again, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    host = F.coalesce(F.regexp_extract("uri", r"^[a-z]+://([^/?#]*)", 1), F.lit(""))
    asked = F.coalesce(F.regexp_extract("uri", r"^[a-z]+://[^/?#]*([^#]*)", 1), F.lit(""))
    request = F.concat(F.lit("GET "), F.when(asked == "", F.lit("/")).otherwise(asked), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END))
    fields = F.concat(F.lit("payload-bytes: "), F.col("size").cast("string"), F.lit("\r\n"))
    records = F.array(
        _record("request", F.concat(main, F.lit(":request")), request, "application/http; msgtype=request", concurrent),
        _record(F.when(again, "revisit").otherwise("response"), main, F.when(again, head).otherwise(F.concat(head, F.col("html"))),
                "application/http; msgtype=response", digest, refers, profile),
        _record("metadata", F.concat(main, F.lit(":metadata")), fields, "application/warc-fields", concurrent),
    )
    out = rows.select(F.explode(records).alias("value"))
    out.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse(archive: bytes):
    """(headers, block) of every record of an uncompressed archive, by the records' lengths."""
    at = 0
    while at < len(archive):
        stop = archive.index(b"\r\n\r\n", at)
        version, *lines = archive[at:stop].decode("utf-8").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        begin = stop + 4
        end = begin + int(headers["content-length"])
        if archive[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} doesn't end where its length says")
        yield headers, archive[begin:end]
        at = end + 4


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record: capture, kind, record_id, uri, digest, size, refers_to, and the payload if asked for.

    digest and size are computed from a response's payload; a revisit has the recorded digest,
    metadata the recorded size.
    """
    schema = pa.schema([("capture", pa.string()), ("kind", pa.string()), ("record_id", pa.string()), ("uri", pa.string()),
                        ("digest", pa.string()), ("size", pa.int64()), ("refers_to", pa.string()), ("payload", pa.binary())])

    def row(headers, block):
        kind, record_id = headers["warc-type"], headers["warc-record-id"].strip("<>")
        capture = headers.get("warc-concurrent-to", headers["warc-record-id"]).strip("<>")
        digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
        size = payload = None
        if kind == "response":
            payload = block[block.index(b"\r\n\r\n") + 4 :]
            digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
        elif kind == "metadata":
            fields = dict(x.split(": ", 1) for x in block.decode("utf-8").splitlines())
            size = int(fields["payload-bytes"])
        refers = headers.get("warc-refers-to")
        return capture, kind, record_id, headers.get("warc-target-uri"), digest, size, refers and refers.strip("<>"), payload if payloads else None

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = [row(*r) for r in parse(gzip.decompress(content.as_py()))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, "capture string, kind string, record_id string, uri string, digest string, size long, refers_to string, payload binary")


def transactions(records: DataFrame) -> DataFrame:
    """One row per capture: page_id, uri, and the request, response (or revisit) and metadata records as structs."""
    def part(*kinds):
        wanted = F.struct("kind", "record_id", "digest", "size", "refers_to", "payload")
        return F.max(F.when(F.col("kind").isin(*kinds), wanted))

    page = F.regexp_extract("capture", r"^urn:page:(-?\d+)#", 1)
    return records.groupBy("capture").agg(
        F.max("uri").alias("uri"), part("request").alias("request"), part("response", "revisit").alias("response"), part("metadata").alias("metadata")
    ).select(F.when(page != "", page).cast("long").alias("page_id"), "uri", "request", "response", "metadata")
