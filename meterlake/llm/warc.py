"""WARC archives: writing captures, reading them back, assembling transactions.

A capture is three records: the request, the response (or a revisit of an
earlier response with an equal payload) and metadata; request and metadata
name the response in WARC-Concurrent-To. Archives are gzip files written by
Spark's text sink, whose line separator is the two line ends that close a
record, and read through ``binaryFile``, so both ways work on any storage that
Spark reads. A record is parsed by its Content-Length, one at a time from the
unpacked stream.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import stage
from meterlake.session import observed

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Bytes of an archive file before compression, in the mean: it is read as one value.
FILE_BYTES = 24 << 20
# Bytes of a capture's three records besides payload and url.
HEADER_BYTES = 1_500
# Payloads that repeat, up to which their first captures are broadcast (about 30 MB).
BROADCAST_ROWS = 200_000
_FLUSH_BYTES = 4 << 20
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five bytes are eight digits."""
    h = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(h, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), HEX32, BASE32)


def _urn(kind: str, key: Column) -> Column:
    h = F.md5(F.concat(F.lit(kind + "|"), key))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in
                    ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _record(kind: Column | str, headers: list[tuple[str, Column | str | None]], block: Column) -> Column:
    """One record without the line ends that close it; null headers are left out."""
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind if isinstance(kind, Column) else F.lit(kind))]
    for name, v in headers:
        lines.append(F.concat(F.lit(name + ": "), v if isinstance(v, Column) else F.lit(v)))
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), block)


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", date: str = DATE) -> None:
    """Three records for each row, payload the html in UTF-8 (null: empty). Of
    rows with equal payloads the smallest id (nulls last) is the response;
    rows that share its id are responses too, all others revisit it. Rows that
    are alike in all columns write alike records."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.regexp_replace(F.regexp_replace(F.col(url_col), "\r", "%0D"), "\n", "%0A").alias("url"),
        payload.alias("payload"), F.sha2(payload, 256).alias("same"))
    own = F.concat_ws("|", F.coalesce(F.col("id").cast("string"), F.lit("-")), F.coalesce("url", F.lit("-")), F.col("same"))
    rows = rows.withColumn("own", own)
    first = F.min(F.struct(F.col("id").isNull().alias("n"), "id", "own")).alias("f")
    own_bytes = F.octet_length("payload") + 3 * F.coalesce(F.octet_length("url"), F.lit(0)) + HEADER_BYTES
    weighed = Observation("captures")
    rows_seen = rows.observe(weighed, F.count("*").alias("n"), F.sum(own_bytes).alias("bytes"))
    firsts = stage(rows_seen.groupBy("same").agg(first, F.count("*").alias("c")).filter("c > 1")
                   .select("same", F.col("f.id").alias("first_id"), F.col("f.own").alias("first_own")), "firsts")
    seen = observed(weighed)
    per_file = max(3, int(3 * FILE_BYTES * (seen.get("n") or 1) // max(seen.get("bytes") or 1, 1)))
    if firsts.count() <= BROADCAST_ROWS:
        firsts = F.broadcast(firsts)
    j = rows.join(firsts, "same", "left").withColumn(
        "again", F.col("first_own").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id")))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length("payload").cast("string"), F.lit(CRLF * 2))
    main, uri = _urn("response", F.col("own")), F.col("url")
    target = ("WARC-Target-URI", uri)
    host = F.coalesce(F.regexp_extract("url", "(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    at = F.coalesce(F.nullif(F.regexp_extract("url", "(?s)^.*?://[^/?#]*([^#]*)", 1), F.lit("")), F.lit("/"))
    request = _record("request", [
        ("WARC-Record-ID", _urn("request", F.col("own"))), ("WARC-Date", date), target, ("WARC-Concurrent-To", main),
        ("Content-Type", "application/http;msgtype=request")],
        F.concat(F.lit("GET "), at, F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(CRLF * 2)))
    response = _record(F.when(F.col("again"), "revisit").otherwise("response"), [
        ("WARC-Record-ID", main), ("WARC-Date", date), target,
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))),
        ("WARC-Refers-To", F.when(F.col("again"), _urn("response", F.col("first_own")))),
        ("WARC-Profile", F.when(F.col("again"), REVISIT_PROFILE)),
        ("Content-Type", "application/http;msgtype=response")],
        F.concat(head, F.when(F.col("again"), "").otherwise(F.col("payload"))))
    metadata = _record("metadata", [
        ("WARC-Record-ID", _urn("metadata", F.col("own"))), ("WARC-Date", date), ("WARC-Concurrent-To", main),
        ("Content-Type", "application/warc-fields")],
        F.concat_ws(CRLF, F.concat(F.lit("pageId: "), F.col("id").cast("string")),
                    F.concat(F.lit("payloadLength: "), F.octet_length("payload").cast("string")), F.lit("")))
    # an empty last line keeps the fields' own line end apart from the separator
    j.select(F.explode(F.array(request, response, metadata)).alias("value")).write.option(
        "lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def parse(stream):
    """(headers, block) of every record of an unpacked archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, stream.read(int(headers.get("content-length", 0)))


RECORD = ("record_id string, type string, concurrent_to string, refers_to string, target_uri string, "
          "payload_digest string, block binary, payload_bytes long, payload_sha1 string")
_NAMES = ["warc-record-id", "warc-type", "warc-concurrent-to", "warc-refers-to", "warc-target-uri", "warc-payload-digest"]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record. payload_bytes and payload_sha1 are taken from the
    payload of a response as read, not from its headers."""
    def run(batches):
        kinds = [pa.string()] * 6 + [pa.binary(), pa.int64(), pa.string()]
        names = [c.split()[0] for c in RECORD.split(", ")]
        for b in batches:
            for content in b.column("content"):
                cols, held = [[] for _ in kinds], 0
                for headers, block in parse(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())))):
                    size = digest = None
                    if headers.get("warc-type") == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    for c, v in zip(cols, [*(headers.get(n) for n in _NAMES), block, size, digest]):
                        c.append(v)
                    held += len(block) + 500
                    if held > _FLUSH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)
                        cols, held = [[] for _ in kinds], 0
                if cols[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: ``response`` (or revisit), ``request`` and
    ``metadata`` as structs, joined on the record that the latter two are
    concurrent to. A response without the others keeps nulls there; records
    concurrent to no response are no capture; alike responses give a row each.
    All records of a capture meet on its identifier in one shuffle."""
    is_main = F.col("type").isin("response", "revisit")
    row = F.struct("record_id", "type", "refers_to", "target_uri", "payload_digest", "block", "payload_bytes", "payload_sha1")
    pick = lambda c: F.first(F.when(c, row), ignorenulls=True)
    key = F.when(is_main, F.col("record_id")).otherwise(F.col("concurrent_to"))
    joined = records.withColumn("capture", key).filter("capture is not null").groupBy("capture").agg(
        pick(is_main).alias("response"), pick(F.col("type") == "request").alias("request"),
        pick(F.col("type") == "metadata").alias("metadata"), F.count(F.when(is_main, 1)).alias("n"))
    return joined.filter("n > 0").withColumn("copy", F.explode(F.expr("sequence(1L, n)"))).drop("n")


def field(block: Column, name: str) -> Column:
    """A field of an application/warc-fields block."""
    return F.nullif(F.regexp_extract(F.decode(block, "UTF-8"), rf"(?:^|\r\n){name}: ([^\r\n]*)", 1), F.lit(""))


def captures(records: DataFrame) -> DataFrame:
    """Per capture: page_id, record_id, record_type, payload_bytes,
    payload_digest, refers_to (the page_id of the response that a revisit
    names)."""
    fields = F.col("metadata.block")
    c = assemble(records).select(
        field(fields, "pageId").cast("long").alias("page_id"), F.col("response.record_id").alias("record_id"),
        F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("to"),
        F.coalesce(F.col("response.payload_bytes"), field(fields, "payloadLength").cast("long")).alias("payload_bytes"),
        F.coalesce(F.col("response.payload_sha1"), F.regexp_replace(F.col("response.payload_digest"), "^sha1:", ""))
        .alias("payload_digest"))
    c = stage(c, "captures")
    named = c.filter("record_type = 'response'").groupBy(F.col("record_id").alias("to")).agg(F.first("page_id").alias("refers_to"))
    back = c.filter("record_type = 'revisit'").join(named, "to", "left")
    cols = ["page_id", "record_id", "record_type", "payload_bytes", "payload_digest", "refers_to"]
    return c.filter("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long")).select(*cols).union(
        back.select(*cols))
