"""Web archives: write a WARC record set per page, read archives back, assemble transactions.

Writing. A page becomes three records: a response (or a revisit, where another page has the
same payload), the request and a metadata record, the last two tied to the first by
WARC-Concurrent-To. Spark's text sink writes them: a row is a record up to the end of its
block, and the line separator is the two line ends that close a WARC record, so every part
file is a plain archive, on whatever file system the path names.

Reading. Every archive file goes to one task, which walks it by the content lengths, so blocks
may hold anything. Its records become rows; request and metadata rows then join the
response or revisit they are concurrent to, and each capture is one nested row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retail_lens.llm.common import join_spread, staging

CRLF = "\r\n"
#: Fixed value of the WARC standard.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = "record_id string, type string, concurrent_to string, refers_to string, target string, date string,"
_RECORD += " payload_digest string, block binary"
_NAMES = ["WARC-Record-ID", "WARC-Type", "WARC-Concurrent-To", "WARC-Refers-To", "WARC-Target-URI", "WARC-Date"]
_NAMES += ["WARC-Payload-Digest"]


def base32_sha1(data: Column) -> Column:
    """SHA-1 in upper-case base32 without prefix: five hex digits give four of base32."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(value: Column) -> Column:
    """A record id from 32 hex digits."""
    cut = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(value, a, n) for a, n in cut)), F.lit(">"))


def _record(kind: Column, record_id: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """Header lines, whose null ones are left out, an empty line and the block; the sink ends the record."""
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), record_id)]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), block)


def _decided(pages: DataFrame, least_bytes: int, key: str, url: str, html: str) -> DataFrame:
    """page, target, body, digest, bytes, kind, response (key of the response; null unless a revisit) per row."""
    body = F.coalesce(F.col(html).cast("string"), F.lit(""))
    # A line end in a URL would end the header line.
    target = F.regexp_replace(F.coalesce(F.col(url).cast("string"), F.lit("urn:none")), r"[\x00-\x20\x7F]", "%20")
    rows = pages.select(F.col(key).cast("long").alias("page"), target.alias("target"), body.alias("body"))
    rows = rows.withColumns({"digest": base32_sha1(F.col("body").cast("binary")), "bytes": F.octet_length("body").cast("long")})
    # Pre-aggregated per payload: the largest page, how many rows it has, and how many rows there are.
    per_page = rows.filter(F.col("bytes") >= least_bytes).groupBy("digest", "page").agg(F.count(F.lit(1)).alias("n"))
    per_payload = per_page.groupBy("digest").agg(
        F.max(F.struct(F.coalesce("page", F.lit(-(2**63))).alias("page"), "n")).alias("top"), F.sum("n").alias("rows")
    )
    shared = staging(pages.sparkSession)(
        per_payload.filter("rows > 1").select("digest", F.col("top.page").alias("top"), F.col("top.n").alias("ties"), "rows"),
        "shared",
    )
    met = join_spread(rows, shared, "digest", "rows")
    at_top = F.coalesce("page", F.lit(-(2**63))) == F.col("top")
    tied = met.filter(at_top & (F.col("ties") > 1))  # one page given several times with one payload
    first = F.row_number().over(Window.partitionBy("digest").orderBy("target")) == 1
    plain = met.filter(~F.coalesce(at_top & (F.col("ties") > 1), F.lit(False)))
    marked = plain.withColumn("own", F.col("top").isNull() | at_top).unionByName(tied.withColumn("own", first))
    return marked.withColumn("kind", F.when(F.col("own"), "response").otherwise("revisit")).withColumn(
        "response", F.when(~F.col("own"), F.col("top"))
    )


def write(
    pages: DataFrame,
    folder: str,
    least_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    records_per_file: int = 6000,
) -> None:
    """Write the pages as gzipped WARC files of at most ``records_per_file`` records.

    Of pages with equal payloads (a null html has an empty one) of at least ``least_bytes``, that
    with the largest key is a response and the others revisit it; among rows that tie for it,
    the first by URL. Smaller payloads are all responses. Null keys come before all others; their
    record carries no key. Other columns are not read; an empty table gives empty archives.
    """
    rows = _decided(pages, least_bytes, key, url, html)
    shared_id = _urn(F.sha2(F.concat(F.lit("response "), "digest"), 256))
    rows = rows.withColumn("capture", F.when(F.col("top").isNotNull() & F.col("own"), shared_id).otherwise(F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))))
    common = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", F.col("target"))]
    is_revisit = F.col("kind") == "revisit"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF * 2}"))
    capture = _record(
        F.col("kind"),
        F.col("capture"),
        [
            *common,
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
            ("WARC-Refers-To", F.when(is_revisit, shared_id)),
            ("WARC-Profile", F.when(is_revisit, F.lit(SAME_PAYLOAD))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.concat(http, F.when(is_revisit, F.lit("")).otherwise(F.col("body"))),
    )
    tied = [*common, ("WARC-Concurrent-To", F.col("capture"))]
    new_id = lambda: F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))
    request = _record(
        F.lit("request"),
        new_id(),
        [*tied, ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), "target", F.lit(f" HTTP/1.1{CRLF * 2}")),
    )
    fields = F.concat_ws(
        CRLF,
        F.concat(F.lit("page-id: "), F.col("page").cast("string")),
        F.concat(F.lit("payload-bytes: "), F.col("bytes").cast("string")),
        F.concat(F.lit("refers-to-page-id: "), F.col("response").cast("string")),
    )
    metadata = _record(F.lit("metadata"), new_id(), [*tied, ("Content-Type", F.lit("application/warc-fields"))], fields)
    records = rows.select(F.explode(F.array(capture, request, metadata)).alias("value"))
    records.write.option("lineSep", CRLF * 2).option("compression", "gzip").option(
        "maxRecordsPerFile", records_per_file
    ).text(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the archives in ``folder``: ids, type, links, target, date, digest and block.

    One task reads one file, so files should be of some tens of MB. A record that is cut off
    raises an error. Files are gzipped or plain.
    """
    import gzip

    def records(data: bytes) -> Iterator[tuple]:
        at = 0
        while at < len(data):
            end = data.find(b"\r\n\r\n", at)
            lines = data[at:end].decode("utf-8").split("\r\n") if end > 0 else []
            if not lines or not lines[0].startswith("WARC/"):
                raise ValueError(f"no WARC record at byte {at}")
            head = dict(line.split(": ", 1) for line in lines[1:])
            length = int(head["Content-Length"])
            if end + 4 + length > len(data):
                raise ValueError(f"the record at byte {at} is cut off")
            yield (*map(head.get, _NAMES), data[end + 4 : end + 4 + length])
            at = end + 8 + length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string()] * 7 + [pa.binary()]
        names = [c.split(" ")[0] for c in _RECORD.split(", ")]
        for batch in batches:
            for value in batch.column(0):
                data = value.as_py()
                if data[:2] == b"\x1f\x8b":
                    data = gzip.decompress(data)
                held: list[tuple] = []
                for record in records(data):
                    held.append(record)
                    if len(held) == 1000:
                        yield _batch(held, names, types)
                        held = []
                if held:
                    yield _batch(held, names, types)

    def _batch(held, names, types):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(run, _RECORD)


def _warc_fields(block: Column) -> Column:
    """name: value lines as a map."""
    return F.str_to_map(block.cast("string"), F.lit(CRLF), F.lit(": "))


def _after_headers(block: Column) -> Column:
    """What follows the empty line of an HTTP message, as bytes."""
    # The header is ASCII, so characters before its end are bytes.
    return F.substr(block, F.locate(CRLF * 2, block.cast("string")) + 4)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: capture (the response or revisit), requests and metadata (arrays of structs).

    Requests and metadata records go to the capture they are concurrent to. A capture without any
    has empty arrays. Records that name no capture, or one that is not there, form a row without
    capture for each name (one in all for no name): nothing is lost. Repeated captures keep a row each.
    """
    part = F.struct("record_id", "target", "date", "block")
    others = records.filter(~F.col("type").isin("response", "revisit")).groupBy(F.col("concurrent_to").alias("of"))
    tied = others.agg(
        *(F.collect_list(F.when(F.col("type") == kind, part)).alias(name) for kind, name in (("request", "requests"), ("metadata", "metadata")))
    )
    captures = records.filter(F.col("type").isin("response", "revisit")).select(
        F.struct("record_id", "type", "refers_to", "target", "date", "payload_digest", "block").alias("capture")
    )
    met = captures.join(tied, F.col("capture.record_id") == F.col("of"), "full")
    return met.select("capture", *(F.coalesce(c, F.array()).alias(c) for c in ("requests", "metadata")))


def capture_report(captures: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per capture: key, payload_bytes, payload_digest, record_type, refers_to.

    A response's payload is measured, length and digest; a revisit's are those of the payload it
    stands for, from its header and metadata record.
    """
    head = captures.filter("capture is not null").select(
        "capture.*", _warc_fields(F.element_at("metadata", 1)["block"]).alias("fields")
    )
    head = head.withColumnRenamed("block", "_block").withColumn("payload", _after_headers(F.col("_block")))
    own = F.col("type") == "response"
    return head.select(
        F.col("fields")["page-id"].cast("long").alias(key),
        F.when(own, F.octet_length("payload")).otherwise(F.col("fields")["payload-bytes"]).cast("long").alias("payload_bytes"),
        F.when(own, base32_sha1(F.col("payload"))).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("fields")["refers-to-page-id"].cast("long").alias("refers_to"),
    )
