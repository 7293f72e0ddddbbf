"""WARC archives with revisit resolution.

`write_records` writes one WARC/1.1 record per row with Spark's text writer:
each line is a record's header block, a blank line and its block, and the
line separator is the two CRLF that end a record, so the files are plain WARC.
`read_records` reads them back whole-file and parses by Content-Length; files
hold at most `FILE_RECORDS` records, which bounds what a task holds.

`resolve_revisits` shuffles headers (no payloads) by payload digest and length:
of records with equal payloads of at least `MIN_PAYLOAD` bytes the one with the
largest page id is the response, the others are revisits that refer to it.
`deduplicate` writes new archives with fresh headers: revisit records carry no
block, but the digest, the length and the id of the record they refer to.

A null payload is empty and a response; a null url has no target header; a
null id is the smallest and writes an empty id header. Rows with the same id
and payload are all responses if that id is the largest. An empty table gives
an empty archive.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_folder, stored

MIN_PAYLOAD = 1000
FILE_RECORDS = 2000
END = "\r\n\r\n"
_FIELDS = ("record_id string, page_id long, record_type string, url string, payload_digest string, "
           "payload_bytes long, refers_to_id string, payload binary")


def record_id(page_id: Column) -> Column:
    """A stable urn:uuid of the page id."""
    h = F.md5(F.concat(F.lit("page|"), F.coalesce(page_id.cast("string"), F.lit(""))))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def records_of(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest) of every page."""
    payload = F.coalesce(F.col(html), F.lit(""))
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"),
                        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(F.encode(payload, "UTF-8")).alias("payload_digest"))


def resolve_revisits(headers: DataFrame, least: int = MIN_PAYLOAD) -> DataFrame:
    """`headers` (page_id, payload_digest, payload_bytes, ...) with record_type
    and refers_to. The largest id of a payload is found by a partial aggregate
    first, so a payload with a third of all rows meets no single task."""
    first = (headers.where(F.col("payload_bytes") >= least).groupBy(F.col("payload_digest").alias("_d"), F.col("payload_bytes").alias("_n"))
             .agg(F.max("page_id").alias("_first")))
    found = headers.join(first, (F.col("payload_digest") == F.col("_d")) & (F.col("payload_bytes") == F.col("_n")), "left")
    revisit = F.col("_n").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return (found.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(revisit, F.col("_first"))).drop("_d", "_n", "_first"))


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def write_records(records: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write response and revisit records (columns of `records_of` and `resolve_revisits`)."""
    revisit = F.col("record_type") == "revisit"
    target = F.regexp_replace(F.col("url"), r"[\x00-\x20\x7F]", "%20")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    head = F.concat(
        F.lit("WARC/1.1\r\n"), _header("WARC-Type", F.col("record_type")), _header("WARC-Record-ID", record_id(F.col("page_id"))),
        _header("WARC-Date", F.lit(date)), F.coalesce(_header("WARC-Target-URI", target), F.lit("")),
        _header("X-Page-ID", F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        _header("X-Payload-Length", F.col("payload_bytes").cast("string")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(_header("WARC-Refers-To", record_id(F.col("refers_to"))),
                                 _header("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(""),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.when(revisit, F.octet_length(http)).otherwise(F.octet_length(http) + F.col("payload_bytes")).cast("string")))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    (records.select(F.concat(head, F.lit("\r\n"), block).alias("value")).write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))


def parse(data: bytes):
    """The records of one archive file: (headers, block)."""
    pos = 0
    while pos < len(data):
        stop = data.index(END.encode(), pos)
        lines = data[pos:stop].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {pos}")
        head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        pos = stop + len(END)
        size = int(head["Content-Length"])
        yield head, data[pos:pos + size]
        pos += size + len(END)


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of all archive files under `path`; `payload` is the body of a response (null if not `payloads`)."""
    def run(batches):
        import gzip

        for b in batches:
            for raw in b.column(0):
                rows = []
                data = raw.as_buffer().to_pybytes()
                for head, block in parse(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                    page = head.get("X-Page-ID") or None
                    response = head["WARC-Type"] == "response"
                    rows.append((head["WARC-Record-ID"], int(page) if page else None, head["WARC-Type"], head.get("WARC-Target-URI"),
                                 head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["X-Payload-Length"]), head.get("WARC-Refers-To"),
                                 block[block.index(END.encode()) + len(END):] if payloads and response else None))
                cols = list(zip(*rows)) if rows else [[]] * 8
                types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 ["record_id", "page_id", "record_type", "url", "payload_digest", "payload_bytes", "refers_to_id", "payload"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, _FIELDS)


def deduplicate(source: DataFrame, path: str, least: int = MIN_PAYLOAD) -> None:
    """Write the records of `source` (columns of `records_of`) as deduplicated archives under `path`."""
    write_records(resolve_revisits(source, least), path)


def revisits_resolved(records: DataFrame) -> DataFrame:
    """Headers read back, with refers_to: the page id of the record a revisit refers to."""
    heads = records.drop("payload")
    to = heads.where("record_type = 'response'").groupBy(F.col("record_id").alias("_id")).agg(F.max("page_id").alias("refers_to"))
    return heads.join(to, F.col("refers_to_id") == F.col("_id"), "left").drop("_id")


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write `pages` as deduplicated archives (in the shared checkpoint folder
    unless a path is given), read them back and resolve the revisits."""
    spark = pages.sparkSession
    path = path or new_folder(spark, "warc")
    deduplicate(records_of(pages), path)
    records = stored(read_records(spark, path, payloads=False).drop("payload"), "warc-headers")
    return revisits_resolved(records.withColumn("payload", F.lit(None).cast("binary")))
