import gzip
import hashlib
from pathlib import Path

from morrowcart.llm import warc as W

BIG = "<p>é</p>" * 300


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_round_trip_and_revisits(spark, tmp_path):
    tricky = "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n\r\n" + "x" * 1000 + "\r\n\r\n"
    rows = [(1, "http://a/", BIG), (2, "http://b/ \n", BIG), (9, "http://c/", BIG), (3, None, None), (4, "u", ""), (5, "u", "small"), (6, "u", "small"),
            (7, "u", tricky), (8, "u", tricky), (10, "u", "y" * 999), (11, "u", "y" * 999), (12, "u", "y" * 1000), (13, "u", "y" * 1000)]
    path = str(tmp_path / "w")
    got = {r.page_id: r for r in W.archive_pages(_pages(spark, rows), path).collect()}
    assert len(got) == len(rows)
    first = {1: 9, 2: 9, 7: 8, 12: 13}
    for i, _, html in rows:
        body = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(body), hashlib.sha1(body).hexdigest())
        assert (got[i].record_type, got[i].refers_to) == (("revisit", first[i]) if i in first else ("response", None))
    # payloads come back byte for byte, revisits through the record they refer to
    body = {r.page_id: bytes(r.payload) for r in W.read_records(spark, path).where("record_type = 'response'").collect()}
    for i, _, html in rows:
        assert body[first.get(i, i)] == (html or "").encode()
    # fresh headers: a revisit carries no payload, and every record parses by its own length
    files = [gzip.decompress(p.read_bytes()) for p in Path(path).glob("part-*")]
    records = [r for f in files for r in W.parse(f)]
    assert len(records) == len(rows) and len({h["WARC-Record-ID"] for h, _ in records}) == len(rows)
    assert all((BIG.encode() not in b) for h, b in records if h["WARC-Type"] == "revisit")
    assert all("\n" not in h.get("WARC-Target-URI", "") for h, _ in records)


def test_null_and_repeated_ids_empty_table_extra_columns(spark):
    rows = [(None, "u", BIG), (1, "u", BIG), (2, "u", BIG), (2, "u", BIG)]
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in W.archive_pages(_pages(spark, rows)).collect()), key=str)
    assert got == [(1, "revisit", 2), (2, "response", None), (2, "response", None), (None, "revisit", 2)]
    assert W.archive_pages(_pages(spark, rows).where("false")).count() == 0
    clash = _pages(spark, rows[1:3]).selectExpr("*", "'z' AS payload", "1 AS record_type", "2 AS payload_bytes")
    assert sorted((r.page_id, r.payload_bytes) for r in W.archive_pages(clash).collect()) == [(1, len(BIG.encode())), (2, len(BIG.encode()))]
