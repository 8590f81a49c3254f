import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from logweave.llm import warc

SCHEMA = "page_id long, url string, html string"
BODY = "<p>" + "x" * 120 + "</p>"
TRICKY = "a\r\nb\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nxyz\r\r\n\r" + "é" * 80 + "\r\n"
PAGES = ([(i, f"http://h/{i}", BODY) for i in (9, 4, 7)] + [(1, "http://h/\r\n1", TRICKY), (2, None, TRICKY)]
         + [(10, "u", None), (11, "u", ""), (12, "u", "short"), (13, "u", "short"), (14, "u", "\r\n" * 60)]
         + [(15, "u", "same row " * 20)] * 2 + [(None, "u", BODY), (16, "u", "日本語 " * 30000)]
         + [(17, "u", "\n" + BODY + "\r"), (18, "u", "x" * 99), (19, "u", "x" * 99)])


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_payloads_survive_the_round_trip(spark):
    path = warc.write_archives(pages(spark).withColumn("digest", F.lit("own")))
    out = warc.read_archives(spark, path, with_payload=True).collect()
    got = sorted((str(r.page_id), bytes(r.payload)) for r in out)
    assert got == sorted((str(p), (h or "").encode()) for p, _, h in PAGES)
    assert len({r.record_id for r in out}) == len(PAGES)
    assert {r.record_type for r in out} == {"response"}


def test_revisits_by_brute_force(spark):
    path = warc.deduplicate_archives(spark, warc.write_archives(pages(spark)))
    out = warc.resolved(spark, path).collect()
    assert len(out) == len(PAGES)
    first, seen = {}, []
    for page, _, html in PAGES:
        payload = (html or "").encode()
        if len(payload) >= 100 and page is not None:
            first[payload] = min(first.get(payload, page), page)
    for page, _, html in PAGES:
        payload = (html or "").encode()
        keeper = first.get(payload)
        again = keeper is not None and (keeper != page or (page, payload) in seen)
        seen.append((page, payload))
        want = ("revisit", keeper) if again else ("response", None)
        rows = [r for r in out if r.page_id == page and r.payload_digest == hashlib.sha256(payload).hexdigest()]
        assert want in [(r.record_type, r.refers_to) for r in rows]
        assert {r.payload_bytes for r in rows} == {len(payload)}
    records = {r.record_id: r for r in warc.read_archives(spark, path, with_payload=True).collect()}
    for r in records.values():
        if r.record_type == "revisit":
            assert bytes(r.payload) == b"" and records[r.refers_to].digest == r.digest
            assert records[r.refers_to].record_type == "response"


def test_records_hold_the_headers_of_the_format(spark):
    """Every record of the files as bytes: its fields, its length, and that its id is its own."""
    crawl = warc.write_archives(pages(spark))
    path = warc.deduplicate_archives(spark, crawl)
    first_ids = {r.record_id for r in warc.read_archives(spark, crawl).collect()}
    ids, kinds = [], []
    for file in spark.read.format("binaryFile").load(path).collect():
        data = gzip.decompress(bytes(file.content))
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            version, *lines = head.decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines)
            length = int(fields["Content-Length"])
            assert version == "WARC/1.1" and rest[length:length + 4] == b"\r\n\r\n"
            assert rest[:length].startswith(b"HTTP/1.1 200 OK\r\n") and fields["WARC-Date"]
            ids.append(fields["WARC-Record-ID"])
            kinds.append(fields["WARC-Type"])
            assert ("WARC-Profile" in fields) == ("WARC-Refers-To" in fields) == (kinds[-1] == "revisit")
            data = rest[length + 4:]
    assert len(set(ids)) == len(PAGES) and not first_ids & set(ids) and set(kinds) == {"response", "revisit"}


def test_broken_archives_are_refused(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/x.txt").write_bytes(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 50\r\n\r\nabc\r\n\r\n")
    with pytest.raises(Exception, match="ends inside a record"):
        warc.read_archives(spark, str(tmp_path / "a")).collect()


def test_empty_table(spark):
    path = warc.deduplicate_archives(spark, warc.write_archives(pages(spark, [])))
    assert warc.resolved(spark, path).count() == 0
