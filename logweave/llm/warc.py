"""WARC archives: writing, reading and revisit resolution.

Archives are written by Spark's text writer, one record a row: a record is a header
block, a blank line and its content, and every record ends with two CRLF, which is
the writer's line separator.  Writing therefore goes through the commit protocol of
the shared store, and a lost executor leaves no half archive.  Files are gzipped, so
one task reads a file from its beginning; records are cut by ``Content-Length``, so
payloads may hold anything.

Revisit resolution: (1) the headers - digest, length, record id, page id - are
shuffled by payload digest, combined inside map tasks, to find the original of each
payload; (2) records that are not the original of their payload are joined to it;
(3) all records are written anew with fresh headers, the revisits with a reference to
their original and without the payload.

Defined results: null html is the empty payload; payloads shorter than ``LEAST_BYTES``
are never revisits; of equal payloads the smallest page id is the original (a null
page id is the largest, ties go to the smaller record id), so rows that repeat are
revisits of one of them.  Line ends in a URL are percent-encoded.  An empty table
gives empty archives and an empty result.  Input columns other than page_id, url and
html are not archived.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm.common import col, ship_code
from logweave.session import scratch_dir

#: fixed values of the format
VERSION = "WARC/1.1"
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: smaller payloads are always stored
LEAST_BYTES = 100
#: records in an archive file at most
FILE_RECORDS = 100_000

_HEADERS = ("record_id string, record_type string, date string, target string, page_id long, "
            "digest string, refers_to string, payload_bytes long")


def _line(name: str, value: Column) -> Column:
    """``name: value`` and a line end; nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def _record(kind: Column, record_id: Column, date: Column, target: Column, page_id: Column,
            digest: Column, refers_to: Column, refers_target: Column, payload: Column) -> Column:
    """The text of a record without its final line ends (null ``payload``: a revisit)."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"),
                    _line("Content-Length", F.octet_length(payload).cast("string")), F.lit(END))
    block = F.concat(http, F.coalesce(payload, F.lit("")))
    profile = F.when(refers_to.isNotNull(), F.lit(PROFILE))
    return F.concat(
        F.lit(VERSION + END), _line("WARC-Type", kind), _line("WARC-Record-ID", record_id),
        _line("WARC-Date", date), _line("WARC-Target-URI", target),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        _line("WARC-Refers-To", refers_to), _line("WARC-Refers-To-Target-URI", refers_target),
        _line("WARC-Profile", profile), _line("X-Page-Id", page_id.cast("string")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length(block).cast("string")), F.lit(END), block)


def _write(records: DataFrame, path: str, level: str = "DEFAULT_COMPRESSION") -> str:
    (records.write.option("lineSep", END + END).option("compression", "gzip")
     .option("zlib.compress.level", level)
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))
    return path


def _fresh_id(*parts: Column) -> Column:
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    pieces = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def write_archives(pages: DataFrame, path: str | None = None, date: str = "2024-01-01T00:00:00Z",
                   id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> str:
    """One response record per row; returns the folder of the archives."""
    target = F.regexp_replace(F.regexp_replace(col(url_col), "\r", "%0D"), "\n", "%0A")
    payload = F.coalesce(col(html_col).cast("string"), F.lit(""))
    none = F.lit(None).cast("string")
    record = _record(F.lit("response"),
                     _fresh_id(col(id_col), col(url_col), F.monotonically_increasing_id()),
                     F.lit(date), target, col(id_col), F.sha2(payload, 256), none, none, payload)
    # archives that are written anew: half the time of the default for a tenth more bytes
    return _write(pages.select(record.alias("value")),
                  path or scratch_dir(pages.sparkSession, "warc-crawl"), "BEST_SPEED")


def _records(lines: Iterator[tuple[str, bytes]]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, content) of every record, from (file, bytes up to a CRLF)."""
    file, state, fields, parts, have, need = None, "between", {}, [], 0, 0
    for name, line in lines:
        if name != file:
            if state != "between":
                raise ValueError(f"archive ends inside a record: {file}")
            file = name
        if state == "between":
            if line:
                if line != VERSION.encode():
                    raise ValueError(f"no record begins here: {file}: {line[:60]!r}")
                state, fields = "fields", {}
        elif state == "fields" and line:
            key, _, value = line.decode().partition(": ")
            fields[key.lower()] = value
        elif state == "fields":
            state, parts, have, need = "content", [], -len(END), int(fields["content-length"])
            if not need:
                yield fields, b""
                state = "between"
        else:
            parts.append(line)
            have += len(END) + len(line)
            if have > need:
                raise ValueError(f"a record is longer than its Content-Length: {file}")
            if have == need:
                yield fields, END.encode().join(parts)
                state = "between"
    if state != "between":
        raise ValueError(f"archive ends inside a record: {file}")


def _parser(with_payload: bool, verify: bool):
    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            yield from zip(batch["file"], batch["value"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, held = [], 0
        names = [h.split(" ")[0] for h in _HEADERS.split(", ")] + ["payload"] * with_payload

        def frame() -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=names)
            out["page_id"] = pd.array([r[4] for r in rows], dtype="Int64")
            out["payload_bytes"] = pd.array([r[7] for r in rows], dtype="Int64")
            return out

        for fields, content in _records(lines(batches)):
            payload = content.partition(b"\r\n\r\n")[2]
            kind, page = fields["warc-type"], fields.get("x-page-id")
            digest = fields["warc-payload-digest"].removeprefix("sha256:")
            stored_here = kind == "response"
            if verify and stored_here and hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"payload and digest differ in {fields['warc-record-id']}")
            rows.append((fields["warc-record-id"], kind, fields.get("warc-date"),
                         fields.get("warc-target-uri"), None if page is None else int(page), digest,
                         fields.get("warc-refers-to"), len(payload) if stored_here else None,
                         *([payload] if with_payload else [])))
            held += len(payload) * with_payload + 500
            if held > 16_000_000:
                yield frame()
                rows, held = [], 0
        if rows:
            yield frame()
    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = False, verify: bool = True) -> DataFrame:
    """One row per record; ``payload`` (binary) only on demand.

    ``verify`` compares each stored payload with its digest; a caller that has read the same
    files before may leave it out.
    """
    ship_code(spark)
    lines = spark.read.option("lineSep", END).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))
    return lines.mapInPandas(_parser(with_payload, verify),
                             _HEADERS + (", payload binary" if with_payload else ""))


def revisits_of(headers: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(record_id, original_id, original_target) of the records that repeat a payload."""
    order = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "record_id", "target")
    able = headers.filter(F.col("payload_bytes") >= least_bytes)
    originals = able.groupBy("digest").agg(F.min(order).alias("first"),
                                           F.count(F.lit(1)).alias("n")).filter("n > 1")
    return (able.select("digest", "record_id").join(originals, "digest")
            .filter(F.col("record_id") != F.col("first.record_id"))
            .select("record_id", F.col("first.record_id").alias("original_id"),
                    F.col("first.target").alias("original_target")))


def deduplicate_archives(spark: SparkSession, path: str, to: str | None = None,
                         least_bytes: int = LEAST_BYTES) -> str:
    """Write the archives of ``path`` anew, repeated payloads as revisit records.

    All records get ids of their own; payloads are verified in the pass over the headers.
    """
    revisits = revisits_of(read_archives(spark, path), least_bytes)
    records = read_archives(spark, path, with_payload=True, verify=False).join(revisits, "record_id", "left")
    again = F.col("original_id").isNotNull()
    payload = F.when(~again, F.col("payload").cast("string"))
    fresh = lambda name: F.when(F.col(name).isNotNull(), _fresh_id(F.lit("unique"), F.col(name)))
    record = _record(F.when(again, "revisit").otherwise("response"), fresh("record_id"),
                     F.col("date"), F.col("target"), F.col("page_id"), F.col("digest"),
                     fresh("original_id"), F.col("original_target"), payload)
    return _write(records.select(record.alias("value")), to or scratch_dir(spark, "warc-unique"))


def resolved(spark: SparkSession, path: str) -> DataFrame:
    """Records of deduplicated archives; revisits with their original's page and length."""
    records = read_archives(spark, path)
    originals = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("original_id"), F.col("page_id").alias("original_page"),
        F.col("payload_bytes").alias("original_bytes"))
    return records.join(originals, records["refers_to"] == originals["original_id"], "left").select(
        "page_id", "target", "record_id", F.coalesce("payload_bytes", "original_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), "record_type",
        F.when(F.col("record_type") == "revisit", F.col("original_page")).alias("refers_to"))
