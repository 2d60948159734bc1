"""WARC archives with an index: write records, index every record, read selected ones in coalesced byte ranges.

Spark's text writer makes the archives: a row is one record's header and block, and the record's closing CRLF CRLF is
the line separator.  The index is taken from the archives themselves, one row per record with file, offset, length, URL
and digest.  A reader sorts the wanted index rows by file and offset, joins neighbours into ranges of about
``range_bytes`` and reads each range at once.  Executors open the archives through pyarrow.fs, so the shared folder must
be one that it reaches (a mounted folder, S3, GCS, HDFS).
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from weighlens.llm.common import staged, utf8_size
from weighlens.storage import shared_dir

END = "\r\n\r\n"
RANGE_BYTES = 8 << 20

# fixed values: digits of base 32 as conv() writes them, and as RFC 4648 does
_CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(text: Column) -> Column:
    """SHA-1 of the UTF-8 bytes in upper-case base 32: 40 bits (10 hex digits) are 8 digits."""
    digest = F.sha1(text.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*groups), _CONV_DIGITS, _BASE32_DIGITS)


def _urn(page_id: Column) -> Column:
    h = F.md5(F.concat(F.lit("page|"), F.coalesce(page_id.cast("string"), F.lit("null"))))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def write_archives(
    pages: DataFrame, path: str, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
    page_id: str = "page_id", url: str = "url", html: str = "html",
) -> None:
    """One record per row of ``pages``, one archive per partition.  Page contents are exchanged only where the table of
    repeated payloads (digest, size, id) is too large to be sent to all tasks.

    Rows whose payloads (UTF-8 bytes of the html, NULL: empty) are equal and at least ``least_bytes`` long: those with
    the largest page_id become responses, the others revisits of it.  All others are responses, as is every row of a
    payload seen only with NULL ids.  A NULL or unprintable URL is left out or percent-encoded.  An empty table writes
    no record.  Other columns are not used.
    """
    one = pages.select(
        F.col(page_id).alias("page_id"), F.regexp_replace(F.col(url), r"[\x00-\x20\x7f]", "%20").alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
    ).withColumns({"digest": sha1_base32(F.col("html")), "bytes": utf8_size(F.col("html"))})
    copies = (
        one.groupBy(F.col("digest").alias("__digest"), F.col("bytes").alias("__bytes"))
        .agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) & (F.col("__bytes") >= least_bytes)).drop("n")
    )
    # written first: with its size known, Spark sends it to all tasks where it is small and sorts both sides where not
    copies = staged(copies, "warc-copies")
    one = one.join(copies, (F.col("digest") == F.col("__digest")) & (F.col("bytes") == F.col("__bytes")), "left")
    revisit = F.col("keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))
    block_head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END)
    )
    block_bytes = F.length(block_head) + F.when(revisit, 0).otherwise(F.col("bytes"))
    header = F.concat_ws(
        "\r\n", F.lit("WARC/1.0"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _urn(F.col("page_id"))), F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.lit(f"WARC-Date: {date}"), F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("bytes").cast("string")), F.concat(F.lit("X-Page-ID: "), F.col("page_id").cast("string")),
        F.when(revisit, F.concat(
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
            _urn(F.col("keep")), F.lit("\r\nX-Refers-To-Page: "), F.col("keep").cast("string"),
        )),
        F.lit("Content-Type: application/http; msgtype=response"), F.concat(F.lit("Content-Length: "), block_bytes.cast("string")),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    one.select(F.concat(header, F.lit(END), block_head, body)).write.option("lineSep", END).text(path)


def _open(path: str):
    """File system and path of a URI as Spark lists it."""
    uri = re.sub(r"^file:/+", "file:///", path) if ":" in path.split("/")[0] else f"file://{path}"
    return arrow_fs.FileSystem.from_uri(uri)


def _fields(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _headers(path: str, size: int, step: int = 4 << 20) -> Iterator[tuple[int, int, dict[str, str]]]:
    """(offset, length, fields) of every record; holds at most ``step`` bytes of the archive."""
    system, name = _open(path)
    with system.open_input_file(name) as f:
        at, base, held = 0, 0, b""
        while at < size:
            end = held.find(END.encode(), at - base) if at - base < len(held) else -1
            if end < 0:
                base, held = at, f.read_at(min(step, size - at), at)
                end = held.find(END.encode())
                if end < 0:
                    raise ValueError(f"cut record at {at} of {path}")
            fields = _fields(held[at - base:end])
            length = end - (at - base) + 8 + int(fields["content-length"])
            yield at, length, fields
            at += length


_INDEX = "file string, offset bigint, length bigint, url string, digest string, page_id bigint"


def index_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of all archives under ``path``: file, offset, length, url, digest, page_id."""
    def scan(batches):
        for batch in batches:
            for file, size in zip(*(batch.column(i).to_pylist() for i in range(2))):
                rows: list[tuple] = []
                for offset, length, f in _headers(file, size):
                    page = f.get("x-page-id")
                    rows.append((file, offset, length, f.get("warc-target-uri"), f["warc-payload-digest"].removeprefix("sha1:"), int(page) if page else None))
                    if len(rows) == 10_000:
                        yield _batch(rows, _INDEX_TYPES)
                        rows = []
                yield _batch(rows, _INDEX_TYPES)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    return files.filter("length > 0").mapInArrow(scan, _INDEX)


_INDEX_TYPES = {"file": pa.string(), "offset": pa.int64(), "length": pa.int64(), "url": pa.string(), "digest": pa.string(), "page_id": pa.int64()}
_RECORD_TYPES = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.int64(), "html": pa.string()}


def _batch(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values())], names=list(types))


def read_records(selected: DataFrame, payloads: bool = True, range_bytes: int = RANGE_BYTES, gap: int = 64 << 10) -> DataFrame:
    """The records of the selected index rows: page_id, url, record_type, payload_bytes, payload_digest, refers_to, html.

    Rows whose records start in the same ``range_bytes`` of a file and lie at most ``gap`` apart are one read.  A
    response's size and digest are those of the bytes read, and must match its header; a revisit has those its header
    names and NULL html.  Selecting a row twice gives its record twice; no row gives none.
    """
    slot = W.partitionBy("file", "slot").orderBy("offset")
    ends = F.lag(F.col("offset") + F.col("length")).over(slot)
    # index rows are few bytes that stand for many: tasks are counted by the bytes to read, a fixed number of them
    wanted = selected.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-wanted // (range_bytes // 2)))
    ranges = (
        selected.select("file", "offset", "length", F.expr(f"offset div {range_bytes}").alias("slot"))
        .repartition(tasks, "file", "slot")
        .withColumn("new", F.coalesce((F.col("offset") - ends > gap).cast("int"), F.lit(1)))
        .withColumn("range", F.sum("new").over(slot))
        .groupBy("file", "slot", "range")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("records"))  # at most range_bytes / 300 records
        .select("file", "records")
    )

    def read(batches):
        for batch in batches:
            for file, records in zip(*(batch.column(i).to_pylist() for i in range(2))):
                system, name = _open(file)
                start, end = records[0]["offset"], max(r["offset"] + r["length"] for r in records)
                with system.open_input_file(name) as f:
                    held = f.read_at(end - start, start)
                yield _batch([_record(held[r["offset"] - start:][: r["length"]], payloads) for r in records], _RECORD_TYPES)

    types = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, html string"
    return ranges.mapInArrow(read, types)


def _record(raw: bytes, payloads: bool) -> tuple:
    head, _, block = raw.partition(END.encode())
    f = _fields(head)
    page, refers = f.get("x-page-id"), f.get("x-refers-to-page")
    digest, size, html = f["warc-payload-digest"].removeprefix("sha1:"), int(f["x-payload-length"]), None
    if f["warc-type"] == "response":
        payload = block[: int(f["content-length"])].partition(END.encode())[2]
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest or len(payload) != size:
            raise ValueError(f"payload of page {page} does not match its header")
        html = payload.decode("utf-8") if payloads else None
    return int(page) if page else None, f.get("warc-target-uri"), f["warc-type"], size, digest, int(refers) if refers else None, html


def archive_round_trip(pages: DataFrame, payloads: bool = True, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` into archives in the shared folder, index them, read all records back."""
    spark = pages.sparkSession
    path = shared_dir(spark, "warc")
    write_archives(pages, path, least_bytes)
    return read_records(staged(index_archives(spark, path), "warc-index"), payloads)
