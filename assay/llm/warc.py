"""WARC archives: writing pages, and a salvage reader for damaged files.

Records are text (headers and UTF-8 payload), so Spark's own writer lays the files down and commits
them. The reader checks lengths, record ends and digests. After a failed check it searches for the
next version line, or the next gzip member in compressed files, from which a whole record can be
read, goes on there, and logs the bytes between as a quarantined gap.
"""

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.common import saved, small_side, table
from assay.plans.lineage import fresh_dir

VERSION = re.compile(rb"WARC/[01]\.[0-9]+\r\n")
MEMBER = b"\x1f\x8b\x08"
LONGEST_HEADER = 1 << 20
#: Bytes of a record beside its page and address, at most; revisits that are broadcast, at most.
LONGEST_FIXED, FEW_REVISITS = 2048, 1_000_000

RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long,"
    " payload_digest string, payload binary"
)
GAPS = "path string, start long, length long, reason string"


# Writing


def with_revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """``page_id, url, html, payload_bytes, payload_digest, refers_to`` for every row of ``pages``.

    Among equal payloads of ``least`` bytes or more, the largest page_id is the one that the others
    refer to; shorter payloads refer to nothing. Null html is an empty payload. Rows that repeat the
    largest page_id with its payload are all responses; a null page_id is smaller than any other.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    sized = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        F.sha1(html.cast("binary")).alias("payload_digest"),
    )
    long_ones = sized.where(F.col("payload_bytes") >= least).select("page_id", "payload_digest")
    last = long_ones.groupBy("payload_digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
    # Only payloads that occur again need looking up, so the pages themselves need not move.
    again = last.where("n > 1").select("payload_digest", "last")
    revisits = saved(
        long_ones.join(again, "payload_digest")
        .where("last IS NOT NULL AND NOT page_id <=> last")
        .select("page_id", "payload_digest", F.col("last").alias("refers_to"))
        .distinct(),
        "revisits",
    )
    few = small_side(revisits, revisits.count(), FEW_REVISITS)
    key = (sized.page_id.eqNullSafe(few.page_id)) & (sized.payload_digest == few.payload_digest)
    return sized.join(few, key, "left").select(sized["*"], "refers_to")


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def record_text(date: str = "2024-01-01T00:00:00Z") -> Column:
    """One record as text without its last line end, from the columns of :func:`with_revisits`."""
    line = "\r\n"
    again = F.col("refers_to").isNotNull()
    # Control characters and blanks would end the header line.
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{line}Content-Type: text/html; charset=utf-8{line}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(line * 2),
    )
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("html")))
    headers = [
        (F.lit("WARC-Type"), F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        (F.lit("WARC-Record-ID"), record_id(F.col("page_id"))),
        (F.lit("WARC-Date"), F.lit(date)),
        (F.lit("WARC-Target-URI"), url),
        (F.lit("WARC-Payload-Digest"), F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        (F.lit("WARC-Block-Digest"), F.concat(F.lit("sha1:"), F.sha1(block.cast("binary")))),
        (F.lit("WARC-Refers-To"), F.when(again, record_id(F.col("refers_to")))),
        (
            F.lit("WARC-Profile"),
            F.when(again, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ),
        (F.lit("Content-Type"), F.lit("application/http;msgtype=response")),
        (F.lit("Content-Length"), F.octet_length(block).cast("string")),
    ]
    # A header without a value is left out.
    lines = [F.when(value.isNotNull(), F.concat(name, F.lit(": "), value)) for name, value in headers]
    return F.concat(F.concat_ws(line, F.lit("WARC/1.1"), *lines), F.lit(line * 2), block, F.lit(line))


def write_warc(
    pages: DataFrame, path: str, least: int = 1000, records_per_file: int = 8192, file_bytes: int = 1 << 29
) -> None:
    """A WARC record per row of ``pages(page_id, url, html)`` in files below ``path``.

    A file has ``records_per_file`` records at most, and fewer if as many of the longest page would
    pass ``file_bytes``; only a single record can be larger than that.
    """
    longest = pages.agg(F.max(F.octet_length("html") + F.coalesce(F.octet_length("url"), F.lit(0)))).first()[0] or 0
    held = max(1, min(records_per_file, file_bytes // (longest + LONGEST_FIXED)))
    records = with_revisits(pages, least).select(record_text().alias("value"))
    records.write.option("lineSep", "\r\n").option("maxRecordsPerFile", held).text(path)


def member(record: bytes) -> bytes:
    """A record as a gzip member of its own, for compressed archives."""
    packer = zlib.compressobj(wbits=31)
    return packer.compress(record) + packer.flush()


# Reading


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes
    end: int


class Damaged(Exception):
    pass


def _parsed(data: bytes, start: int) -> Record:
    """The record that begins at ``start``; raises if it fails a check."""
    version = VERSION.match(data, start)
    if not version:
        raise Damaged("no version line")
    stop = data.find(b"\r\n\r\n", start, start + LONGEST_HEADER)
    if stop < 0:
        raise Damaged("headers don't end")
    headers = {}
    for line in data[version.end() : stop].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header without a colon")
        headers[name.strip().lower().decode(errors="replace")] = value.strip().decode(errors="replace")
    length = headers.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", length):
        raise Damaged("no length")
    begin = stop + 4
    end = begin + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("record cut short" if end + 4 > len(data) else "length doesn't meet the record's end")
    block = data[begin:end]
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha1:") and len(digest) == 45 and hashlib.sha1(block).hexdigest() != digest[5:].lower():
        raise Damaged("block digest differs")
    return Record(headers, block, end + 4)


def _member(data: bytes, start: int) -> tuple[bytes, int]:
    """The content of the gzip member at ``start`` and where it ends."""
    reader = zlib.decompressobj(wbits=31)
    try:
        content = reader.decompress(data[start:])
    except zlib.error as error:
        raise Damaged("gzip member is damaged") from error
    if not reader.eof:
        raise Damaged("gzip member is cut short")
    return content, len(data) - len(reader.unused_data)


def _next_start(data: bytes, at: int, packed: bool) -> int:
    if packed:
        found = data.find(MEMBER, at)
        return len(data) if found < 0 else found
    found = VERSION.search(data, at)
    return found.start() if found else len(data)


def salvage(data: bytes) -> Iterator[Record | tuple[int, int, str]]:
    """Whole records in order, and ``(start, length, reason)`` of the bytes between them."""
    packed = data[:2] == MEMBER[:2] or not VERSION.search(data[:LONGEST_HEADER]) and MEMBER in data
    at, bad, why = 0, -1, ""
    while at < len(data):
        try:
            if packed:
                content, end = _member(data, at)
                record = _parsed(content, 0)
            else:
                record = _parsed(data, at)
                end = record.end
        except Damaged as error:
            if bad < 0:
                bad, why = at, str(error)
            at = _next_start(data, at + 1, packed)
            continue
        if bad >= 0:
            yield bad, at - bad, why
            bad = -1
        yield record
        at = end
    if bad >= 0:
        yield bad, len(data) - bad, why


def _page(uri: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?[0-9]+)>", uri or "")
    return int(found[1]) if found else None


def _fields(record: Record) -> dict:
    """A row of RECORDS; payloads of responses are checked against their digest."""
    h = record.headers
    http, _, payload = record.block.partition(b"\r\n\r\n")
    digest = h.get("warc-payload-digest", "").removeprefix("sha1:").lower()
    revisit = h.get("warc-type") == "revisit"
    told = re.search(rb"(?i)\r\ncontent-length:\s*([0-9]+)", http)
    if not revisit and digest and hashlib.sha1(payload).hexdigest() != digest:
        raise Damaged("payload digest differs")
    return {
        "page_id": _page(h.get("warc-record-id")),
        "url": h.get("warc-target-uri"),
        "record_type": h.get("warc-type"),
        "refers_to": _page(h.get("warc-refers-to")),
        "payload_bytes": (int(told[1]) if told else None) if revisit else len(payload),
        "payload_digest": digest or hashlib.sha1(payload).hexdigest(),
        "payload": None if revisit else payload,
    }


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """RECORDS and GAPS of all files below ``path`` in one table; ``reason`` is null for records.

    Files are read whole, one at a time, so the writer's ``records_per_file`` bounds what a task
    holds. Without ``payloads`` that column is null. Empty folders give no rows.
    """
    schema = f"{RECORDS}, {GAPS}"
    names = [part.split()[0] for part in schema.split(", ") for part in [part.strip()]]
    kinds = pa.schema(
        [(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[k]) for n, k in (p.split() for p in schema.replace(", ", ",").split(","))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                where, rows, held = batch.column("path")[i].as_py(), [], 0
                for found in salvage(batch.column("content")[i].as_py()):
                    if isinstance(found, Record):
                        try:
                            row = _fields(found) | {"path": where}
                        except Damaged as error:
                            row = {"path": where, "start": found.end, "length": 0, "reason": str(error)}
                        if not payloads:
                            row["payload"] = None
                        held += len(row.get("payload") or b"")
                    else:
                        row = {"path": where, "start": found[0], "length": found[1], "reason": found[2]}
                    rows.append(row)
                    if len(rows) >= 5000 or held > 32_000_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    assert names == kinds.names
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, schema)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    records = read_warc(spark, path, payloads=False).where("reason IS NULL")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op5_warc": op5_warc}

SQL = {
    "op5_warc": """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), last AS (
  SELECT payload_digest, max(page_id) AS last FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN l.last <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN l.last <> p.page_id THEN l.last END AS refers_to
FROM p LEFT JOIN last l ON l.payload_digest = p.payload_digest AND p.payload_bytes >= 1000
"""
}
