"""WARC archives with revisit records for repeated payloads.

Headers (page id, address, digest) are shuffled by payload digest to find the
page that keeps its payload; the others become revisit records that refer to it.
The repeated digests are joined back to the pages: where they are too many to be
broadcast, that join shuffles the payloads too, once.  Records are composed by Spark and written by its text writer, whose line
separator is the blank line that ends a WARC record, so archives appear through
Spark's output committer on any file system.  Reading parses archives (plain or
gzip, of one or many members) record by record, checks the digests and joins
revisit records to their originals.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickbay.llm.common import prepare, stage

#: Smaller payloads are always written in full.
REVISIT_MIN_BYTES = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

_BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def resolve_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest (hex SHA-1), bytes, original (page_id and url of the
    response this page revisits, or null), one row per page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("bytes", F.octet_length("payload").cast("long"))
    # the largest page_id of each digest; without any id there is nothing to refer to
    originals = (rows.where(f"bytes >= {REVISIT_MIN_BYTES}").groupBy("digest")
            .agg(F.max(F.struct("page_id", "url")).alias("original"), F.count("*").alias("n"))
            .where("n > 1 AND original.page_id IS NOT NULL").select("digest", "original"))
    # written: the join then meets two plain shuffles, and a digest of very many pages can be split
    return rows.join(stage(originals, "warc-originals"), "digest", "left").withColumn(
        "original", F.when(~F.col("page_id").eqNullSafe(F.col("original.page_id")), F.col("original")))


def _base32(hex_digest):
    """Base-32 text of a 160-bit hex digest: four groups of ten hex digits."""
    groups = [F.lpad(F.conv(F.substring(hex_digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), *_BASE32_DIGITS)


def _record_id(page_id, url, digest):
    """A URN from the page's id, address and digest."""
    h = F.md5(F.concat_ws("\n", F.coalesce(page_id.cast("string"), F.lit("")), F.coalesce(url, F.lit("")), digest).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _field(name: str, value):
    """A header line, left out if the value is null; line breaks can't end it early."""
    clean = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def records(resolved: DataFrame, date: str = DATE) -> DataFrame:
    """One column: the WARC record of each page without the blank line that ends it."""
    c, first = F.col, F.col("original")
    revisit = first.isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"),
                    _field("Content-Length", c("bytes")), F.lit("\r\n"))
    body = F.when(revisit, F.lit("")).otherwise(c("payload").cast("string"))
    length = F.octet_length(http) + F.octet_length(body)
    head = F.concat(
        F.lit("WARC/1.1\r\n"), _field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _field("WARC-Record-ID", _record_id(c("page_id"), c("url"), c("digest"))), _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", c("url")), _field("X-Page-Id", c("page_id")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), _base32(c("digest")))),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _field("WARC-Refers-To", F.when(revisit, _record_id(first["page_id"], first["url"], c("digest")))),
        _field("WARC-Refers-To-Target-URI", F.when(revisit, first["url"])),
        _field("WARC-Refers-To-Date", F.when(revisit, F.lit(date))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"), _field("Content-Length", length), F.lit("\r\n"))
    return resolved.select(F.concat(head, http, body).alias("value"))


def write_archives(pages: DataFrame, path: str, date: str = DATE) -> None:
    """Write a deduplicated archive per task below `path`."""
    (records(resolve_revisits(pages), date).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path))


READ = ("page_id long, url string, record_id string, record_type string, payload_digest string, payload_bytes long,"
        " refers_to_id string, payload binary")
_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()),
                    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to_id", pa.string()),
                    ("payload", pa.binary())])


def parse(stream):
    """Yield (headers with lower-case names, block) of each record of a plain archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
        n = int(fields["content-length"])
        block = stream.read(n)
        if len(block) < n:
            raise ValueError("truncated WARC record")
        yield fields, block


def _row(fields: dict, block: bytes, payloads: bool):
    kind, page = fields.get("warc-type"), fields.get("x-page-id")
    digest = fields.get("warc-payload-digest")
    told = base64.b32decode(digest.removeprefix("sha1:")).hex() if digest else None
    payload = size = None
    if kind == "response":
        http = fields.get("content-type", "").startswith("application/http")
        payload = block.partition(b"\r\n\r\n")[2] if http else block
        size, found = len(payload), hashlib.sha1(payload).hexdigest()
        if told not in (None, found):
            raise ValueError(f"payload digest mismatch in {fields.get('warc-record-id')}")
        told = found
    return (int(page) if page else None, fields.get("warc-target-uri"), fields.get("warc-record-id"), kind, told, size,
            fields.get("warc-refers-to"), payload if payloads else None)


def _read(payloads: bool):
    def run(batches):
        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)
        for files in batches:
            for content in files.column(0):
                data = content.as_buffer()
                raw = pa.BufferReader(data)
                stream = io.BufferedReader(gzip.GzipFile(fileobj=raw) if data[:2].to_pybytes() == b"\x1f\x8b" else raw)
                rows, size = [], 0
                for fields, block in parse(stream):
                    rows.append(_row(fields, block, payloads))
                    size += len(block) * payloads + 500
                    if size > 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)
    return run


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records below `path`, revisits joined to their originals: page_id, url, record_id,
    record_type, payload_digest, payload_bytes, refers_to (page_id of the original) and,
    on request, payload (null for revisits)."""
    prepare(spark)
    found = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
             .mapInArrow(_read(payloads), READ))
    originals = stage(found.where("record_type = 'response'").select(
        F.col("record_id").alias("_id"), F.col("page_id").alias("_page"), F.col("payload_bytes").alias("_bytes"),
        F.col("payload_digest").alias("_digest")).dropDuplicates(["_id"]), "warc-responses")
    # a record without a reference meets itself, so that no key is null
    joined = found.join(originals, F.coalesce("refers_to_id", "record_id") == F.col("_id"), "left")
    same = F.col("payload_digest") == F.col("_digest")
    return joined.select("page_id", "url", "record_id", "record_type", "payload_digest",
                         F.coalesce("payload_bytes", F.when(same, F.col("_bytes"))).alias("payload_bytes"),
                         F.when(F.col("refers_to_id").isNotNull() & same, F.col("_page")).alias("refers_to"),
                         *(["payload"] if payloads else []))


def revisit_table(pages: DataFrame, path: str) -> DataFrame:
    """Write the archives, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Defined cases: a null html is an empty payload; payloads under 1000 bytes are
    always responses; of equal larger ones the largest page_id is the response
    (all rows that repeat it are); pages without an id revisit an original with
    one, and are all responses if there is none; a null address has no
    WARC-Target-URI line; line breaks in an address are percent-encoded; payloads
    may hold any bytes, blank lines and WARC headers included; an empty table
    gives empty archives and an empty result; other columns are ignored.
    """
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
