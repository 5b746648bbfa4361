"""Token ids as length-delimited binary records, with a separate offset index.

A record file is a run of frames, each followed by a newline byte:

    u64 payload length | u32 masked CRC of those 8 bytes | payload | u32 masked CRC of the payload

A payload is: u8 flags (1: no doc_id, 2: 32-bit ids), i64 doc_id, u32 number of
ids, then the ids (16-bit where all fit, else 32-bit).  All integers are
little-endian; a CRC is CRC-32 (zlib), masked as rotate-right-15 plus 0xA282EAD8
so that checksums stored inside checksummed data stay meaningful.

Documents lie in ascending doc_id order over the files part-00000, part-00001, ...
The frames are written by Spark's text writer (the newline is its separator), so
task retries and lost executors are handled by Spark's output committer, on any
file system.  The index is a Parquet table beside the files.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pickbay.llm.common import prepare
from pickbay.llm.tokens import encoder, tokenizer_path

END_ID = 0
_HEAD = struct.Struct("<BqI")
_FILE_NUMBER = re.compile(r"part-(\d+)")


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    payload = _HEAD.pack((doc_id is None) | 2 * wide, doc_id or 0, len(ids)) + ids.astype("<u4" if wide else "<u2").tobytes()
    length = struct.pack("<Q", len(payload))
    return b"".join([length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload))])


def unframe(data, offset: int = 0) -> tuple[int | None, np.ndarray, int]:
    """(doc_id, ids, offset of the next frame) of the frame at `offset`; raises on damage."""
    length = bytes(data[offset:offset + 8])
    if len(length) < 8 or struct.unpack_from("<I", data, offset + 8)[0] != masked_crc(length):
        raise ValueError(f"damaged frame length at byte {offset}")
    at, n = offset + 12, struct.unpack("<Q", length)[0]
    payload = bytes(data[at:at + n])
    if len(payload) < n or struct.unpack_from("<I", data, at + n)[0] != masked_crc(payload):
        raise ValueError(f"damaged frame payload at byte {offset}")
    flags, doc_id, count = _HEAD.unpack_from(payload)
    ids = np.frombuffer(payload, "<u4" if flags & 2 else "<u2", count, _HEAD.size)
    return (None if flags & 1 else doc_id), ids, at + n + 5


def _encode(path: str):
    def run(batches):
        enc, end = encoder(path, added=True), np.array([END_ID], "<u4")
        for batch in batches:
            out = [frame(i, np.concatenate([np.frombuffer(enc.encode(t or ""), "<u4"), end]))
                   for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
    return run


def write_token_records(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Encode whole texts, end each with id 0, and write `path`/records and `path`/index.

    Defined cases: a null or empty text is its end id alone; an added token's string
    in a text is that token, as in the library's own encoding; null doc_ids come first; rows of one doc_id are
    ordered by a hash of the text, equal rows are interchangeable; an empty table
    gives no records and an empty index; other columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    frames = (rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
              .mapInArrow(_encode(tokenizer or tokenizer_path()), "frame binary"))
    frames.select(F.col("frame").cast("string").alias("value")).write.text(f"{path}/records")
    scan(spark, path).write.option("compression", "zstd").parquet(f"{path}/index")


INDEX = ("file int, offset long, length long, doc_id long, start_in_file long, n_tokens long, ids_crc32 long")


def _scan(batches):
    for batch in batches:
        for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            number, data = int(_FILE_NUMBER.search(name)[1]), memoryview(content.as_buffer())
            rows, at, start = [], 0, 0
            while at < len(data):
                doc_id, ids, after = unframe(data, at)
                rows.append((number, at, after - at, doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                at, start = after, start + len(ids)
            if rows:
                fields = ["file", "offset", "length", "doc_id", "start_in_file", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if f == "file" else pa.int64()) for f, c in zip(fields, zip(*rows))], names=fields)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records").select("path", "content")


def scan(spark: SparkSession, path: str) -> DataFrame:
    """The offset index, read from the record files; every checksum is verified."""
    return _files(spark, path).mapInArrow(_scan, INDEX)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The offset index with `start`: the ids of all documents before each one."""
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)   # one row per file
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("n")).select(
        "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return index.join(files, "file").withColumn("start", F.col("before") + F.col("start_in_file")).drop("before")


def _read(batches):
    for batch in batches:
        for content, offsets in zip(batch.column(0), batch.column(1).to_pylist()):
            data = memoryview(content.as_buffer())
            found = [unframe(data, at) for at in offsets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1].tolist() for f in found], pa.list_(pa.int64()))],
                names=["doc_id", "ids"])


def read_records(spark: SparkSession, path: str, entries: DataFrame | None = None, seed: int | None = None) -> DataFrame:
    """doc_id and ids of the records named by index `entries` (all by default).

    With a seed the rows come in an order drawn for it: entries are sought by
    their offsets file by file and sorted by a hash of seed and position.
    """
    entries = read_index(spark, path) if entries is None else entries
    per_file = entries.groupBy("file").agg(F.sort_array(F.collect_list("offset")).alias("offsets"))
    files = _files(spark, path).withColumn("file", F.regexp_extract("path", r"part-(\d+)", 1).cast("int"))
    found = files.join(per_file, "file").select("content", "offsets").mapInArrow(_read, "doc_id long, ids array<long>")
    return found if seed is None else found.orderBy(F.xxhash64(F.lit(seed), "doc_id", "ids"))


def token_table(docs: DataFrame, path: str, tokenizer: str | None = None) -> DataFrame:
    """Write the records below `path`, read them back: doc_id, start, n_tokens, ids_crc32."""
    write_token_records(docs, path, tokenizer)
    return read_index(docs.sparkSession, path).select("doc_id", "start", "n_tokens", "ids_crc32")
