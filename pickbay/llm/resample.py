"""Importance resampling of documents towards a target distribution.

Features are hashed into buckets.  A document's weight is the mean gain of its
features, where a bucket's gain is the log ratio of its smoothed frequency in the
target texts to that in the documents; a draw without replacement by these
weights is the top of a ranking by weight plus Gumbel noise (exponential races),
with the noise taken from a hash of the id, so that reruns agree.

Weights are scored on arrays: the buckets of a text's features pick from the
gains' array.  The ranking is a parallel sort by regular sampling:

1. every partition of the scored table is sorted and written (a *run*);
2. every run gives the keys at a regular stride; the sorted sample gives regular
   splitters, so a segment between two of them holds about the same number of rows;
3. a row's segment is found by binary search among the splitters, segments are
   exchanged whole and merged by a local sort;
4. prefix sums of the segments' counts and the position inside a segment give
   exact ranks.  Segments past the last drawn rank need no exchange.

The key ends with run and position, so it is unique and equal scores, however many,
are spread over segments.  The driver sees the buckets' counts (a parameter's
number of rows), the sample (SAMPLES rows a segment and one a run) and one
count a segment.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickbay.llm.common import prepare, stage, text_bytes

BUCKETS, LONGEST, MIN_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024
#: Sampled keys for each segment.
SAMPLES = 32
#: Features kept with their bucket in a Python worker; a full cache is emptied.
CACHE, CACHED_BYTES = 1_000_000, 48
#: Bytes of a text that are cut into words at once.
CHUNK = 1 << 20

#: Digits, a-z and bytes of other than ASCII characters are kept, A-Z lower-cased, the rest parts words.
_WORD_BYTE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Features(dict):
    """Buckets of features; a bounded cache of itself."""

    def __init__(self, buckets: int, longest: int):
        self.buckets, self.longest = buckets, longest

    def __missing__(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % self.buckets
        if len(feature) <= CACHED_BYTES:
            if len(self) >= CACHE:
                self.clear()
            self[feature] = bucket
        return bucket

    def of(self, text: bytes):
        """Yield (words, buckets of the features that end in them) for stretches of a text."""
        at, tail = 0, []
        while at < len(text):
            part = text[at:at + CHUNK].translate(_WORD_BYTE)
            while at + len(part) < len(text) and b" " not in part:   # a word longer than a chunk
                part += text[at + len(part):at + len(part) + CHUNK].translate(_WORD_BYTE)
            if at + len(part) < len(text):
                part = part[:part.rfind(b" ") + 1]
            at += len(part)
            words = part.split()
            features = words
            if self.longest > 1:
                line, old = tail + words, len(tail)
                features = list(words)
                for n in range(2, self.longest + 1):
                    first = max(0, old - n + 1)
                    features += map(b" ".join, zip(*(line[first + k:] for k in range(n))))
                tail = line[-(self.longest - 1):]
            yield len(words), np.array(list(map(self.__getitem__, features)), np.int64)


def _count(buckets: int, longest: int):
    def run(batches):
        features, total = Features(buckets, longest), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in text_bytes(batch.column(0)):
                for _, found in features.of(text):
                    total += np.bincount(found, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Features in each bucket over all texts (one array of `buckets` numbers)."""
    prepare(texts.sparkSession)
    rows = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(
        _count(buckets, longest), "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect()
    counts = np.zeros(buckets, np.int64)
    for bucket, n in rows:
        counts[bucket] = n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio) of each bucket, from add-one smoothed frequencies."""
    b, s, t = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((y + 1) * (s + b) / ((x + 1) * (t + b))))
                     for x, y in zip(corpus.astype(float).tolist(), target.astype(float).tolist())], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise in thousandths, from the first 32 bits of a hash of the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(table: np.ndarray, longest: int, seed: int):
    def run(batches):
        features = Features(len(table), longest)
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for doc_id, text in zip(ids, text_bytes(batch.column(1))):
                words = n = total = 0
                for found_words, found in features.of(text):
                    words += found_words
                    n += len(found)
                    total += int(table[found].sum())
                weight = total // n if n else 0
                rows.append((words, n, weight, weight + noise(doc_id, seed)))
            columns = np.array(rows, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in columns)],
                                             names=["doc_id", "n_words", "n_features", "weight", "score"])
    return run


def scores(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row of `docs`."""
    prepare(docs.sparkSession)
    table = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _score(table, longest, seed), "doc_id long, n_words long, n_features long, weight long, score long")


# ---------------------------------------------------------------------------
# parallel sorting by regular sampling
# ---------------------------------------------------------------------------

#: Highest score first, then the smaller id (null last); equal rows in any order.
_KEY = ["score", "doc_id", "n_features", "n_words", "run", "pos"]
_POSITION = (1 << 33) - 1      # monotonically_increasing_id counts in its low 33 bits


def _order(*tie: str) -> list:
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "n_features", "n_words", *tie]


def _sort_keys(columns: list[pa.Array]) -> np.ndarray:
    """The columns of _KEY as byte strings that sort like _order()."""
    score, doc, *rest = columns
    flip = np.uint64(1 << 63)
    up = [c.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ flip for c in (score, doc.fill_null(0), *rest)]
    parts = [~up[0], (~np.asarray(doc.is_valid())).astype(np.uint64), *up[1:]]
    table = np.stack(parts, axis=1).astype(">u8")
    return np.ascontiguousarray(table).view(f"S{8 * len(parts)}").reshape(-1)


def _segments(splitters: np.ndarray, names: list[str]):
    def run(batches):
        for batch in batches:
            keys = _sort_keys([batch.column(names.index(c)) for c in _KEY])
            segment = np.searchsorted(splitters, keys, side="right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment.astype(np.int32))], names=[*names, "segment"])
    return run


def ranked(rows: DataFrame, drawn: int, n: int, segments: int) -> DataFrame:
    """`rows` (n of them, with the columns of scores()) and their rank if it is at most `drawn`, else null."""
    at = (F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION))).alias("pos")
    runs = stage(rows.sortWithinPartitions(*_order()).select("*", F.spark_partition_id().alias("run"), at), "resample-runs")

    stride = max(1, -(-n // (SAMPLES * segments)))
    # a run begins at a place of its own within the stride, so short runs are sampled in proportion too
    regular = F.expr(f"pos % {stride} = pmod(run * 2654435761L, {stride}L)")
    sample = runs.where(regular).select(*_KEY).toArrow().combine_chunks()
    keys = np.sort(_sort_keys([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in sample.columns]))
    splitters = keys[SAMPLES::SAMPLES][:segments - 1]

    cut = stage(runs.mapInArrow(_segments(splitters, runs.columns), f"{_ddl(runs)}, segment int"), "resample-segments")
    counts = dict(cut.groupBy("segment").count().collect())
    before, total = [], 0
    for s in range(len(splitters) + 1):
        if total >= drawn:
            break
        before.append((s, total))
        total += counts.get(s, 0)
    offsets = rows.sparkSession.createDataFrame(before, "segment int, before long")

    # only segments that reach below the last drawn rank are exchanged; one segment goes to one task
    exchanged = cut.where(F.col("segment") < len(before)).repartitionById(segments, "segment")
    merged = exchanged.withColumn("local", F.row_number().over(Window.partitionBy("segment").orderBy(*_order("run", "pos"))))
    rank = F.col("before") + F.col("local")
    top = merged.join(F.broadcast(offsets), "segment").withColumn("rank", F.when(rank <= drawn, rank))
    rest = cut.where(F.col("segment") >= len(before)).withColumn("rank", F.lit(None).cast("long"))
    return top.select(*rows.columns, "rank").unionAll(rest.select(*rows.columns, "rank"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS,
             longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null if not drawn) of every row of `docs`.

    Of the rows with at least `min_words` words, floor(percent * rows / 100) are
    drawn: those with the highest scores, ties to the smaller doc_id.

    Defined cases: a null, empty or word-free text has no features and weight 0
    and can't be drawn (if min_words is positive); a null doc_id hashes as an empty
    id and comes after equal scores with an id; repeated rows are drawn one by one;
    texts are read whole, in stretches; an empty target leaves smoothed gains; an
    empty table gives an empty result; columns other than doc_id and text are ignored.
    """
    spark = docs.sparkSession
    scored = stage(scores(docs, target, buckets, longest, seed), "resample-scores")
    eligible = scored.where(F.col("n_words") >= min_words)
    n = eligible.count()
    segments = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = ranked(eligible, percent * n // 100, n, segments).unionAll(
        scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
