"""Helpers shared by the operators: staged tables, words, shingle hashes.

Words are maximal runs of bytes other than space and 0x09-0x0D; A-Z are
lower-cased where a function says so.  A shingle is five consecutive words; a
text of one to four words has its whole sequence as its only shingle; a text
without words has none.  Shingles are represented by 64-bit hashes.
"""

from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession

from pickbay.session import ensure_checkpoint_dir

#: Words in a shingle, and the similarity (in hundredths) that links two texts.
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 75

#: Rows of an Arrow batch handed to Python: whole texts travel in them.
ARROW_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Session settings of operators that hand whole texts to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/staged/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: a lineage cut that
    survives lost executors and fixes whatever partitioning `df` had."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------------------
# words and shingles
# ---------------------------------------------------------------------------

_SPACES = b" \t\n\x0b\x0c\r"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(_SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_CAP = 1 << 18  # bytes hashed at once
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 & ~7 | 5)
_POWERS = np.concatenate([[np.uint64(1)], np.cumprod(np.full(_CAP, _BASE, np.uint64))])
_MIXERS = _rng.integers(0, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mix32(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 32-bit values."""
    x = x ^ (x >> np.uint32(16))
    x = x * np.uint32(0x85EBCA6B)
    x = x ^ (x >> np.uint32(13))
    x = x * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def _hash_chunk(chunk: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every word of at most _CAP bytes that end in a space."""
    raw = np.frombuffer(chunk, np.uint8)
    space = _IS_SPACE[raw]
    inner = ~space
    starts = np.flatnonzero(inner & np.concatenate([[True], space[:-1]]))
    ends = np.flatnonzero(space & np.concatenate([[False], inner[:-1]]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[_LOWER[raw] if lower else raw] * _POWERS[:len(raw)])])
    # a polynomial over the word's bytes, moved to one common exponent
    return starts, mix64((sums[ends] - sums[starts]) * _POWERS[_CAP - starts])


def _long_hashes(text: bytes, lower: bool) -> np.ndarray:
    """Word hashes of a text longer than a chunk, cut at spaces."""
    out, pos = [], 0
    while pos < len(text):
        end = pos + _CAP - 1
        if end >= len(text):
            out.append(_hash_chunk(text[pos:] + b" ", lower)[1])
            break
        cut = max(text.rfind(c, pos, end) for c in (_SPACES[i:i + 1] for i in range(6)))
        if cut < 0:  # one word longer than a chunk
            stop = min((p for p in (text.find(c, end) for c in (_SPACES[i:i + 1] for i in range(6))) if p >= 0),
                       default=len(text))
            if stop - pos < _CAP:   # as long as a chunk holds: hashed as it is in a chunk
                out.append(_hash_chunk(text[pos:stop] + b" ", lower)[1])
            else:
                word = text[pos:stop].lower() if lower else text[pos:stop]
                out.append(np.array([xxhash.xxh3_64_intdigest(word)], np.uint64))
            pos = stop
        else:
            out.append(_hash_chunk(text[pos:cut + 1], lower)[1])
            pos = cut + 1
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the word count of each text."""
    parts, counts, i = [], np.zeros(len(texts), np.int64), 0
    while i < len(texts):
        if len(texts[i]) >= _CAP:
            h = _long_hashes(texts[i], lower)
            parts.append(h)
            counts[i] = len(h)
            i += 1
            continue
        j, size = i, 0
        while j < len(texts) and size + len(texts[j]) + 1 <= _CAP:
            size += len(texts[j]) + 1
            j += 1
        starts, h = _hash_chunk(b"\n".join(texts[i:j]) + b"\n", lower)
        bounds = np.cumsum([len(t) + 1 for t in texts[i:j]])
        counts[i:j] = np.diff(np.searchsorted(starts, bounds), prepend=0)
        parts.append(h)
        i = j
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), counts


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of `width` consecutive word hashes."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, width, np.uint64) * _MIXERS[7]
    for k in range(width):
        total += words[k:k + n] * _MIXERS[k]
    return mix64(total)


def shingle_sets(texts: list[bytes], lower: bool = True):
    """Yield the sorted distinct shingle hashes of each text."""
    words, counts = word_hashes(texts, lower)
    windows = window_hashes(words, SHINGLE_WORDS)
    at = 0
    for n in counts.tolist():
        if n >= SHINGLE_WORDS:
            yield np.unique(windows[at:at + n - SHINGLE_WORDS + 1])
        else:
            yield window_hashes(words[at:at + n], n) if n else np.zeros(0, np.uint64)
        at += n


def text_bytes(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null counts as empty."""
    import pyarrow as pa
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
