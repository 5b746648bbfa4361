"""Benchmark decontamination: size-partitioned MinHash containment search.

Items are partitioned by their number of shingles into powers of two.  In the
partition of items with up to u shingles an item's sketch is its u/4 + 1 smallest
shingle hashes (bottom-k MinHash): an item whose shingles lie in a document to
75 % misses at most a quarter of them, so at least one sketch hash is among the
document's - the search loses nothing.  A document is probed against a partition
only if it has enough shingles to hold 75 % of its smallest item.  Candidates are
confirmed by exact containment of the full shingle sets.

The items are the query set.  They are packed into blocks of bounded bytes; each
block is shipped to the tasks and all documents are searched against it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickbay.llm.common import SHINGLE_WORDS, SIMILAR_PERCENT, prepare, text_bytes, window_hashes, word_hashes

#: UTF-8 bytes of item texts in a block (its sketches and sets take a few times that).
BLOCK_BYTES = 8 << 20

SCHEMA = "doc_id long, item_id long, n_item long, n_shared long"


def _item_sets(texts: list[bytes]) -> list[tuple[int, np.ndarray]]:
    """(words in a shingle, sorted distinct shingle hashes) of each item.  An item
    of fewer than five words is one shingle of its own length."""
    words, counts = word_hashes(texts)
    out, at = [], 0
    for n in counts.tolist():
        width = min(n, SHINGLE_WORDS)
        out.append((width, np.unique(window_hashes(words[at:at + n], width)) if width else np.zeros(0, np.uint64)))
        at += n
    return out


class Partition:
    """Items of one shingle width and size class: sorted sketch hashes with their items."""

    def __init__(self, width: int, upper: int, members: list[int], sets: list[np.ndarray]):
        self.width, self.members = width, members
        k = upper * (100 - SIMILAR_PERCENT) // 100 + 1
        sketches = [sets[m][:k] for m in members]
        hashes = np.concatenate(sketches)
        owner = np.repeat(np.array(members), [len(s) for s in sketches])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owner = hashes[order], owner[order]
        self.need = -(-min(len(sets[m]) for m in members) * SIMILAR_PERCENT // 100)

    def candidates(self, shingles: np.ndarray) -> np.ndarray:
        if len(shingles) < self.need:
            return np.zeros(0, np.int64)
        if len(self.hashes) <= len(shingles):
            at = np.searchsorted(shingles, self.hashes)
            at[at == len(shingles)] = 0
            return np.unique(self.owner[shingles[at] == self.hashes])
        # the shorter list is looked up in the longer one: a document's cost hardly grows with the benchmark
        first, last = (np.searchsorted(self.hashes, shingles, side=s) for s in ("left", "right"))
        n = (last - first)[last > first]
        at = np.repeat(first[last > first] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.unique(self.owner[at])


class Index:
    """A block of items: ids, full sets and size partitions."""

    def __init__(self, ids: list, texts: list[bytes]):
        self.ids = ids
        widths_sets = _item_sets(texts)
        self.sets = [s for _, s in widths_sets]
        groups: dict[tuple[int, int], list[int]] = {}
        for m, (width, s) in enumerate(widths_sets):
            if len(s):
                groups.setdefault((width, 1 << (len(s) - 1).bit_length()), []).append(m)
        self.partitions = [Partition(w, u, members, self.sets) for (w, u), members in sorted(groups.items())]

    def search(self, words: np.ndarray):
        """(item position, shared shingles) of every item contained in a text."""
        by_width: dict[int, np.ndarray] = {}
        for part in self.partitions:
            if part.width not in by_width:
                by_width[part.width] = np.unique(window_hashes(words, part.width))
            shingles = by_width[part.width]
            for m in part.candidates(shingles).tolist():
                item = self.sets[m]
                at = np.searchsorted(shingles, item)
                at[at == len(shingles)] = 0
                shared = int(np.count_nonzero(shingles[at] == item))
                if 100 * shared >= SIMILAR_PERCENT * len(item):
                    yield m, shared


def _search(ids: list, texts: list[bytes]):
    def run(batches):
        index = Index(ids, texts)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            words, counts = word_hashes(text_bytes(batch.column(1)))
            rows, at = [], 0
            for doc, n in zip(docs, counts.tolist()):
                rows += [(doc, ids[m], len(index.sets[m]), shared) for m, shared in index.search(words[at:at + n])]
                at += n
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                 names=["doc_id", "item_id", "n_item", "n_shared"])
    return run


def _blocks(benchmark: DataFrame):
    """Lists of (item_id, text) of at most BLOCK_BYTES, streamed through the driver one by one."""
    held, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        text = (row[1] or "").encode()
        if held and size + len(text) > BLOCK_BYTES:
            yield held
            held, size = [], 0
        held.append((row[0], text))
        size += len(text)
    if held:
        yield held


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_item, n_shared: every item of which a document holds at
    least 75 % of the distinct shingles.

    Defined cases: a null, empty or word-free item is contained in nothing, and a
    null, empty or word-free document contains nothing; an item of fewer than
    five words is searched as that word sequence; null ids stay null; repeated
    documents or items are rows of their own, and so are their hits; without
    items or documents the result is empty; other columns are ignored.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for block in _blocks(benchmark):
        hits = texts.mapInArrow(_search([i for i, _ in block], [t for _, t in block]), SCHEMA)
        found = hits if found is None else found.unionAll(hits)
    return docs.sparkSession.createDataFrame([], SCHEMA) if found is None else found


def _without(ids, items, at: int):
    def run(batches):
        index = None
        for batch in batches:
            index = index or Index(ids, items)
            words, counts = word_hashes(text_bytes(batch.column(at)))
            ends = counts.cumsum().tolist()
            keep = [not any(True for _ in index.search(words[end - n:end])) for end, n in zip(ends, counts.tolist())]
            yield batch.filter(pa.array(keep, pa.bool_()))
    return run


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that contain no item; all columns unchanged.

    Every row is judged by its own text, so rows that share a doc_id or have none
    don't answer for each other.  Defined cases: as in contaminated(); a document
    without text stays; without items all rows stay; an empty table stays empty;
    columns may have any name.
    """
    prepare(docs.sparkSession)
    for block in _blocks(benchmark):
        docs = docs.mapInArrow(_without([i for i, _ in block], [t for _, t in block], docs.columns.index("text")), docs.schema)
    return docs
