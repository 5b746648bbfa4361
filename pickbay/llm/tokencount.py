"""Edit-aware token counts: a segment tree of pre-token runs per document.

The text is cut before spaces that a non-space follows; no token reaches over
such a cut, and it stays one whatever is changed before the space or after the
next character.  LEAF of these stretches make a leaf, which holds its characters
and tokens; inner nodes hold sums.  An edit finds its leaves by descending the
character sums, re-encodes only those leaves (with the leaf before, where the
edit touches a cut), and renews the sums on the paths to the root.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickbay.llm.common import prepare
from pickbay.llm.tokens import encoder, stretches, tokenizer_path

LEAF = 32             # stretches in a leaf
FULL = 8              # a leaf of more than FULL * LEAF stretches after an edit: the tree is built anew

EDITS = "array<struct<pos:int,del:int,ins:string>>"


class Tree:
    """sums[k] of leaf k - width and of inner nodes, for characters and tokens; node 1 is the root."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars, tokens
        self.width = len(chars) // 2

    @classmethod
    def build(cls, text: str, enc) -> Tree:
        cuts = stretches(text)
        leaves = [cuts[i:i + LEAF] for i in range(0, len(cuts), LEAF)] or [[]]
        width = 1 << (len(leaves) - 1).bit_length()
        tree = cls(np.zeros(2 * width, np.int32), np.zeros(2 * width, np.int32))
        for k, leaf in enumerate(leaves):
            tree.chars[width + k] = sum(map(len, leaf))
            tree.tokens[width + k] = sum([len(enc.stretch(s)) for s in leaf]) // 4
        level = width
        while level > 1:
            for a in (tree.chars, tree.tokens):
                a[level // 2:level] = a[level:2 * level:2] + a[level + 1:2 * level:2]
            level //= 2
        return tree

    @classmethod
    def load(cls, data: bytes) -> Tree:
        a = np.frombuffer(data, "<i4").copy()
        return cls(a[:len(a) // 2], a[len(a) // 2:])

    def dump(self) -> bytes:
        return np.concatenate([self.chars, self.tokens]).astype("<i4").tobytes()

    def leaf_at(self, pos: int) -> tuple[int, int]:
        """(leaf, its first character) of the leaf that holds character `pos`; the last
        non-empty one if there is none."""
        node, start = 1, 0
        pos = max(0, min(pos, int(self.chars[1]) - 1))
        while node < self.width:
            node *= 2
            if pos - start >= self.chars[node]:
                start += int(self.chars[node])
                node += 1
        return node - self.width, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        """Set a leaf and renew the sums above it."""
        node = leaf + self.width
        self.chars[node], self.tokens[node] = chars, tokens
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]


def ordered(edits: list, length: int) -> list[tuple[int, int, str]]:
    """Edits as (begin, end, inserted) by position, clipped to the text, without overlaps."""
    out, done = [], 0
    for e in sorted((e for e in edits or [] if e is not None), key=lambda e: (e["pos"] or 0)):
        begin = min(max(e["pos"] or 0, done), length)
        end = min(max((e["pos"] or 0) + max(e["del"] or 0, 0), begin), length)
        out.append((begin, end, e["ins"] or ""))
        done = end
    return out


def edit(text: str, tree: Tree, edits: list, enc) -> tuple[str, Tree, int, int]:
    """(new text, new tree, characters encoded, leaves encoded)."""
    changes = ordered(edits, len(text))
    regions = []                                    # [first leaf, last leaf, begin, end, changes]
    for begin, end, ins in changes:
        first, start = tree.leaf_at(begin)
        while first and begin < start + 2:          # the cut before this leaf may not hold: take the leaf before
            first -= 1
            start -= int(tree.chars[tree.width + first])
        last, last_start = tree.leaf_at(max(end - 1, begin))
        stop = last_start + int(tree.chars[tree.width + last])
        if regions and first <= regions[-1][1]:
            regions[-1][1], regions[-1][3] = max(regions[-1][1], last), max(regions[-1][3], stop)
            regions[-1][4].append((begin, end, ins))
        else:
            regions.append([first, last, start, stop, [(begin, end, ins)]])
    parts, done, encoded, touched, crowded = [], 0, 0, 0, False
    for first, last, start, stop, changed in regions:
        pieces, at = [], start
        for begin, end, ins in changed:
            pieces += [text[at:begin], ins]
            at = end
        new = "".join([*pieces, text[at:stop]])
        parts += [text[done:start], new]
        done = stop
        cuts, slots = stretches(new), last - first + 1
        share = -(-len(cuts) // slots)
        crowded |= share > FULL * LEAF
        for k in range(slots):                      # the same leaves hold the new stretches
            leaf = cuts[k * share:(k + 1) * share]
            tree.put(first + k, sum(map(len, leaf)), sum([len(enc.stretch(s)) for s in leaf]) // 4)
        encoded += len(new)
        touched += slots
    text = "".join([*parts, text[done:]])
    if crowded:
        tree = Tree.build(text, enc)
    return text, tree, encoded, touched


def _build(path: str):
    def run(batches):
        enc = encoder(path)
        for batch in batches:
            trees = [Tree.build(t or "", enc) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([t.dump() for t in trees], pa.binary()),
                 pa.array([int(t.tokens[1]) for t in trees], pa.int64())], names=["doc_id", "text", "tree", "n_tokens"])
    return run


def token_trees(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, text, tree, n_tokens: the documents with their trees, to be stored."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _build(tokenizer or tokenizer_path()), "doc_id long, text string, tree binary, n_tokens long")


def attach_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """Give each document its edits (doc_id, pos, del, ins) of one batch as the column `edits`.
    A batch's edits don't overlap, so a document has at most one per character and gap."""
    packed = edits.groupBy(F.col("doc_id").alias("_id")).agg(F.sort_array(F.collect_list(F.struct(
        F.col("pos").cast("int").alias("pos"), F.col("del").cast("int").alias("del"), F.col("ins").cast("string").alias("ins")))).alias("edits"))
    return trees.join(packed, F.col("doc_id") == F.col("_id"), "left").drop("_id")


def _apply(path: str):
    def run(batches):
        enc = encoder(path)
        for batch in batches:
            out = []
            for doc, text, data, before, edits in zip(*(c.to_pylist() for c in batch.columns)):
                new, tree, encoded, touched = edit(text or "", Tree.load(data), edits, enc)
                out.append((doc, new if edits or text is not None else None, tree.dump(), int(tree.tokens[1]),
                            before, len(edits or []), len(new), encoded, touched))
            kinds = [pa.int64(), pa.string(), pa.binary(), *[pa.int64()] * 6]
            names = ["doc_id", "text", "tree", "n_tokens", "n_tokens_before", "n_edits", "n_chars", "encoded_chars", "encoded_leaves"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else
                                             [pa.array([], k) for k in kinds], names=names)
    return run


def apply_edits(trees: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Apply the column `edits` to trees and texts; token counts stay those of a full encoding.

    Returns doc_id, text, tree, n_tokens (the new state) and n_tokens_before,
    n_edits, n_chars, encoded_chars, encoded_leaves.

    Defined cases: positions are code points of the text before the batch; edits
    are taken by position, those at one position in their order; one that begins
    in text an earlier one deletes begins at its end; positions beyond the text
    mean its end; null edits, positions, lengths and insertions count as none, 0,
    0 and empty; a null text is empty (and stays null without edits); repeated
    documents are rows of their own; empty tables give empty results.
    """
    prepare(trees.sparkSession)
    return trees.select("doc_id", "text", "tree", "n_tokens", F.col("edits").cast(EDITS).alias("edits")).mapInArrow(
        _apply(tokenizer or tokenizer_path()),
        "doc_id long, text string, tree binary, n_tokens long, n_tokens_before long, n_edits long, n_chars long,"
        " encoded_chars long, encoded_leaves long")


def spread_edits(trees: DataFrame, every: int = 2000) -> DataFrame:
    """A batch of edits for each document, drawn from its id and text: one small
    replacement in every `every` characters, inserting text of its own."""
    return trees.withColumn("edits", F.expr(f"""
        transform(sequence(0, length(coalesce(text, '')) div {every}), i -> named_struct(
            'pos', cast(i * {every} + pmod(xxhash64(doc_id, i), {every} - 50) as int),
            'del', cast(pmod(xxhash64(doc_id, i, 1), 12) as int),
            'ins', substring(coalesce(text, ''), cast(1 + pmod(xxhash64(doc_id, i, 2), greatest(length(text), 1)) as int),
                             cast(pmod(xxhash64(doc_id, i, 3), 12) as int))))"""))
