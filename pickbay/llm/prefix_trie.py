"""Prefix trie of conversations by ROLLUP over positional turn columns.

A conversation is cut into blocks of WIDTH turns; a block is one row with its
turns' ids in positional columns t1 .. tWIDTH and the node at which the block
begins.  GROUP BY block, node, ROLLUP(t1, .., tWIDTH) aggregates every prefix
that ends in the block, and GROUPING_ID says how many turns it has.  A node is
named by its depth and a 128-bit fingerprint of its path (the XOR of a hash of
each position and turn), which a row computes from its own columns, so that
blocks of all depths are rolled up at once and no round waits for another.

Sums over subtrees take a second ROLLUP, of the nodes' own values by their paths.
What lies deeper than a node's block is carried by the node's smallest
conversation (its owner) into the blocks before: a running sum over its blocks.

Conversations may be long and groups large: turns are numbered from the counts of
range-partitioned slices, running values over blocks are summed in spans of
blocks, a conversation's id list is hashed as a stream.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickbay.llm.common import prepare, stage

#: Turns in a block (positional columns of a ROLLUP).
WIDTH = 8
#: Blocks of one conversation that are summed together.
SPAN = 1024
#: Rebuilding: families of FAMILY consecutive ids share up to HEAD - 1 first turns.
FAMILY, HEAD = 5, 9
#: Conversation ids written into one piece of a list.
PIECE = 4096


# ---------------------------------------------------------------------------
# turns in order
# ---------------------------------------------------------------------------

def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (1, 2, .. in order of turn, null first), turn_id and bytes of every turn.

    turn_id is a 128-bit digest of role and text.  Equal turn numbers are ordered by
    role and text.  The rows are range-partitioned, so a long conversation lies
    in several slices; its turns are counted slice by slice.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    order = ["conv_id", "turn", "role", "text"]
    within = Window.partitionBy("slice", "conv_id").orderBy("turn", "role", "text")
    sliced = rows.repartitionByRange(*order).withColumn("slice", F.spark_partition_id())
    sliced = stage(sliced.withColumn("local", F.row_number().over(within)).select(
        "conv_id", "slice", "local", digest.alias("turn_id"), F.octet_length("text").cast("long").alias("bytes")), "trie-turns")
    # conversations in more than one slice: one row for each of their slices
    per = sliced.groupBy("conv_id", "slice").agg(F.max("local").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.withColumn("before", F.sum("n").over(before)).where("before IS NOT NULL").select("conv_id", "slice", "before")
    return sliced.join(offsets, ["conv_id", "slice"], "left").select(
        "conv_id", (F.coalesce("before", F.lit(0)) + F.col("local")).alias("pos"), "turn_id", "bytes")


def rebuilt(turns: DataFrame, family: int = FAMILY, head: int = HEAD) -> tuple[DataFrame, DataFrame]:
    """(conversations with their number of turns, turns) after sharing first turns.

    Conversation c begins with the first h original turns of conversation c - c % family
    (fewer if it is shorter, none if absent), h = crc32(decimal c) % head, and goes
    on with its own turns after its first h.
    """
    lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("own"))
    share = F.crc32(F.col("conv_id").cast("string").cast("binary")) % F.lit(head)
    plan = lengths.select("conv_id", "own", share.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    firsts = lengths.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    plan = plan.join(firsts, "base", "left").withColumn("shared", F.least("h", F.coalesce("base_own", F.lit(0))))
    plan = stage(plan.withColumn("n", F.col("shared") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
                 .select("conv_id", "base", "h", "shared", "n"), "trie-plan")
    heads = turns.where(F.col("pos") < head).withColumnRenamed("conv_id", "base")
    taken = plan.where("shared > 0").join(heads, "base").where("pos <= shared").select("conv_id", "pos", "turn_id", "bytes")
    kept = turns.join(plan.select("conv_id", "h", "shared"), "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("shared")).alias("pos"), "turn_id", "bytes")
    return plan.select("conv_id", "n"), taken.unionAll(kept)


# ---------------------------------------------------------------------------
# blocks and nodes
# ---------------------------------------------------------------------------

def _mark(pos, turn) -> list:
    """Two 64-bit hashes of a turn at a position."""
    return [F.xxhash64(pos.cast("long"), turn), F.xxhash64(turn, pos.cast("long"))]


def _running(df: DataFrame, values: dict[str, tuple], forward: bool) -> DataFrame:
    """`values` (name: (aggregate, column)) over the blocks of a conversation before (or after) each block.

    Blocks are aggregated in spans first, so no window holds a long conversation.
    """
    spanned = df.withColumn("span", F.expr(f"block div {SPAN}"))
    order = (lambda c: F.col(c).asc()) if forward else (lambda c: F.col(c).desc())
    outer = Window.partitionBy("conv_id").orderBy(order("span")).rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("conv_id", "span").orderBy(order("block")).rowsBetween(Window.unboundedPreceding, -1)
    spans = spanned.groupBy("conv_id", "span").agg(*[f(c).alias(c) for f, c in values.values()])
    spans = spans.select("conv_id", "span", *[f(c).over(outer).alias(f"_{n}") for n, (f, c) in values.items()])
    inside = spanned.select("*", *[f(c).over(inner).alias(n) for n, (f, c) in values.items()])
    joined = inside.join(spans, ["conv_id", "span"], "left")
    return joined.withColumns({n: (F.coalesce(n, F.lit(0)).bitwiseXOR(F.coalesce(f"_{n}", F.lit(0))) if f is F.bit_xor
                                   else F.coalesce(n, F.lit(0)) + F.coalesce(f"_{n}", F.lit(0)))
                               for n, (f, _) in values.items()}).drop("span", *[f"_{n}" for n in values])


def blocks(conversations: DataFrame, turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """conv_id, block, node (p1, p2) at which it begins, turns t1 .. t<width> (id, bytes) and end (the
    fingerprint e1, e2 of the conversation's path up to the block's last turn).  A
    conversation without turns has one empty block."""
    placed = turns.select("conv_id", F.expr(f"(pos - 1) div {width}").alias("block"),
                          F.expr(f"cast((pos - 1) % {width} + 1 as int)").alias("k"), "pos",
                          F.struct(F.col("turn_id").alias("id"), "bytes").alias("t"))
    one, two = _mark(F.col("pos"), F.col("t.id"))
    rows = placed.groupBy("conv_id", "block").agg(
        *[F.max(F.when(F.col("k") == i, F.col("t"))).alias(f"t{i}") for i in range(1, width + 1)],
        F.bit_xor(one).alias("x1"), F.bit_xor(two).alias("x2"))
    begun = _running(rows, {"p1": (F.bit_xor, "x1"), "p2": (F.bit_xor, "x2")}, forward=True)
    begun = begun.withColumns({"e1": F.col("p1").bitwiseXOR(F.col("x1")), "e2": F.col("p2").bitwiseXOR(F.col("x2"))}).drop("x1", "x2")
    empty = conversations.where("n = 0").select(
        "conv_id", F.lit(0).cast("long").alias("block"),
        *[F.lit(None).cast(placed.schema["t"].dataType).alias(f"t{i}") for i in range(1, width + 1)],
        *[F.lit(0).cast("long").alias(c) for c in ("p1", "p2", "e1", "e2")])
    return begun.select(*empty.columns).unionAll(empty)


def _rollup(df: DataFrame, width: int, measures: str) -> DataFrame:
    """Aggregates of every prefix: block, p1, p2, t1 .., `measures`, depth, node (k1, k2) and its parent (q1, q2).

    Prefixes that run past a conversation's end (their last turn is null) are
    not nodes; a block's own beginning is one only in block 0 (the root).
    """
    turns = ", ".join(f"t{i}" for i in range(1, width + 1))
    rolled = df.sparkSession.sql(
        f"SELECT block, p1, p2, {turns}, {measures}, {width} - bit_count(GROUPING_ID()) AS k "
        f"FROM {{rows}} GROUP BY block, p1, p2, ROLLUP({turns})", rows=df)
    last = "CASE k " + " ".join(f"WHEN {i} THEN t{i}" for i in range(1, width + 1)) + " END"
    rolled = rolled.withColumn("last", F.expr(last)).where("last IS NOT NULL OR (k = 0 AND block = 0)")
    marks = [_mark(F.col("block") * width + i, F.col(f"t{i}.id")) for i in range(1, width + 1)]

    def path(j, upto):   # fingerprint of the path up to the upto-th turn before the last
        key = F.col(f"p{j + 1}")
        for i, m in enumerate(marks, 1):
            key = key.bitwiseXOR(F.when(F.col("k") - upto >= i, m[j]).otherwise(F.lit(0).cast("long")))
        return key
    depth = (F.col("block") * width + F.col("k")).alias("depth")
    return rolled.select("*", depth, path(0, 0).alias("k1"), path(1, 0).alias("k2"), path(0, 1).alias("q1"), path(1, 1).alias("q2"),
                         F.coalesce("last.bytes", F.lit(0)).alias("last_bytes"))


# ---------------------------------------------------------------------------
# digests of id lists
# ---------------------------------------------------------------------------

def _pieces(batches):
    """Sorted (depth, k1, k2, conv_id) rows to pieces of comma-joined ids, each within one node and batch."""
    for batch in batches:
        nodes = list(zip(*(c.to_pylist() for c in batch.columns[:3])))
        ids, out, at = batch.column(3).to_pylist(), [], 0
        while at < len(ids):
            end = at + 1
            while end < len(ids) and nodes[end] == nodes[at] and end - at < PIECE:
                end += 1
            out.append((*nodes[at], ids[at], ",".join(map(str, ids[at:end]))))
            at = end
        if out:
            *keys, text = zip(*out)
            yield pa.RecordBatch.from_arrays([*(pa.array(k, pa.int64()) for k in keys), pa.array(text, pa.string())],
                                             names=["depth", "k1", "k2", "conv_id", "ids"])


def _hash(batches):
    """Pieces sorted by node and first id to one digest a node; a list is never held whole."""
    def row(node, state):
        return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in node), pa.array([state.hexdigest()])],
                                          names=["depth", "k1", "k2", "ends_sha256"])
    node, state, done = None, None, []
    for batch in batches:
        for depth, k1, k2, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
            if (depth, k1, k2) != node:
                if node is not None:
                    done.append(row(node, state))
                node, state = (depth, k1, k2), hashlib.sha256()
                state.update(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()
            done = []
    if node is not None:
        yield row(node, state)


def end_digests(ends: DataFrame) -> DataFrame:
    """depth, k1, k2 and SHA-256 of the ascending, comma-joined conv_ids that end there.

    Ids are sorted by range, so a node with many of them is written by many tasks;
    only its text, in pieces, passes through one hash.
    """
    key = ["depth", "k1", "k2"]
    rows = ends.select(*key, "conv_id").repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
    pieces = rows.mapInArrow(_pieces, "depth long, k1 long, k2 long, conv_id long, ids string")
    return pieces.repartition(*key).sortWithinPartitions(*key, "conv_id").mapInArrow(
        _hash, "depth long, k1 long, k2 long, ends_sha256 string")


# ---------------------------------------------------------------------------

def trie(conversations: DataFrame, turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """The nodes of the trie of `conversations` (conv_id, n) with `turns` (conv_id, pos, turn_id, bytes)."""
    prepare(conversations.sparkSession)
    every = stage(blocks(conversations, turns, width), "trie-blocks")
    nodes = stage(_rollup(every, width, "min(conv_id) AS conv_id, count(*) AS n_convs").drop("k", "last"),
                  "trie-nodes")
    child = (nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("k1"), F.col("q2").alias("k2"))
             .agg(F.count("*").alias("n_children")))
    key = ["depth", "k1", "k2"]
    paths = [f"t{i}" for i in range(1, width + 1)]
    own = nodes.join(child, key, "left").select(
        *key, "conv_id", "block", "p1", "p2", *paths, F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("last_bytes")).alias("saved"))
    own = stage(own, "trie-own")

    # what a conversation owns in later blocks, brought to the earlier ones
    later = own.where("block > 0").groupBy("conv_id", "block").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    owners = later.groupBy("conv_id").agg(F.max("block").alias("deepest"))
    reach = every.join(owners, "conv_id").where("block <= deepest").drop("deepest").join(
        later, ["conv_id", "block"], "left").fillna(0, ["leaves", "saved"])
    carried = _running(reach.drop("e1", "e2"), {"more_leaves": (F.sum, "leaves"), "more_saved": (F.sum, "saved")}, forward=False)
    values = own.select("block", "p1", "p2", *paths, "leaves", "saved").unionAll(
        carried.where("more_leaves > 0 OR more_saved > 0").select("block", "p1", "p2", *paths, "more_leaves", "more_saved"))
    subtrees = _rollup(values, width, "sum(leaves) AS n_leaves, sum(saved) AS saved_tokens")

    ends = every.join(conversations, "conv_id").where(F.expr(f"block = greatest(0, (n - 1) div {width})")).select(
        F.col("n").alias("depth"), F.col("e1").alias("k1"), F.col("e2").alias("k2"), "conv_id")
    nothing = hashlib.sha256().hexdigest()
    whole = (nodes.select(*key, "conv_id", "q1", "q2", "n_convs")
             .join(own.select(*key, "n_children"), key)
             .join(subtrees.select(*key, "n_leaves", "saved_tokens"), key)
             .join(end_digests(ends), key, "left"))
    # the parent is the owner's own node but where the owner's path branches off
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("q1"), F.col("k2").alias("q2"),
                           F.col("conv_id").alias("parent_conv_id"))
    whole = stage(whole, "trie-whole").join(parents, ["depth", "q1", "q2"], "left")
    return whole.select(*[F.col(c).cast("long").alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                                                                   "n_leaves", "saved_tokens")],
                        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """The prefix trie of the rebuilt conversations, one row per node.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (bytes that sharing saves in the subtree), ends_sha256.

    Defined cases: rows without conv_id belong to no conversation and are left
    out; a null turn comes first, equal turns are ordered by role and text; null
    roles and texts are empty; repeated rows are turns of their own; a rebuilt
    conversation may have no turns and then ends at the root; texts are read
    whole; without conversations there is no root; other columns are ignored.
    """
    return trie(*rebuilt(stage(numbered_turns(conversations), "trie-numbered")), width)
