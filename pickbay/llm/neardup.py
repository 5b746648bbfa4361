"""Near-duplicate detection with b-bit MinHash.

1. Every document becomes its set of 5-word shingle hashes, its size, a key of
   the set, 32 band keys of 4 minima each, and a packed signature that keeps
   the low 2 bits of 256 minima (64 bytes).
2. Documents with equal sets form a class; its smallest doc_id represents it.
3. Representatives that share a band key are candidates.  The smallest of a
   bucket is compared with each other member: the collision-corrected estimate
   from the packed signatures (xor and bit counts) discards pairs far below the
   threshold, the full sets decide the rest.
4. Buckets whose members are then still in different components are compared
   in blocks of bounded size, only across components; again the estimate comes
   first and the full sets decide.
5. Components of all confirmed links give every document its component.

A pair at the threshold shares no band with probability (1 - 0.75^4)^32 = 5e-6,
and its estimate is more than 4.5 standard errors low with about 3e-6.  Neither
buckets nor partners are capped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickbay.llm.common import SIMILAR_PERCENT, mix32, mix64, prepare, shingle_sets, stage, text_bytes
from pickbay.llm.components import components

MINIMA, BANDS, ROWS, LOW_BITS = 256, 32, 4, 2
LANES = 64 // LOW_BITS                      # minima in a 64-bit word of the signature
SIG_WORDS = MINIMA // LANES
BLOCK = 512                                 # members of a bucket that one task compares with as many
STANDARD_ERRORS = 4.5

_CHANCE = 2.0 ** -LOW_BITS                  # equal low bits of unequal minima
_MATCH = SIMILAR_PERCENT / 100 * (1 - _CHANCE) + _CHANCE
_SIGMA = (_MATCH * (1 - _MATCH) / MINIMA) ** 0.5 / (1 - _CHANCE)
#: Estimated similarity below which a pair is discarded.
ESTIMATE_MIN = SIMILAR_PERCENT / 100 - STANDARD_ERRORS * _SIGMA
#: The same as a number of equal lanes.
LANES_MIN = int(np.ceil(MINIMA * (ESTIMATE_MIN * (1 - _CHANCE) + _CHANCE)))

_FACTORS = np.random.default_rng(271828).integers(0, 1 << 31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_LANE_MASK = 0x5555555555555555
_SHIFTS = (np.arange(LANES) * LOW_BITS).astype(np.uint64)


# ---------------------------------------------------------------------------
# signatures
# ---------------------------------------------------------------------------

def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each of the MINIMA multiplicative hashes."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        part = x[at:at + 1024]
        np.minimum(low, (_FACTORS[:, None] * part[None, :]).min(axis=1), out=low)
    return mix32(low)


def band_keys(low: np.ndarray) -> np.ndarray:
    """One 64-bit key per band from ROWS consecutive minima and the band's number."""
    m = low[:BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(0, ROWS, 2):
        key = mix64(key ^ (m[:, r] | (m[:, r + 1] << np.uint64(32))))
    return key


def packed(low: np.ndarray) -> np.ndarray:
    """The low bits of all minima in SIG_WORDS 64-bit words."""
    bits = (low & np.uint32((1 << LOW_BITS) - 1)).astype(np.uint64).reshape(SIG_WORDS, LANES)
    return np.bitwise_or.reduce(bits << _SHIFTS, axis=1)


def equal_lanes(sig: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Equal minima (by their low bits) between one signature and each of `others`."""
    x = sig[None, :] ^ others
    return MINIMA - np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(_LANE_MASK)).sum(axis=1).astype(np.int64)


def estimate(lanes):
    """Similarity from the share of equal lanes, corrected for chance collisions."""
    return (lanes / MINIMA - _CHANCE) / (1 - _CHANCE)


def _equal_lanes_sql(a: str, b: str) -> str:
    """`equal_lanes` of two array<bigint> columns in SQL."""
    def word(i):
        x = f"({a}[{i}] ^ {b}[{i}])"
        return f"bit_count(({x} | shiftrightunsigned({x}, 1)) & {_LANE_MASK}L)"
    return f"({MINIMA} - ({' + '.join(word(i) for i in range(SIG_WORDS))}))"


def _comparable_sql(n: str, m: str) -> str:
    return f"100 * least({n}, {m}) >= {SIMILAR_PERCENT} * greatest({n}, {m})"


FEATURES = ("doc_id long, n_shingles long, set_hi long, set_lo long, sig array<long>, bands array<long>")


def _features(batches):
    for batch in batches:
        ids = batch.column(0)
        n, hi, lo, sigs, bands = [], [], [], [], []
        for s in shingle_sets(text_bytes(batch.column(1))):
            n.append(len(s))
            if not len(s):
                hi.append(None), lo.append(None), sigs.append([]), bands.append([])
                continue
            key = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
            low = minima(s)
            hi.append(int(key[0])), lo.append(int(key[1]))
            sigs.append(packed(low).view(np.int64)), bands.append(band_keys(low).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()),
             pa.array(sigs, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))],
            names=["doc_id", "n_shingles", "set_hi", "set_lo", "sig", "bands"])


def features(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, the 128-bit key of the set, signature and band keys."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(_features, FEATURES)


def _sets(batches):
    for batch in batches:
        sets = [s.tobytes() for s in shingle_sets(text_bytes(batch.column(1)))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])


# ---------------------------------------------------------------------------
# confirmation on full sets
# ---------------------------------------------------------------------------

def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    if 100 * min(len(a), len(b)) < SIMILAR_PERCENT * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")                # two sorted runs: one merge
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= SIMILAR_PERCENT * (len(both) - shared)


def _confirm_pairs(batches):
    """Rows (a, b, shingles of a, shingles of b) whose sets are similar enough."""
    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        keep = [k for k, (x, y) in enumerate(zip(batch.column(2), batch.column(3)))
                if _similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64))]
        yield pa.RecordBatch.from_arrays([pa.array([a[k] for k in keep], pa.int64()),
                                          pa.array([b[k] for k in keep], pa.int64())], names=["a", "b"])


CELL = ["bucket", "x", "y"]


class Cell:
    """The members of one cell as arrays: rows lo..hi of a sorted Arrow table."""

    def __init__(self, columns: dict, lo: int, hi: int):
        self.bucket, self.x, self.y, self.band = (int(columns[c][lo]) for c in (*CELL, "band"))
        self.block, self.node, self.label, self.n = (columns[c][lo:hi] for c in ("block", "node", "label", "n"))
        self.sig, self.bands = columns["sig"][lo:hi], columns["bands"][lo:hi]
        self.shingles = columns["shingles"][lo:hi] if "shingles" in columns else None


def _columns(table: pa.Table) -> dict:
    out = {}
    for name in table.column_names:
        col = table.column(name).combine_chunks()
        if name in ("sig", "bands"):
            out[name] = col.flatten().to_numpy().reshape(len(col), -1)
        else:
            out[name] = col if name == "shingles" else col.to_numpy()
    out["sig"] = out["sig"].view(np.uint64)
    return out


def _cells(batches):
    """Split rows sorted by (bucket, x, y) into cells; only the last one waits for the next batch."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        keys = np.stack([table.column(c).to_numpy() for c in CELL])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]
        if len(cuts) > 1:
            columns = _columns(table)
            for lo, hi in zip(cuts, cuts[1:]):
                yield Cell(columns, lo, hi)
        held = table.slice(cuts[-1])
    if held is not None:
        yield Cell(_columns(held), 0, held.num_rows)


def _candidates(cell: Cell):
    """(i, partners): members of a cell with the later ones they must be compared with.

    Partners lie in the other block (or anywhere in a cell of one block), in
    another component, within the size ratio, above the estimate, and share no
    earlier band: each pair is looked at in its first common bucket only.
    """
    split = cell.x != cell.y
    for i in range(len(cell.node) - 1):
        ok = cell.label[i + 1:] != cell.label[i]
        if split:
            ok &= cell.block[i + 1:] != cell.block[i]
        n = cell.n[i + 1:]
        ok &= 100 * np.minimum(n, cell.n[i]) >= SIMILAR_PERCENT * np.maximum(n, cell.n[i])
        js = np.flatnonzero(ok) + (i + 1)
        if len(js):
            js = js[equal_lanes(cell.sig[i], cell.sig[js]) >= LANES_MIN]
        if len(js) and cell.band:
            js = js[~(cell.bands[js, :cell.band] == cell.bands[i, :cell.band]).any(axis=1)]
        if len(js):
            yield i, js


def _flag(batches):
    """The members of each cell that have a candidate partner there."""
    names = [*CELL, "node"]
    for cell in _cells(batches):
        flagged = np.zeros(len(cell.node), bool)
        for i, js in _candidates(cell):
            flagged[i] = True
            flagged[js] = True
        if flagged.any():
            nodes = cell.node[flagged]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(np.full(len(nodes), k)) for k in (cell.bucket, cell.x, cell.y)), pa.array(nodes)], names=names)


def _confirm_cells(batches):
    """Confirmed links of each cell, without those that earlier ones imply."""
    for cell in _cells(batches):
        sets: dict[int, np.ndarray] = {}

        def shingles(k, cell=cell, sets=sets):
            if k not in sets:
                sets[k] = np.frombuffer(cell.shingles[k].as_py(), np.uint64)
            return sets[k]

        labels, root = np.unique(cell.label, return_inverse=True)
        up = list(range(len(labels)))       # components that this cell has joined

        def top(k, up=up):
            while up[k] != k:
                up[k] = up[up[k]]
                k = up[k]
            return k

        links = []
        for i, js in _candidates(cell):
            for j in js.tolist():
                p, q = top(int(root[i])), top(int(root[j]))
                if p != q and _similar(shingles(i), shingles(j)):
                    links.append((int(cell.node[i]), int(cell.node[j])))
                    up[max(p, q)] = min(p, q)
        if links:
            a, b = zip(*links)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


# ---------------------------------------------------------------------------
# the operator
# ---------------------------------------------------------------------------

def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `docs` (doc_id, text, ...).

    Documents are linked when 100 * shared shingles >= 75 * shingles of either;
    component_id is the smallest doc_id reachable over links, the document's own
    included, and kept says that doc_id is component_id.

    Defined cases: a null, empty or word-free text has no shingles and links with
    nothing; a row with a null doc_id can't name or be named by a component: its
    component_id is null and it is kept; repeated rows of one doc_id and text
    share everything; an empty table gives an empty result; columns other than
    doc_id and text are ignored, whatever their names.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    feats = stage(features(docs), "neardup-features")

    classes = (feats.where("n_shingles > 0 AND doc_id IS NOT NULL")
               .groupBy("set_hi", "set_lo").agg(F.min("doc_id").alias("node")))
    reps = feats.where("n_shingles > 0").withColumnRenamed("doc_id", "node").join(
        classes.select("node"), "node", "left_semi").dropDuplicates(["node", "set_hi", "set_lo"])

    banded = reps.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = (banded.groupBy("bucket").agg(F.min("node").alias("pivot"), F.max("node").alias("top"))
              .where("pivot < top").select("bucket", "pivot"))
    # the shared buckets are written, so that a bucket of very many members can be split in the join
    members = stage(banded.join(stage(shared, "neardup-buckets"), "bucket"), "neardup-members")

    named = members.select("node").distinct()
    sigs = reps.select("node", F.col("n_shingles").alias("n"), "sig", "bands").join(named, "node", "left_semi")
    sets = stage(docs.where("doc_id IS NOT NULL").withColumnRenamed("doc_id", "node")
                 .join(named, "node", "left_semi").mapInArrow(_sets, "node long, shingles binary").distinct(),
                 "neardup-sets")
    sigs = stage(sigs, "neardup-sigs")

    # each bucket's smallest member against the others
    def side(df, col, tag):
        return df.select(F.col("node").alias(col), *[F.col(c).alias(f"{c}_{tag}") for c in df.columns if c != "node"])

    brief = sigs.select("node", "n", "sig")
    pairs = (members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
             .join(side(brief, "b", "b"), "b").join(side(brief, "a", "a"), "a")
             .where(f"{_comparable_sql('n_a', 'n_b')} AND {_equal_lanes_sql('sig_a', 'sig_b')} >= {LANES_MIN}")
             .select("a", "b"))
    stars = (pairs.join(side(sets, "b", "b"), "b").join(side(sets, "a", "a"), "a")
             .select("a", "b", "shingles_a", "shingles_b").mapInArrow(_confirm_pairs, "a long, b long"))
    first = stage(components(stars, "neardup-stars"), "neardup-first")

    # what is left: members of one bucket in different components
    def labelled(nodes, labels):
        return nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))

    located = labelled(members, first)
    mixed = (located.groupBy("bucket", "label").agg(F.count("*").alias("c"), F.min("node").alias("m"))
             .groupBy("bucket").agg(F.min_by(F.struct("label", "c"), F.col("m")).alias("main"),
                                    F.sum("c").alias("size"), F.count("*").alias("parts"))
             .where("parts > 1").select("bucket", F.col("main.label").alias("main"),
                                        F.col("main.c").alias("n_main"), F.expr("size - main.c").alias("n_rest")))
    inner = located.join(stage(mixed, "neardup-mixed"), "bucket").withColumn("rest", F.col("label") != F.col("main"))
    # blocks 0 .. mains-1 hold the main component, the following ones the rest;
    # a cell is a pair of blocks of which at least one is of the rest
    cells = (inner.withColumn("mains", F.expr(f"cast(ceil(n_main / {BLOCK}) as long)"))
             .withColumn("blocks", F.expr(f"mains + cast(ceil(n_rest / {BLOCK}) as long)"))
             .withColumn("block", F.expr("CASE WHEN rest THEN mains + pmod(xxhash64(node), blocks - mains)"
                                         " ELSE pmod(xxhash64(node), mains) END"))
             .withColumn("other", F.explode(F.expr("CASE WHEN rest THEN sequence(0L, blocks - 1)"
                                                   " ELSE sequence(mains, blocks - 1) END")))
             .select("bucket", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
                     "block", "band", "node", "label"))
    cells = stage(cells, "neardup-cells")

    # few bytes but much comparing: keep all partitions
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def by_cell(df):
        return df.repartition(tasks, *CELL).sortWithinPartitions(*CELL, "node")

    flagged = (by_cell(cells.join(sigs, "node"))
               .mapInArrow(_flag, "bucket long, x long, y long, node long").distinct())
    flagged = stage(flagged, "neardup-flagged")
    links = (by_cell(cells.join(flagged, [*CELL, "node"]).join(sigs, "node").join(sets, "node"))
             .mapInArrow(_confirm_cells, "a long, b long"))
    ends = labelled(labelled(links.withColumnRenamed("a", "node"), first).select(F.col("label").alias("a"), F.col("b").alias("node")),
                    first).select("a", F.col("label").alias("b"))
    second = components(ends, "neardup-links").select(F.col("node").alias("label"), F.col("label").alias("last"))

    final = (classes.join(first, "node", "left").withColumn("label", F.coalesce("label", "node"))
             .join(second, "label", "left")
             .select("set_hi", "set_lo", F.coalesce("last", "label").alias("component")))
    # written, so that the join below meets two plain shuffles and a hot class of copies can be split
    final = stage(final, "neardup-classes")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (feats.select("doc_id", "n_shingles", "set_hi", "set_lo").join(final, ["set_hi", "set_lo"], "left")
            .select("doc_id", "n_shingles", own.alias("component_id"),
                    F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept")))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The rows of `docs` without near duplicates: one document of each component stays,
    the one with the smallest doc_id; all columns unchanged.

    A document is a doc_id and a text: rows equal in both are one document, all of whose
    rows stay or go together; a doc_id that carries several texts is several
    documents, as are rows without a doc_id.  All but one of them get a number above all
    ids, by which they take part like any other document.  Defined cases: a
    text without words stays; an empty table stays empty; columns may have any name.
    """
    text = F.col("text").cast("string")
    key = {"id": F.col("doc_id").cast("long"), "h1": F.xxhash64(text), "h2": F.xxhash64(F.lit("text"), text)}
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        *[c.alias(n) for n, c in key.items()])
    ids = keyed.select("id", "h1", "h2")
    texts = ids.groupBy("id").agg(F.min(F.struct("h1", "h2")).alias("first"), F.max(F.struct("h1", "h2")).alias("last"))
    several = stage(texts.where("id IS NULL OR first < last").select(F.col("id").alias("of"), "first"), "distinct-several")
    span = ids.agg(F.min("id"), F.max("id")).first()
    top = max(span[1] or 0, 0) + 1
    base = top if top < 1 << 62 else min(span[0] or 0, 0) - (1 << 62)     # room for a number of each document
    others = (ids.join(several, F.expr("id <=> of")).where("id IS NULL OR h1 <> first.h1 OR h2 <> first.h2")
              .select(F.col("id").alias("other"), F.col("h1").alias("o1"), F.col("h2").alias("o2")).distinct()
              .withColumn("extra", F.lit(base) + F.monotonically_increasing_id()))
    others = stage(others, "distinct-others")
    numbered = keyed.join(others, F.expr("id <=> other AND h1 = o1 AND h2 = o2"), "left").select(
        "row", F.coalesce("extra", "id").alias("number"))
    gone = near_duplicates(numbered.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text")))
    gone = gone.where("NOT kept").select(F.col("doc_id").alias("gone")).distinct()
    return numbered.join(gone, F.expr("number = gone"), "left_anti").select("row.*")
