"""Mixing sources to target sizes by systematic sampling.

A source that shall give `target` of its `source_size` words expects
e = target / source_size copies of each of its documents.  Its documents are
laid out in a fixed order (size class, then a hash of id and text), the prefix sum of
expected copies runs over them from one offset drawn for the source, and a
document is emitted once for every integer its step crosses.  Neighbours in the
order have similar sizes, so the words taken stay close to the target.

The prefix sum is distributed: rows are counted in cells of (source, size class,
hash slice), the cells' totals are summed, and a running number inside a cell
does the rest.  The hash slices keep a cell small however hot its source is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickbay.llm.common import stage

#: Weights of the sources in code point order (null last), repeating.
WEIGHTS = (3, 1, 2)
#: The mix takes this share of all words, and at most this multiple of a source.
TOTAL_SHARE, MAX_COPIES = 1.5, 2
#: Rows wanted in a cell; only the number of hash slices follows from it.
CELL_ROWS = 1 << 16

WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, source, size (words of the text; null: 0), the layout column and the columns `keep`."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                    F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                    F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("/"), text).cast("binary"))
                    .alias("digest"), *keep)


def targets(sized: DataFrame, total_share: float = TOTAL_SHARE, max_copies: int = MAX_COPIES,
            weights: tuple = WEIGHTS, seed: int = 0) -> DataFrame:
    """One row per source: source, source_size, n_docs, target, offset.

    The sources share total_share of all words by weight; no target exceeds
    max_copies times its source, and what a full source can't take is shared
    again by weight.  In closed form: with sources ordered by cap / weight, the
    first k are full where (total - their caps) / remaining weight reaches at
    most the next source's cap / weight; the rest get that level times weight.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    named = per.withColumn("k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    w = named.withColumn("weight", F.get(cycle, F.pmod(F.col("k"), F.lit(len(weights))).cast("int")))
    w = w.withColumn("cap", F.col("source_size") * F.lit(max_copies))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "k")
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    done = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    w = (w.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(total_share)))
         .withColumn("full", F.coalesce(F.sum("cap").over(done), F.lit(0)))
         .withColumn("open_weight", F.sum("weight").over(rest))
         .withColumn("level", (F.col("total") - F.col("full")) / F.col("open_weight"))
         .withColumn("open", F.when(F.expr("level * weight <= cap"), F.struct(F.col("cap") / F.col("weight"), "k"))))
    # the level of the first source that is not full holds for all after it
    w = w.withColumn("final_level", F.min_by("level", "open").over(everything))
    target = F.least(F.col("cap").cast("double"),
                     F.coalesce(F.col("final_level") * F.col("weight"), F.col("cap").cast("double")))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce("source", F.lit(""))).cast("binary")), 1, 8),
                  16, 10).cast("double") / F.lit(4294967296.0)
    return w.select("source", "source_size", "n_docs", target.alias("target"), draw.alias("offset"))


def _layout(sized: DataFrame, n: int) -> DataFrame:
    """Size class (length and first four binary digits of the size) and hash slice of each row."""
    digits = 0
    while n > CELL_ROWS * 16 ** digits:
        digits += 1
    binary = F.bin("size")
    return (sized.withColumn("size_class", F.concat(F.lpad(F.length(binary).cast("string"), 2, "0"), F.substring(binary, 1, 4)))
            .withColumn("cut", F.substring("digest", 1, digits) if digits else F.lit("")))


def copies(docs: DataFrame, seed: int = 0, **recipe) -> DataFrame:
    """doc_id, source, size, source_size, target and the copies the mix takes of each row.

    Defined cases: a null or word-free text has size 0 and is drawn like any
    other document; sources of size 0 and empty tables have target 0 and give no
    copies; null is a source of its own, the last one; null doc_ids are rows like
    others; repeated rows are drawn one by one (they are interchangeable, so
    reruns agree); no row is taken more than twice, as expected copies are at
    most 2; columns other than doc_id, text and source are ignored.
    """
    return _copies(stage(sizes(docs), "mix-sizes"), (), seed, **recipe)


def _copies(sized: DataFrame, keep: tuple, seed: int, **recipe) -> DataFrame:
    """copies() of sized rows; the columns `keep` settle ties of the layout and are returned too."""
    plan = targets(sized, seed=seed, **recipe)
    laid = _layout(sized, sized.count())
    cell = ["source", "size_class", "cut"]
    before = Window.partitionBy("source").orderBy("size_class", "cut").rowsBetween(Window.unboundedPreceding, -1)
    cells = (laid.groupBy(*cell).agg(F.count("*").alias("rows"))
             .withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))))
    cells = cells.alias("c").join(plan.alias("p"), F.expr("c.source <=> p.source")).select(
        "c.source", "size_class", "cut", "before", "source_size", "target", "offset")
    rank = F.row_number().over(Window.partitionBy(*cell).orderBy("digest", "doc_id", "size", *keep))
    numbered = laid.withColumn("rank", rank)
    placed = numbered.alias("d").join(cells.alias("c"), F.expr(
        "d.source <=> c.source AND d.size_class = c.size_class AND d.cut = c.cut")).select(
        "doc_id", "d.source", "size", "source_size", "target", "offset", *keep, (F.col("before") + F.col("rank")).alias("i"))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = F.floor(F.col("e") * F.col("i") + F.col("offset")) - F.floor(F.col("e") * (F.col("i") - 1) + F.col("offset"))
    return placed.withColumn("e", expected).withColumn("copies", crossed.cast("int")).select(
        "doc_id", "source", "size", "source_size", "target", "copies", *keep)


def mixture(docs: DataFrame, seed: int = 0, **recipe) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes, repeats counted)."""
    return copies(docs, seed, **recipe).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = 0, **recipe) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it, columns unchanged.

    The rows are written once with a number of their own, by which each meets its
    copies, whatever its doc_id.  Defined cases: as in copies(); rows that share
    doc_id, text and source are told apart by a hash of all their columns, so the
    mix doesn't depend on the order or partitions of the input (rows equal in
    every column are interchangeable); columns may have any name.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole.alias("row"), F.monotonically_increasing_id().alias("number"))
    rows = stage(rows, "mix-rows")
    needed = [F.col(f"row.{c}").alias(c) for c in ("doc_id", "text", "source")]
    sized = sizes(rows.select(*needed, "number", F.xxhash64("row").alias("content")), "content", "number")
    copies_of = _copies(stage(sized, "mix-sizes"), ("content", "number"), seed, **recipe).where("copies > 0")
    drawn = rows.join(copies_of.select("number", "copies"), "number")
    return drawn.select("row", F.explode(F.expr("sequence(1, copies)"))).select("row.*")
