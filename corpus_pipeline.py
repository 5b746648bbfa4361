"""The corpus pipeline: five stages over the documents table.

Every stage works on all rows its predecessor kept; all but the last return the
columns of documents, the last one the shard and slot of every row.

Defined cases, in every stage: rows are judged one by one, so rows with a repeated
doc_id or none don't answer for each other; a null, empty or word-free text has no
words, shingles or bytes of its own; rows equal in all columns are
interchangeable; an empty table stays empty; further columns of any name pass through.
"""

from __future__ import annotations

from pickbay.llm import decontam, mixing, neardup, sharding, weak_quality

SHARDS = 24


def quality_classifier(spark, docs, sf_dir):
    """Documents that the quality classifier rejects go.

    The model is trained on these documents; texts without words get its bias and
    stay if that reaches the threshold."""
    return weak_quality.accepted_documents(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each near-duplicate group stays, that with the smallest doc_id.

    Rows equal in doc_id and text are one document and stay together; texts without
    words are duplicates of nothing."""
    return neardup.distinct_documents(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that contain a benchmark item go.

    Without items, and for items without words, all stay."""
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark, docs, sf_dir):
    """Every document as often as the source mix takes it: not at all, once or twice.

    Null is a source of its own; the draw depends on the rows, not on their order."""
    return mixing.mixed_documents(docs)


def sharded(spark, docs, sf_dir):
    """The shard and slot of every row of the mix; rows without doc_id come first."""
    return sharding.balanced_shards(docs, SHARDS)


STAGES = [("quality_classifier", quality_classifier), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("mixture", mixture), ("sharding", sharded)]

#: The classifier is a trained model: SQL can't express the pipeline.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents table, each written and read again."""
    from pickbay.llm.common import stage as written
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
