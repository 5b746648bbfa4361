"""Queries against their SQL, and the pipeline against plain Python, on the smallest tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def _norm(rows):
    def value(v):
        return None if v is None or v != v else int(v) if isinstance(v, float) and v == math.floor(v) else v
    return sorted(str(tuple(map(value, r))) for r in rows)


@pytest.mark.parametrize("name", ["op2_minhash_near_duplicates", "op3_warc_revisits", "op4_decontamination", "op5_mixing",
                                  "op8_sharding", "op9_quality_rules", "op12_importance_resampling", "op13_prefix_trie", "quality_ablation"])
def test_query_equals_sql(spark, name):
    from pickbay.llm.oracle import ORACLE
    from pickbay.llm.queries import QUERIES
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    cur = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})")
    assert _norm(df.select(*cols).collect()) == _norm(cur.fetchall())


def test_pipeline(spark, monkeypatch):
    """Every stage against a plain computation on the rows it was given."""
    import corpus_pipeline
    from test_decontam import plain
    from test_neardup import plain_components
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    from pickbay.llm.common import stage as written
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "sharding":
            assert out.schema.simpleString() == docs.schema.simpleString()
            out = written(out, "test-stage")
        seen[name] = (docs.collect(), out.collect())
        docs = out
    before, after = seen["near_duplicates"]
    keep = {i for i, (_, _, kept) in plain_components([(r.doc_id, r.text) for r in before]).items() if kept}
    assert {r.doc_id for r in after} == keep and len(after) == len(keep) < len(before)
    before, after = seen["decontamination"]
    hit = {d for d, *_ in plain([(r.doc_id, r.text) for r in before], items)}
    assert hit and {r.doc_id for r in after} == {r.doc_id for r in before} - hit
    before, after = seen["mixture"]
    assert set(Counter(r.doc_id for r in after).values()) <= {1, 2} and {r.doc_id for r in after} <= {r.doc_id for r in before}
    words = [sum(len(r.text.split()) for r in rows) for rows in (before, after)]
    assert abs(words[1] - 1.5 * words[0]) < 0.1 * words[0]
    before, after = seen["sharding"]
    assert Counter(r.doc_id for r in after) == Counter(r.doc_id for r in before)
    direct = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, direct.collect())) == sorted(map(str, after))
