import random

from pickbay.llm import decontam
from support import documents  # noqa: F401 (fixture)


def words(text):
    return (text or "").encode().lower().split()


def plain(docs, items):
    out = []
    for item, text in items:
        w = words(text)
        k = min(5, len(w))
        want = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
        for doc, body in docs:
            d = words(body)
            have = {tuple(d[i:i + k]) for i in range(len(d) - k + 1)}
            n = len(want & have)
            if want and 100 * n >= 75 * len(want):
                out.append((doc, item, len(want), n))
    return sorted(out, key=str)


DOCS = [(1, "x " * 50 + "The quick brown fox jumps over the lazy dog near the river bank today " + "y z " * 900),
        (2, "the quick brown fox jumps over a lazy dog near the river bank today"), (3, None), (4, ""), (5, "short text"),
        (5, "Short  TEXT here"), (None, "the quick brown fox jumps over the lazy dog near the river bank today"),
        (6, " ".join(f"w{i}" for i in range(50_000)))]
ITEMS = [(10, "the QUICK brown fox jumps over the lazy dog\nnear the river bank today"), (11, None), (12, ""), (13, "short text"),
         (14, " ".join(f"w{i}" for i in range(40_000, 40_050))), (14, "unseen words only in this item of the benchmark"),
         (None, "short")]


def test_matches_plain(spark, documents, monkeypatch):
    want = plain(DOCS, ITEMS)
    assert len(want) > 5
    docs, items = documents(DOCS), documents(ITEMS, "item_id long, text string")
    assert sorted(map(tuple, decontam.contaminated(docs, items).collect()), key=str) == want
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 30)       # many blocks of the query set
    assert sorted(map(tuple, decontam.contaminated(docs, items).collect()), key=str) == want


def test_clean_documents_and_empty_tables(spark, documents):
    docs, items = documents(DOCS), documents(ITEMS, "item_id long, text string")
    hit = {r[0] for r in plain(DOCS, ITEMS)}
    wide = docs.selectExpr("doc_id", "text", "1 as item_id", "2 as _x")
    left = decontam.clean_documents(wide, items)
    assert left.columns == wide.columns
    assert sorted((str(r.doc_id) for r in left.collect())) == sorted(str(d) for d, _ in DOCS if d not in hit)
    none = documents([], "item_id long, text string")
    assert decontam.contaminated(docs, none).count() == 0
    assert decontam.clean_documents(docs, none).count() == len(DOCS)
    assert decontam.contaminated(documents([]), items).count() == 0


def test_rows_are_judged_by_their_own_text(documents, monkeypatch):
    """Repeated and null ids with different texts; columns with the operator's own names."""
    hit, clean = ITEMS[0][1], "nothing of the kind stands in this text at all"
    rows = [(None, hit), (None, clean), (7, hit), (7, clean), (7, None)]
    df = documents(rows).selectExpr("*", "1 as item_id", "2 as n_shared", "'x' as _hit")
    items = documents([*ITEMS[:1], (20, "other words of another item"), (21, "a third one of five words")], "item_id long, text string")
    for block in (1 << 20, 10):
        monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
        left = decontam.clean_documents(df, items)
        assert left.columns == df.columns
        assert sorted((str(r.doc_id), str(r.text)) for r in left.collect()) == sorted([("None", clean), ("7", clean), ("7", "None")])


def test_large_benchmarks_are_looked_up_from_the_document():
    """More sketch hashes than shingles: the same items are found."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(3000)]
    index = decontam.Index(list(range(len(texts))), [t.encode() for t in texts])
    docs = [(0, " ".join(texts[5:9])), (1, texts[77]), (2, "w1"), (3, "w1 w2 w3 " + texts[10])]
    from pickbay.llm.common import word_hashes
    got = sorted(((d, m, len(index.sets[m]), n) for d, t in docs for m, n in index.search(word_hashes([t.encode()])[0])), key=str)
    assert got == plain(docs, list(enumerate(texts))) and len(got) > 5
