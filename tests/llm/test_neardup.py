"""Near-duplicates against a plain all-pairs computation."""

import random

import numpy as np
from pickbay.llm import neardup
from pickbay.llm.common import shingle_sets, word_hashes
from support import documents  # noqa: F401 (fixture)


def plain_set(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def plain_components(rows):
    sets = {i: plain_set(t) for i, t in rows if i is not None}
    ids, up = sorted(sets), {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            a, b = sets[i], sets[j]
            shared = len(a & b)
            if shared and 100 * shared >= 75 * (len(a) + len(b) - shared):
                p, q = top(i), top(j)
                up[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), top(i), top(i) == i) for i in ids}


def corpus(seed=5, groups=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 40, 120, 300]))]
        for _ in range(rng.choice([1, 2, 9, 25])):
            edited = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
            texts.append(" ".join(edited))
    rng.shuffle(texts)
    return list(enumerate(texts, 100))


def check(documents, rows, columns="doc_id long, text string"):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(documents(rows, columns)).collect()}
    assert got == plain_components([r[:2] for r in rows])


def test_matches_all_pairs(documents):
    check(documents, corpus())


def test_defined_cases(documents):
    long = " ".join(f"x{i % 977}y{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one TWO"), (6, "two one"), (7, long), (8, long + " tail"),
            (9, "a b c d e f g"), (10, "a b c d e f g"), (11, "É b c d e f"), (12, "é b c d e f")]
    check(documents, rows)
    # clashing extra columns
    check(documents, [(*r, 9, True, "s") for r in rows], "doc_id long, text string, component_id int, kept boolean, sig string")


def test_null_ids_and_repeats(documents):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (6, "a b c d e f")]
    got = sorted(map(tuple, neardup.near_duplicates(documents(rows)).collect()), key=str)
    assert got == sorted([(None, 2, None, True)] * 2 + [(4, 2, 4, True)] * 2 + [(6, 2, 4, False)], key=str)
    assert sorted(r.doc_id for r in neardup.distinct_documents(documents(rows)).collect() if r.doc_id) == [4, 4]
    assert neardup.near_duplicates(documents([])).count() == 0


def test_hot_bucket_is_split(documents, monkeypatch):
    """A large group of near copies, most of them under the threshold to each other,
    compared in many small blocks."""
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rng = random.Random(11)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(90):
        t = list(base)
        for k in rng.sample(range(60), rng.choice([0, 1, 2, 3, 4])):
            t[k] = f"z{i}_{k}"
        rows.append((i, " ".join(t)))
    check(documents, rows)


def test_estimate_is_unbiased():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(60):
        pool = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
        a, b = pool[:200], pool[50:250]
        sig = [neardup.packed(neardup.minima(x)) for x in (a, b)]
        lanes = neardup.equal_lanes(sig[0], sig[1][None, :])[0]
        errors.append(neardup.estimate(lanes) - 150 / 250)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07


def test_word_hashes_across_chunk_cuts():
    rng = random.Random(2)
    words = ["".join(rng.choices("abcXYZé", k=rng.randint(1, 9))) for _ in range(120_000)]
    long = " ".join(words).encode()
    h, n = word_hashes([long])
    single, m = word_hashes([w.encode() for w in words])
    assert n.tolist() == [len(words)] and m.sum() == len(words) and (h == single).all()
    giant = b"q" * 600_000
    h, n = word_hashes([b"a " + giant + b" b", b"a", giant, b"b"])
    assert n.tolist() == [3, 1, 1, 1] and (h[:3] == h[3:]).all()
    sets = [len(s) for s in shingle_sets([b"", b"a b c d e a b c d e", b"a b"])]
    assert sets == [0, 5, 1]


def test_documents_that_share_an_id_or_have_none(documents):
    """Each text of a repeated or missing id is judged by itself; clashing names and wide ids are no matter."""
    rng = random.Random(8)

    def text(n=40):
        return " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 9) for _ in range(n))
    a, b, c, d = text(), text(), text(), text()
    near = " ".join(a.split()[:-1])
    rows = [(3, a), (7, near), (7, b), (None, a), (None, c), (None, c), (9, c + " x"), (4, d), (4, d), (5, None), (None, ""), (7, "")]
    for shift in (0, (1 << 62) + 5):
        moved = [(None if i is None else i + shift, t) for i, t in rows]
        df = documents(moved).selectExpr("*", "1 as number", "'g' as gone", "2 as h1", "3 as id", "4 as extra", "5 as first")
        left = neardup.distinct_documents(df)
        assert left.columns == df.columns
        got = [(None if r.doc_id is None else r.doc_id - shift, r.text) for r in left.collect()]
        texts = [t for _, t in got]
        assert (3, a) in got or shift                             # the smallest id represents the group
        assert sum(t in (a, near) for t in texts) == 1            # one document of each group
        assert (7, b) in got                                      # found nowhere else
        assert len({str(x) for x in got if x[1] in (c, c + " x")}) == 1
        assert texts.count(d) == 2                                # rows of one document stay together
        assert (5, None) in got and (None, "") in got and (7, "") in got
    assert neardup.distinct_documents(documents([])).count() == 0


def test_a_word_as_long_as_a_chunk_has_one_hash():
    from pickbay.llm.common import _CAP
    for n in (_CAP - 2, _CAP - 1, _CAP, _CAP + 1):
        word = b"w" * n
        alone = word_hashes([word])[0].tolist()
        assert word_hashes([word + b" and more words after it"])[0][:1].tolist() == alone
        assert word_hashes([b"before " + word + b" after"])[0][1:2].tolist() == alone
