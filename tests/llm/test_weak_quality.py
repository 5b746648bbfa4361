import os

import numpy as np
import pytest
from pickbay.llm import weak_quality as wq
from support import documents  # noqa: F401 (fixture)

SF = "/root/testdata/sf0.01"


def test_label_model_finds_the_accurate_labellers():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.8
    accuracy = [0.95, 0.9, 0.9, 0.85, 0.8, 0.75, 0.7, 0.55]
    codes = np.zeros(len(truth), np.int64)
    for k, a in enumerate(accuracy):
        right = rng.random(len(truth)) < a
        vote = np.where(rng.random(len(truth)) < 0.2, wq.ABSTAIN, np.where(right == truth, wq.GOOD, wq.BAD))
        codes += vote * 3 ** k
    patterns = dict(zip(*(x.tolist() for x in np.unique(codes, return_counts=True))))
    good = wq.fit_label_model(patterns)
    called = np.array([good[c] > 0.5 for c in codes.tolist()])
    assert (called == truth).mean() > 0.93
    assert wq.fit_label_model({}) == {}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs the test tables")
def test_held_out_accuracy_on_the_larger_table(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = wq.classify(docs).join(labels, "doc_id").select("quality", "kept").collect()
    assert np.mean([r.kept for r in rows if r.quality == 1]) >= 0.99
    assert np.mean([r.kept for r in rows if r.quality == 0]) <= 0.05


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}   # never seen in training
    model = wq.fit(docs)
    rows = [(labels[r.doc_id], r.kept) for r in wq.classify(docs, model).collect() if r.doc_id in labels]
    clean = [k for q, k in rows if q == 1]
    junk = [k for q, k in rows if q == 0]
    assert np.mean(clean) >= 0.99 and np.mean(junk) <= 0.05
    kept = wq.accepted_documents(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for r in wq.classify(docs, model).collect())


def test_defined_cases(spark, documents):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "Some words here."), (4, "Some words here."), (4, "Some words here."),
            (5, "Word. " * 60_000), (6, "a")]
    df = documents(rows).selectExpr("*", "'x' as score", "1 as votes")
    got = wq.classify(df).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert len({(r.score, r.posterior) for r in got if r.doc_id in (None, 4)}) == 1
    assert wq.classify(documents([])).count() == 0
    assert wq.accepted_documents(documents([])).count() == 0


def test_measurements_against_plain_python():
    texts = ["", "a b", "Stop stop stop stop!", "X|Y | *** Z. Q?", "Üa Ü a Ü a Ü a", "one two three one two three"]
    t = wq.Texts([x.encode() for x in texts])
    m = t.measurements()
    for i, x in enumerate(texts):
        w, low = x.split(), [y.encode().lower() for y in x.split()]
        n = max(len(w), 1)
        tri = list(zip(low, low[1:], low[2:]))
        assert m["words"][i] == len(w)
        assert np.isclose(m["symbols"][i], sum(x.count(c) for c in "#*$%&|<>") / n)
        assert np.isclose(m["stutter"][i], sum(a == b for a, b in zip(low, low[1:])) / n)
        assert np.isclose(m["repeated"][i], sum(tri.count(y) > 1 for y in tri) / max(len(tri), 1))
        assert np.isclose(m["length"][i], sum(len(y.encode()) for y in w) / n)


def plain_label_model(patterns):
    """The label model's expectation-maximisation without arrays."""
    labellers, total = range(len(wq.LABELLERS)), sum(patterns.values())
    vote = {c: [c // 3 ** k % 3 for k in labellers] for c in patterns}
    share = {c: [1 - wq.FIRST, wq.FIRST] if wq.BAD in v else [wq.FIRST, 1 - wq.FIRST] for c, v in vote.items()}
    own = []
    while True:
        for _ in range(wq.EM_ROUNDS):
            classes = range(2 + len(own))
            against = [[sum(n * share[c][z] for c, n in patterns.items() if vote[c][k] == wq.BAD) for z in classes] for k in labellers]
            given = [[sum(n * share[c][z] for c, n in patterns.items() if vote[c][k] != wq.ABSTAIN) for z in classes] for k in labellers]
            clean = [(against[k][0] + 0.01) / (given[k][0] + wq.CARE * total + 0.02) for k in labellers]
            rate = [[clean[k] if z == 0 else max(clean[k], (against[k][z] + 0.1) / (given[k][z] + 0.2)) for z in classes] for k in labellers]
            for z, k in enumerate(own, 2):
                rate[k][z] = max(rate[k][z], wq.OWN_RATE)
            old, share = share, {}
            for c in patterns:
                p = [(sum(n * old[d][z] for d, n in patterns.items()) + 1) / (total + len(classes)) for z in classes]
                for z in classes:
                    for k in labellers:
                        p[z] *= {wq.BAD: rate[k][z], wq.GOOD: 1 - rate[k][z], wq.ABSTAIN: 1}[vote[c][k]]
                share[c] = [x / sum(p) for x in p]
            if max(abs(a - b) for c in patterns for a, b in zip(share[c], old[c])) < 1e-9:
                break
        objects = [(sum(n * (1 - share[c][0]) for c, n in patterns.items() if vote[c][k] == wq.BAD) + 0.1)
                   / (sum(n * (1 - share[c][0]) for c, n in patterns.items() if vote[c][k] != wq.ABSTAIN) + 0.2) for k in labellers]
        mistaken = [sum(n * share[c][0] for c, n in patterns.items() if vote[c][k] == wq.BAD) for k in labellers]
        below = [k for k in labellers if k not in own and mistaken[k] > 0 and objects[k] < clean[k]]
        if not below:
            return {c: s[0] for c, s in share.items()}
        own.append(max(below, key=lambda k: mistaken[k]))
        share = {c: [x * (1 - wq.FIRST) for x in s] + [wq.FIRST] if vote[c][own[-1]] == wq.BAD else [*s, 0.0] for c, s in share.items()}


def test_label_model_against_plain_python():
    def code(**votes):
        names = [n for n, *_ in wq.LABELLERS]
        return sum(votes.get(n, wq.GOOD if good else wq.ABSTAIN) * 3 ** k for k, (n, good) in enumerate(zip(names, [x[2] for x in wq.LABELLERS])))
    kinds = {code(): 900, code(symbols=wq.BAD): 40, code(symbols=wq.BAD, pipes=wq.BAD): 30, code(shouting=wq.BAD, exclamations=wq.BAD): 60,
             code(stutter=wq.BAD, repeated_windows=wq.BAD): 20, code(sentences=wq.ABSTAIN): 15}
    rng = np.random.default_rng(3)
    noise = {int(c): int(n) for c, n in zip(rng.integers(0, 3 ** len(wq.LABELLERS), 12), rng.integers(1, 50, 12))}
    for patterns in (kinds, noise, {code(): 5}):
        got, want = wq.fit_label_model(patterns), plain_label_model(patterns)
        assert got.keys() == want.keys() and all(abs(got[c] - want[c]) < 1e-6 for c in want)
    found = wq.fit_label_model(kinds)      # each kind of junk is seen by labellers that the others contradict
    assert [found[c] > 0.5 for c in kinds] == [True, False, False, False, False, True]


def test_scorer_against_plain_descent():
    rows = [(np.array([1, 5], np.int32), np.array([0.5, 0.25], np.float32), 0.9), (np.array([5, 9], np.int32), np.array([0.5, 0.5], np.float32), 0.1),
            (np.array([], np.int32), np.array([], np.float32), 0.8)]
    got = wq.Scorer.fit(rows)
    share = sum(r[2] for r in rows) / 3
    w, b, seen, seen_b = {1: 0.0, 5: 0.0, 9: 0.0}, 0.0, {1: 1e-8, 5: 1e-8, 9: 1e-8}, 1e-8
    for _ in range(wq.ROUNDS):
        g, gb = {f: wq.DECAY * w[f] for f in w}, 0.0
        for at, x, goal in rows:
            p = 1 / (1 + np.exp(-(sum(w[f] * float(v) * wq.SCALE for f, v in zip(at.tolist(), x)) + b)))
            error = (p - goal) * (0.5 / share if goal > 0.5 else 0.5 / (1 - share)) / len(rows)
            gb += error
            for f, v in zip(at.tolist(), x):
                g[f] += float(v) * wq.SCALE * error
        for f in w:
            seen[f] += g[f] ** 2
            w[f] -= wq.RATE * g[f] / seen[f] ** 0.5
        seen_b += gb ** 2
        b -= wq.RATE * gb / seen_b ** 0.5
    assert abs(got.bias - b) < 1e-4 and all(abs(got.weights[f] - w[f]) < 1e-3 for f in w)


def test_sample_is_bounded(spark, documents, monkeypatch):  # noqa: F811
    rows = [(i, f"word{i} and more of it.") for i in range(300)] + [(7, "the same text again and again")] * 200
    texts = wq._texts(documents(rows))
    assert wq._sample(texts, 500, 1000, 0).count() == 301
    assert 60 < wq._sample(texts, 500, 150, 0).count() < 130
    monkeypatch.setattr(wq, "SAMPLE_FEATURES", 100)
    assert wq._sample(texts, 500, 1000, 0).agg({"n": "sum"}).first()[0] <= 100
    assert wq._sample(documents([]).select("doc_id", "text"), 0, 10, 0).count() == 0
