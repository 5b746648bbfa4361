"""Importance resampling against a plain computation."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pickbay.llm import resample as rs
from support import documents  # noqa: F401 (fixture)

SETTINGS = {"percent": 30, "min_words": 3, "buckets": 101, "longest": 2, "seed": 7}


def features(text, longest):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    return [b" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)], len(words)


def plain(docs, target, percent, min_words, buckets, longest, seed):
    def count(texts):
        return Counter(zlib.crc32(f) % buckets for t in texts for f in features(t, longest)[0])
    s, t = count(x for _, x in docs), count(target)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        f, words = features(text, longest)
        weight = sum(gain[zlib.crc32(x) % buckets] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), words))
    best = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    rank = Counter()
    out = [(*r[:4], n + 1) for n, r in enumerate(best[:percent * len(best) // 100])]
    rank.update(r[:4] for r in out)
    for r in rows:
        if rank[r[:4]]:
            rank[r[:4]] -= 1
        else:
            out.append((*r[:4], None))
    return sorted(map(str, out))


def found(df):
    return sorted(str(tuple(r)) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


@pytest.fixture
def target(spark):
    def make(texts):
        return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")
    return make


def test_against_plain(documents, target):  # noqa: F811
    rng = random.Random(3)
    words = ["Ünïcode", "ABC", "abc", "x1", "zeta-beta", "日本", "the", "of"]
    docs = [(rng.choice([None, i, i, i, 5]), " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(400)]
    wanted = ["the of ABC", None, "日本 x1 x1"]
    df = documents(docs).selectExpr("*", "'x' as score", "2 as run", "3 as pos", "4 as segment").repartition(7)
    assert found(rs.resample(df, target(wanted), **SETTINGS)) == plain(docs, wanted, **SETTINGS)


def test_equal_scores_fill_many_segments(spark, documents, target, monkeypatch):  # noqa: F811
    """A third of all rows with one key: ranks stay exact and segments even."""
    monkeypatch.setattr(rs, "SAMPLES", 4)
    docs = [(7, "a b c d")] * 700 + [(i, "e f g h") for i in range(1300)]
    settings = {**SETTINGS, "percent": 90}
    assert found(rs.resample(documents(docs).repartition(5), target(["a"]), **settings)) == plain(docs, ["a"], **settings)


def test_defined_cases(documents, target):  # noqa: F811
    docs = [(1, None), (2, ""), (3, "!?"), (None, "one two three"), (None, "one two three"), (4, "w" * 3_000_000), (5, "v " * 1_200_000)]
    for wanted in ([], ["two"], [None]):
        assert found(rs.resample(documents(docs), target(wanted), **SETTINGS)) == plain(docs, wanted, **SETTINGS)
    assert found(rs.resample(documents([]), target(["two"]))) == []


def test_stretches_of_a_text_give_the_features_of_the_whole(monkeypatch):
    monkeypatch.setattr(rs, "CHUNK", 7)
    monkeypatch.setattr(rs, "CACHE", 3)
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choices(["ab", "é", " ", "x", "-", "longer"], k=rng.randint(0, 40)))
        for longest in (1, 2, 3):
            want, words = features(text, longest)
            got = list(rs.Features(1 << 20, longest).of(text.encode()))
            assert sum(n for n, _ in got) == words
            assert Counter(x for _, b in got for x in b.tolist()) == Counter(zlib.crc32(f) % (1 << 20) for f in want)


def test_gains_are_zero_for_equal_shares():
    same = np.array([3, 0, 5])
    assert rs.gains(same, same).tolist() == [0, 0, 0]
