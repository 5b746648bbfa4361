"""The prefix trie against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pickbay.llm import prefix_trie as pt

COLUMNS = "conv_id long, turn long, role string, text string"


def plain(rows, family=5, head=9):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % head
        whole[c] = own.get(c - c % family, [])[:h] + turns[h:]
    members, children, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
            leaves[p[:d]] += p not in children
    return sorted((m[0], len(p), members[p[:-1]][0] if p else -1, len(m), children[p] if p in children else 0, leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in m if len(whole[c]) == len(p)).encode()).hexdigest())
                  for p, m in list(members.items()))


def found(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                   r.saved_tokens, r.ends_sha256) for r in df.collect())


def noise(rng, convs, longest):
    rows = []
    for c in rng.sample(range(convs * 2), convs):
        for t in range(rng.choice([0, 1, 2, 3, rng.randint(1, longest)])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["é", "b", "", None])))
    return rows


@pytest.mark.parametrize("width", [1, 3, 8])
def test_against_plain(spark, monkeypatch, width):
    monkeypatch.setattr(pt, "SPAN", 2)       # several spans in a conversation
    rows = noise(random.Random(width), 60, 40)
    assert found(pt.conversation_trie(spark.createDataFrame(rows, COLUMNS), width)) == plain(rows)


def test_defined_cases(spark):
    rows = [(None, 1, "user", "lost"), (1, None, "user", "first"), (1, 0, None, None), (1, 0, "b", "tie"), (1, 0, "a", "tie"),
            (1, 0, "a", "tie"), (2, 5, "user", "x" * 300_000), (2, 5, "user", "x" * 300_000), (10, 0, "user", "short"),
            (14, 0, "user", "turnless or not"), (9_000_000_000, 0, "user", "big id")]
    df = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "1 as block", "'k' as k1", "2 as pos", "3 as n_convs")
    assert found(pt.conversation_trie(df)) == plain(rows)
    assert pt.conversation_trie(spark.createDataFrame([], COLUMNS)).count() == 0
    assert pt.conversation_trie(spark.createDataFrame(rows[:1], COLUMNS)).count() == 0


def test_turnless_conversations_end_at_the_root(spark):
    short = [c for c in range(5, 4000) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1][:20]   # their first turn is replaced
    rows = [(c, 0, "user", "gone") for c in short]
    got = found(pt.conversation_trie(spark.createDataFrame(rows, COLUMNS)))
    assert got == plain(rows) == [(short[0], 0, -1, 20, 0, 1, 0, hashlib.sha256(",".join(map(str, short)).encode()).hexdigest())]


def test_long_lists_and_conversations(spark, monkeypatch):
    """A conversation with a third of all rows, and a node at which a third of all conversations end."""
    monkeypatch.setattr(pt, "PIECE", 7)
    rows = [(0, t, "user", f"turn {t % 50}") for t in range(2000)]
    rows += [(10 * c, 0, "user", "common") for c in range(1, 1500)] + [(10 * c + 1, t, "user", f"{c % 7}") for c in range(700) for t in range(3)]
    assert found(pt.conversation_trie(spark.createDataFrame(rows, COLUMNS).repartition(8))) == plain(rows)
