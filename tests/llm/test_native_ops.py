"""Mixing, sharding and quality rules against plain Python."""

import re
import zlib
from collections import Counter, defaultdict

from pickbay.llm import mixing, quality_rules, sharding
from pyspark.sql import functions as F
from support import documents  # noqa: F401 (fixture)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plan_targets(sizes):
    """Share by weight, cut at twice the size, share the excess again."""
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, rest, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while open_ and rest > 1e-9:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += rest * weight[s] / total
        rest = sum(max(0.0, target[s] - 2 * sizes[s]) for s in names)
        for s in list(open_):
            if target[s] >= 2 * sizes[s]:
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


def test_mixture(documents):
    rows = [(i, "w " * (i * 7 % 90), f"s{i % 5}" if i % 11 else None) for i in range(1500)]
    rows += [(9000, None, "empty"), (9001, "", "empty"), (None, "a b", "s1"), (1, "w " * 7, "s1"), (1, "w " * 7, "s1")]
    df = documents(rows, "doc_id long, text string, source string").withColumn("size", F.lit("x")).withColumn("copies", F.lit(1))
    got = mixing.mixture(df).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, len(WORD.findall(t or ""))) for i, t, _ in rows)
    sizes, of = defaultdict(int), defaultdict(set)
    for i, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = plan_targets(sizes)
    full = mixing.copies(df).collect()
    taken = defaultdict(int)
    for r in full:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r["size"]
        of[r.source].add(r.target)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.02 * want[s] + 180
    assert sorted(map(str, got)) == sorted(map(str, mixing.mixture(df.repartition(5)).collect()))
    emitted = mixing.mixed_documents(df)
    assert emitted.columns == df.columns
    assert Counter(r.doc_id for r in emitted.collect()) == Counter({k: v for k, v in Counter(
        {}).items()}) + sum((Counter({r.doc_id: r.copies}) for r in full), Counter())
    none = documents([], "doc_id long, text string, source string")
    assert mixing.mixture(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def test_cells_do_not_change_the_draw(documents, monkeypatch):
    rows = [(i, "w " * (i % 37), "hot" if i % 3 else f"s{i % 4}") for i in range(700)]
    df = documents(rows, "doc_id long, text string, source string")
    one = sorted(map(str, mixing.mixture(df).collect()))
    monkeypatch.setattr(mixing, "CELL_ROWS", 5)
    assert sorted(map(str, mixing.mixture(df).collect())) == one


def test_balanced_shards(documents):
    rows = [(i * 3 % 1009, "é" * (i * 13 % 300)) for i in range(1009)] + [(None, None), (None, ""), (7, "x"), (7, "x")]
    df = documents(rows).withColumn("shard", F.lit(1)).withColumn("slice", F.lit("z"))
    got = sharding.balanced_shards(df, 24).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert set(by) == set(range(24))
    totals = [sum(r["size"] for r in by[s]) for s in range(24)]
    assert max(totals) - min(totals) <= 2 * 608
    last = -1
    for s in range(24):
        assert sorted(r.slot for r in by[s]) == list(range(len(by[s])))
        ids = [-1 if r.doc_id is None else r.doc_id for r in sorted(by[s], key=lambda r: r.slot)]
        assert ids == sorted(ids) and ids[0] >= last
        last = ids[-1]
    assert sharding.balanced_shards(documents([]), 24).count() == 0
    # one document larger than a share
    big = sharding.balanced_shards(documents([(1, "x" * 5000), (2, "y"), (3, None)]), 4).collect()
    assert sorted((r.doc_id, r.slot) for r in big) == [(1, 0), (2, 0), (3, 1)]


def plain_rules(text):
    t = text or ""
    w = WORD.findall(t)
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


TEXTS = [None, "", " \n ", "a", "a b", "a b c a b c", "x x x x x", "a b c d\na b c d\n\na b c d \nq", "é é é é ü <|#> $",
         "\n".join(["one two three four five six"] * 30), " ".join(f"w{i % 701}v{i % 3}" for i in range(20_000)),
         " ".join(f"w{i}" for i in range(80)), "|".join("ab " * 60), "SHOUT!! " * 20 + " ".join(f"a{i}" for i in range(90)),
         "a\x0bb\x0cc\rd e f", "a b c"]


def test_quality_rules(documents):
    rows = list(enumerate(TEXTS)) + [(None, "a b c a b c"), (5, TEXTS[5])]
    df = documents(rows).withColumn("words", F.lit(1)).withColumn("kept", F.lit("no"))
    got = quality_rules.quality_rules(df).collect()
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert Counter((r.doc_id, *[r[f] for f in fields]) for r in got) == Counter((i, *plain_rules(t)) for i, t in rows)
    for r in got:
        base = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == base and not (base and r.kept)
        assert r.kept == (r.fail_bits & quality_rules.POLICIES["v2"] == 0)
    assert quality_rules.quality_rules(documents([])).count() == 0


def test_ablation_by_bits(documents):
    entries = quality_rules.ledger(documents(list(enumerate(TEXTS))))
    bits = [r.fail_bits for r in entries.collect()]
    for policy, mask in quality_rules.POLICIES.items():
        got = {r.rule: (r.failed, r.only_this, r.kept_without) for r in quality_rules.ablation(entries, policy).collect()}
        assert got == {name: (sum(b & bit != 0 for b in bits), sum(b & mask == bit for b in bits),
                              sum(b & mask & ~bit == 0 for b in bits))
                       for name, bit in quality_rules.BIT.items() if bit & mask}
    assert {r.failed for r in quality_rules.ablation(quality_rules.ledger(documents([]))).collect()} == {0}


def test_mixed_rows_keep_their_own_copies(documents):
    """Null and repeated ids with different texts, clashing names, any order of the input."""
    rows = [(None if i % 3 else 7, "w " * (i % 29), f"s{i % 2}", f"x{i}", i) for i in range(900)]
    rows += [(3, "same text", "s1", "one", 1), (3, "same text", "s1", "two", 2), (3, None, None, None, None)]
    df = documents(rows, "doc_id long, text string, source string, _key string, _size long").selectExpr(
        "*", "1 as _copy", "2 as _copies", "'r' as number", "'c' as content", "4 as copies", "5 as digest")
    once = mixing.mixed_documents(df)
    assert once.columns == df.columns
    got = Counter(map(str, once.collect()))
    assert set(got) <= set(map(str, df.collect())) and set(got.values()) <= {1, 2}
    words = Counter()
    for r in once.collect():
        words[r.source] += len(WORD.findall(r.text or ""))
    plan = {r.source: r.target for r in mixing.copies(df).select("source", "target").distinct().collect()}
    assert all(abs(words[s] - plan[s]) <= 60 for s in plan)
    for other in (df.repartition(7), df.orderBy(F.desc("_size")), df.coalesce(1)):
        assert Counter(map(str, mixing.mixed_documents(other).collect())) == got


def test_mixing_of_many_null_ids_is_linear(documents):
    rows = documents([(0, "a b c", "s")], "doc_id long, text string, source string")
    many = rows.selectExpr("cast(null as long) as doc_id", "text", "source", "explode(sequence(1, 100000)) as n")
    assert abs(mixing.mixed_documents(many).count() - 150_000) < 10


def test_windows_with_equal_hashes_are_told_apart(documents, monkeypatch):
    """Every window with one hash, and one of two: the words decide."""
    rows = list(enumerate(TEXTS)) + [(99, "a b c d a b c x y z y z a b"), (98, "p q r " * 30 + "s t u")]
    for weak in ("0L", "xxhash64(w) % 2"):
        monkeypatch.setattr(quality_rules, "WINDOW_HASH", weak)
        got = {r.doc_id: r.n_repeat_words for r in quality_rules.quality_rules(documents(rows)).collect()}
        assert got == {i: plain_rules(t)[4] for i, t in rows}


def test_very_long_text_has_no_repeats_of_its_own(spark):
    n = 2_000_000
    text = spark.range(1).selectExpr("id as doc_id", f"array_join(transform(sequence(1, {n}), x -> cast(x as string)), ' ') as text")
    r = quality_rules.quality_rules(text).first()
    assert (r.n_words, r.n_repeat_words) == (n, 0)
