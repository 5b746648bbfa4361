"""Token counts, token records and chat masks against whole encodings."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pickbay.llm import chat, tokenbin, tokencount
from pickbay.llm.common import stage_path
from pickbay.llm.tokens import encoder, tokenizer_path
from support import documents  # noqa: F401 (fixture)
from tokenizers import AddedToken, Tokenizer

PIECES = ["a", "B", "é", " ", "  ", "\n", "\t", " ", "\x1c", "\x85", "'s", "'", "ll", "1", "中", "!", "<|endoftext|>", "😀",
          "don't", "word", "\\", "<", "|", "<|im_end|>"]
TEXTS = [None, "", " ", "plain words only", "x" * 5000, " ".join(f"word{i}," for i in range(9000)), "a  b\n\n c <|endoftext|> d"]


def noise(rng, n):
    return "".join(rng.choice(PIECES) for _ in range(n))


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def library():
    """The library's encoding with nothing set."""
    t = Tokenizer.from_file(tokenizer_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_added_tokens_are_taken_as_the_library_does(library):
    rng, enc = random.Random(2), encoder(tokenizer_path(), added=True)
    fixed = ["<|endoftext|>", "a  <|endoftext|> b", "<|endoftext|><|endoftext|>", " " * 200_000, "ab  " * 50_000]
    for text in [*(t or "" for t in TEXTS), *fixed, *(noise(rng, rng.randint(0, 14)) for _ in range(3000))]:
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == library(text)


def test_encoder_equals_whole_encoding(whole):
    rng, enc = random.Random(1), encoder(tokenizer_path())
    for text in [*(t or "" for t in TEXTS), *(noise(rng, rng.randint(0, 14)) for _ in range(3000))]:
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == whole(text)


def test_edits_keep_the_count_of_a_full_encoding(whole):
    rng, enc = random.Random(4), encoder(tokenizer_path())
    for _ in range(60):
        text = noise(rng, rng.randint(0, 900))
        tree = tokencount.Tree.build(text, enc)
        for _ in range(4):
            edits = [{"pos": rng.randint(-2, len(text) + 5), "del": rng.choice([0, 0, 1, 3, 40, None]),
                      "ins": rng.choice([None, "", noise(rng, rng.randint(0, 6))])} for _ in range(rng.randint(0, 6))]
            changes, expected, at = tokencount.ordered(edits, len(text)), [], 0
            for begin, end, ins in changes:
                assert at <= begin <= end <= len(text)
                expected += [text[at:begin], ins]
                at = end
            expected = "".join([*expected, text[at:]])
            text, tree, encoded, _ = tokencount.edit(text, tree, edits, enc)
            assert text == expected and int(tree.tokens[1]) == len(whole(text)) and int(tree.chars[1]) == len(text)
            tree = tokencount.Tree.load(tree.dump())


def test_few_edits_encode_little(whole):
    enc, text = encoder(tokenizer_path()), TEXTS[5]
    tree = tokencount.Tree.build(text, enc)
    _, new, encoded, leaves = tokencount.edit(text, tree, [{"pos": 30_000, "del": 4, "ins": "new"}], enc)
    assert encoded < 1000 and leaves <= 2


def test_token_counts_query_path(documents, spark, whole):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3, "plain words only")]
    trees = tokencount.token_trees(documents(rows))
    assert sorted(((str(r.doc_id), r.n_tokens) for r in trees.collect())) == sorted((str(i), len(whole(t))) for i, t in rows)
    out = tokencount.apply_edits(tokencount.spread_edits(trees, 500)).collect()
    assert all(r.n_tokens == len(whole(r.text)) for r in out) and len(out) == len(rows)
    edits = spark.createDataFrame([(3, 6, 5, "tokens"), (3, 0, 0, None), (99, 1, 1, "x")], "doc_id long, pos int, del int, ins string")
    got = tokencount.apply_edits(tokencount.attach_edits(trees, edits)).collect()
    assert {r.text for r in got if r.doc_id == 3} == {"plain tokens only"}
    assert [r.text for r in got if r.doc_id == 0] == [None]
    assert tokencount.apply_edits(tokencount.spread_edits(tokencount.token_trees(documents([])))).count() == 0


def test_token_records_round_trip(documents, spark, library):
    rows = [(i * 7 % 31, t) for i, t in enumerate([*TEXTS, *TEXTS, *TEXTS, "<|endoftext|>"])] + [(None, "no id"), (7, "more"), (7, "more")]
    df = documents(rows).selectExpr("*", "1 as ids", "'x' as file")
    path = stage_path(spark, "records-test")
    got = tokenbin.token_table(df, path).collect()
    want = {}
    for i, t in rows:
        ids = np.array(library(t) + [0], "<u4")
        want.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    for i in want:
        assert sorted(want[i]) == sorted((r.n_tokens, r.ids_crc32) for r in got if r.doc_id == i)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda x: (x is not None, x))
    read = tokenbin.read_records(spark, path, seed=3).collect()
    assert sorted(str((r.doc_id, r.ids)) for r in read) == sorted(str((i, library(t) + [0])) for i, t in rows)
    some = tokenbin.read_index(spark, path).where("doc_id = 7")
    assert [r.doc_id for r in tokenbin.read_records(spark, path, some).collect()] == [7] * len(want[7])
    assert tokenbin.token_table(documents([]), stage_path(spark, "records-test")).count() == 0


def test_damage_is_noticed():
    data = tokenbin.frame(5, np.array([1, 70_000, 0], "<u4")) + b"\n"
    doc, ids, end = tokenbin.unframe(data)
    assert (doc, ids.tolist(), end) == (5, [1, 70_000, 0], len(data))
    for k in range(len(data) - 1):
        bad = bytearray(data)
        bad[k] ^= 4
        with pytest.raises(ValueError, match="damaged frame"):
            tokenbin.unframe(bytes(bad))


def test_escape_is_reversible():
    rng = random.Random(8)
    for _ in range(4000):
        text = "".join(rng.choice(["<", "|", "\\", "<|", "<|im_end|>", "a", "\n"]) for _ in range(rng.randint(0, 9)))
        assert "<|" not in chat.escape(text) and chat.unescape(chat.escape(text)) == text


def test_chat_masks(documents, spark):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "system", None, "<|im_sep|>"]),
             rng.choice([None, "", " lead", "trail \n", "\n\n", "<", "|x", noise(rng, 12), "<\\|im_end|>"]))
            for c in range(60) for t in range(rng.randint(1, 7))]
    rows += [(None, 0, "user", "q"), (None, 1, "assistant", "a"), (5, 0, "assistant", "again")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = chat.with_hostile(spark, df.selectExpr("*", "1 as formatted"))
    table = chat.format_chats(df)
    got = {r.conv_id: r for r in chat.digests(table).collect()}
    rows += [(-1, 0, "user", chat.HOSTILE_TEXT), (-1, 1, "assistant", chat.HOSTILE_TEXT)]
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        turns = sorted((x[1:] for x in rows if x[0] == conv), key=lambda x: (x[0], x[1] is not None, x[1] or "", x[2] is not None, x[2] or ""))
        whole_text = "".join(f"{role or ''}\n{text or ''}\n" for _, role, text in turns)
        loss = "".join(text or "" for _, role, text in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.turns_sha256 == hashlib.sha256(whole_text.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    tok = Tokenizer.from_file(tokenizer_path())
    tok.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in chat.MARKS])
    for r in table.collect():
        encoding = tok.encode(r.formatted, add_special_tokens=False)
        assert r.input_ids == encoding.ids
        # plain masks: the tokens between <|im_sep|> and <|im_end|> of an assistant turn
        begin, sep, end = map(tok.token_to_id, chat.MARKS)
        want, role, inside = [], [], None
        for i in encoding.ids:
            if i == begin:
                role, inside = [], False
            elif i == sep:
                inside = tok.decode(role, skip_special_tokens=False) == "assistant"
                want.append(False)
                continue
            elif i == end:
                inside = None
            elif inside is False:
                role.append(i)
            want.append(inside is True)
        assert r.loss_mask == want
    lengths = {r.conv_id: len(r.formatted) for r in table.collect()}
    assert all(got[c].formatted_chars == n for c, n in lengths.items())
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_chats(empty)).count() == 0


def test_loss_mask_against_every_token():
    rng = random.Random(12)
    for _ in range(2000):
        ends = np.cumsum([rng.randint(1, 4) for _ in range(rng.randint(0, 12))]).astype(np.int64)
        top = int(ends[-1]) if len(ends) else 0
        cuts = sorted(rng.sample(range(top + 1), k=min(top + 1, 2 * rng.randint(0, 3)) // 2 * 2))
        spans = np.array(cuts, np.int64).reshape(-1, 2)
        begins = [0, *ends[:-1].tolist()]
        want = [any(b < y and e > x for x, y in spans.tolist()) for b, e in zip(begins, ends.tolist())]
        assert chat.loss_mask(ends, spans).tolist() == want
    assert chat.loss_mask(np.array([3, 5]), np.array([[3, 3]])).tolist() == [False, False]   # an empty text
