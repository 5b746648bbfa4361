"""Byte-level BPE as a streaming transducer with bounded lookahead, and its inverse.

Merging is not left to right, but what follows can change earlier tokens only
over a bounded distance.  Compare the merges of a text with those of the text
continued: let p be a boundary that one of them closes and the other does not,
and let no boundary left of p differ.  Before, the symbol right of p was the same
c in both, so the boundary right of c differed earlier, by a rule (c, a) of lower
rank than the rule (d, X) that closed p, where X is c or begins with c merged
later or with c and a.  Such chains of rules, ranks falling to the right, begin
at the text's end; the longest sum of their left symbols' lengths over the
merge list is a sufficient lookahead (129 bytes for byte_bpe_50k.json).  Tokens
that end so far before the bytes seen are stable and are emitted; what is held
is the lookahead and one block.  A boundary that stays open parts the merging
into two independent ones, so merging goes on from the last emitted token.

Texts are cut where no token can reach over: at added tokens, before a space that
a non-space follows, and between pre-tokens.  Output for short stretches is kept
in a bounded cache; longer pre-tokens are streamed.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickbay.llm.common import prepare
from pickbay.llm.tokens import _byte_letters, _pattern, tokenizer_path

#: Bytes merged at once besides the lookahead, and characters of a text looked at together.
BLOCK, REGION = 2048, 1 << 16
#: Stretches and pre-tokens of at most so many characters are kept, in two generations of at most so many:
#: a full one becomes the older, and what is found there is kept on.
CACHED_CHARS, CACHE = 64, 400_000
#: Ids turned into text at once.
IDS = 1 << 16


#: A rule as one number: its rank, then the merged symbol in the low bits.
_SYMBOL, _NO_RULE = (1 << 32) - 1, 1 << 62


class Merges:
    """A merge list over byte symbols: rules, and the lookahead that suffices for it."""

    def __init__(self, bytes_of: dict[int, bytes], rules: list[tuple[int, int, int]]):
        """bytes_of: what each symbol spells; rules: (left, right, merged) in order of rank."""
        self.single = {b[0]: i for i, b in bytes_of.items() if len(b) == 1}
        self.rules = {(left, right): (rank, merged) for rank, (left, right, merged) in enumerate(rules)}
        self.codes = {pair: rank << 32 | merged for pair, (rank, merged) in self.rules.items()}   # order like ranks
        made = {i for i, b in bytes_of.items() if len(b) == 1}
        for left, right, merged in rules:
            if left not in made or right not in made or merged in made:
                raise ValueError("a rule's parts must be made before it, and each symbol by one rule")
            made.add(merged)
        self.lookahead = self._lookahead({i: len(b) for i, b in bytes_of.items()}, rules)

    @staticmethod
    def _lookahead(length: dict[int, int], rules: list[tuple[int, int, int]]) -> int:
        first = {merged: left for left, _, merged in rules}
        right_of: dict[int, int] = {}    # longest chain of the rules seen whose right part is a symbol
        begun_by: dict[int, int] = {}    # ... whose right part begins with a symbol's derivation
        grown: dict[int, int] = {}       # ... whose right part begins with a symbol merged with something later
        longest = 1
        for left, right, merged in reversed(rules):
            grown[left] = max(grown.get(left, 0), begun_by.get(merged, 0))
            chain = length[left] + max(right_of.get(left, 0), grown[left])
            right_of[right] = max(right_of.get(right, 0), chain)
            symbol = right
            while symbol is not None:
                begun_by[symbol] = max(begun_by.get(symbol, 0), chain)
                symbol = first.get(symbol)
            longest = max(longest, chain)
        return longest

    def merge(self, data: bytes) -> list[int]:
        """The tokens of bytes taken by themselves."""
        symbols = [self.single[b] for b in data]
        return self._merge_short(symbols) if len(symbols) <= CACHED_CHARS else self._merge_long(symbols)

    def _merge_short(self, symbols: list[int]) -> list[int]:
        rules, none = self.codes.get, _NO_RULE
        codes = [rules(pair, none) for pair in zip(symbols, symbols[1:])]
        while codes:
            best = min(codes)
            if best == none:
                break
            i, merged = codes.index(best), best & _SYMBOL
            symbols[i] = merged
            del symbols[i + 1], codes[i]
            if i:
                codes[i - 1] = rules((symbols[i - 1], merged), none)
            if i < len(codes):
                codes[i] = rules((merged, symbols[i + 1]), none)
        return symbols

    def _merge_long(self, symbols: list[int]) -> list[int]:
        rules, n = self.rules, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rules[pair][0], i, pair) for i, pair in enumerate(zip(symbols, symbols[1:])) if pair in rules]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if j >= n or symbols[i] is None or (symbols[i], symbols[j]) != pair:
                continue                             # one of the two has been merged since
            symbols[i], symbols[j] = rules[pair][1], None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (symbols[a], symbols[b]) in rules:
                    heapq.heappush(heap, (rules[symbols[a], symbols[b]][0], a, (symbols[a], symbols[b])))
        return [s for s in symbols if s is not None]


class Stream:
    """Tokens of one pre-token whose bytes come in pieces."""

    def __init__(self, merges: Merges, length: dict[int, int], block: int = BLOCK):
        self.merges, self.length, self.block, self.held = merges, length, block, b""

    def push(self, data: bytes) -> list[int]:
        """The tokens that have become stable."""
        self.held += data
        out: list[int] = []
        while len(self.held) >= self.merges.lookahead + self.block:
            window = self.held[:self.merges.lookahead + self.block]
            end, stable = 0, len(window) - self.merges.lookahead
            for token in self.merges.merge(window):
                if end + self.length[token] > stable:
                    break
                end += self.length[token]
                out.append(token)
            if not end:                              # a token longer than a block
                self.block *= 2
            self.held = self.held[end:]
        return out

    def finish(self) -> list[int]:
        rest, self.held = self.merges.merge(self.held), b""
        return rest


_CUT = re.compile(r"(?= \S)")
_WIDE = re.compile(r" (?=\s)")


class Transducer:
    """Encodes and decodes texts with the merge list, pattern and added tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError("a byte-level BPE file without prefix space and normalizer is needed")
        letters = {c: b for b, c in enumerate(_byte_letters())}
        vocab = model["vocab"]
        self.bytes_of = {i: bytes(map(letters.__getitem__, s)) for s, i in vocab.items()
                         if all(c in letters for c in s)}
        self.length = {i: len(b) for i, b in self.bytes_of.items()}
        rules = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Merges(self.bytes_of, [(vocab[a], vocab[b], vocab[a + b]) for a, b in rules])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that strip or match whole words only are not supported")
        self.bytes_of |= {i: s.encode() for s, i in self.added.items()}
        self.between = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.pattern = regex.compile(_pattern())
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    # -- text to ids -----------------------------------------------------

    def _keep(self, text: str, ids: bytes) -> bytes:
        if len(text) <= CACHED_CHARS:
            if len(self.known) >= CACHE:
                self.older, self.known = self.known, {}
            self.known[text] = ids
        return ids

    def _pretoken(self, text: str, start: int, end: int) -> bytes:
        if end - start <= CACHED_CHARS:
            part = text[start:end]
            found = self.known.get(part)
            if found is None:
                found = self.older.get(part)
                found = self._keep(part, array("I", self.merges.merge(part.encode())).tobytes() if found is None else found)
            return found
        stream, out = Stream(self.merges, self.length), array("I")
        for at in range(start, end, BLOCK):
            out.extend(stream.push(text[at:min(at + BLOCK, end)].encode()))
        out.extend(stream.finish())
        return out.tobytes()

    def _span(self, text: str, start: int, end: int) -> bytes:
        """Ids of text[start:end], which ends where no token reaches over."""
        return b"".join([self._pretoken(text, *m.span()) for m in self.pattern.finditer(text, start, end)])

    def _stretch(self, part: str) -> bytes:
        if part in self.older:
            return self._keep(part, self.older[part])
        if part[part[0] == " ":].isalpha():
            return self._pretoken(part, 0, len(part))
        return self._keep(part, self._span(part, 0, len(part)))

    def _plain(self, text: str):
        """Yield the ids of a text without added tokens, region by region."""
        at = 0
        while at < len(text):
            cut = _CUT.search(text, at + REGION) if at + REGION < len(text) else None
            end = cut.start() if cut else len(text)
            if end - at > 2 * REGION:                # hardly any space: pre-token by pre-token
                yield self._span(text, at, end)
            else:
                region = text[at:end]
                if region[-1] != " " and not _WIDE.search(region):
                    head, *rest = region.split(" ")
                    parts = [head, *[" " + p for p in rest]] if head else [" " + p for p in rest]
                else:
                    parts = [p for p in _CUT.split(region) if p]
                ids = list(map(self.known.get, parts))
                if None in ids:
                    ids = [self._stretch(p) if i is None else i for p, i in zip(parts, ids)]
                yield b"".join(ids)
            at = end

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as native 32-bit integers."""
        if not self.added or not self.between.search(text):
            return b"".join(self._plain(text))
        out = []
        for k, part in enumerate(self.between.split(text)):
            out += [array("I", [self.added[part]]).tobytes()] if k % 2 else self._plain(part)
        return b"".join(out)

    # -- ids to text -----------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; bytes that are no UTF-8 become replacement characters, unknown ids nothing."""
        out, state = [], Text(self.bytes_of)
        for at in range(0, len(ids), IDS):
            out.append(state.push(ids[at:at + IDS].tolist()))
        return "".join([*out, state.finish()])


class Text:
    """Incremental machine from ids to text: holds the bytes of at most one unfinished character."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of, self.held = bytes_of, b""

    def push(self, ids: list[int]) -> str:
        """The text that the ids complete."""
        try:
            data = self.held + b"".join([self.bytes_of[i] for i in ids])
        except KeyError:
            data = self.held + b"".join([self.bytes_of.get(i, b"") for i in ids])
        end = len(data)
        for back in range(1, min(3, end) + 1):
            byte = data[-back]
            if byte >= 0xC0:                         # begins a character of 2, 3 or 4 bytes
                if back < 2 + (byte >= 0xE0) + (byte >= 0xF0):
                    end -= back
                break
            if byte < 0x80:
                break
        self.held = data[end:]
        return data[:end].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


@functools.cache
def transducer(path: str) -> Transducer:
    """One for each Python worker and file."""
    return Transducer(path)


def _encode(path: str):
    def run(batches):
        t = transducer(path)
        for batch in batches:
            ids = [t.encode(x or "") for x in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *(len(i) // 4 for i in ids)])
            flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)],
                                             names=["doc_id", "ids"])
    return run


def _decode(path: str):
    def run(batches):
        t = transducer(path)
        for batch in batches:
            texts = [t.decode(np.zeros(0, np.int32) if x.values is None else x.values.to_numpy(zero_copy_only=False))
                     for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])
    return run


def encode_texts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and ids (array<int>) of every row of `docs`.

    Defined cases: a null or empty text has no ids; an added token's string in a
    text is that token; texts are read whole; null doc_ids and repeated rows are
    rows like others; an empty table gives an empty result; columns other than
    doc_id and text are ignored.
    """
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _encode(tokenizer or tokenizer_path()), "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, ids and decoded (the text they spell); null ids spell nothing."""
    prepare(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(
        _decode(tokenizer or tokenizer_path()), "doc_id long, ids array<int>, decoded string")


def code_digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row: encoded, then decoded from the ids."""
    back = decode_ids(encode_texts(docs, tokenizer), tokenizer)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
