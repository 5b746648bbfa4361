"""Byte-level BPE with the tokenizers library, cached by stretches of text.

The pre-tokenizer's pattern never lets a token reach over a space that a
non-space follows: whatever stands before, such a space starts a token.  A text
can therefore be encoded stretch by stretch, cut before those spaces, and most
stretches (a space and a word) repeat.  Ids of stretches and of single
pre-tokens are kept in a cache of bounded size.
"""

from __future__ import annotations

import functools
import re
from array import array

import regex

TOKENIZER = "byte_bpe_50k.json"
CACHE = 1_200_000     # entries kept (about 200 MB); a full cache is emptied
CACHED_CHARS = 64     # longer stretches and pre-tokens aren't kept


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


_WIDE = re.compile(r" (?=\s)")
_CUT = re.compile(r"(?= \S)")


def stretches(text: str) -> list[str]:
    """Cut a text before each space that a non-space follows."""
    if text[-1:] != " " and not _WIDE.search(text):
        pieces = text.split(" ")
        out = [pieces[0], *[" " + p for p in pieces[1:]]]
    else:
        return [p for p in _CUT.split(text) if p]
    return out if out[0] else out[1:]


class Encoder:
    """Ids of whole texts, equal to the tokenizer's own encoding with add_special_tokens=False.

    With `added`, strings of the file's added tokens in a text are those tokens, as the
    library takes them; without, they are ordinary text.  `marks` become added tokens too.
    """

    def __init__(self, path: str, added: bool = False, marks: tuple[str, ...] = ()):
        from tokenizers import AddedToken, Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in marks])
        self.added = {}
        for i, t in self.tokenizer.get_added_tokens_decoder().items() if added else ():
            if t.single_word or t.lstrip or t.rstrip:
                raise ValueError("added tokens that strip or match whole words only are not supported")
            self.added[t.content] = array("I", [i]).tobytes()
        self.between = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.model = self.tokenizer.model
        self.pattern = regex.compile(_pattern())
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}

    def _keep(self, text: str, ids: bytes) -> bytes:
        if len(text) <= CACHED_CHARS:
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[text] = ids
        return ids

    def _pretoken(self, part: str) -> bytes:
        """Ids of one pre-token as little-endian 32-bit integers."""
        letters = self.letters
        spelled = "".join([letters[b] for b in part.encode()])
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def stretch(self, s: str) -> bytes:
        """Ids of a stretch; letters after at most one space are a single pre-token,
        and so is a last full stop or comma."""
        found = self.known.get(s)
        if found is not None:
            return found
        start = s[0] == " "
        if s[start:].isalpha():
            return self._keep(s, self._pretoken(s))
        ids, simple = [], s[-1] in ".," and s[start:-1].isalpha()
        for part in (s[:-1], s[-1]) if simple else self.pattern.findall(s):
            found = self.known.get(part)
            ids.append(found if found is not None else self._keep(part, self._pretoken(part)))
        return self._keep(s, b"".join(ids))

    def encode(self, text: str) -> bytes:
        """All ids of a text as little-endian 32-bit integers."""
        if not self.added or not self.between.search(text):
            return self._plain(text)
        return b"".join([self.added[part] if k % 2 else self._plain(part) for k, part in enumerate(self.between.split(text))])

    @functools.cached_property
    def token_bytes(self) -> list[bytes]:
        """The bytes each id stands for in a text."""
        value = {letter: b for b, letter in enumerate(self.letters)}
        out = [b""] * (max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            out[i] = bytes([value[c] for c in token]) if set(token) <= value.keys() else token.encode()
        for i, token in self.tokenizer.get_added_tokens_decoder().items():
            out[i] = token.content.encode()
        return out

    def _plain(self, text: str) -> bytes:
        """Ids of a text in which no added token stands."""
        cuts = stretches(text)
        ids = list(map(self.known.get, cuts))
        if None in ids:
            ids = [self.stretch(s) if i is None else i for s, i in zip(cuts, ids)]
        return b"".join(ids)


@functools.cache
def encoder(path: str, added: bool = False, marks: tuple[str, ...] = ()) -> Encoder:
    """One encoder for each Python worker, file and choice of added tokens."""
    return Encoder(path, added, marks)


def _pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def _byte_letters() -> list[str]:
    """Byte-level spelling: printable bytes stand for themselves, the others for
    the code points from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]
