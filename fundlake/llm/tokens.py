"""Pre-tokens and token ids of a tokenizer file, piece by piece.

Byte-pair merges never cross a pre-token, so a text's ids are the ids of its pre-tokens one after the other, and a
pre-token seen before need not be merged again. The two splitting patterns below are the ones the files carry, written
for Python's ``re`` over the characters of ``PLAIN``, for which both pattern languages agree (tests compare every one of
them). A text with any other character, or with the start of a special token, is left to the library as a whole.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

from tokenizers import Tokenizer

#: Characters for which the patterns below split as the library does: Latin, common punctuation, currency signs.
PLAIN = "\\t\\n\\r\\x20-\\x7e¡-±´-¸º»¿-įĲ-ɏ‐-‧‰-⁞₠-₿"
_OTHER = re.compile(f"[^{PLAIN}]")
#: Letters among them and their lower case, which ``re`` has no class for; what is neither letter, digit nor space is a symbol.
_LETTER = "a-zA-Zªµº\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af\u2c65\u2c66"
_SYMBOL = rf"[^\s0-9{_LETTER}]"

# Pattern in the tokenizer file -> the same pattern for ``re``.
SPLITS = {
    "ByteLevel": rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?{_SYMBOL}+|\s+(?!\S)|\s+",
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+": rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|{_SYMBOL}+",
}



def byte_letters() -> list[str]:
    """Letter that stands for each byte in a byte-level vocabulary: printable bytes are themselves, the others follow 255."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(byte if byte in printable else next(others)) for byte in range(256)]


_LETTERS = byte_letters()

#: Pre-tokens whose ids are remembered by one Python worker, twice over: those seen lately and those before them.
REMEMBERED = 400_000


class _Ids(dict):
    """Token ids of a pre-token as little-endian unsigned 32-bit words, filled on demand. When full, what it holds moves
    to a second store, from which only pre-tokens that come again are taken back."""

    def __init__(self, encode: Callable[[str], list[int]]):
        super().__init__()
        self._encode, self._before = encode, {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self._before = dict(self)
            self.clear()
        ids = self._before.get(piece)
        if ids is None:
            ids = array("I", self._encode(piece)).tobytes()
        self[piece] = ids
        return ids


class PieceTokenizer:
    """A tokenizer file taken apart into splitting and merging."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.word_end = spec["model"].get("end_of_word_suffix") or ""
        self.lower = "Lowercase" in json.dumps(spec.get("normalizer"))
        self.special = sorted({token["content"][0] for token in spec["added_tokens"]})
        steps = [spec["pre_tokenizer"], *(spec["pre_tokenizer"].get("pretokenizers") or [])]
        known = [SPLITS.get(s.get("pattern", {}).get("Regex") or (s["type"] if s.get("use_regex") else "")) for s in steps]
        self.pattern = next((re.compile(k) for k in known if k), None)
        self.marks = [token["content"] for token in spec["added_tokens"]]
        self.bytewise = "ByteLevel" in json.dumps(spec["pre_tokenizer"])
        self.ids = _Ids(self._merge)

    def _merge(self, piece: str) -> list[int]:
        """Ids of one pre-token: the merges alone, as a pre-token is neither split nor normalised again."""
        if self.bytewise:
            piece = "".join(map(_LETTERS.__getitem__, piece.encode()))
        return [token.id for token in self.library.model.tokenize(piece)]

    def pieces(self, text: str) -> list[str] | None:
        """The pre-tokens of ``text``, or None where only the library can tell."""
        if self.pattern is None or _OTHER.search(text) or any(mark in text for mark in self.marks):
            return None
        return self.pattern.findall(text.lower() if self.lower else text)

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian unsigned 32-bit words, without added tokens."""
        pieces = self.pieces(text)
        if pieces is None:
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.ids.__getitem__, pieces))


@lru_cache(maxsize=4)
def tokenizer(path: str) -> PieceTokenizer:
    """One per Python worker and file."""
    return PieceTokenizer(path)
