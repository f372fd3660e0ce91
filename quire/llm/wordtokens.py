"""Ids of whole texts as a word-level BPE file of the tokenizers library gives them."""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

from tokenizers import Tokenizer

from .common import Remembered

#: White space that ends a word for the file's pattern and that no normal form joins to a neighbour.
_SPACE = re.compile("[ \t\n\v\f\r]+")
#: Below U+0300 nothing composes, and Python's lower case is that of the library (a test compares every sign).
_LATE = re.compile("[^\x00-\u02ff]")
_SIGNS = {c for sign in map(chr, range(0x300)) for c in (sign, *sign.lower())}
_LETTERS = "".join(sorted(c for c in _SIGNS if unicodedata.category(c)[0] == "L"))
_NUMBERS = "".join(sorted(c for c in _SIGNS if unicodedata.category(c)[0] == "N"))
_BLANKS = " \t\n\v\f\r\x85\xa0"
#: Fixed value: the pattern between white space, spelt out for the signs below U+0300.
_EARLY = re.compile(f"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{_NUMBERS}]|[^{_BLANKS}{_LETTERS}{_NUMBERS}]+")
#: Fixed value: the pattern that the file has to give.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Code points of a text that are split at once.
STRETCH = 1 << 20
#: Pre-tokens that a task remembers, of about 200 bytes each.
PIECES = 1 << 19


class Encoder:
    """The library's ids of a text without special tokens added, pre-token by pre-token.

    White space is dropped and never inside a token, so a text's ids are those of
    its words one after another.  Words below U+0300 are lower-cased and split
    here, and each pre-token that isn't remembered goes to the library's model;
    other words, and those with an added token, go through the whole library.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec["pre_tokenizer"].get("pretokenizers", [{}])
        if (steps[0].get("pattern", {}).get("Regex") != PATTERN or steps[0].get("behavior") != "Removed"
                or not steps[0].get("invert") or [s.get("type") for s in steps[1:]] != ["ByteLevel"]
                or steps[1].get("add_prefix_space") or steps[1].get("use_regex")
                or [n.get("type") for n in (spec["normalizer"] or {}).get("normalizers", ())] != ["NFC", "Replace", "Lowercase"]
                or spec["model"]["dropout"] or spec["truncation"] or spec["padding"]
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or _SPACE.search(t["content"])
                       for t in spec["added_tokens"])):
            raise ValueError("a word-level BPE file with lower case and the usual pattern is needed")
        self.vocabulary = self.library.get_vocab_size()
        self.kind = "H" if self.vocabulary <= 1 << 16 else "I"
        self.added = tuple(t["content"] for t in spec["added_tokens"])
        model, signs = self.library.model, self.library.pre_tokenizer

        def merged(piece: str) -> bytes:
            seen = piece if piece.isascii() and piece.isprintable() else signs.pre_tokenize_str(piece)[0][0]
            return array(self.kind, [t.id for t in model.tokenize(seen)]).tobytes()

        self.pieces = Remembered(merged, PIECES)
        self.words = Remembered(
            lambda word: array(self.kind, self.library.encode(word, add_special_tokens=False).ids).tobytes())

    def _plain(self, text: str) -> bool:
        return _LATE.search(text) is None and not any(a in text for a in self.added)

    def _plain_ids(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, _EARLY.findall(text.lower())))

    def _stretch(self, text: str) -> bytes:
        if self._plain(text):
            return self._plain_ids(text)
        return b"".join([self._plain_ids(w) if self._plain(w) else self.words[w] for w in _SPACE.split(text)])

    def encode(self, text: str) -> bytes:
        """Little-endian ids, two bytes each if the vocabulary allows it, else four."""
        self.pieces.age()
        self.words.age()
        if len(text) <= STRETCH:
            return self._stretch(text)
        out, at = [], 0
        while at < len(text):
            space = _SPACE.search(text, at + STRETCH)
            stop = space.end() if space else len(text)
            out.append(self._stretch(text[at:stop]))
            at = stop
        return b"".join(out)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)
