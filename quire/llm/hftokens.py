"""Ids of whole texts as a byte-level BPE file of the tokenizers library gives them, with an end id."""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

from . import pretoken
from .common import Remembered, byte_slices, strings


def _byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in the file: itself if printable, else one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Encodes as the file says: added tokens inside a text first, then each pre-token by the library's model.

    A pre-token's ids depend on it alone, so they are remembered; one that isn't
    goes to the model that the tokenizers library built from the file.
    """

    def __init__(self, path: str):
        library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind, model, added = spec["pre_tokenizer"] or {}, spec["model"], spec["added_tokens"]
        # a post-processor adds nothing without special tokens; ignore_merges and the like are the model's own
        if (spec["normalizer"] or model["type"] != "BPE" or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space")
                or not kind.get("use_regex", True) or model.get("dropout") or spec["truncation"] or spec["padding"]
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)):
            raise ValueError("a byte-level BPE file is needed, without normaliser, prefix space, dropout or truncation")
        sign = {b: c for c, b in _byte_signs().items()}
        space, tokenize = sign[32], library.model.tokenize
        self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in added}
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")"
                                   ) if self.added else None

        def merged(piece: str) -> bytes:
            seen = (piece.replace(" ", space) if piece.isascii() and piece.isprintable()
                    else "".join([sign[b] for b in piece.encode()]))
            return array("I", [t.id for t in tokenize(seen)]).tobytes()

        self.ids = Remembered(merged)

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        self.ids.age()
        if self.marks is None or self.marks.search(text) is None:
            return b"".join(map(self.ids.__getitem__, pretoken.split(text)))
        out = []
        for part in self.marks.split(text):
            out += [self.added[part]] if part in self.added else map(self.ids.__getitem__, pretoken.split(part))
        return b"".join(out)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encoded(batches: Iterator[pa.RecordBatch], path: str, end_id: int,
            column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with the ids of each text, the end id appended."""
    own, end = encoder(path), np.array([end_id], "<u4").tobytes()
    for batch in byte_slices(batches, column):
        yield batch, [own.encode(x) + end for x in strings(batch, column)]
