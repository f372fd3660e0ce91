"""Byte-level BPE pre-tokens of a text, whole or by overlapping chunks."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right

import regex

#: Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Code points that a match needs to see past its own start (the longest contraction).
LOOK = 3

_split = regex.compile(PATTERN)
#: Below U+0558 every Unicode version agrees on letters and numbers.
_AGREED = 0x558
_late = re.compile("[^\x00-\u0557]")


def _early_pattern() -> re.Pattern:
    """The same matches for texts below U+0558, with the classes spelt out (faster)."""
    low = [chr(c) for c in range(_AGREED)]
    letters = "".join(c for c in low if unicodedata.category(c)[0] == "L")
    numbers = "".join(c for c in low if unicodedata.category(c)[0] == "N")
    space = "\t\n\v\f\r \x85\xa0"
    return re.compile(
        f" ?[{letters}]+| ?[{numbers}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{space}{letters}{numbers}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+")


_early = _early_pattern()


def _stand_in(text: str) -> str:
    """``text`` as the tokenizer libraries classify it.

    Code points that were assigned after their Unicode tables are neither
    letters nor numbers to them; here a plain sign of that class stands in, at
    the same place, so that matches keep their positions.
    """
    new = [c for c in set(text) if c > "\u0557" and unicodedata.category(c) == "Cn"]
    return text.translate({ord(c): "!" for c in new}) if new else text


def split(text: str) -> list[str]:
    """The pre-tokens of a whole text; joined they are the text."""
    if _late.search(text) is None:
        return _early.findall(text)
    seen = _stand_in(text)
    if seen is text:
        return _split.findall(text)
    return [text[m.start():m.end()] for m in _split.finditer(seen)]


def ends(text: str) -> list[int]:
    """End positions of the pre-tokens of ``text``."""
    if _late.search(text) is None:
        return [m.end() for m in _early.finditer(text)]
    return [m.end() for m in _split.finditer(_stand_in(text))]


def chunk_spans(length: int, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Chunk ``k`` starts at ``k * chunk`` and reaches ``overlap`` into the next one."""
    return [(s, min(length, s + chunk + overlap)) for s in range(0, max(length, 1), chunk)]


def settled(bounds: list[int], start: int, stop: int, length: int) -> list[int]:
    """Boundaries (absolute) whose match the cut at ``stop`` can't have changed.

    A match from p to q depends on text up to max(q + 1, p + LOOK).
    """
    if stop == length:
        return bounds
    out, p = [], start
    for q in bounds:
        if q >= stop or p + LOOK > stop:
            break
        out.append(q)
        p = q
    return out


def stitch(text: str, chunks: list[tuple[int, list[int]]]) -> list[int]:
    """True pre-token ends of ``text`` from the settled ends of its chunks.

    ``chunks`` holds (start, settled ends) in order of start.  A match depends
    only on the text from its own start on, so as soon as a chunk has a
    boundary where a true one lies, all its later settled ones are true.  Where
    the overlap has no common boundary (a run longer than it), matching goes on
    from the last true boundary until one resynchronises.
    """
    out: list[int] = []
    at, seen = 0, _stand_in(text)

    def walk(until: set[int], limit: int) -> int:
        p = at
        while p < limit and p not in until:
            p = _split.match(seen, p).end()
            out.append(p)
        return p

    for start, bounds in chunks:
        marks = {start, *bounds}
        at = walk(marks, bounds[-1] if bounds else start)
        if at in marks:
            out += bounds[bisect_right(bounds, at):]
            at = out[-1] if out else at
    walk(set(), len(text))
    return out
