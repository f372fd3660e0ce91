"""Column functions for book text: normalisation, headings, inclusion, shelves.

Every function takes and returns :class:`pyspark.sql.Column`, so it runs inside
whole-stage codegen / JVM expression evaluation; no Python per row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def _lit(s: str) -> Column:
    return F.lit(s)


def once(x: Column, use: Callable[[Column], Column]) -> Column:
    """``use(x)`` with ``x`` made once: there it is a lambda's own element, which the optimiser doesn't inline."""
    return F.transform(F.array(x), use)[0]


#: Whitespace other than the space; the range before the class settles most characters at once.
_ODD_SPACE = r"[\x00-\x1f\x7f-\x{10ffff}&&" + K.WS + "]"


def _single_spaced(p: Column) -> Column:
    """The only whitespace are single spaces; they may stand at the ends."""
    return ~((F.instr(p, "  ") > 0) | p.rlike(_ODD_SPACE))


def _spaces(p: Column) -> Column:
    return F.length(p) - F.length(F.replace(p, _lit(" "), _lit("")))


def normalize_book(book: Column) -> Column:
    """Literal replacements in fixed order, then whitespace runs -> one space.

    The regex runs only where a run is left after pairs of spaces became one.
    """
    out = book
    for old, new in K.NORMALISE_REPLACEMENTS:
        if old != new:
            out = F.replace(out, _lit(old), _lit(new))
    return once(F.replace(out, _lit("  "), _lit(" ")),
                lambda x: F.when(_single_spaced(x), x).otherwise(F.regexp_replace(x, K.WS + "+", " ")))


def split_paragraphs(norm: Column) -> Column:
    """Normalised book -> array of raw paragraph strings (split on the marker)."""
    return F.split(norm, re.escape(K.PARAGRAPH_MARKER), -1)


def strip(p: Column) -> Column:
    """``str.strip()`` for any text: trims every Unicode whitespace char.

    The regex runs only when the first or last character is whitespace.
    """
    edge = F.substring(p, 1, 1).rlike(K.WS) | F.substring(p, -1, 1).rlike(K.WS)
    return F.when(edge, F.regexp_replace(p, f"^{K.WS}+|{K.WS}+$", "")).otherwise(p)


def word_count(p: Column) -> Column:
    """``len(p.split())``: number of maximal non-whitespace runs.

    Pieces of a split on whitespace runs, minus the empty first / last piece
    when the text starts / ends with whitespace (checked on one character).
    Where single spaces are the only whitespace, these are counted instead.
    """
    edge = lambda c: F.when(c.rlike(K.WS), 1).otherwise(0)
    ends = edge(F.substring(p, 1, 1)) + edge(F.substring(p, -1, 1))
    return F.when(p == "", F.lit(0)).otherwise(_stretches(p) - ends).cast("bigint")


def _stretches(p: Column) -> Column:
    """Pieces of a split on whitespace runs."""
    return F.when(_single_spaced(p), _spaces(p) + 1).otherwise(F.size(F.split(p, K.WS + "+", -1)))


#: The two characters that a heading starts with; the heading pattern's own search would try every place of a text.
_HEADING_START = r"^(?:[cC][hH]|[IVXLCDM](?:$|[IVXLCDM])|[A-Z ]{2}|No|Pa|[\s*])"


def _no_heading_start(p: Column) -> Column:
    return ~F.substring(p, 1, 2).rlike(_HEADING_START)


def heading_or_empty(p: Column) -> Column:
    return F.when(_no_heading_start(p), F.lit("")).otherwise(F.regexp_extract(p, K.HEADING_PATTERN, 0))


def heading(p: Column) -> Column:
    """Matched heading text of a stripped paragraph, or NULL."""
    return F.nullif(heading_or_empty(p), _lit(""))


def no_chapterization(norm: Column) -> Column:
    """True when the heading pattern does *not* match the normalised book."""
    return F.when(_no_heading_start(norm), F.lit(True)).otherwise(~norm.rlike(K.HEADING_PATTERN))


def is_all_upper(p: Column) -> Column:
    """``str.isupper()``: one upper-case char and no lower/title-case char."""
    # the usual case stops after the first test
    return ~p.rlike(r"[\p{IsLowercase}\p{IsTitlecase}]") & p.rlike(r"\p{IsUppercase}")


def inclusion_flags(p: Column, n_words: Column) -> dict[str, Column]:
    """The six conditions a paragraph must meet to be kept, by name."""
    low = F.lower(p)
    quoted = F.lit(False)
    for q in K.DIALOGUE_QUOTES:
        quoted = quoted | (F.instr(p, q) > 0)
    return {
        "more_three_words": n_words > K.MIN_WORDS,
        "not_dialog": (n_words > K.DIALOGUE_MAX_WORDS) | ~quoted,
        "not_all_upper": ~is_all_upper(p),
        "not_footnote": ~low.rlike(K.FOOTNOTE_PATTERN),
        "not_transcriber": ~low.rlike(K.TRANSCRIBER_PATTERN),
        "not_illustration": ~low.rlike(K.ILLUSTRATION_PATTERN),
    }


def inclusion_condition(p: Column, n_words: Column | None = None) -> Column:
    """Conjunction of :func:`inclusion_flags` (``p`` already stripped)."""
    if n_words is None:
        n_words = word_count(p)
    f = inclusion_flags(p, n_words)
    # the three note patterns in one scan of the lower-cased text, only for
    # text containing '[' (every note pattern starts with it, and lower-casing
    # neither creates nor removes it)
    notes = "|".join((K.FOOTNOTE_PATTERN, K.TRANSCRIBER_PATTERN, K.ILLUSTRATION_PATTERN))
    has_note = (F.instr(p, "[") > 0) & F.lower(p).rlike(notes)
    return f["more_three_words"] & f["not_dialog"] & f["not_all_upper"] & ~has_note


def bookshelves(shelf: Column) -> Column:
    """Shelf string -> array of shelf tokens; NULL stays NULL."""
    s = F.replace(shelf, _lit(K.SHELF_PREFIX), _lit(""))
    s = F.lower(s)
    s = F.replace(F.replace(s, _lit("-"), _lit("")), _lit(" "), _lit(""))
    return F.split(s, K.SHELF_SEPARATORS, -1)


def genre_exclusive(shelves: Column) -> Column:
    """True when every shelf is one of the kept genres."""
    genres = [F.lit(g) for g in K.GENRES_KEPT]
    return F.forall(shelves, lambda x: x.isin(*genres))


def piece_limit(n_words: Column, max_len: Column | int, floor_limit: bool = True) -> Column:
    """Words allowed per piece when a text of ``n_words`` is cut: max / cuts.

    ``floor_limit=False`` keeps the unrounded quotient (the notebook variant);
    for integer word sums ``sum > x`` equals ``sum > floor(x)``, so both give
    the same pieces.
    """
    m = F.lit(max_len) if isinstance(max_len, int) else max_len
    cuts = F.ceil(n_words / m)
    return F.floor(m / cuts).cast("bigint") if floor_limit else (m / cuts).cast("double")


# A sentence: the shortest stretch up to end punctuation with any closing quotes
# or brackets, before whitespace and an optional opening quote or bracket with an
# upper-case letter; else the rest of the text.  Whitespace before it is left out.
# Stretches without punctuation are taken whole and never given back; Java's
# matcher walks a possessive group in a loop, so the stack doesn't grow.
def _sentence(kept: str) -> str:
    end = kept + "[\"”’')\\]]*+(?=" + K.WS + "+[\"“‘'(\\[]?\\p{Lu})"
    return f"(?s){K.WS}*(.[^.!?]*+(?:[.!?](?!{end})[^.!?]*+)*+(?:[.!?]{end}|\\z))"


SENTENCE = _sentence("")


def sentence_pattern(abbreviations: Iterable[str] = ()) -> str:
    """The pattern of a sentence; a period after a whole word among ``abbreviations`` (in any case) ends none."""
    words = sorted(set(abbreviations), key=lambda w: (-len(w), w))
    if not words:
        return SENTENCE
    listed = "|".join(f"\\Q{w}\\E" for w in words)
    return _sentence(f"(?<!(?<![\\p{{L}}\\p{{N}}.])(?iu:{listed})\\.)")


def sentences(p: Column, abbreviations: Iterable[str] = ()) -> Column:
    """Paragraph -> array of sentences (whitespace between them dropped).

    The text is stripped first; an empty text has no sentence.  ``abbreviations``
    are words without their last period, such as ``mr`` or ``e.g``, given by the
    caller or learned by ``operators.abbreviations``.
    """
    return F.regexp_extract_all(strip(p), _lit(sentence_pattern(abbreviations)), F.lit(1))


def trimmed_word_count(p: Column) -> Column:
    """:func:`word_count` for text known to have no leading/trailing space."""
    return F.when(p == "", F.lit(0)).otherwise(_stretches(p)).cast("bigint")
