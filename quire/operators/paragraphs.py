"""Stage 1: books -> paragraphs (text, book id, span, chapter, index, words).

Per book (one row) everything happens on arrays inside the row, and no shuffle
is needed for the global index either:

* normalise, split on the paragraph marker, strip;
* tag headings; forward-fill the chapter in linear time by repeating each
  heading over the run up to the next one (``array_repeat`` + ``flatten``);
* keep the paragraphs that pass the inclusion test, outside headings;
* locate each kept paragraph's first occurrence in the normalised book (small
  Arrow UDF over the book and the places of the kept paragraphs);
* explode.

The normalised book is never carried onto exploded rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions import text as X
from . import ordering

#: Times that a text is read for its stretches one by one; a reading takes a fifteenth of what hashes take for ten.
SEARCHES = 128
#: Bits of a text hash: odd factors for joining the hashes of two halves.
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _halves_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    h = left * np.uint64(_FACTORS[0]) + right * np.uint64(_FACTORS[1])
    return h ^ (h >> np.uint64(29))


def first_offsets(text: str, begins: list[int], lengths: list[int]) -> list[int]:
    """First occurrence in ``text`` (code points) of each stretch ``text[b:b + n]``.

    Each is looked for in the text before it, unless that reads the text more
    than ``SEARCHES`` times; then hashes find all of them.
    """
    if sum(begins) <= SEARCHES * len(text):
        return [text.find(text[b:b + n], 0, b + n) for b, n in zip(begins, lengths, strict=True)]
    return hashed_offsets(text, begins, lengths)


def hashed_offsets(text: str, begins: list[int], lengths: list[int]) -> list[int]:
    """:func:`first_offsets` in a time that grows with the text, whatever the number of stretches.

    A stretch of ``n`` code points is known by the hashes of its first and its
    last ``2**k``, the largest power up to ``n``; window hashes of length
    ``2**k`` for all places come from those of half the length.  For each ``k``
    the places whose window is the first half of some stretch are found by
    binary search, and among them, for each length, the last halves.  What is
    found is compared with the text itself.
    """
    out = list(begins)
    points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    window = _halves_hash(points + np.uint64(1), points)
    begin, length = np.array(begins, np.int64), np.array(lengths, np.int64)
    power = np.where(length > 0, np.frexp(np.maximum(length, 1).astype(float))[1] - 1, -1)
    out = np.where(length == 0, 0, begin)
    size = 1
    for k in range(int(power.max(initial=-1)) + 1):
        if k:
            window = _halves_hash(window[:-size], window[size:])
            size *= 2
        at = np.flatnonzero(power == k)
        if not len(at):
            continue
        heads, owner = np.unique(window[begin[at]], return_inverse=True)
        spot = np.minimum(np.searchsorted(heads, window), len(heads) - 1)
        places = np.flatnonzero(heads[spot] == window)
        order = np.argsort(spot[places], kind="stable")  # by head, in text order
        places = places[order]
        bounds = np.searchsorted(spot[places], np.arange(len(heads) + 1))
        # stretches with the same head and length are looked up together
        groups = np.lexsort((length[at], owner))
        keys = np.stack([owner[groups], length[at][groups]])
        edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), len(groups)]
        for a, b in zip(edges, edges[1:]):
            mine = at[groups[a:b]]
            n = int(length[mine[0]])
            h = int(owner[groups[a]])
            cand = places[bounds[h]:bounds[h + 1]]
            cand = cand[cand + n <= len(points)]
            tails, first = np.unique(window[cand + n - size], return_index=True)
            out[mine] = cand[first[np.searchsorted(tails, window[begin[mine] + n - size])]]
    found = out.tolist()
    for i, (o, b, n) in enumerate(zip(found, begins, lengths, strict=True)):
        if o != b and text[o:o + n] != text[b:b + n]:  # two hashes met by chance
            found[i] = text.find(text[b:b + n])
    return found


def _begins(lengths: list[int], blanks: list[int], positions: list[int]) -> list[int]:
    """Code-point offset of each part ``pos`` after its leading blanks, from the lengths of all parts."""
    if not positions:
        return []
    before = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64) + len(K.PARAGRAPH_MARKER))])
    return (before[positions] + np.array(blanks, np.int64)[positions]).tolist()


@F.arrow_udf(T.ArrayType(T.LongType()))
def true_starts(lengths: pa.Array, blanks: pa.Array, positions: pa.Array) -> pa.Array:
    """Where the parts ``positions`` of a book begin."""
    rows = zip(lengths.to_pylist(), blanks.to_pylist(), positions.to_pylist(), strict=True)
    return pa.array([None if n is None or at is None else _begins(n, lead, at) for n, lead, at in rows], pa.list_(pa.int64()))


@F.arrow_udf(T.ArrayType(T.LongType()))
def first_occurrence(book: pa.Array, lengths: pa.Array, blanks: pa.Array, positions: pa.Array, sizes: pa.Array) -> pa.Array:
    """Code-point offset of the first occurrence of each of the parts ``positions``, which have ``sizes``.

    Where they begin is worked out here as well: a second function would send the books on once more.
    """
    out = []
    for text, n, lead, at, size in zip(*(c.to_pylist() for c in (book, lengths, blanks, positions, sizes)), strict=True):
        out.append(None if text is None or n is None or at is None else first_offsets(text, _begins(n, lead, at), size))
    return pa.array(out, type=pa.list_(pa.int64()))


def _spaced_word_count(p: Column) -> Column:
    """Words of a normalised, stripped paragraph (single spaces only)."""
    return F.when(p == "", F.lit(0)).otherwise(
        F.length(p) - F.length(F.replace(p, F.lit(" "), F.lit(""))) + 1).cast("bigint")


def _text_id(df: DataFrame, id_col: str) -> Column:
    """Integer book id from the corpus' string id (``"007"`` -> 7, junk -> NULL)."""
    return F.expr(f"try_cast(trim(`{id_col}`) AS BIGINT)")


def book_parts(corpus: DataFrame, id_col: str = "id", text_col: str = "text",
               keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per book: normalised text, stripped parts, headings, chapters.

    Columns: ``text_ids``, ``keep``..., ``_norm``, ``_ps`` (stripped parts),
    ``_hs`` (heading per part, ``''`` when none), ``_cs`` (chapter in force
    per part, NULL before the first heading), ``_nochap``.

    Lambdas only ever read their own element: an outer array referenced inside
    a lambda may be inlined by the optimiser and recomputed per element.
    """
    b = corpus.select(_text_id(corpus, id_col).alias(K.COL_TEXT_ID), *keep,
                      X.normalize_book(F.col(text_col)).alias("_norm"))
    b = b.select("*", X.split_paragraphs(F.col("_norm")).alias("_raw"), X.no_chapterization(F.col("_norm")).alias("_nochap"))
    b = b.select("*", F.transform("_raw", lambda x: F.trim(x)).alias("_ps"), F.transform("_raw", F.length).alias("_lens"),
                 F.transform("_raw", lambda x: F.length(x) - F.length(F.ltrim(x))).alias("_leads")).drop("_raw")
    b = b.withColumn("_hs", F.transform("_ps", X.heading_or_empty))
    n = F.size("_ps")
    # headings with their positions, then where each heading's run ends
    heads = F.filter(F.arrays_zip(F.sequence(F.lit(0), n - 1).alias("i"), F.col("_hs").alias("h")),
                     lambda x: x["h"] != "")
    b = b.withColumn("_heads", heads)
    starts = F.transform("_heads", lambda x: x["i"])
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), F.array(n))
    runs = F.transform(F.arrays_zip(F.col("_heads").alias("a"), ends.alias("e")),
                       lambda z: F.array_repeat(z["a"]["h"], (z["e"] - z["a"]["i"]).cast("int")))
    lead = F.array_repeat(F.lit(None).cast("string"),
                          F.coalesce(F.get(starts, F.lit(0)), n).cast("int"))
    # chapter in force at each part: O(parts) per book
    return b.withColumn("_cs", F.concat(lead, F.flatten(runs))).drop("_heads")


def _kept(b: DataFrame) -> DataFrame:
    """Add ``_kept``: array of (pos, p, chapter, words) for kept paragraphs."""
    z = F.arrays_zip(F.col("_ps").alias("p"), F.col("_cs").alias("c"), F.col("_hs").alias("h"))

    def item(x, i):
        return F.struct(i.cast("bigint").alias("pos"), x["p"].alias("p"), x["c"].alias("c"),
                        x["h"].alias("h"), _spaced_word_count(x["p"]).alias("nw"))

    def keep(x):
        return ((x["h"] == "") & (x["c"].isNotNull() | F.col("_nochap"))
                & X.inclusion_condition(x["p"], x["nw"]))

    return b.withColumn("_kept", F.filter(F.transform(z, item), keep))


def book_paragraph_arrays(corpus: DataFrame, id_col: str = "id", text_col: str = "text",
                          keep: tuple[str, ...] = (), true_spans: bool = False) -> DataFrame:
    """One row per book with ``_kept`` paragraphs and their ``_starts``.

    ``true_spans`` adds ``_tstarts``: where each kept paragraph really is
    (the parity span is its first occurrence, which may be earlier).
    """
    b = _kept(book_parts(corpus, id_col, text_col, keep))
    parts = F.col("_lens"), F.col("_leads"), F.transform("_kept", lambda x: x["pos"])
    starts = {"_starts": first_occurrence(F.col("_norm"), *parts, F.transform("_kept", lambda x: F.length(x["p"])))}
    if true_spans:
        starts["_tstarts"] = true_starts(*parts)
    b = b.withColumns(starts)
    return b.drop("_norm", "_ps", "_hs", "_cs", "_nochap", "_lens", "_leads")


def explode_paragraphs(books: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Book rows with ``_kept``/``_starts`` -> one row per kept paragraph.

    Adds ``_k``: ordinal of the paragraph among the kept ones of its book.
    """
    true = "_tstarts" in books.columns
    cols = [F.col("_kept").alias("x"), F.col("_starts").alias("s")]
    if true:
        cols.append(F.col("_tstarts").alias("t"))
    e = books.select(K.COL_TEXT_ID, *keep, F.posexplode(F.arrays_zip(*cols)).alias("_k", "_z"))
    p = F.col("_z.x.p")
    start = F.col("_z.s")
    extra = [F.array(F.col("_z.t"), F.col("_z.t") + F.length(p).cast("bigint")).alias("spans_true")] if true else []
    return e.select(*extra,
        p.alias(K.COL_PARAGRAPH),
        K.COL_TEXT_ID,
        F.array(start, start + F.length(p).cast("bigint")).alias(K.COL_SPANS),
        F.col("_z.x.c").alias(K.COL_CHAPTER),
        F.col("_z.x.nw").alias(K.COL_WORDS),
        F.col("_z.x.pos").alias("_pos"),
        F.col("_k").cast("bigint").alias("_k"),
        *keep,
    )


def paragraphs(corpus: DataFrame, id_col: str = "id", text_col: str = "text", with_index: bool = True,
               true_spans: bool = False, broadcast_rows: int = ordering.BASE_ROWS) -> DataFrame:
    """Stage 1 output: ``paragraphs, text_ids, spans, chapters,
    paragraphs_index, n_words``.

    ``corpus`` has places (``io.read_corpus`` or ``ordering.in_order``); the
    index numbers paragraphs by (place of the book, position in book), from 0.
    The paragraph rows are written once and the text isn't shuffled.
    ``true_spans`` adds ``spans_true`` (actual position; ``spans`` keeps the
    first-occurrence semantics).
    """
    if not with_index:
        return _paragraph_rows(corpus, id_col, text_col, true_spans)
    return paragraphs_counted(corpus, id_col, text_col, true_spans, broadcast_rows)[0]


def _paragraph_rows(corpus: DataFrame, id_col: str, text_col: str, true_spans: bool) -> DataFrame:
    return explode_paragraphs(
        book_paragraph_arrays(corpus, id_col, text_col, keep=ordering.PLACE, true_spans=true_spans),
        keep=ordering.PLACE).drop("_pos", "_k")


def paragraphs_counted(corpus: DataFrame, id_col: str = "id", text_col: str = "text", true_spans: bool = False,
                       broadcast_rows: int = ordering.BASE_ROWS) -> tuple[DataFrame, int]:
    """:func:`paragraphs` with the index, and their number (the index lies in 0..number-1)."""
    rows, n = ordering.number_counted(_paragraph_rows(corpus, id_col, text_col, true_spans), K.COL_INDEX, broadcast_rows)
    return rows.select(
        K.COL_PARAGRAPH, K.COL_TEXT_ID, K.COL_SPANS, K.COL_CHAPTER, K.COL_INDEX, K.COL_WORDS,
        *(["spans_true"] if true_spans else [])), n


def no_chapterization(corpus: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """Whether a book has no heading at all; one row per book."""
    return corpus.select(_text_id(corpus, id_col).alias(K.COL_TEXT_ID),
                         X.no_chapterization(X.normalize_book(F.col(text_col))).alias("no_chapterization"))


def split_book(corpus: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """Every part of every book: position, stripped text, heading, chapter."""
    b = book_parts(corpus, id_col, text_col)
    z = F.arrays_zip(F.col("_ps").alias("p"), F.col("_hs").alias("h"), F.col("_cs").alias("c"))
    e = b.select(K.COL_TEXT_ID, "_nochap", F.posexplode(z).alias("pos", "_z"))
    return e.select(K.COL_TEXT_ID, F.col("pos").cast("bigint").alias("pos"),
                    F.col("_z.p").alias("paragraph"), F.nullif(F.col("_z.h"), F.lit("")).alias("heading"),
                    F.col("_z.c").alias("chapter"), F.col("_nochap").alias("no_chapterization"))
