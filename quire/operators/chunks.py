"""Stage 2b: cut over-long aggregates at sentence ends into chunks.

An aggregate of ``n`` words with ``n >= max`` is cut: the word limit per piece
is ``floor(max / ceil(n / max))``; sentences are packed greedily, a new piece
starting when adding a sentence would pass the limit (the first sentence of a
piece is always taken whole).  Pieces are re-joined with single spaces.  Rows
with ``n < max`` pass through unchanged.

Everything is per row (no shuffle).  Sentences and their word counts are JVM
expressions; only the per-sentence word counts go to a small Arrow UDF for the
packing scan, which is linear where an array fold would be quadratic.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions import text as X


def pack_starts_list(ks, limit):
    """Start index of each piece (shared with the UDF): a piece takes its first
    sentence whole and then as many as its words allow, found by binary search."""
    sums = np.cumsum(np.array(ks, float))
    starts, at = [0], 0
    while at < len(sums):
        before = sums[at - 1] if at else 0.0
        at = max(at + 1, int(np.searchsorted(sums, before + limit, side="right")))
        if at < len(sums):
            starts.append(at)
    return starts


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def pack_starts(ks: pa.Array, limit: pa.Array) -> pa.Array:
    """Greedy packing of sentence word counts under a limit -> piece starts."""
    out = [None if k is None or m is None else pack_starts_list(k, m)
           for k, m in zip(ks.to_pylist(), limit.to_pylist())]
    return pa.array(out, type=pa.list_(pa.int32()))


def _pieces(sents: Column, starts: Column) -> Column:
    """Sentences joined into pieces; ``sents`` is made once, not once a piece, as it is a lambda's own element."""

    def joined(own: Column) -> Column:
        starts, sents = own["starts"], own["sents"]
        ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), F.array(F.size(sents)))
        z = F.arrays_zip(starts.alias("s"), ends.alias("e"))
        return F.transform(z, lambda x: F.array_join(F.slice(sents, x["s"] + 1, x["e"] - x["s"]), K.SENTENCE_JOIN))

    return X.once(F.struct(sents.alias("sents"), starts.alias("starts")), joined)


def _words(s: Column) -> Column:
    """Words of a sentence or a piece; the separator of an aggregate becomes a space, which leaves their number."""
    return X.trimmed_word_count(F.replace(s, F.lit(K.AGGREGATE_JOIN), F.lit(" ")))


def split_paragraph(p: Column, limit: Column, abbreviations: Iterable[str] = ()) -> Column:
    """Paragraph -> array of pieces under ``limit`` words (sentence packing)."""
    sents = X.sentences(p, abbreviations)
    ks = F.transform(sents, _words)
    return _pieces(sents, pack_starts(ks, limit.cast("double")))


def break_paragraphs(aggregates: DataFrame, max_p_length: int,
                     keep: tuple[str, ...] = ("agg_order",), floor_limit: bool = True,
                     abbreviations: Iterable[str] = (), counted: bool = False) -> DataFrame:
    """Chunks: ``paragraphs, n_words, text_ids, spans, chapters,
    splitted_paragraphs`` (+ ``keep`` columns and ``piece`` for the order).

    ``floor_limit=False`` uses the unrounded piece limit (same pieces); no
    sentence ends after ``abbreviations``; ``counted`` says that ``n_words`` holds
    the words of the text as they are, so that they needn't be counted."""
    if max_p_length <= 0:
        raise ValueError("max_p_length must be positive")
    keep = tuple(c for c in keep if c in aggregates.columns)
    p = F.col(K.COL_PARAGRAPH)
    d = aggregates.withColumn("_nw", F.col(K.COL_WORDS) if counted else X.word_count(p))
    cut = F.col("_nw") >= max_p_length
    d = d.withColumn("_cut", cut)
    # sentences only for rows that are cut; others send an empty array
    sents = F.when(F.col("_cut"), X.sentences(p, abbreviations)).otherwise(F.array().cast("array<string>"))
    d = d.withColumn("_sents", sents)
    ks = F.transform("_sents", _words)
    limit = F.when(F.col("_cut"), X.piece_limit(F.col("_nw"), max_p_length, floor_limit)).otherwise(F.lit(0))
    d = d.withColumn("_starts", pack_starts(ks, limit.cast("double")))
    pieces = F.when(F.col("_cut"), _pieces(F.col("_sents"), F.col("_starts"))).otherwise(F.array(p))
    e = d.select(K.COL_TEXT_ID, K.COL_SPANS, K.COL_CHAPTER, "_nw", "_cut", *keep,
                 F.posexplode(pieces).alias("piece", "_piece"))
    return e.select(
        F.col("_piece").alias(K.COL_PARAGRAPH),
        F.when(F.col("_cut"), _words(F.col("_piece"))).otherwise(F.col("_nw")).alias(K.COL_WORDS),
        K.COL_TEXT_ID, K.COL_SPANS, K.COL_CHAPTER,
        F.col("_cut").alias(K.COL_SPLIT),
        *keep, F.col("piece").cast("int").alias("piece"))
