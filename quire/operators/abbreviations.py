"""Abbreviations learned from a corpus: words that are hardly ever there without a period.

The score of a word is Kiss and Strunk's (2006): the log-likelihood ratio of
"nearly always before a period" (0.99) against "as often as any word", weighed
by length, inner periods and the times that the word stands without one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Share of periods after an abbreviation under the hypothesis.
NEARLY_ALWAYS = 0.99
THRESHOLD = 0.3
#: The learned list goes into a pattern, so it has a bound: the best by score, none longer than this.
MOST, LONGEST = 500, 12

TOKEN = r"[\p{L}\p{N}][\p{L}\p{N}.'’-]*"


def _has_letter(token: Column) -> Column:
    return token.rlike(r"\p{L}")


def tokens(text: Column) -> Column:
    """Words with inner and trailing periods; a word has a letter."""
    return F.filter(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), _has_letter)


def _score(n: Column, with_period: Column, share: Column, length: Column, inner: Column) -> Column:
    without = n - with_period
    other = with_period * F.ln(share) + without * F.ln(1 - share)
    always = with_period * F.ln(F.lit(NEARLY_ALWAYS)) + without * F.ln(F.lit(1 - NEARLY_ALWAYS))
    return 2 * (always - other) * F.exp(-length - without * F.ln(length)) * (inner + 1)


def period_statistics(df: DataFrame, text_col: str = "paragraphs") -> DataFrame:
    """(word, n, n_period, score) of every word that stands before a period at least once.

    Words are lower-cased and without trailing periods; counts cover all texts
    and are summed map-side first.  Where all words or none have a period nothing
    can be told, and the score is null.
    """
    # tokens are counted as they stand first, so that patterns read each distinct one only
    found = df.select(F.explode(F.regexp_extract_all(F.col(text_col), F.lit(TOKEN), F.lit(0))).alias("t"))
    each = found.groupBy("t").agg(F.count(F.lit(1)).alias("k")).where(_has_letter(F.col("t"))).select(
        F.lower(F.regexp_replace("t", r"[.'’-]*$", "")).alias("word"), F.col("t").endswith(".").alias("p"), "k")
    words = each.groupBy("word").agg(
        F.sum("k").alias("n"), F.sum(F.when(F.col("p"), F.col("k")).otherwise(0)).alias("n_period"))
    total = words.agg(F.sum("n").alias("_all"), F.sum("n_period").alias("_periods"))  # one row
    share = F.col("_periods") / F.col("_all")
    inner = F.char_length("word") - F.char_length(F.replace("word", F.lit("."), F.lit("")))
    length = (F.char_length("word") - inner).cast("double")
    known = F.when((share > 0) & (share < 1), _score(F.col("n"), F.col("n_period"), share, length, inner))
    return words.where("n_period > 0").join(F.broadcast(total)).select("word", "n", "n_period", known.alias("score"))


def learned(df: DataFrame, text_col: str = "paragraphs", threshold: float = THRESHOLD, most: int = MOST) -> list[str]:
    """The words to hand to ``text.sentences``: at most ``most`` of the best, each of at most ``LONGEST`` code points."""
    good = period_statistics(df, text_col).where((F.col("score") >= threshold) & (F.char_length("word") <= LONGEST))
    return [r.word for r in good.orderBy(F.desc("score"), "word").limit(most).collect()]
