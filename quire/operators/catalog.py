"""Catalog side: corpus metadata, catalog join, kept books, corpus filter."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import text as X
from ..sources.checkpoint import cut
from . import bloom, joins, ordering

#: So many ids that a Bloom filter lets pass by mistake are broadcast (8 bytes each).
FALSE_IDS = 2_000_000


def integer_id(id_col: str = "id") -> Column:
    """The id as an integer; null if it is none."""
    return F.expr(f"try_cast(trim(`{id_col}`) AS BIGINT)")


def extract_metadata(corpus: DataFrame, id_col: str = "id", metadata_col: str = "metadata",
                     keep: tuple[str, ...] = (), counts: Observation | None = None) -> DataFrame:
    """Metadata struct fields as columns plus integer ``text_id`` (+ ``keep``).

    Only the struct and the id are read: the text column is pruned at the scan.
    Rows whose id is no integer stay, with a null ``text_id`` that meets no
    catalog row; ``counts`` observes their number (``junk_ids``) and that of all
    rows (``books``) in the pass that reads them.
    """
    if counts is not None:
        junk = F.col(id_col).isNotNull() & integer_id(id_col).isNull()
        corpus = corpus.select(id_col, metadata_col, *keep).observe(
            counts, F.count(F.lit(1)).alias("books"), F.count_if(junk).alias("junk_ids"))
    return corpus.select(f"{metadata_col}.*", integer_id(id_col).alias("text_id"), *keep)


def merge_catalog(catalog: DataFrame, metadata: DataFrame) -> DataFrame:
    """Inner join catalog ``Text#`` = metadata ``text_id``; keep
    ``Language, text_id, Bookshelves``.

    Both sides are book-level tables.  Only the key and the three kept
    columns are read.  The join is left to adaptive execution, which broadcasts
    a side that turns out small and splits a hot id.  The sides are aliased
    because ``Language`` (catalog) and ``language`` (metadata) differ only by case.
    """
    c = catalog.select(F.col("`Text#`").alias("_key"), "Language", "Bookshelves")
    m = metadata.select("text_id")
    j = c.alias("c").join(m.alias("m"), F.col("c._key") == F.col("m.text_id"), "inner")
    return j.select(F.col("c.Language").alias("Language"), F.col("m.text_id").alias("text_id"),
                    F.col("c.Bookshelves").alias("Bookshelves"))


def kept_books(merged: DataFrame, languages: Iterable[str] = ("en",)) -> DataFrame:
    """Rows in the given languages, with shelves, all shelves in the genres.

    Output keeps the input's columns (the parsed shelves are not added).
    """
    langs = list(languages)
    return merged.where(
        F.col("Language").isin(langs)
        & F.col("Bookshelves").isNotNull()
        & X.genre_exclusive(X.bookshelves(F.col("Bookshelves"))))


def filter_corpus(corpus: DataFrame, ids: DataFrame | Iterable[int], id_col: str = "id",
                  ids_col: str = "text_id", broadcast_rows: int = joins.DEFAULT_BROADCAST_ROWS,
                  false_ids: int = FALSE_IDS) -> DataFrame:
    """Corpus rows whose integer id is in ``ids`` (left-semi join).

    The ids are de-duplicated and broadcast when their counted size allows.
    Beyond that a Bloom filter of them goes to the corpus, whose text stays where
    it is: first the ids alone are screened, and the few that pass by mistake
    (found by a join of narrow keys) are broadcast; then the rows are screened
    and those taken out.  Only where the filter or the mistakes are too many to
    broadcast is it a shuffle semi-join, after which rows with places are written
    in their order again.
    """
    spark = corpus.sparkSession
    if not isinstance(ids, DataFrame):
        ids = spark.createDataFrame([(int(v),) for v in ids], f"{ids_col} bigint")
    keys = ids.select(F.col(ids_col).cast("bigint").alias("_kid")).distinct()
    if corpus.isStreaming:
        return corpus.join(joins.maybe_broadcast(keys, broadcast_rows), integer_id(id_col) == F.col("_kid"), "left_semi")
    keys = cut(keys.where("_kid is not null"))
    n = keys.count()
    if n <= broadcast_rows:
        return corpus.join(F.broadcast(keys), integer_id(id_col) == F.col("_kid"), "left_semi")
    out = _screened(corpus, keys, n, id_col, false_ids)
    if out is None:
        out = corpus.join(keys, integer_id(id_col) == F.col("_kid"), "left_semi")
        if all(c in corpus.columns for c in ordering.PLACE):
            out = ordering.restored(out)
    return out


def _screened(corpus: DataFrame, keys: DataFrame, n: int, id_col: str, false_ids: int) -> DataFrame | None:
    """Corpus rows with an id among ``keys``, by a Bloom filter; None if too much would have to be broadcast."""
    blocks = bloom.block_count(n)
    if blocks > bloom.MOST_BLOCKS:
        return None
    table = cut(bloom.build(keys, "_kid", blocks))
    marked = corpus.withColumn("_cid", integer_id(id_col))
    passed = bloom.passing(marked.select("_cid"), "_cid", table, blocks).distinct()
    wrong = cut(passed.join(keys, F.col("_cid") == F.col("_kid"), "left_anti").select(F.col("_cid").alias("_wid")))
    if wrong.count() > false_ids:
        return None
    rows = bloom.passing(marked, "_cid", table, blocks)
    return rows.join(F.broadcast(wrong), F.col("_cid") == F.col("_wid"), "left_anti").drop("_cid")
