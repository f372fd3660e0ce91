"""User entry points: books -> paragraphs, paragraphs -> chunks, slice -> embed."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import aggregate, catalog, chunks, embed, ordering, paragraphs
from ..sources import io
from ..sources.checkpoint import scratch


def books_to_paragraphs_df(corpus: DataFrame, catalog_df: DataFrame,
                           languages: Iterable[str] = ("en",)) -> tuple[DataFrame, DataFrame]:
    """Stage 1 as DataFrames: ``(metadata, paragraphs)``; ``corpus`` has places."""
    meta = catalog.extract_metadata(corpus)
    return meta, paragraphs.paragraphs(_kept(corpus, catalog_df, meta, languages))


def _kept(corpus: DataFrame, catalog_df: DataFrame, meta: DataFrame, languages: Iterable[str]) -> DataFrame:
    kept = catalog.kept_books(catalog.merge_catalog(catalog_df, meta), languages)
    return catalog.filter_corpus(corpus, kept.select("text_id"))


def books_to_paragraphs(spark: SparkSession, corpus_path: str, catalog_path: str,
                        output_file: str, metadata_csv: str | None = None,
                        languages: Iterable[str] = ("en",), malformed: str = "raise") -> dict[str, int]:
    """Job 1: corpus + catalog -> paragraph parquet (and metadata CSV).

    Returns what the same passes counted: ``books`` and ``junk_ids`` of the
    corpus, ``lines``, ``long_lines`` and ``odd_ids`` of the catalog, and
    ``paragraphs``.  A catalog line with too many fields fails the job before
    anything is written, unless ``malformed`` is ``"null"``.
    """
    if not output_file.endswith(".parquet"):
        raise ValueError("Output file must be in parquet format.")
    corpus = io.read_corpus(spark, corpus_path)
    books, lines = Observation(), Observation()
    cat = io.read_catalog(spark, catalog_path, spark.sparkContext.defaultParallelism, malformed, lines)
    with scratch(spark):
        meta = catalog.extract_metadata(corpus, counts=books)
        out, n = paragraphs.paragraphs_counted(_kept(corpus, cat, meta, languages))
        if metadata_csv:
            # all corpus rows (before any filter), indexed in corpus order
            rows = catalog.extract_metadata(corpus.select("id", "metadata", *ordering.PLACE), keep=ordering.PLACE)
            io.write_csv_with_index(rows, metadata_csv)
        io.write_parquet(out, output_file, order_cols=(K.COL_INDEX,), rows=n)
    return {**books.get, **lines.get, "paragraphs": n}


def paragraphs_to_chunks_df(paras: DataFrame, max_p_length: int, threshold_min: int,
                            max_paragraphs: int | None = None,
                            order_cols: str | tuple[str, ...] | None = None) -> DataFrame:
    """Stage 2 as a DataFrame.

    Rows are numbered by position (file order, or ``order_cols``; see
    ``aggregate.reindex``) and word counts recounted before merging.
    ``max_paragraphs`` keeps only the first rows, if the caller wants that.
    """
    return _chunks_counted(paras, max_p_length, threshold_min, max_paragraphs, order_cols)[0]


def _chunks_counted(paras: DataFrame, max_p_length: int, threshold_min: int, max_paragraphs: int | None = None,
                    order_cols: str | tuple[str, ...] | None = None,
                    abbreviations: Iterable[str] = ()) -> tuple[DataFrame, int]:
    """Stage 2 and the number of its paragraphs; ``agg_order`` lies below it."""
    p, n = aggregate.reindexed(paras, order_cols)
    if max_paragraphs is not None:
        p, n = p.where(F.col(K.COL_INDEX) < F.lit(max_paragraphs)), min(n, max_paragraphs)
    agg = aggregate.aggregate_paragraphs(p, threshold_min, n_rows=n)
    # an aggregate's words are the sum of its paragraphs' recounted ones
    return chunks.break_paragraphs(agg, max_p_length, abbreviations=abbreviations, counted=True), n


CHUNK_COLUMNS = (K.COL_PARAGRAPH, K.COL_WORDS, K.COL_TEXT_ID, K.COL_SPANS, K.COL_CHAPTER, K.COL_SPLIT)


def paragraphs_to_chunks(spark: SparkSession, hf_dataset: str | list[str], hf_output: str,
                         max_p_length: int, threshold_min: int,
                         max_paragraphs: int | None = None, keep_order: bool = False,
                         abbreviations: Iterable[str] = ()) -> None:
    """Job 2: paragraph parquet (one table or several) -> chunk parquet.

    The chunk table has six columns and its files are in chunk order;
    ``keep_order`` adds ``agg_order`` and ``piece``.  No sentence ends after
    ``abbreviations`` (``operators.abbreviations.learned`` finds them).
    """
    paths = [hf_dataset] if isinstance(hf_dataset, str) else list(hf_dataset)
    with scratch(spark):
        write_chunks(io.read_paragraphs(spark, *paths), hf_output, max_p_length, threshold_min, max_paragraphs, keep_order,
                     abbreviations)


def write_chunks(paras: DataFrame, path: str, max_p_length: int, threshold_min: int,
                 max_paragraphs: int | None = None, keep_order: bool = False,
                 abbreviations: Iterable[str] = ()) -> None:
    """Stage 2, written in chunk order.

    A chunk's order is a position among the paragraphs, whose number is known,
    so ranges are too: the plan runs once, straight into the files.
    """
    ranges = ordering.range_count(paras)
    out, n = _chunks_counted(paras, max_p_length, threshold_min, max_paragraphs, None, abbreviations)
    dealt = ordering.dealt_by_position(out, "agg_order", n, "piece", ranges=ranges)
    extra = ("agg_order", "piece") if keep_order else ()
    io.write_parquet(dealt.select(*CHUNK_COLUMNS, *extra), path, require_suffix=False)


def slice_paragraphs(paras: DataFrame, start: int, stop: int) -> DataFrame:
    """Rows ``start <= paragraphs_index < stop`` (the notebook's slice)."""
    return paras.where((F.col(K.COL_INDEX) >= start) & (F.col(K.COL_INDEX) < stop))


def embed_slice(paras: DataFrame, start: int | None = None, stop: int | None = None,
                make_encoder: Callable | None = None, batch_size: int = 2000, dim: int = 256,
                profile: ResourceProfile | None = None) -> DataFrame:
    """Job 3: embed with unit-length vectors; all rows unless a slice is given.

    ``profile`` places the tasks of a user's encoder (``embed.device_profile``).
    """
    if start is not None:
        paras = paras.where(F.col(K.COL_INDEX) >= start)
    if stop is not None:
        paras = paras.where(F.col(K.COL_INDEX) < stop)
    if make_encoder is None:
        return embed.embed_hashing(paras, K.COL_PARAGRAPH, dim)
    return embed.embed_with(paras, make_encoder, K.COL_PARAGRAPH, batch_size, profile=profile)
