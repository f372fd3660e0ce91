"""Incremental stage 1: new corpus files -> paragraph rows, exactly once.

Stage 1 is stateless per book, so it runs unchanged on a file stream: a
stream-static left-semi join with the kept ids, the per-book array pipeline,
and an append-only parquet sink whose checkpoint (in the shared folder)
records which files were processed.

A global position needs every book, so the stream writes each paragraph's
book key (file, row in file) and its ordinal in the book instead;
``index_stream_output`` assigns ``paragraphs_index`` in a batch pass
(distributed prefix sums, as in the batch job).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import catalog, ordering, paragraphs
from ..sources import io


def paragraph_stream(spark: SparkSession, corpus_dir: str, kept_ids: DataFrame | None = None,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of paragraph rows for the books arriving in ``corpus_dir``."""
    r = spark.readStream.schema(io.CORPUS_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    src = r.parquet(corpus_dir).select(
        "*", F.col("_metadata.file_path").alias("corpus_file"),
        F.col("_metadata.row_index").alias("corpus_row"))
    if kept_ids is not None:
        src = catalog.filter_corpus(src, kept_ids)
    books = paragraphs.book_paragraph_arrays(src, keep=("corpus_file", "corpus_row"))
    rows = paragraphs.explode_paragraphs(books, keep=("corpus_file", "corpus_row"))
    return rows.select(K.COL_PARAGRAPH, K.COL_TEXT_ID, K.COL_SPANS, K.COL_CHAPTER, K.COL_WORDS,
                       "corpus_file", "corpus_row", F.col("_k").alias("book_ordinal"))


def start(spark: SparkSession, corpus_dir: str, out_path: str, checkpoint_location: str,
          kept_ids: DataFrame | None = None, available_now: bool = True):
    """Start the stream into a parquet folder; returns the ``StreamingQuery``."""
    w = (paragraph_stream(spark, corpus_dir, kept_ids).writeStream.format("parquet")
         .option("path", out_path).option("checkpointLocation", checkpoint_location)
         .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def index_stream_output(spark: SparkSession, out_path: str) -> DataFrame:
    """Paragraph table with ``paragraphs_index`` from the stream's output."""
    rows = spark.read.parquet(out_path)
    rows = rows.withColumnsRenamed({"corpus_file": "_file", "corpus_row": "_row"})
    # each key is unique; rows are written in their order and numbered as they lie
    out = ordering.positions(rows, ("_file", "_row", "book_ordinal"), K.COL_INDEX)
    return out.select(K.COL_PARAGRAPH, K.COL_TEXT_ID, K.COL_SPANS, K.COL_CHAPTER, K.COL_INDEX, K.COL_WORDS)
