"""Registered queries: one per operator, over the views derived from the tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame whose column names and
types equal the DuckDB oracle's (``oracle.py``).  Spans are returned as
``span_start, span_end`` and arrays as joined strings or exploded rows so the
comparison hashes plain values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as X
from ..operators import abbreviations, aggregate, catalog, chunks, embed, ordering, paragraphs
from ..sources import io
from ..sources.checkpoint import exists, shared_path
from . import bookview, jobs

THRESHOLD = 120        # aggregate threshold (words)
MAX_LEN = 200          # chunk max length (words)
SPLIT_MAX = 60         # split_paragraphs query: max length
PIECE_MAX = 17         # piece_limit query: max length
SLICE = (1000, 3000)   # slice_paragraphs query bounds
HEAD = 2000            # chunks_head query: first paragraphs of the table
CHUNK_SLICE = (500, 1500)  # slice_chunks query bounds
LEARNED = 0.02         # sentences_learned query: least score of an abbreviation
LANGUAGES = ("en",)
CONV_THRESHOLD = 150   # conversation merge threshold (words)
EMBED_DIM = 32         # slots of the hashed vectors in the embedding queries
TINY = {"rows_per_bucket": 7, "per_block": 3}  # forces every edge of the bucketed plan


def _corpus(spark, sf):
    return bookview.corpus(spark, sf)


def _spans(df: DataFrame) -> DataFrame:
    return df.withColumn("span_start", F.get(F.col(K.COL_SPANS), 0)).withColumn(
        "span_end", F.get(F.col(K.COL_SPANS), 1)).drop(K.COL_SPANS)


def scan_corpus(spark: SparkSession, sf: str) -> DataFrame:
    c = _corpus(spark, sf)
    return c.select("id", "text", "source", "added", F.col("metadata.language").alias("language"),
                    F.col("metadata.url").alias("url"),
                    F.char_length("text").cast("bigint").alias("n_chars"))


def extract_metadata(spark, sf):
    return catalog.extract_metadata(_corpus(spark, sf))


def merge_catalog(spark, sf):
    return catalog.merge_catalog(bookview.catalog(spark, sf), extract_metadata(spark, sf))


def read_catalog(spark, sf):
    """S2: the gzip catalog CSV with its schema."""
    return bookview.catalog(spark, sf).withColumnRenamed("Text#", "text_id")


def metadata_csv(spark, sf):
    """S6: metadata written as CSV with an index column in corpus order, and read back."""
    path = shared_path(spark, "metadata")
    rows = catalog.extract_metadata(_corpus(spark, sf).select("id", "metadata", *ordering.PLACE), keep=ordering.PLACE)
    io.write_csv_with_index(rows, path)
    schema = "_c0 bigint, license string, language string, url string, title string, text_id bigint"
    return io.read_csv_with_index(spark, path, schema).withColumnRenamed("_c0", "idx")


def bookshelves(spark, sf):
    c = bookview.catalog(spark, sf)
    s = X.bookshelves(F.col("Bookshelves"))
    return c.select(F.col("Text#").alias("text_id"), "Bookshelves",
                    F.array_join(s, "|").alias("shelves"), F.size(s).cast("bigint").alias("n_shelves")
                    ).where(F.col("Bookshelves").isNotNull())


def genre_exclusive(spark, sf):
    c = bookview.catalog(spark, sf).where(F.col("Bookshelves").isNotNull())
    return c.select(F.col("Text#").alias("text_id"), "Bookshelves",
                    X.genre_exclusive(X.bookshelves(F.col("Bookshelves"))).alias("keep"))


def kept_books(spark, sf):
    return catalog.kept_books(merge_catalog(spark, sf), LANGUAGES)


def filter_corpus(spark, sf):
    kept = kept_books(spark, sf).select("text_id")
    return catalog.filter_corpus(_corpus(spark, sf), kept).select("id", "text")


def filter_corpus_screened(spark, sf):
    """The same with no id broadcast: a Bloom filter screens the corpus where it lies."""
    kept = kept_books(spark, sf).select("text_id")
    return catalog.filter_corpus(_corpus(spark, sf), kept, broadcast_rows=-1).select("id", "text")


def catalog_faults(spark, sf):
    """S2: a gzip catalog with lines too long and with odd ids, each marked."""
    lines = io.read_catalog(spark, bookview.faulty_catalog(spark, sf), malformed="mark")
    return lines.select(F.col("Text#").alias("text_id"), "Title", "Language", "Bookshelves", "malformed")


def normalize_text(spark, sf):
    c = _corpus(spark, sf)
    return c.select(F.col("id").cast("bigint").alias("text_id"), X.normalize_book(F.col("text")).alias("norm"))


def split_book(spark, sf):
    return paragraphs.split_book(_corpus(spark, sf)).select(K.COL_TEXT_ID, "pos", "paragraph")


def headings(spark, sf):
    s = paragraphs.split_book(_corpus(spark, sf))
    return s.where(F.col("heading").isNotNull()).select(K.COL_TEXT_ID, "pos", "heading")


def chapterization_flag(spark, sf):
    return paragraphs.no_chapterization(_corpus(spark, sf))


def chapter_fill(spark, sf):
    return paragraphs.split_book(_corpus(spark, sf)).select(K.COL_TEXT_ID, "pos", "chapter")


def _words(p):
    return paragraphs._spaced_word_count(p)


def inclusion_flags(spark, sf):
    s = paragraphs.split_book(_corpus(spark, sf)).where(F.col("heading").isNull())
    nw = _words(F.col("paragraph"))
    flags = X.inclusion_flags(F.col("paragraph"), nw)
    return s.select(K.COL_TEXT_ID, "pos", nw.alias(K.COL_WORDS),
                    *[c.alias(k) for k, c in flags.items()])


def included_paragraphs(spark, sf):
    s = paragraphs.split_book(_corpus(spark, sf)).where(F.col("heading").isNull())
    return s.where(X.inclusion_condition(F.col("paragraph"), _words(F.col("paragraph")))).select(
        K.COL_TEXT_ID, "pos", "paragraph")


def spans(spark, sf):
    b = paragraphs.book_paragraph_arrays(_corpus(spark, sf))
    e = paragraphs.explode_paragraphs(b)
    return _spans(e.select(K.COL_TEXT_ID, F.col("_pos").alias("pos"), K.COL_SPANS))


def spans_true(spark, sf):
    b = paragraphs.book_paragraph_arrays(_corpus(spark, sf), true_spans=True)
    e = paragraphs.explode_paragraphs(b)
    return e.select(K.COL_TEXT_ID, F.col("_pos").alias("pos"),
                    F.get(F.col("spans_true"), 0).alias("span_start"),
                    F.get(F.col("spans_true"), 1).alias("span_end"))


_TABLES: dict[tuple[str, str], str] = {}


def paragraph_table(spark, sf) -> str:
    """Stage 1 over every book of the view (all languages), written by the writer once a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TABLES or not exists(spark, _TABLES[key]):
        path = shared_path(spark, "paragraphs") + ".parquet"
        out, n = paragraphs.paragraphs_counted(_corpus(spark, sf))
        io.write_parquet(out, path, order_cols=(K.COL_INDEX,), rows=n)
        _TABLES[key] = path
    return _TABLES[key]


def paragraphs_indexed_df(spark, sf):
    """The paragraph table as the reader gives it, without places."""
    return io.read_paragraphs(spark, paragraph_table(spark, sf)).drop(*ordering.PLACE)


def paragraphs_indexed(spark, sf):
    """S3, S4: stage 1 with the index, through the writer and the reader."""
    return _spans(paragraphs_indexed_df(spark, sf))


def paragraphs_job(spark, sf):
    """Job 1 end to end: catalog join, kept books, semi-join, stage 1."""
    _, out = jobs.books_to_paragraphs_df(_corpus(spark, sf), bookview.catalog(spark, sf), LANGUAGES)
    return _spans(out)


def slice_paragraphs(spark, sf):
    return _spans(jobs.slice_paragraphs(paragraphs_indexed_df(spark, sf), *SLICE))


def segments(spark, sf):
    p = paragraphs_indexed_df(spark, sf)
    narrow = p.select(K.COL_INDEX, K.COL_TEXT_ID, F.col(K.COL_INDEX).alias("_idx"), K.COL_CHAPTER)
    d = aggregate.segment_starts(narrow, K.COL_INDEX)
    return d.select(K.COL_INDEX, K.COL_TEXT_ID, K.COL_CHAPTER, F.col("_new").alias("new_segment"))


def aggregates(spark, sf):
    p = paragraphs_indexed_df(spark, sf)
    return _spans(aggregate.aggregate_paragraphs(p, THRESHOLD))


def aggregates_tiny_buckets(spark, sf):
    """The same with buckets of 7 rows in blocks of 3, so that groups reach over many edges."""
    p = paragraphs_indexed_df(spark, sf)
    return _spans(aggregate.aggregate_paragraphs(p, THRESHOLD, **TINY))


def conversation_rows(spark, sf):
    """Conversations as paragraph rows: a conversation is the book, the turn
    the paragraph index, no chapter; the order keys are conv_id and turn."""
    c = spark.read.parquet(f"{sf}/conversations.parquet")
    return c.select(
        F.col("text").alias(K.COL_PARAGRAPH), F.col("conv_id").alias(K.COL_TEXT_ID),
        F.array(F.col("turn"), F.col("turn") + 1).alias(K.COL_SPANS),
        F.lit(None).cast("string").alias(K.COL_CHAPTER),
        F.col("turn").alias(K.COL_INDEX), X.word_count(F.col("text")).alias(K.COL_WORDS), "conv_id", "turn")


def conversation_aggregates(spark, sf):
    """Segment + greedy merge on a second table (two order keys, not dense)."""
    return _conversations(spark, sf)


def conversation_aggregates_tiny_buckets(spark, sf):
    return _conversations(spark, sf, **TINY)


def _conversations(spark, sf, **buckets):
    rows = conversation_rows(spark, sf)
    out = aggregate.aggregate_paragraphs(rows, CONV_THRESHOLD, order_col=("conv_id", "turn"), **buckets)
    return _spans(out.withColumn("turn", F.col("agg_order.turn")).drop("agg_order"))


def sentences(spark, sf):
    p = paragraphs_indexed_df(spark, sf)
    e = p.select(K.COL_INDEX, F.posexplode(X.sentences(F.col(K.COL_PARAGRAPH))).alias("pos", "sentence"))
    return e.select(K.COL_INDEX, F.col("pos").cast("bigint").alias("pos"), "sentence",
                    X.word_count(F.col("sentence")).alias(K.COL_WORDS))


def piece_limit(spark, sf):
    p = paragraphs_indexed_df(spark, sf).where(F.col(K.COL_WORDS) > 0)
    return p.select(K.COL_INDEX, K.COL_WORDS, X.piece_limit(F.col(K.COL_WORDS), PIECE_MAX).alias("piece_limit"))


def abbreviation_scores(spark, sf):
    """X9: how much each word of the paragraphs looks like an abbreviation."""
    found = abbreviations.period_statistics(paragraphs_indexed_df(spark, sf), K.COL_PARAGRAPH)
    return found.withColumn("score", F.round("score", 6) + F.lit(0.0))  # no negative zeros


def sentences_learned(spark, sf):
    """X9: sentences that don't end after the abbreviations learned from the same paragraphs."""
    p = paragraphs_indexed_df(spark, sf)
    words = abbreviations.learned(p, K.COL_PARAGRAPH, LEARNED)
    e = p.select(K.COL_INDEX, F.posexplode(X.sentences(F.col(K.COL_PARAGRAPH), words)).alias("pos", "sentence"))
    return e.select(K.COL_INDEX, F.col("pos").cast("bigint").alias("pos"), "sentence")


def piece_limit_unrounded(spark, sf):
    """X8b: the notebook's limit, without rounding down."""
    p = paragraphs_indexed_df(spark, sf).where(F.col(K.COL_WORDS) > 0)
    return p.select(K.COL_INDEX, K.COL_WORDS, X.piece_limit(F.col(K.COL_WORDS), PIECE_MAX, False).alias("piece_limit"))


def split_paragraphs(spark, sf):
    p = paragraphs_indexed_df(spark, sf).where(F.col(K.COL_WORDS) > 0)
    lim = X.piece_limit(F.col(K.COL_WORDS), SPLIT_MAX)
    e = p.select(K.COL_INDEX, F.posexplode(chunks.split_paragraph(F.col(K.COL_PARAGRAPH), lim))
                 .alias("piece", "text"))
    return e.select(K.COL_INDEX, F.col("piece").cast("bigint").alias("piece"), "text",
                    X.word_count(F.col("text")).alias(K.COL_WORDS))


def chunks_q(spark, sf):
    """Job 2 over the written paragraph table."""
    table = io.read_paragraphs(spark, paragraph_table(spark, sf))
    return _chunks(jobs.paragraphs_to_chunks_df(table, MAX_LEN, THRESHOLD))


def _chunks(out):
    return _spans(out.withColumn("piece", F.col("piece").cast("bigint")))


def chunks_two_tables(spark, sf):
    """Job 2 over two stage-1 outputs, each with an index from 0; English books first."""
    c, base = _corpus(spark, sf), shared_path(spark, "two")
    english = F.col("metadata.language") == "en"
    paths = [f"{base}/a.parquet", f"{base}/b.parquet"]
    for path, part in zip(paths, (c.where(english), c.where(~english)), strict=True):
        out, n = paragraphs.paragraphs_counted(part)
        io.write_parquet(out, path, order_cols=(K.COL_INDEX,), rows=n)
    return _chunks(jobs.paragraphs_to_chunks_df(io.read_paragraphs(spark, *paths), MAX_LEN, THRESHOLD))


def chunks_no_index(spark, sf):
    """Job 2 over a paragraph table without an index column."""
    table = io.read_paragraphs(spark, paragraph_table(spark, sf)).drop(K.COL_INDEX)
    return _chunks(jobs.paragraphs_to_chunks_df(table, MAX_LEN, THRESHOLD))


def chunks_head(spark, sf):
    """job 2 over the first paragraphs of the table only, as its caller asks."""
    table = io.read_paragraphs(spark, paragraph_table(spark, sf))
    return _chunks(jobs.paragraphs_to_chunks_df(table, MAX_LEN, THRESHOLD, max_paragraphs=HEAD))


def chunk_files(spark, sf) -> str:
    """Job 2 over the written paragraph table, written with its order columns once a session."""
    key = (spark.sparkContext.applicationId, f"{sf} chunks")
    if key not in _TABLES or not exists(spark, _TABLES[key]):
        table, path = io.read_paragraphs(spark, paragraph_table(spark, sf)), shared_path(spark, "chunks")
        jobs.write_chunks(table, path, MAX_LEN, THRESHOLD, keep_order=True)
        _TABLES[key] = path
    return _TABLES[key]


def chunk_table(spark, sf):
    """S5: the chunk table, written in chunk order and read back with its row numbers."""
    rows = ordering.number_rows(io.read_paragraphs(spark, chunk_files(spark, sf)), "chunk_row")
    return _spans(rows.select(*jobs.CHUNK_COLUMNS, "chunk_row"))


def slice_chunks(spark, sf):
    """a slice of the chunk table by position; the table has no index column."""
    return _spans(io.read_slice(spark, chunk_files(spark, sf), *CHUNK_SLICE).select(*jobs.CHUNK_COLUMNS))


def unit_embeddings(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    u = embed.unit_embeddings(e, "embedding", "unit")
    x = u.select("vec_id", "label", F.posexplode("unit").alias("dim", "x"))
    return x.select("vec_id", "label", F.col("dim").cast("bigint").alias("dim"),
                    F.col("x").cast("float").alias("x"))


def _values(df, *keys):
    """The dimensions of each vector that aren't zero."""
    e = df.select(*keys, F.posexplode("embedding").alias("dim", "value")).where("value != 0")
    return e.select(*keys, F.col("dim").cast("bigint").alias("dim"), F.col("value").cast("float").alias("value"))


def embed_chunks(spark, sf):
    """The chunk table as job 2 wrote it, embedded."""
    c = spark.read.parquet(chunk_files(spark, sf)).withColumn("piece", F.col("piece").cast("bigint"))
    return _values(embed.embed_hashing(c, K.COL_PARAGRAPH, dim=EMBED_DIM), "agg_order", "piece")


def embed_paragraphs(spark, sf):
    """Job 3 on all rows."""
    return _values(jobs.embed_slice(paragraphs_indexed_df(spark, sf), dim=EMBED_DIM), K.COL_INDEX)


def embed_paragraph_slice(spark, sf):
    """Job 3 on a slice that the caller gives."""
    return _values(jobs.embed_slice(paragraphs_indexed_df(spark, sf), *SLICE, dim=EMBED_DIM), K.COL_INDEX)


def _hash_encoder():
    """A batch encoder with the slots of ``embed_hashing``, in Python."""
    import hashlib

    from functools import lru_cache

    import numpy as np
    import regex

    find = regex.compile(r"[\p{L}\p{N}]+").findall

    @lru_cache(1 << 16)
    def slot(token):
        return int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % EMBED_DIM

    def encode(texts):
        out = np.zeros((len(texts), EMBED_DIM))
        for i, text in enumerate(texts):
            out[i] = np.bincount(np.fromiter(map(slot, find(text.lower())), np.int64), minlength=EMBED_DIM)
        return out

    return encode


def embed_encoder(spark, sf):
    """Job 3 with a user's batch encoder."""
    return _values(jobs.embed_slice(paragraphs_indexed_df(spark, sf), make_encoder=_hash_encoder, batch_size=500),
                   K.COL_INDEX)


QUERIES = {
    "scan_corpus": scan_corpus,
    "extract_metadata": extract_metadata,
    "merge_catalog": merge_catalog,
    "read_catalog": read_catalog,
    "metadata_csv": metadata_csv,
    "bookshelves": bookshelves,
    "genre_exclusive": genre_exclusive,
    "kept_books": kept_books,
    "filter_corpus": filter_corpus,
    "filter_corpus_screened": filter_corpus_screened,
    "catalog_faults": catalog_faults,
    "normalize_text": normalize_text,
    "split_book": split_book,
    "headings": headings,
    "chapterization_flag": chapterization_flag,
    "chapter_fill": chapter_fill,
    "inclusion_flags": inclusion_flags,
    "included_paragraphs": included_paragraphs,
    "spans": spans,
    "spans_true": spans_true,
    "paragraphs": paragraphs_job,
    "paragraphs_indexed": paragraphs_indexed,
    "slice_paragraphs": slice_paragraphs,
    "segments": segments,
    "aggregates": aggregates,
    "aggregates_tiny_buckets": aggregates_tiny_buckets,
    "conversation_aggregates": conversation_aggregates,
    "conversation_aggregates_tiny_buckets": conversation_aggregates_tiny_buckets,
    "sentences": sentences,
    "piece_limit": piece_limit,
    "piece_limit_unrounded": piece_limit_unrounded,
    "abbreviation_scores": abbreviation_scores,
    "sentences_learned": sentences_learned,
    "split_paragraphs": split_paragraphs,
    "chunks": chunks_q,
    "chunks_head": chunks_head,
    "chunks_two_tables": chunks_two_tables,
    "chunks_no_index": chunks_no_index,
    "chunk_table": chunk_table,
    "slice_chunks": slice_chunks,
    "unit_embeddings": unit_embeddings,
    "embed_chunks": embed_chunks,
    "embed_paragraphs": embed_paragraphs,
    "embed_paragraph_slice": embed_paragraph_slice,
    "embed_encoder": embed_encoder,
}
