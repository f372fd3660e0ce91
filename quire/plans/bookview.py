"""Books, corpus and catalog views derived from the driver's ``documents``.

``documents`` holds single-newline prose without headings or notes, so the
views add them deterministically:

* a book is one language within a block of ``BOOK_BLOCK`` consecutive doc ids
  (``text_id = block * 10 + language code``).  Groups are bounded by the block
  size, so the grouping has no hot key however large the table grows;
* every fourth document of a book opens a chapter; lines become paragraphs;
* some documents get a footnote, an illustration, a dialogue line, a line with
  CR/LF and a no-break space, or a scene break.  Which ones is decided by the
  doc id modulo small primes: this injects noise, it does not select rows.

The DuckDB oracle builds the same views (``oracle.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import io
from ..sources.checkpoint import exists, shared_path

BOOK_BLOCK = 32
LANG_CODES = (("en", 0), ("fr", 1), ("de", 2))  # anything else -> 3
SHELVES = (
    "Category: Novels; Category: British Literature",
    "Children & Young Adult Reading",
    "Science-Fiction & Fantasy",
    "Category: Poetry",
    None,
    "History - Early Modern (c. 1450-1750)",
)
NL2 = "\n\n"
FOOTNOTE = "[Footnote 1: see the other book on this page of ours.]"
ILLUSTRATION = "[Illustration: a view of the old harbour at dawn today.]"
DIALOGUE = '"Stop there," cried the man.'
CRLF_LINE = "It was a \r\nquiet\xa0 night in town."
SCENE_BREAK = "* * * * *"
ROMAN = "IVXLC"


def _lang_code(lang: Column) -> Column:
    out = F.lit(3)
    for name, code in reversed(LANG_CODES):
        out = F.when(lang == name, F.lit(code)).otherwise(out)
    return out


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``text_id BIGINT, book STRING``: one row per book."""
    d = documents(spark, sf_dir).select("doc_id", "lang", "text")
    d = d.withColumn("text_id", (F.floor(F.col("doc_id") / BOOK_BLOCK) * 10
                                 + _lang_code(F.col("lang"))).cast("bigint"))
    g = d.groupBy("text_id").agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "text"))).alias("_d"))

    def part(x: Column, i: Column) -> Column:
        rn = i + 1
        doc = x["doc_id"]

        def extra(mod: int, s: str) -> Column:
            return F.when(doc % mod == 0, F.lit(NL2 + s)).otherwise(F.lit(""))

        chapter = F.when(
            rn % 4 == 1,
            F.concat(F.lit("CHAPTER "),
                     F.substring(F.lit(ROMAN), (F.floor(rn / 4) % 5 + 1).cast("int"), 1),
                     F.lit(NL2))).otherwise(F.lit(""))
        return F.concat(chapter, F.replace(x["text"], F.lit("\n"), F.lit(NL2)),
                        extra(7, FOOTNOTE), extra(11, ILLUSTRATION), extra(5, DIALOGUE),
                        extra(3, CRLF_LINE), extra(17, SCENE_BREAK))

    return g.select("text_id", F.array_join(F.transform("_d", part), NL2).alias("book"))


def derived_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus-shaped rows ``id, text, source, added, metadata`` with their order ``text_id``."""
    b = books(spark, sf_dir)
    lang = F.element_at(F.array(*[F.lit(n) for n, _ in LANG_CODES], F.lit("es")),
                        (F.col("text_id") % 10 + 1).cast("int"))
    return b.select(
        F.col("text_id").cast("string").alias("id"),
        F.col("book").alias("text"),
        F.lit("documents").alias("source"),
        F.lit("2024-01-01").alias("added"),
        F.struct(F.lit(None).cast("string").alias("license"), lang.alias("language"),
                 F.concat(F.lit("books/"), F.col("text_id").cast("string")).alias("url"),
                 F.lit(None).cast("string").alias("title")).alias("metadata"),
        "text_id",
    )


def derived_catalog(ids: DataFrame) -> DataFrame:
    """Catalog-shaped rows, one per book of ``ids`` (``text_id``)."""
    lang = F.element_at(F.array(*[F.lit(n) for n, _ in LANG_CODES], F.lit("es")),
                        (F.col("text_id") % 10 + 1).cast("int"))
    shelf = F.lit(None).cast("string")
    blk = (F.floor(F.col("text_id") / 10) % len(SHELVES)).cast("int")
    for i, s in reversed(list(enumerate(SHELVES))):
        shelf = F.when(blk == i, F.lit(s).cast("string")).otherwise(shelf)
    return ids.select(
        F.col("text_id").alias("Text#"),
        F.lit("Text").alias("Type"),
        F.lit("2024-01-01").alias("Issued"),
        F.concat(F.lit("Book "), F.col("text_id").cast("string")).alias("Title"),
        lang.alias("Language"),
        F.lit("Anonymous").alias("Authors"),
        F.lit("Fiction").alias("Subjects"),
        F.lit("PZ").alias("LoCC"),
        shelf.alias("Bookshelves"),
    )


_FILES: dict[tuple[str, str], str] = {}


def files(spark: SparkSession, sf_dir: str) -> str:
    """Folder with ``corpus.parquet`` and ``catalog.csv`` (gzip), derived from the tables once a session.

    It lies in the session's shared folder and goes when the process ends.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FILES or not exists(spark, f"{_FILES[key]}/catalog.csv"):
        base = shared_path(spark, "books")
        rows = derived_corpus(spark, sf_dir)
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows.repartitionByRange(n, "text_id").sortWithinPartitions("text_id").drop("text_id").write.parquet(
            f"{base}/corpus.parquet")
        ids = spark.read.parquet(f"{base}/corpus.parquet").select(F.col("id").cast("bigint").alias("text_id"))
        derived_catalog(ids).write.option("header", True).option("compression", "gzip").csv(f"{base}/catalog.csv")
        _FILES[key] = base
    return _FILES[key]


def faulty_catalog(spark: SparkSession, sf_dir: str) -> str:
    """The derived catalog (gzip) with faults: German books have a field too many, French ones an odd id."""
    lines = derived_catalog(corpus(spark, sf_dir).select(F.col("id").cast("bigint").alias("text_id")))
    key = F.when(F.col("Language") == "fr", F.concat(F.lit("no. "), F.col("`Text#`").cast("string"))).otherwise(
        F.col("`Text#`").cast("string"))
    more = F.when(F.col("Language") == "de", F.lit("one, too many"))
    path = shared_path(spark, "faulty")
    lines.withColumn("Text#", key).withColumn("More", more).write.option("header", True).option(
        "compression", "gzip").csv(path)
    return path


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived corpus as the reader gives it, with places."""
    return io.read_corpus(spark, f"{files(spark, sf_dir)}/corpus.parquet")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived catalog as the reader gives it."""
    return io.read_catalog(spark, f"{files(spark, sf_dir)}/catalog.csv")
