"""Sources and sinks: corpus, catalog CSV, paragraph / chunk parquet, CSV."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import ordering

METADATA_TYPE = T.StructType([
    T.StructField("license", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
])

CORPUS_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("added", T.StringType()),
    T.StructField("metadata", METADATA_TYPE),
])

CATALOG_SCHEMA = T.StructType([
    T.StructField("Text#", T.LongType()),
    T.StructField("Type", T.StringType()),
    T.StructField("Issued", T.StringType()),
    T.StructField("Title", T.StringType()),
    T.StructField("Language", T.StringType()),
    T.StructField("Authors", T.StringType()),
    T.StructField("Subjects", T.StringType()),
    T.StructField("LoCC", T.StringType()),
    T.StructField("Bookshelves", T.StringType()),
])

PARAGRAPH_SCHEMA = T.StructType([
    T.StructField("paragraphs", T.StringType()),
    T.StructField("text_ids", T.LongType()),
    T.StructField("spans", T.ArrayType(T.LongType())),
    T.StructField("chapters", T.StringType()),
    T.StructField("paragraphs_index", T.LongType()),
    T.StructField("n_words", T.LongType()),
])


def read_corpus(spark: SparkSession, path: str, schema: T.StructType | None = CORPUS_SCHEMA,
                with_order: bool = True) -> DataFrame:
    """Batch-read the corpus parquet (one row per book).

    With ``with_order`` each row has its place (file name, block, row in file),
    the dataset order: files in name order, rows in file order.
    """
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    return ordering.with_place(df) if with_order else df


def read_catalog(spark: SparkSession, path: str, partitions: int | None = None, malformed: str = "null",
                 counts: Observation | None = None) -> DataFrame:
    """Catalog CSV (gzip or plain) with its explicit schema (no inference).

    A line with more fields than the schema (``long``) or with a ``Text#`` that
    is no integer (``id``) is malformed; fields that a line's end lacks are nulls
    and no fault, nor are further empty ones.  ``malformed`` says what becomes of it: with ``"null"`` further
    fields are dropped and the id is null, ``"raise"`` fails the job that reads a
    long line (an odd id stays null), ``"mark"`` adds the column ``malformed``
    with ``long``, ``id`` or null.  ``counts`` observes the number of ``lines``,
    ``long_lines`` and ``odd_ids`` in the same pass.

    A gzip file is one split, so the result is repartitioned for the joins.
    """
    if malformed not in ("null", "raise", "mark"):
        raise ValueError(f"not a way to treat malformed lines: {malformed!r}")
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in [*CATALOG_SCHEMA, T.StructField("_more", T.StringType())]])
    df = (spark.read.schema(raw)
          .option("header", True).option("multiLine", True)
          .option("quote", '"').option("escape", '"')
          .csv(path))
    number = F.expr("try_cast(`Text#` as bigint)")
    long, odd = F.col("_more").isNotNull(), F.col("Text#").isNotNull() & number.isNull()
    if counts is not None:
        df = df.observe(counts, F.count(F.lit(1)).alias("lines"), F.count_if(long).alias("long_lines"),
                        F.count_if(odd).alias("odd_ids"))
    key = number
    if malformed == "raise":
        key = F.when(long, F.raise_error(F.concat(F.lit("catalog line with too many fields: "), F.coalesce(
            "Text#", F.lit("no id")))).cast("bigint")).otherwise(number)
    extra = [F.when(long, "long").when(odd, "id").alias("malformed")] if malformed == "mark" else []
    df = df.select(key.alias("Text#"), *[F.col(f.name) for f in CATALOG_SCHEMA[1:]], *extra)
    if partitions:
        df = df.repartition(partitions)
    return df


def read_paragraphs(spark: SparkSession, *paths: str) -> DataFrame:
    """Paragraph tables with the place of each row; an index column may be missing."""
    return ordering.with_place(spark.read.parquet(*paths))


def read_slice(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """Rows ``start <= position < stop`` of a table without an index, positions in file order.

    The rows of each file are counted from the footers, no column is read; then
    only the files that hold a part of the slice are read, and of them only
    these rows come out.  At most the files of the slice are named to the driver.
    """
    table = ordering.with_place(spark.read.parquet(path))
    files = table.groupBy(ordering.FILE).agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.orderBy(ordering.FILE).rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    placed = files.select(ordering.FILE, "_n", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    held = placed.where((F.col("_before") < stop) & (F.col("_before") + F.col("_n") > start)).collect()
    columns = [c for c in table.columns if c not in ordering.PLACE]
    if not held:
        return table.select(*columns).limit(0)
    first, last = (f(held, key=lambda r: r._before) for f in (min, max))
    row, file = F.col(ordering.ROW), F.col(ordering.FILE)
    inside = ((file != first[ordering.FILE]) | (row >= start - first._before)) & (
        (file != last[ordering.FILE]) | (row < stop - last._before))
    # names come encoded as in a URI
    read = spark.read.schema(table.select(*columns).schema).parquet(*[unquote(r[ordering.FILE]) for r in held])
    return ordering.with_place(read).where(inside).select(*columns)


def replace_table(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write(aside)`` make a table beside ``path``, then swap it in.

    A job that fails leaves the old table as it was, and what it wrote is
    deleted.  The swap is two renames: on stores without an atomic rename a reader
    may find no table between them.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    fs = target.getFileSystem(conf)
    tag = uuid.uuid4().hex
    aside, old = (jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{kind}-{tag}") for kind in ("new", "old"))
    try:
        write(aside.toString())
        if fs.exists(target) and not fs.rename(target, old):
            raise OSError(f"{path} can't be moved")
        if not fs.rename(aside, target):
            if fs.exists(old):
                fs.rename(old, target)
            raise OSError(f"{path} can't be replaced")
        fs.delete(old, True)
    finally:
        fs.delete(aside, True)


def write_parquet(df: DataFrame, path: str, require_suffix: bool = True, order_cols: tuple[str, ...] = (),
                  rows: int | None = None) -> None:
    """Replace ``path`` by ``df``; the paragraph output must end in .parquet.

    With ``order_cols`` rows lie in their order, in files and over the files'
    names, which is the order that the next stage reads.  ``rows`` says that the
    first of them holds positions in 0..rows-1; ranges are sampled otherwise.
    """
    if require_suffix and not path.endswith(".parquet"):
        raise ValueError("Output file must be in parquet format.")
    if order_cols and rows is not None:
        df = ordering.dealt_by_position(df, order_cols[0], rows, *order_cols[1:])
    elif order_cols:
        df = df.repartitionByRange(ordering.range_count(df), *order_cols).sortWithinPartitions(*order_cols)
    replace_table(df.sparkSession, path, lambda aside: df.write.parquet(aside))


def write_csv_with_index(df: DataFrame, path: str) -> None:
    """CSV with header and an unnamed leading row-index column.

    Rows with places are indexed in file order; others 0..n-1 in the order in
    which their tasks make them.
    """
    from .checkpoint import cut

    if ordering.FILE not in df.columns:
        df = ordering.with_place(cut(df))
    cols = [c for c in df.columns if c not in ordering.PLACE]
    d = ordering.number_rows(df, "_idx")
    out = d.select(F.col("_idx").alias(""), *cols)
    replace_table(df.sparkSession, path, lambda aside: out.write.option("header", True).csv(aside))


def read_csv_with_index(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema else r.option("inferSchema", True)
    return r.csv(path)
