"""Order of rows as files hold them, and positions without a global sort.

A row's place is composite: the file's name, the start of the block of the file
that one task reads, and the row's number in the file.  Numbering needs no data
to move: the task that reads a block counts its rows as they come, one row per
block gives the totals, and the totals before each block are added back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.checkpoint import cut
from . import joins

FILE, BLOCK, ROW = "corpus_file", "corpus_block", "corpus_row"
PLACE = (FILE, BLOCK, ROW)
#: File names keep five digits in order.
MOST_FILES = 99_999
#: A task that writes in order gets about so many bytes, as stored.
RANGE_BYTES = 128 << 20
#: What is added to the rows of a block goes to them as two longs; so many bytes of such rows are broadcast.
BASE_BYTES, BASE_ROW_BYTES = 32 << 20, 16
BASE_ROWS = BASE_BYTES // BASE_ROW_BYTES


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files that the plan of ``df`` reads, from their listing; no job runs."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(n for n in sizes if n < 1 << 60)  # of a leaf that isn't a file nothing is known


def range_count(df: DataFrame, range_bytes: int = RANGE_BYTES) -> int:
    """Ranges that rows are dealt to: the session's shuffle partitions, more if the stored bytes ask for it."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(MOST_FILES, max(least, -(-stored_bytes(df) // range_bytes))))


def dealt_by_position(df: DataFrame, pos: str, rows: int, *then: str, ranges: int | None = None) -> DataFrame:
    """``df`` in the order of ``pos`` (and ``then``) over its partitions and in them.

    Positions lie in 0..rows-1, so the ranges are known: ``df`` runs once, where
    dealing by sampled ranges would run it twice.
    """
    n = ranges or range_count(df)
    part = F.expr(f"cast(greatest(0, least({n - 1}, `{pos}` * {n} DIV {max(rows, 1)})) as int)")
    return df.repartitionById(n, part).sortWithinPartitions(pos, *then)


def with_place(df: DataFrame) -> DataFrame:
    """Add the place of each row; ``df`` is a plain read of parquet files."""
    meta = {FILE: "file_path", BLOCK: "file_block_start", ROW: "row_index"}
    return df.select("*", *[F.col(f"_metadata.{field}").alias(name) for name, field in meta.items()])


def in_order(df: DataFrame, order_cols: tuple[str, ...] | list[str], keep_order: bool = True) -> DataFrame:
    """``df`` written to the shared folder in the order of ``order_cols`` and read back with places.

    The keys are dealt out by ranges, so the rows move once and none waits for
    all others.
    """
    dealt = df.repartitionByRange(range_count(df), *order_cols).sortWithinPartitions(*order_cols)
    if not keep_order:
        dealt = dealt.drop(*order_cols)
    return with_place(cut(dealt))


def check_keys(df: DataFrame, order_cols: tuple[str, ...] | list[str]) -> tuple[int, bool]:
    """Number of rows, and whether a single key is exactly 0..n-1; raises unless keys are unique and not NULL."""
    null = F.lit(False)
    for c in order_cols:
        null = null | F.col(c).isNull()
    ends = [F.min(order_cols[0]).alias("lo"), F.max(order_cols[0]).alias("hi")]
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(null).alias("bad"),
                 F.count_distinct(F.struct(*order_cols)).alias("nd"), *ends).first()
    if row.bad or row.nd != row.n:
        raise ValueError(f"order column {', '.join(order_cols)!r} must be unique and not NULL "
                         f"({row.n} rows, {row.bad} with NULL, {row.nd} distinct)")
    return row.n, len(order_cols) == 1 and (row.n == 0 or (row.lo == 0 and row.hi == row.n - 1))


def place_key(salt: int, *cols: str) -> Column:
    """A long for a file or a block, so that no path goes along with what is added to its rows."""
    return F.xxhash64(F.lit(salt), *cols)


def salt_of(counted: DataFrame, *cols: str) -> int:
    """A salt under which files and ``cols`` of ``counted``, one row for each of them, have keys of their own."""
    for salt in range(8):
        row = counted.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(place_key(salt, *cols)).alias("keys"),
                          F.count_distinct(FILE).alias("files"), F.count_distinct(place_key(salt, FILE)).alias("file_keys")).first()
        if row.n == row["keys"] and row.files == row.file_keys:
            return salt
    raise RuntimeError(f"no keys for {row.n} blocks of {row.files} files")  # blocks given twice, not chance


def block_totals(counted: DataFrame, salt: int, *cols: str) -> DataFrame:
    """(``_key``, other columns of ``counted``, ``_before``: rows in all blocks before), one row per block.

    ``counted`` has FILE, BLOCK and ``_n``; ``_key`` stands for ``cols``.  Blocks
    are summed inside their file, and the file totals over the files: the only
    unpartitioned window has one row per file.
    """
    inside = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.orderBy(FILE).rowsBetween(Window.unboundedPreceding, -1)
    files = counted.groupBy(FILE).agg(F.sum("_n").alias("_all")).select(
        place_key(salt, FILE).alias("_file"), F.coalesce(F.sum("_all").over(ahead), F.lit(0)).alias("_ahead"))
    inner = counted.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0))).select(
        place_key(salt, *cols).alias("_key"), place_key(salt, FILE).alias("_file"), "_inside",
        *[c for c in counted.columns if c not in PLACE])
    return inner.join(files, "_file").withColumn("_before", F.col("_ahead") + F.col("_inside")).drop(
        "_ahead", "_inside", "_file")


def number(df: DataFrame, out_col: str, broadcast_rows: int = BASE_ROWS) -> DataFrame:
    return number_counted(df, out_col, broadcast_rows)[0]


def number_counted(df: DataFrame, out_col: str, broadcast_rows: int = BASE_ROWS) -> tuple[DataFrame, int]:
    """Add ``out_col``: the 0-based position of the row in file order; drops the place.  And the number of rows.

    ``df`` has places; several rows may share one (paragraphs of a book), and
    then count in the order in which the task makes them.  ``df`` is written
    once; the rows don't move where each block's rows stayed in the task that
    read them.  Where a join has dealt them anew, they are put back in order
    first (a join that sorts rows by another key inside their task has to call
    :func:`restored` itself).  What is added to a block's rows reaches them as
    rows of two longs, ``BASE_ROW_BYTES`` bytes, broadcast up to ``broadcast_rows``.
    """
    d = cut(df.withColumn("_run", F.monotonically_increasing_id()))
    blocks = cut(d.groupBy(FILE, BLOCK).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_run").alias("_first"), F.max("_run").alias("_last"),
        F.min_by(ROW, "_run").alias("_low"), F.max_by(ROW, "_run").alias("_high"), F.min(ROW).alias("_least"),
        F.max(ROW).alias("_most")))
    torn = F.expr("_last - _first + 1 != _n or _low != _least or _high != _most")
    row = blocks.agg(F.count(F.lit(1)).alias("blocks"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n"),
                     F.count_if(torn).alias("torn")).first()
    if row.torn:
        # rows of one place were made by one task, so its running id orders them
        return numbered(restored(d, "_run"), out_col, broadcast_rows)
    salt = salt_of(blocks, FILE, BLOCK)
    delta = block_totals(blocks.select(FILE, BLOCK, "_n", "_first"), salt, FILE, BLOCK).select(
        "_key", (F.col("_before") - F.col("_first")).alias("_delta"))
    out = d.withColumn("_key", place_key(salt, FILE, BLOCK)).drop(*PLACE).join(
        joins.maybe_broadcast(delta, broadcast_rows, row.blocks), "_key")
    return out.withColumn(out_col, (F.col("_run") + F.col("_delta")).cast("bigint")).drop("_key", "_run", "_delta"), row.n


def numbered(df: DataFrame, out_col: str, broadcast_rows: int = BASE_ROWS) -> tuple[DataFrame, int]:
    """:func:`number` for a plain read of whole files, and the number of rows.

    The position is the rows before the file and the row's number in it: nothing
    is written and nothing moves.  A frame that lacks rows of its files goes
    through :func:`number`.
    """
    files = df.groupBy(FILE).agg(F.count(F.lit(1)).alias("_n"), (F.max(ROW) + 1).alias("_rows"), F.lit(0).alias(BLOCK))
    row = files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n"),
                    F.count_if(F.col("_n") != F.col("_rows")).alias("torn"),
                    F.count_distinct(place_key(0, FILE)).alias("keys")).first()
    if row.torn:
        return number_counted(df, out_col, broadcast_rows)[0], row.n
    salt = 0 if row["keys"] == row.files else salt_of(files, FILE)
    ahead = block_totals(files.drop("_rows"), salt, FILE).select("_key", "_before")
    out = df.withColumn("_key", place_key(salt, FILE)).drop(FILE, BLOCK).join(
        joins.maybe_broadcast(ahead, broadcast_rows, row.files), "_key")
    return out.withColumn(out_col, (F.col("_before") + F.col(ROW)).cast("bigint")).drop(ROW, "_before", "_key"), row.n


def number_rows(df: DataFrame, out_col: str) -> DataFrame:
    return numbered(df, out_col)[0]


def restored(df: DataFrame, *then: str) -> DataFrame:
    """Rows that a shuffle has dealt anew, written in the order of their places (and ``then``), with new places."""
    old = {c: f"_old_{c}" for c in (*PLACE, *then)}
    return in_order(df.withColumnsRenamed(old), list(old.values()), keep_order=False)


def positions(df: DataFrame, order_cols: tuple[str, ...] | list[str], out_col: str) -> DataFrame:
    """Add ``out_col``: the position of the row in the order of unique keys."""
    check_keys(df, order_cols)
    return number_rows(in_order(df, order_cols), out_col)
