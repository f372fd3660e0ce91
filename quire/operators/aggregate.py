"""Stage 2a: merge consecutive paragraphs into aggregates of >= T words.

Order is data: rows are scanned in position order (0-based, dense).  A new
segment starts where the book id changes (from a non-NULL one), the paragraph
index is not the previous one + 1, or the chapter changes (NULL-safe).  Inside
a segment paragraphs are merged greedily until the words reach the threshold.

One plan for all sizes:

* a bucket is ``position DIV rows_per_bucket``, so it holds a bounded number of
  rows whatever the segment lengths;
* the narrow columns (position, ids, chapter, words) are dealt by bucket, the
  last row of each bucket going to the next one too, as its row before;
* ``greedy`` gives the group starts of each bucket as narrow mark rows, its
  summaries being folded as a tree over blocks of buckets;
* marks and text rows are united and dealt by bucket: the text's one shuffle.
  A running value over the marks gives each row its group, and the aggregation
  inside a bucket needs no further shuffle.  Only the rows of the groups that
  may reach over a bucket's edge (two a bucket at most) meet once more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions import text as X
from ..sources.checkpoint import cut
from . import greedy, ordering

#: Rows of a bucket, and buckets of a block of the fold.
ROWS_PER_BUCKET = 1 << 13
BUCKETS_PER_BLOCK = 1 << 10
#: Rows that a task of the text shuffle holds at most, in whole buckets.
ROWS_PER_TASK = 16 * ROWS_PER_BUCKET
#: Rows and buckets of which a narrow task gets as many at least, if the session's shuffle partitions are not used up:
#: their bytes are few, their time in Python is not, so sizes must not decide how many tasks share them.
LEAST_ROWS, LEAST_BUCKETS = ROWS_PER_BUCKET, 1 << 9

SUMMARY_SCHEMA = T.StructType([
    T.StructField("bucket", T.LongType()),
    T.StructField("fixed", T.BooleanType()),
    T.StructField("first_r", T.LongType()),
    T.StructField("total", T.LongType()),
    T.StructField("fixed_open", T.BooleanType()),
    T.StructField("fixed_acc", T.LongType()),
    T.StructField("fixed_g", T.LongType()),
    T.StructField("cand_s", T.ArrayType(T.LongType())),
    T.StructField("cand_open", T.ArrayType(T.BooleanType())),
    T.StructField("cand_acc", T.ArrayType(T.LongType())),
    T.StructField("cand_g", T.ArrayType(T.LongType())),
])
#: A bucket's rows: its summary, and for each row whether it opens a segment, and its words.
BUCKET_SCHEMA = T.StructType([*SUMMARY_SCHEMA, T.StructField("news", T.ArrayType(T.BooleanType())),
                              T.StructField("words", T.ArrayType(T.LongType()))])
_LONGS, _FLAGS = pa.list_(pa.int64()), pa.list_(pa.bool_())
SUMMARY_TYPES = {
    "bucket": pa.int64(), "fixed": pa.bool_(), "first_r": pa.int64(), "total": pa.int64(), "fixed_open": pa.bool_(),
    "fixed_acc": pa.int64(), "fixed_g": pa.int64(), "cand_s": _LONGS, "cand_open": _FLAGS, "cand_acc": _LONGS, "cand_g": _LONGS}
BUCKET_TYPES = SUMMARY_TYPES | {"news": _FLAGS, "words": _LONGS}
CARRY_SCHEMA = "bucket long, c_open boolean, c_acc long, c_g long"
#: gid: the group that goes on from ``at`` on; more: it may reach into the next bucket.
MARK_SCHEMA = "_b long, at long, gid long, more boolean"


def _narrow_tasks(df: DataFrame, buckets: int, rows: int = 0) -> int:
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(width, buckets, max(-(-buckets // LEAST_BUCKETS), -(-rows // LEAST_ROWS))))


def _dealt(df: DataFrame, tasks: int, key: str) -> DataFrame:
    """``df`` dealt by ``key``; the session chooses the partitions where one task would do."""
    return df.repartition(tasks, key) if tasks > 1 else df.repartition(key)


def segment_starts(df: DataFrame, pos: str, rows_per_bucket: int = ROWS_PER_BUCKET, text_col: str = K.COL_TEXT_ID,
                   index_col: str = "_idx", chapter_col: str = K.COL_CHAPTER, tasks: int | None = None) -> DataFrame:
    """Add ``_b`` (bucket) and ``_new``: the row opens a new segment.

    ``pos`` is dense.  The last row of a bucket is dealt to the next one as well,
    where it only serves as the row before.  ``tasks`` share the buckets, as many
    as the session chooses if not given.
    """
    bucket = F.expr(f"`{pos}` DIV {rows_per_bucket}")
    both = F.when((F.col(pos) + 1) % rows_per_bucket == 0, F.array(bucket, bucket + 1)).otherwise(F.array(bucket))
    d = df.withColumn("_b", F.explode(both))
    if tasks and tasks > 1:
        d = d.repartition(tasks, "_b")
    w = Window.partitionBy("_b").orderBy(pos)
    pt, pi, pc = (F.lag(c).over(w) for c in (text_col, index_col, chapter_col))
    new = ((F.col(pos) == 0)
           | (pt.isNotNull() & ~pt.eqNullSafe(F.col(text_col)))
           | F.coalesce(pi.isNotNull() & (F.col(index_col) - 1 != pi), F.lit(False))
           | ~pc.eqNullSafe(F.col(chapter_col)))
    return d.withColumn("_new", new).where(F.col("_b") == bucket)


def _whole(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Sorted rows cut so that all rows of a value of ``key`` lie in one table."""
    held, before = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.column(key).to_numpy()
        edges = np.flatnonzero(at[1:] != at[:-1]) + 1
        if before is not None and at[0] != before:
            edges = np.concatenate([[0], edges])
        before = at[-1]
        if len(edges):
            last = int(edges[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks()
            held = []
            batch = batch.slice(last)
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _runs(at: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each stretch of equal values."""
    edges = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)]
    return list(zip(edges, edges[1:]))


def carried(summaries: DataFrame, threshold: int, per_block: int = BUCKETS_PER_BLOCK,
            buckets: int | None = None) -> DataFrame:
    """Incoming state of each bucket (``CARRY_SCHEMA``) by a fold over a tree.

    Buckets are composed in blocks of ``per_block``.  Up to ``BUCKETS_PER_BLOCK``
    blocks are scanned in order, one row each; more are folded as buckets in
    their turn.  Then each block's buckets go on from its state.  ``buckets`` is
    the number of ``summaries``, counted if not given.  Many blocks are handled
    by one call of Python.
    """
    buckets = summaries.count() if buckets is None else buckets
    d = summaries.withColumn("block", F.expr(f"bucket DIV {per_block}"))

    def compose(batches):
        for table in _whole(batches, "block"):
            rows = table.to_pylist()
            found = [{"bucket": rows[a]["block"], **greedy.compose(rows[a:b], threshold)}
                     for a, b in _runs(table.column("block").to_numpy())]
            yield from pa.Table.from_pylist(found, pa.schema(SUMMARY_TYPES)).to_batches()

    def over_blocks(batches):
        state = greedy.FRESH
        for pdf in batches:
            rows = pdf.to_dict("records")
            found, state = greedy.carries(rows, threshold, state)
            yield pd.DataFrame([(r["bucket"], *s) for r, s in zip(rows, found, strict=True)],
                               columns=["bucket", "c_open", "c_acc", "c_g"])

    def inside(batches):
        for table in _whole(batches, "block"):
            rows, found = table.to_pylist(), []
            for a, b in _runs(table.column("block").to_numpy()):
                first = rows[a]["state"]
                found += greedy.carries(rows[a:b], threshold, (first["c_open"], first["c_acc"], first["c_g"]))[0]
            columns = ([r["bucket"] for r in rows], *zip(*found, strict=True))
            types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                             ["bucket", "c_open", "c_acc", "c_g"])

    n = -(-buckets // per_block)
    tasks = min(n, _narrow_tasks(d, buckets))
    blocks = _dealt(d, tasks, "block").sortWithinPartitions("block", "bucket").mapInArrow(compose, SUMMARY_SCHEMA)
    if n <= BUCKETS_PER_BLOCK:
        states = blocks.repartition(1).sortWithinPartitions("bucket").mapInPandas(over_blocks, CARRY_SCHEMA)
    else:
        states = carried(cut(blocks), threshold, BUCKETS_PER_BLOCK, n)
    states = states.select(F.col("bucket").alias("block"), F.struct("c_open", "c_acc", "c_g").alias("state"))
    return _dealt(d.join(states, "block"), tasks, "block").sortWithinPartitions("block", "bucket").mapInArrow(
        inside, CARRY_SCHEMA)


def start_marks(df: DataFrame, threshold_min: int, pos: str, rows_per_bucket: int = ROWS_PER_BUCKET,
                per_block: int = BUCKETS_PER_BLOCK, n_rows: int | None = None) -> DataFrame:
    """Mark rows (``MARK_SCHEMA``): the group carried into a bucket, and each group start in it.

    Runs on the narrow columns only (position, id, index, chapter, words).
    ``n_rows``, if known, says how many tasks share the buckets.
    """
    limit = int(threshold_min)
    narrow = df.select(F.col(pos).alias("_pos"), K.COL_TEXT_ID, F.col(K.COL_INDEX).alias("_idx"), K.COL_CHAPTER,
                       F.coalesce(F.col(K.COL_WORDS), F.lit(0)).cast("bigint").alias("_n"))
    buckets = None if n_rows is None else max(1, -(-n_rows // rows_per_bucket))
    tasks = None if n_rows is None else _narrow_tasks(df, buckets, n_rows)
    d = segment_starts(narrow, "_pos", rows_per_bucket, tasks=tasks).select("_b", "_pos", "_new", "_n")

    def summarise(batches):
        for table in _whole(batches, "_b"):
            at, pos, new, n = (table.column(c).to_numpy() for c in ("_b", "_pos", "_new", "_n"))
            found = [{"bucket": int(at[a]), **greedy.summarise(new[a:b], n[a:b], pos[a:b], limit), "news": new[a:b],
                      "words": n[a:b]} for a, b in _runs(at)]
            yield from pa.Table.from_pylist(found, pa.schema(BUCKET_TYPES)).to_batches()

    def marks(batches):
        for batch in batches:
            b, at, gid, more = [], [], [], []
            for c in batch.to_pylist():
                r = c["first_r"] + np.arange(len(c["words"]))  # positions are dense
                state = (c["c_open"], c["c_acc"], c["c_g"])
                found, after = greedy.starts(c["news"], c["words"], r, limit, state)
                found = r[found].tolist()
                groups = found
                if state[0] and not c["news"][0]:  # goes on until the first start
                    found, groups = [int(r[0]), *found], [state[2], *found]
                b += [c["bucket"]] * len(found)
                at += found
                gid += groups
                more += [after[0] and g == after[2] for g in groups]
            yield pa.RecordBatch.from_arrays(
                [pa.array(b, pa.int64()), pa.array(at, pa.int64()), pa.array(gid, pa.int64()), pa.array(more, pa.bool_())],
                ["_b", "at", "gid", "more"])

    # the window has dealt the rows by bucket
    rows = cut(d.sortWithinPartitions("_b", "_pos").mapInArrow(summarise, BUCKET_SCHEMA))
    carry = carried(rows.select(*SUMMARY_SCHEMA.names), limit, per_block)
    rows = rows.select("bucket", "first_r", "news", "words")
    if tasks and tasks > 1:
        rows = rows.repartition(tasks, "bucket")
    return rows.join(carry, "bucket").mapInArrow(marks, MARK_SCHEMA)


def _joined(texts: Column) -> Column:
    """Texts in order with the separator between; leading empty ones are skipped."""

    def joined(x: Column) -> Column:
        return F.when(x["first"] == 0, F.lit("")).otherwise(
            F.array_join(F.slice(x["texts"], x["first"], F.size(x["texts"]) - x["first"] + 1), K.AGGREGATE_JOIN))

    def placed(texts: Column) -> Column:
        first = F.array_position(F.transform(texts, lambda x: x != ""), True).cast("int")
        return X.once(F.struct(texts.alias("texts"), first.alias("first")), joined)

    return X.once(texts, placed)


def _merged(rows: DataFrame, *keys: str) -> DataFrame:
    """One row for each group of ``rows`` (already in the same task if dealt by one of the keys)."""
    return rows.groupBy(*keys).agg(
        F.collect_list(F.struct(F.col("at").alias("o"), F.col(K.COL_PARAGRAPH).alias("p"))).alias("_items"),
        F.sum(K.COL_WORDS).cast("bigint").alias("_n"),
        F.max(F.coalesce(F.col(K.COL_PARAGRAPH) != "", F.lit(False))).alias("_some"),
        F.max_by(K.COL_TEXT_ID, "at").alias("_t"),
        F.max_by(K.COL_CHAPTER, "at").alias("_c"),
        F.min_by(F.get(F.col(K.COL_SPANS), 0), "at").alias("_s0"),
        F.max_by(F.get(F.col(K.COL_SPANS), 1), "at").alias("_s1"),
        F.min(F.struct("at", "_order")).alias("_lo"))


def aggregate_paragraphs(df: DataFrame, threshold_min: int, order_col: str | tuple[str, ...] = K.COL_INDEX,
                         rows_per_bucket: int = ROWS_PER_BUCKET, per_block: int = BUCKETS_PER_BLOCK,
                         n_rows: int | None = None) -> DataFrame:
    """Aggregates: ``paragraphs, chapters, n_words, text_ids, spans`` plus
    ``agg_order`` (order key of the first paragraph, to keep the order).

    ``order_col`` is one dense position column, or one or several columns whose
    values are unique (several give a struct ``agg_order``); rows with keys that
    aren't dense are first written in their order.  ``n_rows`` says that the
    positions are known to be 0..n_rows-1, as numbering gives them.  Text is joined with
    ``"\\n\\n"`` in order (leading empty texts are skipped, and a group of empty
    texts below the threshold is not emitted); words are summed; the span runs
    from the first paragraph's start to the last one's stop; id and chapter are
    the last paragraph's.
    """
    cols = [order_col] if isinstance(order_col, str) else list(order_col)
    order = F.col(cols[0]) if len(cols) == 1 else F.struct(*cols)
    pos = cols[0]
    if n_rows is None:
        n_rows, dense = ordering.check_keys(df, cols)
        if not dense:
            pos = "_position"
            df = ordering.number_rows(ordering.in_order(df, cols), pos)
    marks = cut(start_marks(df, threshold_min, pos, rows_per_bucket, per_block, n_rows))

    text = df.select(F.expr(f"`{pos}` DIV {rows_per_bucket}").alias("_b"), F.col(pos).alias("at"), order.alias("_order"),
                     K.COL_PARAGRAPH, K.COL_TEXT_ID, K.COL_CHAPTER, K.COL_SPANS, K.COL_WORDS)
    rows = marks.unionByName(text, allowMissingColumns=True)
    buckets = max(1, -(-n_rows // rows_per_bucket))
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(buckets, max(width, -(-n_rows // max(rows_per_bucket, ROWS_PER_TASK))))
    # the one shuffle of the text; a mark comes before the row that it is for
    dealt = rows.repartition(tasks, "_b")
    w = Window.partitionBy("_b").orderBy("at", F.col("gid").isNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    last = F.last(F.when(F.col("gid").isNotNull(), F.struct("gid", "more")), ignorenulls=True).over(w)
    own = dealt.withColumn("_g", last).where(F.col("gid").isNull()).select(
        "_b", "at", "_order", F.col("_g.gid").alias("_gid"), F.col("_g.more").alias("_more"),
        K.COL_PARAGRAPH, K.COL_TEXT_ID, K.COL_CHAPTER, K.COL_SPANS, K.COL_WORDS)
    # a null-safe test infers no filter of one branch on the bucket, so both read the same shuffle
    over = F.col("_more") | ~F.expr(f"_gid DIV {rows_per_bucket}").eqNullSafe(F.col("_b"))
    whole = _merged(own.where(~over), "_b", "_gid").drop("_b")
    a = whole.unionByName(_merged(own.where(over), "_gid"))
    # before the text is joined: a filter on it would join it twice
    a = a.where(F.col("_some") | (F.col("_n") >= threshold_min))
    texts = F.transform(F.sort_array("_items"), lambda x: x["p"])
    return a.select(_joined(texts).alias(K.COL_PARAGRAPH), F.col("_c").alias(K.COL_CHAPTER),
                    F.col("_n").alias(K.COL_WORDS), F.col("_t").alias(K.COL_TEXT_ID),
                    F.array("_s0", "_s1").alias(K.COL_SPANS), F.col("_lo._order").alias("agg_order"))


def reindexed(df: DataFrame, order_cols: str | tuple[str, ...] | None = None) -> tuple[DataFrame, int]:
    """Stage 2's first step: ``paragraphs_index`` = position, ``n_words`` recounted; and the number of rows.

    A table read by ``io.read_paragraphs`` has places and is numbered in file
    order, whatever its incoming index says.  A frame without places is numbered
    in the order of ``order_cols``, by default the incoming index; keys that
    repeat or are NULL raise, as they leave the order open.
    """
    words = X.word_count(F.col(K.COL_PARAGRAPH))
    if order_cols is None and all(c in df.columns for c in ordering.PLACE):
        out, n = ordering.numbered(df.withColumn(K.COL_WORDS, words).drop(K.COL_INDEX), K.COL_INDEX)
    else:
        cols = [order_cols or K.COL_INDEX] if order_cols is None or isinstance(order_cols, str) else list(order_cols)
        n, dense = ordering.check_keys(df, cols)
        if cols == [K.COL_INDEX] and dense:
            return df.withColumn(K.COL_WORDS, words), n
        out = ordering.number_rows(ordering.in_order(df, cols), "_position").withColumn(K.COL_WORDS, words)
        out = out.drop(K.COL_INDEX).withColumnRenamed("_position", K.COL_INDEX)
    names = [c for c in df.columns if c not in ordering.PLACE]
    return out.select(*dict.fromkeys([*names, K.COL_INDEX, K.COL_WORDS])), n


def reindex(df: DataFrame, order_cols: str | tuple[str, ...] | None = None) -> DataFrame:
    return reindexed(df, order_cols)[0]
