"""Samples of labelled texts, bounded in rows, to fit the classifiers on."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves 2 by 4 (a null id counts as "")."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _marked(labels: DataFrame) -> DataFrame:
    """(doc_id, quality) of the rows labelled 0 or 1 that aren't held out."""
    marked = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return marked.select("doc_id", "quality").dropDuplicates(["doc_id"])


def chosen(labels: DataFrame, per_class: int) -> DataFrame:
    """(doc_id, quality, chance) of at most ``per_class`` rows of each quality label (0, 1) that isn't held out."""
    marked = _marked(labels).withColumn("chance", F.xxhash64(F.col("doc_id"), F.lit("sample")))
    ids = [marked.where(F.col("quality") == q).orderBy("chance", "doc_id").limit(per_class) for q in (0, 1)]
    return ids[0].unionByName(ids[1])  # 2 * per_class rows


def weighted(rows: pd.DataFrame, labels: DataFrame) -> pd.DataFrame:
    """``rows`` with a column ``weight`` that gives the classes the shares they have among all labels that aren't held out.

    The bound on rows of a class then doesn't change what a score means; the weights' mean is 1.
    """
    count = {r.quality: r["count"] for r in _marked(labels).groupBy("quality").count().collect()}
    here = rows.quality.value_counts()
    total = sum(count[q] for q in here.index)
    share = {q: count[q] / total * len(rows) / here[q] for q in here.index}
    return rows.assign(weight=rows.quality.map(share).astype(float))


def sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(chance, doc_id, quality, text): the whole texts of at most ``per_class`` ids of each quality label (0, 1).

    Ids are chosen by a hash, none of them held out; of rows with the same id the
    least text counts.  So there are 2 * per_class rows, of any length, which
    stay in the tasks.
    """
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen(labels, per_class)), "doc_id")
    return rows.groupBy("chance", "doc_id", "quality").agg(F.min("text").alias("text"))
