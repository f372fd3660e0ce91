"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text per Arrow batch that a task hands to Python at once.
SLICE_BYTES = 1 << 20
#: Bound on the number of hot keys of a join, and the fewest rows of one.
HOT_KEYS, HOT_LEAST = 50_000, 1000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def byte_slices(batches: Iterator[pa.RecordBatch], column: str,
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``limit`` bytes in each.

    A batch of very long texts then never doubles in Python all at once; a
    single row longer than the limit is a slice of its own.
    """
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


class Remembered(dict):
    """key -> ``make(key)`` for about the last ``most`` keys asked for.

    Two generations: when the young one is half of ``most``, it becomes the old
    one, from which keys that turn up again come back.  Keys longer than
    ``longest`` aren't kept.
    """

    def __init__(self, make, most: int = 1 << 18, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest, self.old = make, most, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            self[key] = value
        return value

    def age(self) -> None:
        """To be called now and then, such as once a text."""
        if len(self) > self.most // 2:
            self.old = dict(self)
            self.clear()


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """Values of a text column; null counts as the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def absent(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores as it takes to be no column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def hot_join(rows: DataFrame, table: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` joined with ``table`` (one row for each key, with the number of its rows in ``size``).

    Keys with more than ``total`` / ``HOT_KEYS`` of the ``total`` rows, fewer than
    ``HOT_KEYS``, meet a broadcast of their table rows, so that no task gets all
    rows of one; the others are dealt by key.
    """
    least = max(HOT_LEAST, total // HOT_KEYS)
    hot = F.broadcast(table.where(F.col(size) > least))
    rest = rows.join(hot.select(key), key, "left_anti").join(table.where(F.col(size) <= least), key)
    return rows.join(hot, key).unionByName(rest)
