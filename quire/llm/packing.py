"""Packing of token sequences by bounded-space online best fit."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.checkpoint import cut
from .common import text_or_empty
from .hftokens import encoded

#: Bins that a task holds open; also the pieces that it orders by length at once.
OPEN_BINS = 8192
#: About so many pieces go to a task.
TASK_PIECES = 1 << 17

_PIECES = "doc_id {}, piece int, start long, length long, ids_crc32 long"


class BestFit:
    """A fixed number of open bins, found by a bitset keyed by free space.

    ``place`` puts a piece into the open bin with the least free space that
    holds it, else into a new one; beyond ``open_bins`` the fullest closes.
    """

    def __init__(self, capacity: int, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = self.open = self.made = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        out = bins.pop()
        self.open -= 1
        if not bins:
            self.bits &= ~(1 << free)
        return out

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset in it)."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bin_ = self._take(free)
        else:
            free, bin_ = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free[left].append(bin_)
            self.bits |= 1 << left
            self.open += 1
            if self.open > self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)
        return bin_, self.capacity - free


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Pieces of a document of ``n`` ids: all full but the first."""
    first = n % capacity
    return ([first] if first else []) + [capacity] * (n // capacity)


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32), the end id included."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids in encoded(batches, path, end_id):
            of, piece, start, length, crc = [], [], [], [], []
            for i, own in enumerate(ids):
                at = 0
                for k, n in enumerate(cut_lengths(len(own) // 4, capacity)):
                    of.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(own[4 * at:4 * (at + n)]))
                    at += n
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(run, _PIECES.format(id_type))


def _packed(capacity: int, open_bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, task = BestFit(capacity, open_bins), TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks().sort_by([("length", "descending")])
            places = [fit.place(n) for n in table.column("length").to_pylist()]
            held.clear()
            bins, offsets = zip(*places, strict=True)
            return table.append_column("task", pa.array([task] * len(bins), pa.int32())).append_column(
                "bin", pa.array(bins, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

        for batch in batches:
            while batch.num_rows:
                room = open_bins - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in held) == open_bins:
                    yield from flush().to_batches()
        if held:
            yield from flush().to_batches()

    return run


def pack(docs: DataFrame, path: str, end_id: int, capacity: int = 1024, open_bins: int = OPEN_BINS,
         task_pieces: int = TASK_PIECES) -> DataFrame:
    """Every piece with its place: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    Narrow piece rows are dealt evenly over tasks of about ``task_pieces``; each
    task orders blocks of them by falling length and feeds the blocks to one
    ``BestFit``.  Sequences of a task are numbered from the total of the tasks
    before it.

    A null text counts as empty (its end id alone is packed); repeated rows are
    packed one by one; a null doc_id stays null; an empty table gives no rows;
    other columns are ignored.  The two lineage cuts lie in spark.checkpoint.dir.
    """
    made = cut(pieces(docs, path, end_id, capacity))
    tasks = max(1, -(-made.count() // task_pieces))
    schema = f"{_PIECES.format(made.schema['doc_id'].dataType.simpleString())}, task int, bin long, offset long"
    packed = cut(made.repartition(tasks).mapInArrow(_packed(capacity, open_bins), schema))
    # one row a task: the window runs over a row for each task_pieces pieces
    before = packed.groupBy("task").agg((F.max("bin") + 1).alias("n")).select(
        "task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("before"))
    return packed.join(before, "task").select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("before") + F.col("bin")).alias("sequence_id"), "offset")
