"""Packing of documents that lie side by side on a space-filling curve."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.checkpoint import cut
from .common import byte_slices, strings, text_or_empty
from .wordtokens import encoder

#: Slots of a document's hashed vector, and the dimensions that it is projected to.
SLOTS, DIMS = 1024, 4
#: Bits of the curve's key in each dimension.
BITS = 15
SEED = 7
#: Projections are whole numbers, so that sums over the corpus don't depend on their order.
UNIT = 1 << 20
#: About so many bytes of ids lie in one range of the curve.
RANGE_BYTES = 32 << 20
#: One row for each range is broadcast, and one for each cell: the leading bits of the key.
MOST_RANGES = 50_000
CELL_BITS = 18


@lru_cache(maxsize=2)
def _tables(vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot of each id, sign of each id, directions of the projection)."""
    ids = np.arange(vocabulary, dtype=np.uint64) + np.uint64(1)
    h = ids * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    slot, sign = (h >> np.uint64(33)) % np.uint64(SLOTS), np.where(h >> np.uint64(63), 1.0, -1.0)
    return slot.astype(np.int64), sign, np.random.default_rng(SEED).standard_normal((SLOTS, DIMS))


def projected(ids: np.ndarray, vocabulary: int) -> np.ndarray:
    """A text's ids as a hashed vector of unit length, projected; whole numbers in units of 1 / ``UNIT``.

    Each slot holds the signed count of its ids, damped by a root.
    """
    slot, sign, directions = _tables(vocabulary)
    n = np.bincount(slot[ids], sign[ids], SLOTS)
    n = np.sign(n) * np.sqrt(np.abs(n))
    length = np.sqrt(n @ n)
    return np.rint((n / length if length else n) @ directions * UNIT).astype(np.int64)


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers 0..2**bits-1 (bits * dimensions below 64).

    From the highest bit down, each cube's coordinates are turned so that the
    curve through it starts and ends at its neighbours'; what is left is a Gray
    code over the dimensions.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for d in range(dims):
            high = (x[d] >> bit & 1).astype(bool)
            swapped = np.where(high, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(high, low, swapped)
            if d:
                x[d] ^= swapped
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            key = key << 1 | x[d] >> bit & 1
    return key


def curve_key(points: np.ndarray, mean: list[float], spread: list[float]) -> np.ndarray:
    """Keys of projections; a coordinate's cell follows its rank among normal values of that mean and spread."""
    z = (points - np.array(mean)) / np.maximum(np.array(spread), 1.0)
    share = 1 / (1 + np.exp(-1.702 * np.clip(z, -30, 30)))
    return hilbert(np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))


def token_rows(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, ids, n, point) of every document, the end id included; ``point`` without it."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        kind = "<u2" if own.kind == "H" else "<u4"
        end = np.array([end_id], kind).tobytes()
        for batch in byte_slices(batches, "text"):
            ids = [own.encode(x) for x in strings(batch, "text")]
            points = [projected(np.frombuffer(i, kind), own.vocabulary) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([i + end for i in ids], pa.binary()),
                 pa.array([len(i) // int(kind[2]) + 1 for i in ids], pa.int64()),
                 pa.array([p.tolist() for p in points], pa.list_(pa.int64()))], ["doc_id", "ids", "n", "point"])

    return rows.mapInArrow(run, f"doc_id {id_type}, ids binary, n long, point array<long>")


def _ranges(rows: DataFrame, range_bytes: int) -> DataFrame:
    """(cell, first, parts): the ranges of each cell of the curve, one row a cell.

    Cells are as many leading bits of the key as ``CELL_BITS``; their bytes are
    summed along the curve and cut every ``range_bytes``.  A cell beyond that,
    such as one of many copies, has several ranges.
    """
    cells = rows.groupBy("cell").agg(F.sum(F.octet_length("ids")).alias("size"))
    # at most 2 ** CELL_BITS rows
    before = F.sum("size").over(Window.orderBy("cell")) - F.col("size")
    return cells.select("cell", F.floor(before / range_bytes).cast("int").alias("first"),
                        F.ceil(F.col("size") / range_bytes).cast("int").alias("parts"))


def along_curve(rows: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows of :func:`token_rows` dealt by ranges of the curve and written in its order.

    Adds ``range`` (number of the range) and ``at`` (ids before the row in its
    range).  Ranges hold about the same number of bytes, however long the
    documents of a region are; the documents of a cell that needs several are
    dealt to these by a hash of their row.
    """
    dec = "decimal(38,0)"
    point = [F.col("point")[d] for d in range(DIMS)]
    row = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("ids")).alias("size"),
                   F.array(*[F.sum(p.cast(dec)) for p in point]).alias("sums"),
                   F.array(*[F.sum((p * p).cast(dec)) for p in point]).alias("squares")).first()
    n = max(row.rows, 1)
    mean = [float(s or 0) / n for s in row.sums]
    spread = [max(float(q or 0) / n - m * m, 0.0) ** 0.5 for q, m in zip(row.squares, mean, strict=True)]

    @F.arrow_udf("long")
    def key(points: pa.Array) -> pa.Array:
        flat = points.flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMS)
        return pa.array(curve_key(flat, mean, spread))

    size = max(range_bytes, -(-(row.size or 0) // MOST_RANGES))
    keyed = rows.select("doc_id", "ids", "n", key("point").alias("curve"), "row").withColumn(
        "cell", F.shiftright("curve", BITS * DIMS - CELL_BITS).cast("int"))
    dealt = keyed.join(F.broadcast(cut(_ranges(keyed, size))), "cell").withColumn(
        "range", F.col("first") + F.pmod(F.hash("row"), F.col("parts"))).drop("cell", "first", "parts")
    dealt = dealt.repartitionById((row.size or 0) // size + 2, "range").sortWithinPartitions("curve", "row")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema.fields)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in byte_slices(batches, "ids"):
            n = batch.column("n").to_numpy(zero_copy_only=False)
            stops = at + np.cumsum(n)
            yield batch.append_column("at", pa.array(stops - n))
            at = int(stops[-1])

    return cut(dealt.mapInArrow(placed, f"{fields}, at long"), "zstd")


def tail_ends(full: int, total: int) -> list[int]:
    """Ends of the sequences after the last full one: the rest as powers of two, the largest first."""
    ends, at = [], full
    for bit in range((total - full).bit_length() - 1, -1, -1):
        if total - full >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return ends


def cuts(start: int, n: int, capacity: int, full: int, tail: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """Pieces (start in the document, length, sequence, offset) of ``n`` ids that begin at ``start`` of the stream."""
    at, stop = start, start + n
    k = 0
    while at < stop:
        if at < full:
            sequence, offset = divmod(at, capacity)
            end = at - offset + capacity
        else:
            while tail[k] <= at:
                k += 1
            sequence, end = full // capacity + k, tail[k]
            offset = at - (tail[k - 1] if k else full)
        size = min(end, stop) - at
        yield at - start, size, sequence, offset
        at += size


def pack(docs: DataFrame, path: str, end_id: int, capacity: int = 2048,
         range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) of every piece.

    A document's ids make a hashed vector, projected to ``DIMS`` dimensions.
    Documents are sorted by their place on the Hilbert curve through these and
    laid one after another; the stream is cut every ``capacity`` ids, and its
    rest into powers of two, which need no padding.  So no sequence is padded,
    and its documents are neighbours on the curve.  ``ids`` are little-endian,
    two bytes each if the vocabulary allows it, else four.

    A null text counts as empty (its end id alone is packed); repeated rows are
    packed one by one; a null doc_id stays null; an empty table gives no rows;
    other columns are ignored.  The lineage cuts lie in spark.checkpoint.dir.
    """
    if capacity & (capacity - 1) or capacity < 1:
        raise ValueError("the capacity must be a power of two")
    rows = cut(token_rows(docs, path, end_id).withColumn("row", F.monotonically_increasing_id()), "zstd")
    lain = along_curve(rows, range_bytes)
    # one row a range: the window runs over a row for each range_bytes of ids
    before = lain.groupBy("range").agg(F.sum("n").alias("in_range")).select(
        "range", "in_range", (F.sum("in_range").over(Window.orderBy("range")) - F.col("in_range")).alias("before"))
    total = before.agg(F.sum("in_range")).first()[0] or 0
    full = total - total % capacity
    tail = tail_ends(full, total)
    stream = lain.join(F.broadcast(before), "range").select("doc_id", "ids", "n", (F.col("before") + F.col("at")).alias("at"))
    id_type = stream.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "ids"):
            of, parts, pieces = [], [], []
            for i, (ids, n, at) in enumerate(zip(batch.column("ids").to_pylist(), batch.column("n").to_pylist(),
                                                 batch.column("at").to_pylist(), strict=True)):
                width = len(ids) // n
                for piece in cuts(at, n, capacity, full, tail):
                    of.append(i)
                    parts.append(ids[width * piece[0]:width * (piece[0] + piece[1])])
                    pieces.append(piece)
            own = pa.array(of, pa.int64())
            start, length, sequence, offset = (pa.array(c, pa.int64()) for c in zip(*pieces, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(own), start, length, pa.array(parts, pa.binary()),
                 batch.column("n").take(own), sequence, offset],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return stream.mapInArrow(run, f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long, "
                                  "sequence_id long, offset long")


def ids_crc32(ids: bytes, width: int) -> int:
    """Of ids of ``width`` bytes each, spelt as unsigned 32-bit integers."""
    return zlib.crc32(np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes())


def with_crc32(pieces: DataFrame) -> DataFrame:
    """Pieces with ``ids_crc32`` (of unsigned 32-bit ids) in place of ``ids``."""

    @F.arrow_udf("long")
    def crc(ids: pa.Array, length: pa.Array) -> pa.Array:
        return pa.array([ids_crc32(i, len(i) // n) for i, n in zip(ids.to_pylist(), length.to_pylist(), strict=True)],
                        pa.int64())

    return pieces.select("doc_id", "start", "length", crc("ids", "length").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
