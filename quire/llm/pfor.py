"""Token-id files in patched frame-of-reference blocks."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordering import range_count
from .common import text_or_empty
from .hftokens import encoded

#: Ids in a block: 32 rows of 4 lanes, packed into as many 128-bit words as an id has bits.
BLOCK = 128
#: Share of a block's ids that the packed width holds; the rest are exceptions.
PERCENTILE = 90
#: A segment closes once it holds so many ids; a document is never split.
SEGMENT_IDS = 1 << 18
#: Writing tasks whose totals (16 bytes each) are broadcast when files are read.
BROADCAST_PARTS = 1 << 20

_MAGIC = b"PFR1"
_HEAD = struct.Struct("<4sIQII")  # magic, documents, ids, blocks, bytes of payload


def _widths(x: np.ndarray) -> np.ndarray:
    """Bits of each value."""
    return np.frexp(x.astype(np.float64))[1].astype(np.int64)


def _pack(x: np.ndarray, width: int) -> np.ndarray:
    """(n, 128) values of ``width`` bits -> (n, width, 4) words."""
    lanes = x.reshape(-1, 32, 4)
    out = np.zeros((len(lanes), width, 4), np.uint32)
    for i in range(32):
        word, shift = divmod(i * width, 32)
        out[:, word] |= lanes[:, i] << np.uint32(shift)
        if shift + width > 32:
            out[:, word + 1] |= lanes[:, i] >> np.uint32(32 - shift)
    return out


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(words), 32, 4), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for i in range(32):
        word, shift = divmod(i * width, 32)
        out[:, i] = words[:, word] >> np.uint32(shift)
        if shift + width > 32:
            out[:, i] |= words[:, word + 1] << np.uint32(32 - shift)
        out[:, i] &= mask
    return out.reshape(-1, BLOCK)


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[bytes, int]:
    """(index and payload, number of blocks).

    Index: of each block its minimum (u4), width (u1), exceptions (u1) and start
    in the payload (u8).  Payload of a block: the low bits of all 128
    differences, the places of the exceptions (u1) and their high bits (u4).
    The last block is filled up with its own last id.
    """
    n = -(-len(ids) // BLOCK)
    if not n:
        return b"", 0
    x = np.full(n * BLOCK, ids[-1], np.uint32)
    x[:len(ids)] = ids
    x = x.reshape(n, BLOCK)
    low = x.min(axis=1)
    x = x - low[:, None]
    bits = _widths(x)
    width = np.sort(bits, axis=1)[:, max(0, -(-BLOCK * percentile // 100) - 1)]
    width = np.minimum(width, 31)
    odd = bits > width[:, None]
    n_odd = odd.sum(axis=1)
    size = width * 16 + n_odd * 5
    start = np.concatenate([[0], np.cumsum(size)])
    payload = np.zeros(int(start[-1]), np.uint8)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        if w:
            words = _pack(x[at] & np.uint32((1 << int(w)) - 1), int(w)).view(np.uint8).reshape(len(at), -1)
            payload[start[at][:, None] + np.arange(int(w) * 16)] = words
    block, place = np.nonzero(odd)
    nth = np.arange(len(block)) - np.concatenate([[0], np.cumsum(n_odd)])[block]
    base = start[block] + width[block] * 16
    payload[base + nth] = place
    high = (x[block, place] >> width[block].astype(np.uint32)).astype("<u4").view(np.uint8).reshape(-1, 4)
    payload[(base + n_odd[block] + 4 * nth)[:, None] + np.arange(4)] = high
    index = (low.astype("<u4").tobytes() + width.astype(np.uint8).tobytes() + n_odd.astype(np.uint8).tobytes()
             + start[:-1].astype("<u8").tobytes())
    return index + payload.tobytes(), n


def decode_blocks(data: bytes, n: int, first: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids of the blocks from ``first`` up to ``stop``, found by the block index."""
    stop = n if stop is None else stop
    low = np.frombuffer(data, "<u4", n)[first:stop]
    width = np.frombuffer(data, np.uint8, n, 4 * n)[first:stop].astype(np.int64)
    n_odd = np.frombuffer(data, np.uint8, n, 5 * n)[first:stop].astype(np.int64)
    start = np.frombuffer(data, "<u8", n, 6 * n)[first:stop].astype(np.int64)
    payload = np.frombuffer(data, np.uint8, offset=14 * n)
    out = np.zeros((stop - first, BLOCK), np.uint32)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        if w:
            raw = payload[start[at][:, None] + np.arange(int(w) * 16)]
            out[at] = _unpack(raw.view("<u4").reshape(len(at), int(w), 4), int(w))
    block = np.repeat(np.arange(stop - first), n_odd)
    nth = np.arange(len(block)) - np.repeat(np.cumsum(n_odd) - n_odd, n_odd)
    base = start[block] + width[block] * 16
    place = payload[base + nth]
    high = np.ascontiguousarray(payload[(base + n_odd[block] + 4 * nth)[:, None] + np.arange(4)]).view("<u4")[:, 0]
    out[block, place] |= high << width[block].astype(np.uint32)
    return (out + low[:, None]).reshape(-1)


def encode_segment(ids: np.ndarray, lengths: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """Header, length of each document (u4), blocks."""
    body, n = encode_blocks(ids, percentile)
    return _HEAD.pack(_MAGIC, len(lengths), len(ids), n, len(body)) + lengths.astype("<u4").tobytes() + body


def decode_segment(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids, length of each document)."""
    magic, docs, ids, n, size = _HEAD.unpack_from(data)
    if magic != _MAGIC or len(data) != _HEAD.size + 4 * docs + size:
        raise ValueError("not a whole segment")
    lengths = np.frombuffer(data, "<u4", docs, _HEAD.size)
    return decode_blocks(data[_HEAD.size + 4 * docs:], n)[:ids], lengths


def decode_range(data: bytes, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` up to ``stop`` of a segment; reads only the blocks that hold them."""
    _, docs, ids, n, _ = _HEAD.unpack_from(data)
    stop = min(stop, ids)
    if start >= stop:
        return np.zeros(0, np.uint32)
    first = start // BLOCK
    got = decode_blocks(data[_HEAD.size + 4 * docs:], n, first, -(-stop // BLOCK))
    return got[start - first * BLOCK:stop - first * BLOCK]


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int,
                 segment_ids: int = SEGMENT_IDS, percentile: float = PERCENTILE) -> None:
    """Write the ids of all documents to ``path`` in ascending order of doc_id.

    The texts are dealt by ranges of (doc_id, hash of the text), as many as their
    stored bytes ask for, and sorted in each task, which writes its segments in order: rows (part, inside, n_ids,
    doc_ids, data), where ``inside`` counts the part's ids before the segment and ``data``
    is the packed segment.  Spark's Parquet writer
    holds them (uncompressed, as they are packed), so that a lost task leaves no
    half-written file in any store.

    A null text counts as empty and holds the end id alone; null doc_ids come
    first; repeated rows follow each other; other columns are ignored.
    """
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    rows = rows.repartitionByRange(range_count(docs), *order).sortWithinPartitions(*order)
    rows = rows.withColumn("part", F.spark_partition_id())
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        owners: list = []
        size, part, inside = 0, 0, 0

        def flush() -> pa.RecordBatch:
            lengths = np.array([len(x) // 4 for x in held], np.int64)
            ids = np.frombuffer(b"".join(held), "<u4")
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([inside], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([list(owners)], pa.list_(owner)), pa.array([encode_segment(ids, lengths, percentile)], pa.binary())],
                ["part", "inside", "n_ids", "doc_ids", "data"])
            held.clear()
            owners.clear()
            return out

        owner = pa.int64()
        for batch, ids in encoded(batches, vocabulary, end_id):
            owner = batch.schema.field("doc_id").type
            part = batch.column("part")[0].as_py()
            for who, own in zip(batch.column("doc_id").to_pylist(), ids, strict=True):
                held.append(own)
                owners.append(who)
                size += len(own) // 4
                if size >= segment_ids:
                    yield flush()
                    inside, size = inside + size, 0
        if held:
            yield flush()

    schema = f"part int, inside long, n_ids long, doc_ids array<{id_type}>, data binary"
    rows.mapInArrow(run, schema).write.mode("errorifexists").option("compression", "uncompressed").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) of all documents that ``path`` holds.

    ``start`` counts the ids of all documents before, in ascending doc_id order:
    the totals of the parts before (one row for each writing task, broadcast up
    to ``BROADCAST_PARTS`` of them), the part's ids before the segment, and
    those before the document in its segment.  Null doc_ids and repeated rows
    come as they were written, with their own starts; a folder of an empty table
    gives no rows.
    """
    stored = spark.read.parquet(path)
    parts = stored.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    if stored.select("part").distinct().count() <= BROADCAST_PARTS:
        parts = F.broadcast(parts)
    id_type = stored.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, lengths = decode_segment(batch.column("data")[i].as_py())
                base = batch.column("before")[i].as_py() + batch.column("inside")[i].as_py()
                stops = np.cumsum(lengths, dtype=np.int64)
                starts = stops - lengths
                raw = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids").slice(i, 1).flatten(), pa.array(base + starts),
                     pa.array(lengths.astype(np.int64)),
                     pa.array([raw[4 * a:4 * b] for a, b in zip(starts, stops, strict=True)], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])

    return stored.join(parts, "part").select("before", "inside", "doc_ids", "data").mapInArrow(
        run, f"doc_id {id_type}, start long, n_tokens long, ids binary")
