"""Byte-level BPE: overlapping-chunk encoding and decoding."""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pretoken
from .common import Remembered, byte_slices, strings, text_or_empty

#: Longer texts are pre-tokenised by chunks of so many code points, shared out over tasks.
CHUNK_CHARS = 1 << 16
#: So far a chunk reaches into the next one.
OVERLAP_CHARS = 1 << 9

_RESULT = "doc_id {}, n_tokens long, ids binary, decoded binary"


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the lowest-rank adjacent pair first, leftmost of equals."""
    n = len(piece)
    parts: list[bytes | None] = [piece[i:i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get(piece[i:i + 2])
        if rank is not None:
            heap.append((rank, i, 2))
    heapq.heapify(heap)
    while heap:
        rank, i, size = heapq.heappop(heap)
        left = parts[i]
        if left is None or (j := after[i]) >= n or len(left) + len(parts[j]) != size:
            continue  # one of the two has merged since
        both = left + parts[j]
        parts[i], parts[j] = both, None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rank = ranks.get(both + parts[k])
            if rank is not None:
                heapq.heappush(heap, (rank, i, size + len(parts[k])))
        h = before[i]
        if h >= 0:
            rank = ranks.get(parts[h] + both)
            if rank is not None:
                heapq.heappush(heap, (rank, h, size + len(parts[h])))
    return [ranks[p] for p in parts if p is not None]


class Codec:
    """Ids (little-endian, 32 bits) of pre-tokens and back."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.raw = {i: b for b, i in self.ranks.items()}

        self.ids = Remembered(lambda piece: array("I", merge(piece.encode(), self.ranks)).tobytes())

    def encode(self, pieces: list[str]) -> bytes:
        self.ids.age()
        return b"".join(map(self.ids.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def _encode_rows(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in byte_slices(batches, "text"):
            ids = [own.encode(pretoken.split(x)) for x in strings(batch, "text")]
            yield _rows(batch.column("doc_id"), ids, own)

    return run


def _rows(doc_id: pa.Array, ids: list[bytes], own: Codec) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [doc_id, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
         pa.array([own.decode(x) for x in ids], pa.binary())], ["doc_id", "n_tokens", "ids", "decoded"])


def _cut(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            for i, text in enumerate(strings(batch, "text")):
                spans = pretoken.chunk_spans(len(text), chunk, overlap)
                same = [0] * len(spans)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, 1).take(pa.array(same)),
                     batch.column("row").slice(i, 1).take(pa.array(same)),
                     pa.array([a for a, _ in spans], pa.int32()), pa.array([len(text)] * len(spans), pa.int32()),
                     pa.array([text[a:b] for a, b in spans], pa.string())],
                    ["doc_id", "row", "start", "length", "piece"])

    return run


def _chunk_bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Settled pre-token ends of each chunk, as absolute positions."""
    for batch in byte_slices(batches, "piece"):
        out = []
        for start, length, piece in zip(batch.column("start").to_pylist(), batch.column("length").to_pylist(),
                                        strings(batch, "piece"), strict=True):
            own = [start + e for e in pretoken.ends(piece)]
            out.append(pretoken.settled(own, start, start + len(piece), length))
        bounds = pa.array([np.array(x, "<i4").tobytes() for x in out], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "row", "start", "length", "piece")), bounds],
            ["doc_id", "row", "start", "length", "piece", "bounds"])


def _stitched(path: str, chunk: int):
    def run(table: pa.Table) -> pa.Table:
        own = codec(path)
        table = table.sort_by("start")
        parts = [x or "" for x in table.column("piece").to_pylist()]
        text = "".join(p[:chunk] for p in parts)
        starts = table.column("start").to_pylist()
        bounds = [np.frombuffer(b, "<i4").tolist() for b in table.column("bounds").to_pylist()]
        stops = pretoken.stitch(text, list(zip(starts, bounds, strict=True)))
        pieces = [text[a:b] for a, b in zip([0, *stops], stops, strict=False)]
        doc_id = table.column("doc_id").combine_chunks().slice(0, 1)
        return pa.Table.from_batches([_rows(doc_id, [own.encode(pieces)], own)])

    return run


def encode(docs: DataFrame, path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """Rows (doc_id, n_tokens, ids, decoded) of every whole text.

    ``ids`` are little-endian unsigned 32-bit integers; ``decoded`` are the raw
    bytes that they stand for.  Texts longer than a chunk are cut into
    overlapping chunk rows that all tasks pre-tokenise; per document the chunks
    are stitched where their boundaries meet and the pieces encoded.  Shorter
    texts are one chunk, encoded where they are read, without a shuffle.

    A null text counts as empty and gives no ids; repeated rows give one row
    each; a null doc_id stays null; other columns are ignored.
    """
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    result = _RESULT.format(id_type)
    length = F.length("text")
    short = rows.where(length <= chunk).mapInArrow(_encode_rows(path), result)
    # the row number tells repeated rows apart
    long = rows.where(length > chunk).withColumn("row", F.monotonically_increasing_id())
    cut = long.mapInArrow(_cut(chunk, overlap),
                          f"doc_id {id_type}, row long, start int, length int, piece string")
    bounds = cut.repartition("row", "start").mapInArrow(
        _chunk_bounds, f"doc_id {id_type}, row long, start int, length int, piece string, bounds binary")
    stitched = bounds.groupBy("row").applyInArrow(_stitched(path, chunk), result)
    return short.unionByName(stitched)
