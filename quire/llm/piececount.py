"""Token counts of a sentencepiece BPE model by heap-and-linked-list merging."""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, byte_slices, strings, text_or_empty

#: Fixed values of the public model format: field numbers and piece types.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SPACE = "▁"


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one protocol-buffer message."""
    i = 0

    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[i]
            value |= (byte & 127) << shift
            i, shift = i + 1, shift + 7
            if byte < 128:
                return value, i

    while i < len(data):
        key, i = varint(i)
        kind = key & 7
        if kind == 0:
            value, i = varint(i)
        else:
            if kind == 2:
                size, i = varint(i)
            else:
                size = 8 if kind == 1 else 4
            value, i = data[i:i + size], i + size
        yield key >> 3, value


class Model:
    """Merge order and symbol rules of a BPE model file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            fields = list(_fields(f.read()))
        pieces = [dict(_fields(v)) for k, v in fields if k == PIECES]
        trainer = dict(next((_fields(v) for k, v in fields if k == TRAINER), ()))
        norm = dict(next((_fields(v) for k, v in fields if k == NORMALIZER), ()))
        kinds = [p.get(3, NORMAL) for p in pieces]
        if trainer.get(3, 1) != 2 or norm.get(2) or not trainer.get(35) or {USER_DEFINED, UNUSED} & set(kinds):
            raise ValueError("a BPE model with byte fallback, without character map or user-defined pieces, is needed")
        #: piece -> priority; smaller merges first
        self.order = {p[1].decode(): -struct.unpack("<f", p.get(2, b"\0\0\0\0"))[0]
                      for p, kind in zip(pieces, kinds, strict=True) if kind == NORMAL}
        self.prefix = bool(norm.get(3, 1))
        self.squeeze = bool(norm.get(4, 1))
        if self.squeeze or not norm.get(5, 1) or trainer.get(24, 0):
            raise ValueError("a model that keeps and escapes white space is needed")
        # no piece goes on from another sign to a space: units between can't merge
        self.apart = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.order)
        self.units = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if self.apart else "(?s:.+)")
        self.counts = Remembered(self.count_unit)

    def count_unit(self, unit: str) -> int:
        """Initial symbols of ``unit`` less its merges; an unknown sign counts its bytes."""
        order, n = self.order, len(unit)
        stop, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        total = sum(1 if c in order else len(c.encode()) for c in unit)
        heap = [(order[pair], i, i + 2) for i in range(n - 1) if (pair := unit[i:i + 2]) in order]
        heapq.heapify(heap)
        gone = bytearray(n)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or stop[j] != end:
                continue  # one of the two has merged since
            total -= 1
            gone[j] = 1
            stop[i] = end
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = order.get(unit[i:stop[k]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, stop[k]))
            h = before[i]
            if h >= 0:
                rank = order.get(unit[h:end])
                if rank is not None:
                    heapq.heappush(heap, (rank, h, end))
        return total

    def count(self, text: str) -> int:
        """Tokens of a whole text, without begin or end."""
        if not text:
            return 0
        units = self.units.findall((SPACE if self.prefix else "") + text.replace(" ", SPACE))
        self.counts.age()
        return sum(map(self.counts.__getitem__, units))


@lru_cache(maxsize=4)
def model(path: str) -> Model:
    return Model(path)


def token_counts(docs: DataFrame, path: str, limit: int) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit) of every whole text; no ids are made.

    Units between spaces, which no piece of the model can join, are counted
    apart and remembered.  A null text counts as empty (no bytes, no tokens);
    repeated rows give one row each; other columns are ignored.
    """
    rows = docs.select("doc_id", text_or_empty().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in byte_slices(batches, "text"):
            sizes = pc.binary_length(batch.column("text")).cast(pa.int64())
            counts = pa.array([own.count(x) for x in strings(batch, "text")], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, counts],
                                             ["doc_id", "n_bytes", "n_tokens"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
