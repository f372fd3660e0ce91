"""Codes of vectors: one codebook a part, nearest entries by slices of sorted coordinates and bitmasks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.checkpoint import cut

PARTS = 16
#: Entries of a codebook; their set fits one uint64.
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Totals of up to so many labels (a few dozen bytes each) are broadcast; beyond, both sides are salted and shuffled.
BROADCAST_LABELS = 200_000
SALTS = 32


class Slices:
    """Nearest entries of one codebook.

    For each dimension the coordinates are sorted, and ``masks[k]`` has the bits
    of the first k entries in that order.  A range of coordinates is then the
    difference of two masks, and the entries inside a box are the AND over the
    dimensions.
    """

    def __init__(self, entries: np.ndarray):
        k, dims = entries.shape
        if k > ENTRIES:
            raise ValueError(f"{k} entries don't fit a mask of {ENTRIES} bits")
        self.entries = entries
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.coords = np.ascontiguousarray(np.take_along_axis(entries, self.order, 0).T)
        self.masks = np.zeros((dims, k + 1), np.uint64)
        self.masks[:, 1:] = np.bitwise_or.accumulate(np.uint64(1) << self.order.T.astype(np.uint64), axis=1)

    def guess(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance): the nearest of the entries that are next to a row in one of the dimensions."""
        entry, least = None, None
        for d, line in enumerate(self.coords):
            value = x[:, d]
            above = np.minimum(np.searchsorted(line, value), len(line) - 1)
            below = np.maximum(above - 1, 0)
            spot = self.order[np.where(np.abs(line[below] - value) < np.abs(line[above] - value), below, above), d]
            distance = ((x - self.entries[spot]) ** 2).sum(1)
            if entry is None:
                entry, least = spot, distance
            else:
                better = distance < least
                entry, least = np.where(better, spot, entry), np.where(better, distance, least)
        return entry, least

    def inside(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries within ``radius`` of each row in every dimension."""
        found = np.full(len(x), ~np.uint64(0))
        for line, masks, value in zip(self.coords, self.masks, x.T, strict=True):
            first, stop = np.searchsorted(line, value - radius, "left"), np.searchsorted(line, value + radius, "right")
            found &= masks[stop] & ~masks[first]
        return found

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row; of equally near entries the first.

        The distance to a guessed entry is the radius: the box around a row holds
        every entry that is as near or nearer.
        """
        entry, least = self.guess(x)
        # a float root of a long is off by less than one
        found = self.inside(x, np.sqrt(least.astype(float)).astype(np.int64) + 1)
        for e, own in enumerate(self.entries):
            rows = np.flatnonzero(found & (np.uint64(1) << np.uint64(e)))
            if len(rows):
                distance = ((x[rows] - own) ** 2).sum(1)
                better = (distance < least[rows]) | ((distance == least[rows]) & (e < entry[rows]))
                entry[rows[better]], least[rows[better]] = e, distance[better]
        return entry, least


def whole(vector: Column) -> Column:
    """Whether a vector has a positive multiple of 16 components, all of them finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & (F.size(vector) % PARTS == 0) & finite, F.lit(False))


def integers(column: pa.Array, dims: int) -> np.ndarray:
    """(rows, dims) of floor(256 * x), held within bounds whose squared distances add up inside a long."""
    most = 1 << int((61 - log2(dims)) // 2)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * SCALE), -most, most).astype(np.int64)


class Codebooks:
    """``books``: (parts, entries, dims of a part) integers."""

    def __init__(self, books: np.ndarray):
        self.books, self.slices = books, [Slices(b) for b in books]

    def __reduce__(self):
        return Codebooks, (self.books,)

    @property
    def dims(self) -> int:
        return self.books.shape[0] * self.books.shape[2]

    def assigned(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries and squared distances, both (rows, parts)."""
        parts = x.reshape(len(x), *self.books.shape[::2]).transpose(1, 0, 2)
        found = [s.nearest(p) for s, p in zip(self.slices, parts, strict=True)]
        return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)

    def sha256(self) -> str:
        """Of all integers in the order of part, entry and place, in decimal, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, list]:
    """Rows with whole vectors as long as that of the smallest id, and the first ``ENTRIES`` of them."""
    kept = vectors.where(whole(F.col(vector_col).cast("array<double>")))
    order = [F.col(id_col).asc_nulls_last(), F.col(vector_col)]
    first = kept.orderBy(*order).limit(ENTRIES).select(vector_col).collect()
    if not first:
        return kept, []
    dims = len(first[0][0])
    kept = kept.where(F.size(vector_col) == dims)
    if any(len(r[0]) != dims for r in first):
        first = kept.orderBy(*order).limit(ENTRIES).select(vector_col).collect()
    return kept, [r[0] for r in first]


def train(kept: DataFrame, first: list, vector_col: str, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks that start from the vectors ``first``, after ``rounds`` of assigning and averaging.

    A task sends one row for each entry that it met; the driver receives their
    totals, at most ``PARTS * ENTRIES`` rows.
    """
    dims = len(first[0])
    start = integers(pa.array([[float(x) for x in v] for v in first], pa.list_(pa.float64())), dims)
    books = start.reshape(len(first), PARTS, dims // PARTS).transpose(1, 0, 2)
    size = dims // PARTS
    vectors = kept.select(F.col(vector_col).cast("array<double>").alias("vector"))
    for _ in range(rounds):
        own = Codebooks(books)

        def partial(batches: Iterator[pa.RecordBatch], own: Codebooks = own) -> Iterator[pa.RecordBatch]:
            n = np.zeros(own.books.shape[:2], np.int64)
            sums = np.zeros(own.books.shape, np.int64)
            for batch in batches:
                x = integers(batch.column(0), own.dims)
                entry, _ = own.assigned(x)
                parts = x.reshape(len(x), *own.books.shape[::2])
                for p in range(PARTS):
                    n[p] += np.bincount(entry[:, p], minlength=n.shape[1])
                    np.add.at(sums[p], entry[:, p], parts[:, p])
            part, used = np.nonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(used, pa.int32()), pa.array(n[part, used]),
                 pa.array(list(sums[part, used]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

        totals = vectors.mapInArrow(partial, "part int, entry int, n long, sums array<long>").groupBy("part", "entry").agg(
            F.sum("n").alias("n"),
            F.array(*[F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(size)]).alias("sums"))
        books = books.copy()
        for r in totals.collect():
            books[r.part, r.entry] = [int(s) // r.n for s in r.sums]
    return Codebooks(books)


def coded(kept: DataFrame, books: Codebooks, vector_col: str, keep: tuple[str, ...]) -> DataFrame:
    """Columns ``keep`` with ``code`` (binary, one index a byte) and ``error`` (sum of the parts' squared distances)."""
    rows = kept.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
                       F.col(vector_col).cast("array<double>").alias("vector"))
    fields = [f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entry, distance = books.assigned(integers(batch.column("vector"), books.dims))
            code = [r.tobytes() for r in entry.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(code, pa.binary()), pa.array(distance.sum(1))],
                [*batch.schema.names[:-1], "code", "error"])

    out = rows.mapInArrow(run, ", ".join([*fields, "code binary", "error long"]))
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "code", "error")


def with_label_error(rows: DataFrame, label_col: str, broadcast_labels: int = BROADCAST_LABELS) -> DataFrame:
    """Add ``label_error``: ``error`` summed over rows of the same label, nulls together (null beyond a long).

    Totals are summed map-side first.  Up to ``broadcast_labels`` of them go to
    every task; beyond, the rows of a label are dealt over ``SALTS`` tasks.
    """
    total = F.try_sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint")
    totals = cut(rows.groupBy(F.col(label_col).alias("_of")).agg(total.alias("_total")))
    same = F.col(label_col).eqNullSafe(F.col("_of"))
    if totals.count() <= broadcast_labels:
        out = rows.join(F.broadcast(totals), same)
    else:
        salted = totals.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = F.pmod(F.hash("code", "error"), F.lit(SALTS))
        out = rows.join(salted.hint("shuffle_hash"), same & (own == F.col("_salt"))).drop("_salt")
    return out.withColumn("label_error", F.col("_total")).drop("_of", "_total")


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label") -> tuple[DataFrame, Codebooks | None]:
    """((id, label, code, error, label_error) of every kept row, the codebooks).

    Dropped: null vectors, vectors with a null, NaN or infinite component, and
    those whose length isn't a positive multiple of 16 or isn't that of the
    kept vector with the smallest id.  Integers beyond the bound at which
    squared distances could pass a long (2**27 at 64 components) count as that
    bound.  A null id counts as the largest; rows of the same id come in the
    order of their vectors when codebooks start; with fewer than 64 rows the
    codebooks are smaller; repeated rows are coded one by one; no kept rows give
    no rows and no codebooks.  Other columns are ignored.
    """
    kept, first = kept_vectors(vectors, id_col, vector_col)
    if not first:
        ids = vectors.schema[id_col].dataType.simpleString(), vectors.schema[label_col].dataType.simpleString()
        none = vectors.sparkSession.createDataFrame([], f"i {ids[0]}, l {ids[1]}, code binary, error long, label_error long")
        return none.withColumnsRenamed({"i": id_col, "l": label_col}), None
    books = train(kept, first, vector_col)
    rows = cut(coded(kept, books, vector_col, (id_col, label_col)))
    return with_label_error(rows, label_col), books
