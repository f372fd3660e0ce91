"""Quality classifier: compressed sizes with dictionaries of good and of bad text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.checkpoint import cut
from .common import byte_slices, strings, text_or_empty
from .labelled import held_out, sample, weighted

#: Labelled texts of each class that the model is fitted on.
PER_CLASS = 4000
#: Bytes of a dictionary, of a training segment, and of a segment that is scored.
DICTIONARY, TRAIN_SEGMENT, SEGMENT = 112_640, 1024, 512
#: Segments that the driver trains a dictionary on, 8 MB.
DICTIONARY_SEGMENTS = 8000
#: Numbers that the calibration sees of a text.
SIZES = 6
LEVEL = 3


@dataclass(frozen=True)
class Model:
    """Dictionaries, and a logistic calibration of the sizes that they give."""

    good: bytes
    bad: bytes
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]


@lru_cache(maxsize=8)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    found = zstandard.ZstdCompressionDict(dictionary)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=found, write_checksum=False,
                                    write_content_size=False, write_dict_id=False)


def _segments(text: str, size: int) -> list[bytes]:
    data = text.encode()
    return [data[i:i + size] for i in range(0, len(data), size)]


def sizes(text: str, good: bytes, bad: bytes) -> list[float]:
    """What the calibration sees of a text that isn't empty.

    The normalised difference of the sizes over all segments, the log ratio of
    compressed to plain bytes (runs of one word hardly differ between the
    dictionaries, but shrink far below prose) with its square, and of single
    segments the least difference and least log ratio with its square.
    """
    parts = _segments(text, SEGMENT)
    plain = np.array([len(p) for p in parts], float)
    g = np.array([len(_compressor(good).compress(p)) for p in parts], float)
    b = np.array([len(_compressor(bad).compress(p)) for p in parts], float)
    ratio = np.log(((g + b).sum() + 2) / 2 / (plain.sum() + 8))
    each = np.log((g + b) / 2 / (plain + 8))[plain >= min(SEGMENT // 2, plain.max())].min()
    return [(b.sum() - g.sum()) / (b.sum() + g.sum()), ratio, ratio ** 2, ((b - g) / (b + g)).min(), each, each ** 2]


def _dictionary(parts: list[bytes]) -> bytes:
    total = sum(map(len, parts))
    try:
        return zstandard.train_dictionary(max(256, min(DICTIONARY, total // 2)), parts).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself serves
        return b"".join(parts)[-DICTIONARY:] or b" "


def own_texts(rows: DataFrame) -> DataFrame:
    """(doc_id, quality, text): texts without the lines that several of them have.

    Such lines (licences, quoted passages) say nothing of either class.
    """
    lines = rows.select("doc_id", "quality", F.posexplode(F.split("text", "\n", -1)).alias("at", "line")).withColumn(
        "key", F.xxhash64("line"))
    once = lines.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low = high")
    own = lines.join(once.select("key"), "key").groupBy("doc_id", "quality").agg(
        F.sort_array(F.collect_list(F.struct("at", "line"))).alias("lines"))
    return own.select("doc_id", "quality", F.array_join(F.col("lines.line"), "\n").alias("text"))


def segments(rows: DataFrame) -> DataFrame:
    """(quality, turn, segment) of whole texts, cut in the tasks; ``turn`` is a hash of the segment and its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            for quality, text in zip(batch.column("quality").to_pylist(), strings(batch, "text"), strict=True):
                parts = _segments(text, TRAIN_SEGMENT)
                turns = [xxhash.xxh3_64_intdigest(p, seed=i & 0xFFFF) >> 1 for i, p in enumerate(parts)]
                yield pa.RecordBatch.from_arrays([pa.array([quality] * len(parts), pa.int32()), pa.array(turns, pa.int64()),
                                                  pa.array(parts, pa.binary())], ["quality", "turn", "segment"])

    return rows.select(F.col("quality").cast("int").alias("quality"), "text").mapInArrow(
        run, "quality int, turn long, segment binary")


def measured(rows: DataFrame, good: bytes, bad: bytes) -> pd.DataFrame:
    """(chance, doc_id, quality, s0 .. s5): the sizes of whole texts, made in the tasks; only numbers reach the driver."""
    names = [f"s{i}" for i in range(SIZES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            found = np.array([sizes(t, good, bad) for t in strings(batch, "text")]).reshape(-1, SIZES)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(c) for c in found.T)],
                                             [*batch.schema.names[:3], *names])

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.select("chance", "doc_id", "quality").schema.fields]
    found = rows.select("chance", "doc_id", "quality", "text").mapInArrow(run, ", ".join([*kinds, *(f"{n} double" for n in names)]))
    return found.toPandas().sort_values(["chance", "doc_id"]).reset_index(drop=True)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, counts: np.ndarray | None = None) -> np.ndarray:
    """Weights (bias first) by Newton steps, halved until the loss falls; a row counts ``counts`` times (else once)."""
    counts = np.ones(len(x)) if counts is None else counts
    x = np.column_stack([np.ones(len(x)), x])
    penalty = np.eye(x.shape[1]) * ridge
    penalty[0, 0] = 1e-6
    w = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        return (counts * np.logaddexp(0, -(2 * y - 1) * (x @ w))).sum() + w @ penalty @ w / 2

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve((x * (counts * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (counts * (p - y)) + penalty @ w)
        t = 1.0
        while loss(w - t * step) > loss(w) and t > 1e-6:
            t /= 2
        w = w - t * step
        if abs(t * step).max() < 1e-7:
            break
    return w


def calibrated(good: bytes, bad: bytes, x: np.ndarray, quality: np.ndarray, counts: np.ndarray) -> Model:
    """The model whose scores are a logistic function of the sizes ``x`` of labelled texts."""
    if not len(x):
        return Model(good, bad, (0.0,) * SIZES, (1.0,) * SIZES, (0.0,) * (SIZES + 1))
    mean = np.average(x, axis=0, weights=counts)
    scale = np.sqrt(np.average((x - mean) ** 2, axis=0, weights=counts)) + 1e-6
    w = _logistic((x - mean) / scale, quality, counts=counts)
    return Model(good, bad, tuple(mean), tuple(scale), tuple(w))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Dictionaries from three fifths of a sample of labelled texts, calibration on the others; both on whole texts.

    A dictionary is a digest of its texts' own lines: it is trained on
    ``DICTIONARY_SEGMENTS`` segments that a hash chooses evenly from all of them.
    """
    rows = cut(sample(docs, labels, per_class).where("text != ''"))
    taught = F.pmod(F.xxhash64("doc_id", F.lit("dictionary")), F.lit(5)) < 3
    parts = cut(segments(own_texts(rows.where(taught))))
    chosen_ = [[bytes(r.segment) for r in parts.where(F.col("quality") == q).orderBy("turn", "segment").limit(
        DICTIONARY_SEGMENTS).select("segment").collect()] for q in (1, 0)]
    good, bad = map(_dictionary, chosen_)
    rest = measured(rows.where(~taught), good, bad)
    if not len(rest):
        rest = measured(rows, good, bad)
    rest = weighted(rest, labels) if len(rest) else rest.assign(weight=1.0)
    return calibrated(good, bad, rest[[f"s{i}" for i in range(SIZES)]].to_numpy(float), rest.quality.to_numpy(float),
                      rest.weight.to_numpy(float))


def score(texts: list[str], model: Model) -> np.ndarray:
    """Probability of label 1; an empty text gets 0."""
    full = [i for i, t in enumerate(texts) if t]
    out = np.zeros(len(texts))
    if full:
        x = np.array([sizes(texts[i], model.good, model.bad) for i in full])
        z = model.weights[0] + ((x - model.mean) / model.scale) @ np.array(model.weights[1:])
        out[full] = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    return out


def quality_scores(docs: DataFrame, labels: DataFrame, cutoff: float = 0.7,
                   per_class: int = PER_CLASS) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted) of every whole text.

    The model is fitted on a bounded sample of the labelled rows that aren't
    held out and goes to the tasks (two dictionaries of 110 KB).  Without labels
    of a class its dictionary is blank.  A null text counts as empty and scores
    0; repeated rows give one row each; other columns are ignored.
    """
    model = fit(docs, labels, per_class)
    rows = docs.select("doc_id", text_or_empty().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            found = pa.array(score(strings(batch, "text"), model), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], ["doc_id", "score"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= cutoff).cast("int").alias("predicted"))
