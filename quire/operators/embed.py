"""Embeddings: unit-length vectors and batch encoding of text.

* ``unit_vector`` — L2 normalisation as a Column expression (JVM).
* ``embed_hashing`` — offline default encoder: tokens -> md5 slots (JVM) -> term
  counts (Arrow) -> L2 normalised dense array; no model weights.
* ``embed_with`` — any batch encoder (e.g. a sentence-embedding model), run
  with ``mapInPandas``: the model is loaded once per task and fed batches of
  ``batch_size`` texts; its output is normalised like the original pipeline's
  ``normalize_embeddings=True``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.resource import ExecutorResourceRequests, ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPS = 1e-12
#: Batches that a task sorts by length at once, and a bound on their code points.
SORTED_BATCHES, SORTED_CHARS = 8, 1 << 25


def unit_vector(v: Column) -> Column:
    """``v / max(||v||, eps)`` element-wise, as doubles; the norm is taken once a vector."""
    sq = F.aggregate(v, F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double"))
    norm = F.array(F.greatest(F.sqrt(sq), F.lit(EPS)))
    return F.transform(norm, lambda n: F.transform(v, lambda x: x.cast("double") / n))[0]


def unit_embeddings(df: DataFrame, col: str = "embedding", out: str = "unit") -> DataFrame:
    return df.withColumn(out, unit_vector(F.col(col)))


def token_slots(text: Column, dim: int) -> Column:
    """Tokens (runs of letters and digits, lower-cased) -> their slots: md5's first 32 bits modulo ``dim``."""
    tokens = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")
    return F.transform(tokens, lambda t: (
        F.conv(F.substring(F.md5(t.cast("binary")), 1, 8), 16, 10).cast("bigint") % dim).cast("int"))


def slot_vectors(dim: int):
    """Arrow UDF: slots of a text -> how many fall on each of ``dim``, as a unit vector."""

    def vector(slots):
        n = np.bincount(np.array(slots, np.int64), minlength=dim).astype(float)
        return n / max(np.sqrt(n @ n), EPS)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def vectors(slots: pa.Array) -> pa.Array:
        return pa.array([None if s is None else vector(s) for s in slots.to_pylist()], type=pa.list_(pa.float64()))

    return vectors


def embed_hashing(df: DataFrame, text_col: str = "paragraphs", dim: int = 256,
                  out: str = "embedding") -> DataFrame:
    """Hashed bag-of-words vectors, unit length, as ``array<double>``."""
    return df.withColumn(out, slot_vectors(dim)(token_slots(F.col(text_col), dim)))


def embed_with(df: DataFrame, make_encoder: Callable[[], Callable[[list[str]], np.ndarray]],
               text_col: str = "paragraphs", batch_size: int = 2000,
               out: str = "embedding", normalize: bool = True,
               profile: ResourceProfile | None = None) -> DataFrame:
    """Encode ``text_col`` with a user model in batches (``mapInPandas``).

    ``make_encoder`` is called once per task and returns ``encode(texts) ->
    (n, d) array``; the factory pattern keeps the model out of the closure.  A
    task holds ``SORTED_BATCHES`` batches (or ``SORTED_CHARS`` code points) and
    feeds them by length, so that texts of a batch need little padding; rows come
    out in the order in which they came.  A null text is encoded as the empty
    one.  ``profile`` places the tasks: a resource profile that asks for the
    devices that the model needs (stage-level scheduling), such as
    :func:`device_profile` makes.
    """
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.ArrayType(T.FloatType()))])

    def encoded(encode: Callable, held: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(held, ignore_index=True)
        texts = rows[text_col].fillna("")
        order = np.argsort(texts.str.len().to_numpy(), kind="stable")
        vectors: list = [None] * len(rows)
        for lo in range(0, len(rows), batch_size):
            part = order[lo:lo + batch_size]
            m = np.asarray(encode([texts.iat[i] for i in part]), dtype=np.float64)
            if normalize:
                m = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), EPS)
            for i, row in zip(part, m.astype(np.float32), strict=True):
                vectors[i] = row
        rows[out] = vectors
        return rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, held, n, chars = make_encoder(), [], 0, 0
        for pdf in batches:
            for lo in range(0, len(pdf), batch_size):
                part = pdf.iloc[lo:lo + batch_size]
                held.append(part)
                n, chars = n + len(part), chars + int(part[text_col].str.len().sum())
                if n >= SORTED_BATCHES * batch_size or chars >= SORTED_CHARS:
                    yield encoded(encode, held)
                    held, n, chars = [], 0, 0
        if held:
            yield encoded(encode, held)

    return df.mapInPandas(run, schema, profile=profile)


def device_profile(device: str = "gpu", per_executor: int = 1, tasks_per_device: int = 1,
                   discovery_script: str = "") -> ResourceProfile:
    """A profile whose executors have ``per_executor`` devices, each shared by ``tasks_per_device`` tasks."""
    executors = ExecutorResourceRequests().resource(device, per_executor, discovery_script)
    tasks = TaskResourceRequests().cpus(1).resource(device, 1 / tasks_per_device)
    return ResourceProfileBuilder().require(executors).require(tasks).build
