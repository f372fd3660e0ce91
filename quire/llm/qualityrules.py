"""Quality rules: statistics of a text, judged by boosted trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, strings, text_or_empty
from .labelled import sample, weighted
from .trees import Forest, train

#: Labelled texts of each class that the trees are grown on, by the statistics of each whole text.
PER_CLASS = 4000
#: Words of a window.  Distinct and repeated words are counted in windows, as their shares of a whole text depend on its length.
WINDOW = 256
#: Windows that are counted at once.
WINDOWS_AT_ONCE = 1024
#: A text stays if the trees (grown on good and bad texts in the shares that the labels have) give it at least this.
KEEP = 0.3

#: ASCII white space, and the signs that count as symbols.
SPACE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_OTHER = b"!?;:=+-_/\\()[]{}@~^\"'`"
_DIGITS = b"0123456789"

#: What the trees see, with the direction in which it may move the score.
FEATURES = {"log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
            "upper_share": 0, "mark_share": 0, "digit_share": 0, "distinct_share": 0}


def _without(data: bytes, signs: bytes) -> int:
    """How many of ``signs`` (all ASCII) there are."""
    return len(data) - len(data.translate(None, signs))


def _numbered(words: list[bytes]) -> np.ndarray:
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def _runs(ids: np.ndarray, width: int = 3) -> np.ndarray:
    """A key of the ``width`` words from each place, the same for the same words only."""
    n = max(len(ids) - width + 1, 0)
    if not n:
        return np.zeros(0, np.int64)
    distinct = int(ids.max()) + 1
    key = ids[:n].copy()
    for i in range(1, width):
        if int(key.max()) >= (1 << 62) // distinct:  # number runs anew, so that keys stay exact
            key = np.unique(key, return_inverse=True)[1]
        key = key * distinct + ids[i:n + i]
    return key


def _repeated(key: np.ndarray, width: int = 3) -> int:
    if len(key) < 2:
        return 0
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[inverse] > 1
    covered = np.zeros(len(key) + width - 1, bool)
    for i in range(width):
        covered[i:len(key) + i] |= twice
    return int(covered.sum())


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Places of words in a window of ``width`` words that the text has twice or more."""
    return _repeated(_runs(_numbered(words), width), width)


def windowed(ids: np.ndarray, key: np.ndarray, size: int = WINDOW, width: int = 3) -> tuple[int, int, int]:
    """(words, distinct words, repeated words) summed over windows of ``size`` words that cover the whole text.

    The last window ends with the text, so that all have the same size; a shorter text is one window.
    """
    n = len(ids)
    if n <= size:
        return n, len(np.unique(ids)), _repeated(key, width)
    starts = np.append(np.arange(0, n - size, size), n - size)
    distinct = repeated = 0
    for at in range(0, len(starts), WINDOWS_AT_ONCE):
        some = starts[at:at + WINDOWS_AT_ONCE, None]
        own = np.sort(ids[some + np.arange(size)], axis=1)
        distinct += len(own) + int((own[:, 1:] != own[:, :-1]).sum())
        runs = key[some + np.arange(size - width + 1)]
        order = np.argsort(runs, axis=1)
        runs = np.take_along_axis(runs, order, 1)
        same = runs[:, 1:] == runs[:, :-1]
        twice = np.zeros(runs.shape, bool)
        twice[:, 1:] |= same
        twice[:, :-1] |= same
        back = np.empty_like(twice)
        np.put_along_axis(back, order, twice, 1)
        covered = np.zeros(own.shape, bool)
        for i in range(width):
            covered[:, i:runs.shape[1] + i] |= back
        repeated += int(covered.sum())
    return len(starts) * size, distinct, repeated


#: What ``statistics`` counts.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks",
          "n_digits", "window_words", "window_distinct", "window_repeat"]


def statistics(text: str) -> tuple[int, ...]:
    """COUNTS of a whole text; lines are those with a word."""
    data = text.encode()
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    ids = _numbered(words)
    key = _runs(ids)
    return (len(words), len(text) - _without(data, SPACE), _without(data, SYMBOLS), len(lines) - len(set(lines)),
            _repeated(key), len(lines), _without(data, _UPPER), _without(data, _OTHER), _without(data, _DIGITS),
            *windowed(ids, key))


def features(found: np.ndarray) -> np.ndarray:
    """Rows of ``statistics`` as the columns of FEATURES."""
    words, chars, symbols, dup, _, lines, upper, marks, digits, seen, distinct, repeat = found.astype(float).T
    w, c, seen = np.maximum(words, 1), np.maximum(chars, 1), np.maximum(seen, 1)
    return np.column_stack([np.log1p(words), chars / w, symbols / c, dup / np.maximum(lines, 1), repeat / seen,
                            upper / c, marks / c, digits / c, distinct / seen])


def _statistics(texts: list[str]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.int64).reshape(-1, len(COUNTS))


def sampled(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> pd.DataFrame:
    """(chance, doc_id, quality, COUNTS, weight) of a bounded sample of the labelled rows that aren't held out, in a fixed order.

    The counts are of whole texts and made where those are read; only numbers reach the driver.
    """
    rows = sample(docs, labels, per_class)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            found = _statistics(strings(batch, "text"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *(pa.array(found[:, i]) for i in range(len(COUNTS)))],
                [*batch.schema.names[:3], *COUNTS])

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:3]]
    found = rows.mapInArrow(run, ", ".join([*kinds, *(f"{c} long" for c in COUNTS)])).toPandas()
    return weighted(found.sort_values(["chance", "doc_id"]).reset_index(drop=True), labels)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Forest:
    """Trees grown on the statistics of the sample's whole texts."""
    rows = sampled(docs, labels, per_class)
    return train(features(rows[COUNTS].to_numpy(np.int64)), rows.quality.to_numpy(float), list(FEATURES.values()),
                 weight=rows.weight.to_numpy(float))


def base_fails(found: np.ndarray) -> np.ndarray:
    return (found[:, 0] < 50) | (100 * found[:, 4] > 50 * found[:, 0])


def verdicts(found: np.ndarray, forest: Forest, keep: float = KEEP) -> np.ndarray:
    return ~base_fails(found) & (forest.probability(features(found)) >= keep)


def judged(docs: DataFrame, forest: Forest, keep: float = KEEP) -> DataFrame:
    """Rows (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score).

    A null text counts as having no words and fails the base rules; repeated
    rows give one row each; a null doc_id stays null; other columns are ignored.
    """
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            found = _statistics(strings(batch, "text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(found[:, i]) for i in range(5)), pa.array(base_fails(found)),
                 pa.array(verdicts(found, forest, keep)), pa.array(forest.probability(features(found)))],
                ["doc_id", *names, "base_failed", "kept", "score"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, {', '.join(f'{x} long' for x in names)}, "
                                "base_failed boolean, kept boolean, score double")


def passing(docs: DataFrame, forest: Forest, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, where they are read.

    A null or empty text fails the base rules and goes; repeated rows stay or go
    together; columns of any name stay; an empty table stays empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            yield batch.filter(pa.array(verdicts(_statistics(strings(batch, "text")), forest, keep)))

    return docs.mapInArrow(run, docs.schema)
