"""Spelling variants: words one edit apart, by banded edit rows along sorted word lists."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import groupby, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.checkpoint import cut

LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form is at least so many times as frequent.
TIMES = 10
#: Of runs whose digest this divides one code point is missing.
EVERY = 31
#: About so many words of a sorted list make a block; a block's words are in memory, its queries stream by.
BLOCK_WORDS = 8192
#: Bounds of so many blocks at most, cut to so many code points, are broadcast.
MOST_BLOCKS, BOUND_SIGNS = 100_000, 64
#: Queries that one task looks up in one block.
SLICE_QUERIES = 1 << 15
#: Queries of one length that go down a list together.
QUERIES_AT_ONCE = 1024
#: Above every word that starts with what is before it.
_LAST = "\U0010ffff"


def runs(text: Column) -> Column:
    """Array of the maximal runs of at least ``LEAST_LENGTH`` letters; null for a null text."""
    return F.regexp_extract_all(text, F.lit("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LENGTH), F.lit(0))


def lowered(run: Column) -> Column:
    """``run`` with A-Z lower-cased; most runs have none, and those that have are rewritten sign by sign."""
    low = F.translate(run, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(run.rlike("[A-Z]"), low).otherwise(run)


def without_one(run: Column, doc_id: Column, every: int = EVERY) -> Column:
    """``run`` less one code point where ``every`` divides the crc32 of ``<doc_id>:<run>``; a null id leaves it whole."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run))
    gone = F.pmod(h, F.char_length(run).cast("long")).cast("int")
    less = F.concat(F.substr(run, F.lit(1), gone), F.substr(run, gone + 2))
    return F.when(h % every == 0, less).otherwise(run)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of at least 7 code points and 2 occurrences; counts are summed map-side first."""
    words = docs.select("doc_id", F.explode(runs(F.col("text"))).alias("run")).select(
        "doc_id", lowered(F.col("run")).alias("run")).select(without_one(F.col("run"), F.col("doc_id")).alias("word"))
    words = words.where(F.char_length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def shared(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    if a == b[:len(a)]:
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def next_row(row: tuple[int, int, int], same: tuple[bool, bool, bool], columns: int) -> tuple[int, int, int]:
    """Row ``at + 1`` of the edit matrix from row ``at``, after one more sign of the word.

    A row has the distances to ``query[:at - 1]``, ``query[:at]`` and
    ``query[:at + 1]``; 2 stands for more than one edit.  ``same`` says whether
    the sign is that of the query at ``at - 1``, ``at`` and ``at + 1``, and
    ``columns`` how many of the new row's distances exist.
    """
    left, mid, right = row
    a = min(left + (not same[0]), mid + 1, 2) if columns > 0 else 2
    b = min(mid + (not same[1]), right + 1, a + 1, 2) if columns > 1 else 2
    c = min(right + (not same[2]), b + 1, 2) if columns > 2 else 2
    return a, b, c


def columns_after(at: int, n: int) -> int:
    return max(0, min(3, n + 1 - at))


def row_after(row: tuple[int, int, int], sign: str, at: int, query: str) -> tuple[int, int, int]:
    n = len(query)
    same = tuple(0 <= k < n and query[k] == sign for k in (at - 1, at, at + 1))
    return next_row(row, same, columns_after(at, n))


#: A row as a number: its distances are digits of base 3; the row of a prefix that agrees, and all beyond one edit.
_ROWS = list(product(range(3), repeat=3))
_AGREE, _BEYOND = _ROWS.index((1, 0, 1)), _ROWS.index((2, 2, 2))
_SAMES = list(product((False, True), repeat=3))
#: [columns, row, same] -> row
_NEXT = np.array([[[_ROWS.index(next_row(row, same, columns)) for same in _SAMES] for row in _ROWS]
                  for columns in range(4)], np.uint8)
_DISTANCE = np.array(_ROWS, np.uint8)


class SortedWords:
    """A sorted list of distinct words with the prefix lengths that neighbours share."""

    def __init__(self, words: list[str]):
        self.words = words
        self.shares = np.array([0, *(shared(a, b) for a, b in zip(words, words[1:]))], np.int64)
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.signs = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.breaks: dict[int, np.ndarray] = {}

    def _breaks(self, depth: int) -> np.ndarray:
        """Places whose word shares at most ``depth`` with the one before."""
        if depth not in self.breaks:
            self.breaks[depth] = np.flatnonzero(self.shares <= depth)
        return self.breaks[depth]

    def near(self, queries: list[str], keep: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, place) of the words that start with a query's first ``keep`` and differ from it by one edit.

        The queries have the same length.  All go down the list together, depth
        by depth: a row of the edit matrix belongs to a query and the range of
        words that share a prefix, is computed once for the range, and is dropped
        with all its words as soon as it is beyond one edit.
        """
        n, words = len(queries[0]), self.words
        signs = np.zeros((len(queries), n + 2), np.uint32)  # column k + 1: sign k
        signs[:, 1:-1] = np.frombuffer("".join(queries).encode("utf-32-le"), np.uint32).reshape(-1, n)
        low = np.array([bisect_left(words, q[:keep]) for q in queries], np.int64)
        high = np.array([bisect_right(words, q[:keep] + _LAST) for q in queries], np.int64)
        query = np.flatnonzero(low < high)
        low, high = low[query], high[query]
        row = np.full(len(query), _AGREE, np.uint8)
        found = []
        depth = keep
        while len(query):
            ended = self.lengths[low] == depth
            if -1 <= n - depth <= 1:
                hit = ended & (_DISTANCE[row, n - depth + 1] == 1)
                found.append((query[hit], low[hit]))
            low = low + ended
            breaks = self._breaks(depth)
            first, stop = np.searchsorted(breaks, low, "right"), np.searchsorted(breaks, high, "left")
            ways = np.where(low < high, stop - first + 1, 0)
            above = np.repeat(np.arange(len(query)), ways)
            nth = np.arange(len(above)) - np.repeat(np.cumsum(ways) - ways, ways)
            edge = first[above] + nth
            start = np.where(nth == 0, low[above], breaks[edge - 1])
            sign, of = self.signs[self.starts[start] + depth], query[above]
            columns = columns_after(depth, n)
            same = sum((signs[of, min(depth + k, n + 1)] == sign).astype(np.uint8) << np.uint8(2 - k) for k in range(3))
            row = _NEXT[columns, row[above], same]
            alive = np.flatnonzero(row != _BEYOND)
            last = nth[alive] == ways[above[alive]] - 1
            end = np.where(last, high[above[alive]], breaks[np.minimum(edge[alive], len(breaks) - 1)])
            query, low, high, row = of[alive], start[alive], end, row[alive]
            depth += 1
        if not found:
            return query, query
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def kept_prefix(query: str) -> int:
    """How many code points a word one edit away shares with ``query`` at its start or else at its end."""
    return len(query) // 2


def could_hold(query: str, keep: int, low: str, high: str) -> bool:
    """Whether a block from ``low`` to ``high`` may hold words near ``query`` that share its first ``keep``."""
    common = low[:shared(low, high)]
    if len(common) <= keep:
        return True
    row = (1, 0, 1)
    for depth in range(keep, min(len(common), len(query) + 1)):
        row = row_after(row, common[depth], depth, query)
        if min(row) > 1:
            return False
    return True


def _blocks(words: DataFrame, block_words: int) -> DataFrame:
    """(backward, key, n, block): both sorted lists, words and reversed words, cut into blocks by ranges."""
    n = words.count()
    both = words.select(F.explode(F.array(F.lit(False), F.lit(True))).alias("backward"), "word", "n").select(
        "backward", F.when(F.col("backward"), F.reverse("word")).otherwise(F.col("word")).alias("key"), "n")
    ranges = max(1, min(MOST_BLOCKS // 2, -(-2 * n // block_words)))
    dealt = both.repartitionByRange(ranges, "backward", "key").sortWithinPartitions("backward", "key")
    return cut(dealt.withColumn("block", F.spark_partition_id() * 2 + F.col("backward").cast("int")))


def _routed(lists: DataFrame) -> DataFrame:
    """(block, key): each word as a query to the blocks that may hold words near it."""
    ends = [F.substring(f("key"), 1, BOUND_SIGNS) for f in (F.min, F.max)]
    bounds = sorted(lists.groupBy("backward", "block").agg(ends[0].alias("low"), ends[1].alias("high")).collect(),
                    key=lambda r: (r.backward, r.low, r.block))
    held = {}
    for way in (False, True):
        own = [r for r in bounds if r.backward == way]
        high = [r.high + _LAST if len(r.high) == BOUND_SIGNS else r.high for r in own]
        held[way] = [r.block for r in own], [r.low for r in own], high
    sent = lists.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to, of = [], []
            ways, keys = batch.column("backward").to_pylist(), batch.column("key").to_pylist()
            for i, (way, key) in enumerate(zip(ways, keys, strict=True)):
                numbers, lows, highs = sent.value[way]
                keep = kept_prefix(key)
                first, stop = bisect_left(highs, key[:keep]), bisect_right(lows, key[:keep] + _LAST)
                for b in range(first, stop):
                    if could_hold(key, keep, lows[b], highs[b]):
                        to.append(numbers[b])
                        of.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(to, pa.int32()), batch.column("key").take(pa.array(of, pa.int64()))], ["block", "key"])

    return lists.mapInArrow(run, "block int, key string")


def _best(index: SortedWords, counts: list[int], backward: int, queries: list[str]) -> Iterator[tuple]:
    """(word, n_near, form_n, form) of the queries that have near words in a block."""
    for _, same in groupby(sorted(queries, key=len), len):
        own = list(same)
        keep = kept_prefix(own[0])
        for lo in range(0, len(own), QUERIES_AT_ONCE):
            part, best = own[lo:lo + QUERIES_AT_ONCE], {}
            for q, place in zip(*(x.tolist() for x in index.near(part, keep)), strict=True):
                word, n = index.words[place], counts[place]
                if backward:
                    if word[-keep:] == part[q][-keep:]:  # words that share the start, too, turn up in the other list
                        continue
                    word = word[::-1]
                near, most, form = best.get(q, (0, 0, ""))
                best[q] = (near + 1, n, word) if n > most or (n == most and word < form) else (near + 1, most, form)
            for q, (near, most, form) in best.items():
                yield part[q][::-1] if backward else part[q], near, most, form


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is found for each query in each block; a block's words come before its queries."""
    here, words, counts, index = None, [], [], None
    for batch in batches:
        found = []
        rows = zip(*(batch.column(c).to_pylist() for c in ("block", "slice", "key", "n")), strict=True)
        for (block, slice_), group in groupby(rows, lambda r: r[:2]):
            if (block, slice_) != here:
                here, words, counts, index = (block, slice_), [], [], None
            queries = []
            for _, _, key, n in group:
                if n is None:
                    queries.append(key)
                else:
                    words.append(key)
                    counts.append(n)
            if queries and words:
                index = index or SortedWords(words)
                found += _best(index, counts, block & 1, queries)
        columns = list(zip(*found, strict=True)) or [[]] * 4
        types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                         ["word", "n_near", "form_n", "form"])


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS, slice_queries: int = SLICE_QUERIES) -> DataFrame:
    """(word, n_near, form, form_n) of the words with a near word; ``form`` is the near word of largest n.

    Of two words one edit apart, each shares half of its own code points with
    the other at the start or else at the end.  So each word is looked up in the
    sorted list by its first half and in the list of reversed words by its last
    half.  The lists are cut into blocks of equal size; a word goes to the
    blocks whose shared prefix is within one edit.  What is found is summed up a
    word and block; pairs aren't written.  A word of length m has fewer than
    92 * (2 * m + 1) near words, so no group is hot.
    """
    lists = _blocks(words, block_words)
    asked = cut(_routed(lists))
    slices = F.broadcast(asked.groupBy("block").agg(
        F.ceil(F.count(F.lit(1)) / slice_queries).cast("int").alias("slices")))
    queries = asked.join(slices, "block").select(
        "block", F.pmod(F.hash("key"), F.col("slices")).alias("slice"), "key", F.lit(None).cast("long").alias("n"))
    entries = lists.join(slices, "block").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "key", "n")
    dealt = entries.unionByName(queries).repartition("block", "slice").sortWithinPartitions(
        "block", "slice", F.col("n").isNull(), "key")
    found = dealt.mapInArrow(_looked_up, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form) rows: the last form of the chain.

    Each round doubles the steps that a word has gone.  n grows tenfold with each
    step, so that chains end after at most 18.
    """
    reach = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        on = reach.select(F.col("word").alias("root"), F.col("root").alias("further"))
        gone = cut(reach.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        reach = gone.drop("moved")
        if gone.where("moved").isEmpty():
            return reach


def variants(docs: DataFrame, block_words: int = BLOCK_WORDS, slice_queries: int = SLICE_QUERIES) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the texts.

    Runs of letters are taken from whole texts; a run whose digest 31 divides
    lacks one code point.  Words have at least 7 code points and 2 occurrences.
    A word's form is its near word of largest n (of equal ones the smallest in
    code-point order) if that n is at least ten times its own; its root is the
    last of the forms that follow, or itself.

    A null or empty text has no words; with a null doc_id no code point is
    taken out; repeated rows count each time; an empty table gives no rows;
    other columns are ignored.  The lineage cuts lie in spark.checkpoint.dir.
    """
    words = cut(vocabulary(docs))
    near = near_words(words, block_words, slice_queries)
    named = F.col("form_n") >= F.col("n") * TIMES
    linked = cut(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(named, F.col("form")).alias("form"), F.when(named, F.col("form_n")).alias("form_n")))
    last = roots(linked.where("form is not null"))
    return linked.join(last, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
