"""URL rules in a memory-mapped, sorted array of 64-bit digests."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.checkpoint import shared_path

#: Rules whose index stays under so many bytes are collected, which takes the driver about ten times as much,
#: and go to the executors as a file; more are joined.
MAX_INDEX_BYTES = 16 << 20
#: Seed of Spark's xxhash64, so that digests made by either agree.
SEED = 42

_HEAD = struct.Struct("<4sIQ")
_MAGIC = b"URL1"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    mark = F.locate("://", url)
    return F.when(mark > 0, F.substr(url, mark + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; else empty."""
    found = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def build(rules: list[tuple[str, str]]) -> bytes:
    """The index of (rule, verdict) rows, such as ("example.net/en/", "allow").

    Header, lengths of the rules' paths, digests in rising order, places of the
    full strings, verdicts, strings.  Of a rule given twice the last counts.
    """
    last = {rule: verdict for rule, verdict in rules}
    rows = sorted((xxhash.xxh64_intdigest(rule.encode(), SEED), rule.encode(), v == "block") for rule, v in last.items())
    lengths = sorted({len(rule) - rule.index(b"/") for _, rule, _ in rows})
    stops = np.cumsum([0, *(len(rule) for _, rule, _ in rows)])
    return b"".join([
        _HEAD.pack(_MAGIC, len(lengths), len(rows)), np.array(lengths, "<u4").tobytes(),
        np.array([d for d, _, _ in rows], "<u8").tobytes(), stops.astype("<u8").tobytes(),
        np.array([b for _, _, b in rows], np.uint8).tobytes(), b"".join(rule for _, rule, _ in rows)])


class Index:
    """Reads an index; the arrays are views of the mapped file."""

    def __init__(self, data: np.ndarray):
        magic, n_lengths, n = _HEAD.unpack(data[:_HEAD.size].tobytes())
        if magic != _MAGIC:
            raise ValueError("not an index")
        at = _HEAD.size

        def view(kind: str, count: int) -> np.ndarray:
            nonlocal at
            size = np.dtype(kind).itemsize * count
            out = np.frombuffer(data, kind, count, at)
            at += size
            return out

        self.lengths = view("<u4", n_lengths).tolist()
        self.digests, self.stops = view("<u8", n), view("<u8", n + 1)
        self.block = view("u1", n)
        self.text = data[at:]
        self.longest = int(np.diff(self.stops).max(initial=0))

    def find(self, keys: list[bytes]) -> np.ndarray:
        """Place of each key in the index, or -1: binary search by digest, then the full strings."""
        want = np.fromiter((xxhash.xxh64_intdigest(k, SEED) for k in keys), np.uint64, len(keys))
        out = np.full(len(keys), -1, np.int64)
        first = np.searchsorted(self.digests, want, "left")
        stop = np.searchsorted(self.digests, want, "right")
        for i in np.flatnonzero(stop > first):
            for k in range(int(first[i]), int(stop[i])):  # more than one only if digests collide
                if self.rule(k) == keys[i]:
                    out[i] = k
                    break
        return out

    def rule(self, k: int) -> bytes:
        return self.text[int(self.stops[k]):int(self.stops[k + 1])].tobytes()


def candidates(host_: str, path_: str, lengths: list[int], longest: int) -> list[bytes]:
    """Keys of the rules that could fit: each suffix of the host with each path prefix, longest first.

    ``longest`` is the length of the longest rule; longer suffixes have none.
    """
    if not host_ or not path_:
        return []
    raw, whole = path_.encode(), host_.encode()
    prefixes = [raw[:n] for n in lengths if n <= len(raw)]
    tail = whole[-longest - 1:]
    starts = [m.end() for m in re.finditer(rb"\.", tail)] + [0] * (len(whole) <= longest)
    keys = {tail[i:] + p for i in starts for p in prefixes}
    return sorted(keys, key=lambda k: (-len(k), k))


@lru_cache(maxsize=4)
def _mapped(name: str) -> Index:
    return Index(np.memmap(SparkFiles.get(name), np.uint8, "r"))


def _published(spark: SparkSession, data: bytes) -> str:
    """Put the index into the shared folder, until the process ends; executors fetch it from there once each."""
    where = shared_path(spark, "urls")
    name = where.rsplit("/", 1)[1]
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(where)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    try:
        for i in range(0, len(data), 1 << 20):
            out.write(bytearray(data[i:i + (1 << 20)]))
    finally:
        out.close()
    spark.sparkContext.addFile(where)
    return name


def _by_index(parts: DataFrame, data: bytes) -> DataFrame:
    spark = parts.sparkSession
    name = _published(spark, data)
    id_type = parts.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _mapped(name)
        for batch in batches:
            keys, owner = [], []
            for i, (h, p) in enumerate(zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)):
                own = candidates(h, p, index.lengths, index.longest)
                keys += own
                owner += [i] * len(own)
            found = index.find(keys)
            best: list[int] = [-1] * batch.num_rows
            for k in np.flatnonzero(found >= 0)[::-1]:  # the longest of a row comes first, so it is written last
                best[owner[k]] = int(found[k])
            rules = [index.rule(k).decode() if k >= 0 else None for k in best]
            said = [None if k < 0 else "block" if index.block[k] else "allow" for k in best]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("page_id", "host", "path")), pa.array(rules, pa.string()),
                 pa.array(said, pa.string())], ["page_id", "host", "path", "rule", "said"])

    return parts.mapInArrow(run, f"page_id {id_type}, host string, path string, rule string, said string")


def _by_join(parts: DataFrame, rules: DataFrame) -> DataFrame:
    """The same by a join on digests, for rule lists beyond the index's bound."""
    table = rules.select(F.xxhash64("rule").alias("digest"), "rule", F.col("verdict").alias("said"))
    # as many rows as paths of rules have lengths
    lengths = table.groupBy(F.octet_length(F.substr("rule", F.locate("/", "rule"))).alias("n")).agg(
        F.max(F.octet_length("rule")).alias("all")).collect()
    widths, longest = sorted(r.n for r in lengths), max((r["all"] for r in lengths), default=0)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, rank, key = [], [], []
            for i, (h, p) in zip(batch.column("row").to_pylist(),
                                 zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True),
                                 strict=True):
                own = candidates(h, p, widths, longest)
                row += [i] * len(own)
                rank += range(len(own))
                key += [k.decode(errors="replace") for k in own]
            yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(rank, pa.int32()),
                                              pa.array(key, pa.string())], ["row", "rank", "key"])

    numbered = parts.withColumn("row", F.monotonically_increasing_id())
    asked = numbered.select("row", "host", "path").mapInArrow(keys, "row long, rank int, key string").withColumn(
        "digest", F.xxhash64("key"))
    hits = asked.join(table, "digest").where("key = rule").groupBy("row").agg(
        F.min_by(F.struct("rule", "said"), "rank").alias("hit"))
    return numbered.join(hits, "row", "left").select("page_id", "host", "path", "hit.rule", "hit.said")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow",
               max_index_bytes: int = MAX_INDEX_BYTES) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict) of every page, by ``rules`` (rule, verdict).

    A rule is a host, ``/`` and more of a path; it fits its host and all
    subdomains if the url's path starts with its own.  The longest that fits
    wins; where none does, ``rule`` is null and the verdict is ``default``.

    Rules whose index stays under ``max_index_bytes`` become a sorted digest
    array in the shared folder, mapped by every executor; more are joined.  A
    null or odd url has an empty host and path and no rule; repeated rows give
    one row each; other columns are ignored.
    """
    rules = rules.groupBy("rule").agg(F.max("verdict").alias("verdict"), F.count_if(F.coalesce(
        ~F.col("rule").contains("/") | ~F.col("verdict").isin("allow", "block"), F.lit(True))).alias("bad"))
    size = rules.agg(F.coalesce(F.sum(F.octet_length("rule") + 17), F.lit(0)).alias("bytes"),
                     F.min(F.when(F.col("bad") > 0, F.struct("rule", "verdict"))).alias("odd")).first()
    if size.odd:
        raise ValueError(f"not a rule: {size.odd.rule!r} {size.odd.verdict!r}")
    parts = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    if size.bytes <= max_index_bytes:
        rows = [(r["rule"], r["verdict"]) for r in rules.orderBy("rule").collect()]
        found = _by_index(parts, build(rows))
    else:
        found = _by_join(parts, rules)
    return found.select("page_id", "host", "path", "rule", F.coalesce("said", F.lit(default)).alias("verdict"))
