"""MinHash near-dedup: banding, signature verification, exact links, components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.checkpoint import cut
from .common import absent, byte_slices, hot_join, strings, text_or_empty
from .components import components

#: Nodes of a bucket or of a group of pairs that a task compares with each other at once.
BLOCK = 512
#: Bytes of the full sets of a block.
BLOCK_BYTES = 16 << 20
#: Further nodes that a bucket of several components is compared with before all its pairs are.  Each takes a
#: round of components, whose plans the driver holds.
CENTRES = 1
#: Up to so many narrow rows (about 24 bytes each) are broadcast to fetch texts or drop rows.
BROADCAST_ROWS = 500_000

_U = np.uint64
#: Odd factors for the words of a shingle.
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                     0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], _U)


@dataclass(frozen=True)
class MinHash:
    """``bands`` of ``rows`` minima find candidates; ``minima`` in all verify them.

    With 24 bands of 5, two sets of similarity 0.80 share no band with
    probability 7e-5, and of 0.85 with 8e-7.  ``slack`` is four standard
    deviations of the share of equal minima at 0.80, so that verification loses
    3e-5 of such pairs at most before sets are compared in full.
    """

    words: int = 5
    percent: int = 80
    bands: int = 24
    rows: int = 5
    minima: int = 256
    slack: float = 0.10
    seed: int = 20

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        a = rng.integers(0, 1 << 32, self.minima, dtype=np.uint32) | np.uint32(1)
        return a, rng.integers(0, 1 << 32, self.minima, dtype=np.uint32)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < 1 << 17:
            self[word] = value
        return value


_words = _Words()


def _scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


def shingles(text: str, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; A-Z count as a-z."""
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, _U)
    n = len(found) - words + 1
    if n < 1:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found), seed=1)], _U)
    x = np.fromiter(map(_words.__getitem__, found), _U, len(found))
    h = np.zeros(n, _U)
    for i in range(words):
        h = _scrambled(h * _FACTORS[0] + x[i:i + n] * _FACTORS[i % 5])
    return np.unique(h)


def minima(found: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of each universal hash over the set."""
    x = (found >> _U(32)).astype(np.uint32)
    low = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        h = a[:, None] * x[None, i:i + 2048]
        h += b[:, None]
        np.minimum(low, h.min(axis=1), out=low)
    return low


def signature(low: np.ndarray) -> bytes:
    """A byte of each minimum."""
    return ((low * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()


def band_keys(low: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = low[:bands * rows].reshape(bands, rows).astype(_U)
    h = np.arange(1, bands + 1, dtype=_U) * _FACTORS[1]
    for i in range(rows):
        h = _scrambled(h * _FACTORS[0] + parts[:, i] * _FACTORS[2])
    return h.view(np.int64)


def _sketched(docs: DataFrame, how: MinHash) -> DataFrame:
    """(doc_id, text_hash, n_shingles, set_key, bands, sig) of every document; keys are null for empty sets."""
    rows = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_hash"), text_or_empty().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = how.hashes()
        for batch in byte_slices(batches, "text"):
            sizes, keys, bands, sigs = [], [], [], []
            for text in strings(batch, "text"):
                found = shingles(text, how.words)
                sizes.append(len(found))
                low = minima(found, a, b)
                keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                bands.append(band_keys(low, how.bands, how.rows))
                sigs.append(signature(low))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()),
                 pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
                ["doc_id", "text_hash", "n_shingles", "set_key", "bands", "sig"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {id_type}, text_hash long, n_shingles long, set_key binary, bands array<long>, sig binary")


def _sets(docs: DataFrame, nodes: DataFrame, how: MinHash) -> DataFrame:
    """(node, members) of the given nodes, from the whole text of one row (doc_id and text hash) of each."""
    nodes = nodes.select("node", "set_key", "row.*").toDF("node", "set_key", "own_id", "own_hash")
    if nodes.count() <= BROADCAST_ROWS:
        nodes = F.broadcast(nodes)
    texts = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_hash"), text_or_empty().alias("text"))
    wanted = texts.join(nodes, texts.doc_id.eqNullSafe(nodes.own_id) & (texts.text_hash == nodes.own_hash)).select(
        "node", "set_key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            at, found = [], []
            for i, (text, key) in enumerate(zip(strings(batch, "text"), batch.column("set_key").to_pylist(), strict=True)):
                own = shingles(text, how.words).tobytes()
                if xxhash.xxh3_128_digest(own) == key:  # else another text of the same hash
                    at.append(i)
                    found.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(at, pa.int64())), pa.array(found, pa.binary())], ["node", "members"])

    return wanted.mapInArrow(run, "node long, members binary").dropDuplicates(["node"])


def _alike(pairs: DataFrame, classes: DataFrame, how: MinHash) -> DataFrame:
    """The pairs (a, b) whose sizes and signatures allow the similarity asked for."""
    side = classes.select("node", "n_shingles", "sig")
    both = pairs.join(side.toDF("a", "n_a", "sig_a"), "a").join(side.toDF("b", "n_b", "sig_b"), "b")
    both = both.where((100 * F.least("n_a", "n_b") >= how.percent * F.greatest("n_a", "n_b")))
    least = how.percent / 100 - how.slack

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, how.minima)
                           for c in ("sig_a", "sig_b"))
            yield batch.select(["a", "b"]).filter(pa.array((left == right).mean(axis=1) >= least))

    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def _parts(rows: DataFrame, key: str) -> DataFrame:
    """(key, parts, size): blocks that the nodes of a key are cut into, by their number and the bytes of their sets."""
    return rows.groupBy(key).agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_shingles") * 8 / BLOCK_BYTES)).cast("int").alias("parts"),
        F.count(F.lit(1)).alias("size"))


def _starred(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) as tasks (task, a[], b[]) of blocks of nodes with the same label.

    The set of a node with many pairs then goes to a task once for a block of them.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels, "node")
    parts = _parts(ends, "label").select("label", "parts")
    spots = cut(ends.join(parts, "label").select(
        "node", F.xxhash64("label", F.pmod(F.xxhash64("node"), F.col("parts"))).alias("spot")))
    dealt = pairs.join(spots.toDF("a", "spot_a"), "a").join(spots.toDF("b", "spot_b"), "b")
    task = F.xxhash64(F.least("spot_a", "spot_b"), F.greatest("spot_a", "spot_b"))
    return dealt.groupBy(task.alias("task")).agg(F.collect_list(F.struct("a", "b")).alias("pairs")).select(
        "task", F.col("pairs.a").alias("a"), F.col("pairs.b").alias("b"))


def _linked(tasks: DataFrame, nodes: DataFrame, docs: DataFrame, how: MinHash) -> DataFrame:
    """Links (a, b) that join what the similar pairs of the tasks (task, a[], b[]) join.

    Sets go to the tasks that need them and are compared in full, but for pairs
    that links of the same task join already.
    """
    needed = tasks.select(F.col("task").alias("goal"), F.explode(F.array_distinct(F.concat("a", "b"))).alias("node"))
    sets = _sets(docs, needed.select("node").distinct().join(nodes, "node"), how)
    needed = needed.join(sets, "node")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        sets_ = {n: np.frombuffer(m, _U) for n, m in zip(
            right.column("node").to_pylist(), right.column("members").to_pylist(), strict=True)}
        head: dict[int, int] = {}

        def find(x: int) -> int:
            while (y := head.get(x, x)) != x:
                x = y
            return x

        links = []
        for many_a, many_b in zip(left.column("a").to_pylist(), left.column("b").to_pylist(), strict=True):
            for a, b in zip(many_a, many_b, strict=True):
                p, q = find(a), find(b)
                if p == q:
                    continue
                x, y = sets_[a], sets_[b]
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= how.percent * (len(x) + len(y) - both):
                    links.append((a, b))
                    head[max(p, q)] = min(p, q)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return tasks.groupBy("task").cogroup(needed.groupBy("goal")).applyInArrow(run, "a long, b long")


def _apart(members: DataFrame, classes: DataFrame, sizes: DataFrame, how: MinHash) -> DataFrame:
    """Tasks (task, a[], b[]) of pairs of one bucket but of different components so far, with like signatures.

    Buckets are compared in pairs of blocks, so that no task holds a whole hot
    one, and a task's pairs stay together: they are never rows of their own.  A
    pair in several buckets comes from its first band only; the likest first.
    """
    least = how.percent / 100 - how.slack
    rows = hot_join(members, sizes, "key", "size", members.count()).withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    p, q = F.least("own", "other"), F.greatest("own", "other")
    rows = rows.select(F.xxhash64("key", p, q).alias("task"), "key", "band", p.alias("p"), q.alias("q"),
                       "own", "node", "component")  # n_shingles comes with the signature
    # two blocks need a signature, and half of each band's key to know the first band
    side = classes.select("node", "n_shingles", "sig", F.transform(
        "bands", lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")).alias("short"))
    rows = rows.join(side, "node")

    def run(table: pa.Table) -> pa.Table:
        task, p, q, band = (table.column(c)[0].as_py() for c in ("task", "p", "q", "band"))
        own = table.column("own").to_numpy()
        node, comp = table.column("node").to_numpy(), table.column("component").to_numpy()
        n = table.column("n_shingles").to_numpy()
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(-1, how.minima)
        short = table.column("short").combine_chunks().flatten().to_numpy().reshape(-1, how.bands)
        found = [np.zeros((3, 0))]
        first = np.flatnonzero(own == p)
        for k, i in enumerate(first):
            # a block with itself: each pair once
            j = first[k + 1:] if p == q else np.flatnonzero(own == q)
            j = j[(comp[j] != comp[i]) & (100 * np.minimum(n[j], n[i]) >= how.percent * np.maximum(n[j], n[i]))]
            j = j[~(short[j, :band] == short[i, :band]).any(axis=1)]
            alike = (sig[j] == sig[i]).mean(axis=1)
            j, alike = j[alike >= least], alike[alike >= least]
            found.append(np.stack([np.full(len(j), i), j, -alike]))
        i, j, alike = np.concatenate(found, axis=1)
        order = np.argsort(alike, kind="stable")
        ends = [node[x[order].astype(np.int64)] for x in (i, j)]
        some = int(len(order) > 0)
        return pa.table({"task": pa.array([task] * some, pa.int64()),
                         "a": pa.array([ends[0].tolist()] * some, pa.list_(pa.int64())),
                         "b": pa.array([ends[1].tolist()] * some, pa.list_(pa.int64()))})

    return rows.groupBy("task", "key").applyInArrow(run, "task long, a array<long>, b array<long>")


def near_duplicates(docs: DataFrame, how: MinHash | None = None) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one for each document.

    Documents with the same set of shingles are one node.  Nodes that share a
    band's bucket are candidates.  First each is compared with its bucket's
    smallest node; the links confirmed on full sets give components.  Where a
    bucket still holds several, the nodes of the others are compared with one
    more of its nodes and components are made anew, ``CENTRES`` times.  In
    buckets that hold several even then, all pairs between different components
    are compared by signature, in blocks, and the like ones on full sets.  Pairs
    inside a component need no further link.

    ``component_id`` is the smallest doc_id that links reach and ``kept`` says
    whether it is the row's own.  A null text counts as empty; a document
    without words is alone.  A null doc_id counts as larger than all others.
    Repeated rows share a result.  Other columns are ignored.
    """
    how = how or MinHash()
    sketched = cut(_sketched(docs, how))
    classes = cut(sketched.where("set_key is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
        F.first(F.struct("doc_id", "text_hash")).alias("row"), F.first("sig").alias("sig")).withColumn("node", F.monotonically_increasing_id()))
    every = classes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = cut(every.groupBy("key").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("size")).where("size > 1"))
    members = cut(hot_join(every, buckets, "key", "size", how.bands * classes.count()))
    nodes = classes.select("node", "rep", "set_key", "row")
    labels = cut(members.groupBy("node").agg(F.min("centre").alias("label")).join(classes.select("node", "n_shingles"), "node"))

    def linked(pairs: DataFrame) -> DataFrame:
        return cut(_linked(cut(_starred(cut(_alike(pairs.distinct(), classes, how)), labels)), nodes, docs, how))

    links = linked(members.where("node != centre").select(F.col("centre").alias("a"), F.col("node").alias("b")))
    found = cut(components(links.toDF("u", "v")))
    for turn in range(CENTRES):
        placed = cut(members.where("size > 2").join(found, "node", "left").select(
            "key", "node", F.coalesce("component", "node").alias("component")))
        # another node of each bucket that still holds several components, against those of the others
        spot = F.xxhash64("node", F.lit(turn))
        centres = cut(placed.groupBy("key").agg(
            F.count(F.lit(1)).alias("size"), F.min("component").alias("low"), F.max("component").alias("high"),
            F.min_by(F.struct("node", "component"), spot).alias("c")).where("low != high").select(
            "key", "size", F.col("c.node").alias("centre"), F.col("c.component").alias("own")))
        if centres.isEmpty():
            break
        pairs = hot_join(placed, centres, "key", "size", placed.count()).where("component != own").select(
            F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
        more = linked(pairs)
        if not more.isEmpty():
            links = links.unionByName(more)
            found = cut(components(links.toDF("u", "v")))
    placed = cut(members.where("size > 2").join(found, "node", "left").join(classes.select("node", "n_shingles"), "node").select(
        "key", "band", "node", "n_shingles", F.coalesce("component", "node").alias("component")))
    several = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
    rest = cut(_apart(placed, classes, cut(_parts(placed, "key").join(several.select("key"), "key")), how))
    more = cut(_linked(rest, nodes, docs, how))
    if not more.isEmpty():
        found = components(links.unionByName(more).toDF("u", "v"))

    placed = nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    keyed = placed.join(least, "component").select("set_key", "component_id")
    rows = sketched.select("doc_id", "n_shingles", "set_key")
    out = rows.join(keyed, "set_key", "left").withColumn(
        "component_id", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def without_near_copies(docs: DataFrame, how: MinHash | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one document of each group.

    A doc_id goes if no row of it is kept; rows without one stay, as do empty
    texts; of a group the smallest doc_id stays, with all its repeated rows.
    Other columns stay, whatever their names; an empty table stays empty.
    """
    id_ = absent(docs, "gone_id")[0]
    gone = cut(near_duplicates(docs, how).groupBy("doc_id").agg(F.max("kept").alias("kept")).where(
        "doc_id is not null and not kept").select(F.col("doc_id").alias(id_)))
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return docs.join(gone, F.col("doc_id") == F.col(id_), "left_anti")
