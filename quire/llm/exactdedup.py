"""Exact dedup: binary-fuse filters of a snapshot screen the digests of a new batch."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.checkpoint import cut
from . import fuse
from .common import absent, text_or_empty

#: About so many digests have a filter of their own.
SHARD_KEYS = 1 << 18
#: Up to so many pairs of equal digests (about 60 bytes each) are broadcast to fetch their texts.
BROADCAST_PAIRS = 100_000


def normalised() -> Column:
    """The whole text with each run of ASCII white space as one space."""
    return F.regexp_replace(text_or_empty(), r"[\x20\x09-\x0D]+", " ")


def digest() -> Column:
    return F.unhex(F.sha2(normalised(), 256))


@dataclass
class Snapshot:
    """Immutable: exact buckets (digest, key, shard, keep_id, n) and a filter for each shard."""

    buckets: DataFrame
    filters: DataFrame
    shards: int


def _groups(rows: DataFrame, shards: int) -> DataFrame:
    """One row for each digest of ``rows`` (doc_id, digest, n): its smallest doc_id and size."""
    key = F.xxhash64("digest")
    return rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.sum("n").alias("n")).select(
        "digest", key.alias("key"), F.pmod(key, F.lit(shards)).cast("int").alias("shard"), "keep_id", "n")


def snapshot(rows: DataFrame, shard_keys: int = SHARD_KEYS) -> Snapshot:
    """Write the exact buckets of ``rows`` and build their filters."""
    shards = max(1, -(-rows.count() // shard_keys))
    buckets = cut(_groups(rows, shards))

    def run(table: pa.Table) -> pa.Table:
        keys = table.column("key").to_numpy().view(np.uint64)
        return pa.table({"shard": table.column("shard").slice(0, 1).cast(pa.int32()),
                         "filter": pa.array([fuse.build(keys)], pa.binary())})

    filters = cut(buckets.select("shard", "key").groupBy("shard").applyInArrow(run, "shard int, filter binary"))
    return Snapshot(buckets, filters, shards)


def screen(groups: DataFrame, known: Snapshot, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``groups`` with ``maybe``: whether the filter of its shard may hold the digest.

    Each shard's digests are dealt over so many parts that a part has about
    ``shard_keys``; the filter goes to each part.
    """
    parts = max(1, -(-groups.count() // (shard_keys * known.shards)))
    dealt = groups.withColumn("part", F.pmod(F.hash("digest"), F.lit(parts)))
    filters = known.filters.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        keys = left.column("key").to_numpy().view(np.uint64)
        data = right.column("filter")[0].as_py() if right.num_rows else b""
        return left.drop_columns("part").append_column("maybe", pa.array(fuse.probe(data, keys), pa.bool_()))

    id_type = groups.schema["keep_id"].dataType.simpleString()
    return dealt.groupBy("shard", "part").cogroup(filters.groupBy("shard", "part")).applyInArrow(
        run, f"digest binary, key long, shard int, keep_id {id_type}, n long, maybe boolean")


def _byte_checked(matched: DataFrame, docs: DataFrame) -> DataFrame:
    """The matched digests whose two texts, one of each side, are the same bytes; fails on any other."""
    wanted = matched.select("digest", F.posexplode(F.array("keep_id", "old_id")).alias("side", "doc_id"))
    if matched.count() <= BROADCAST_PAIRS:
        wanted = F.broadcast(wanted)
    texts = docs.select("doc_id", normalised().alias("text"), digest().alias("own"))
    found = texts.join(wanted, texts.doc_id.eqNullSafe(wanted.doc_id) & (texts.own == wanted.digest))
    same = found.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high"),
                                       F.min("side").alias("first"), F.max("side").alias("last"))
    return same.select("digest", F.when(F.col("first") == F.col("last"), F.raise_error(
        F.lit("a text to compare is gone"))).when(F.col("low") != F.col("high"), F.raise_error(
            F.lit("texts of one digest differ"))).otherwise(F.lit(True)).cast("boolean").alias("same"))


def merge_batch(known: Snapshot, rows: DataFrame, docs: DataFrame) -> DataFrame:
    """All digests of the snapshot and of the batch: (digest, keep_id, n).

    The batch's own duplicates are grouped by themselves.  Digests that the
    filters rule out are new; the others join the exact buckets, and pairs that
    meet there are compared byte by byte.
    """
    screened = cut(screen(_groups(rows, known.shards), known))
    old = known.buckets.select("digest", F.col("keep_id").alias("old_id"))
    positive = cut(screened.where("maybe").join(old.withColumn("hit", F.lit(True)), "digest", "left"))
    matched = positive.where("hit")
    checked = matched.join(_byte_checked(matched, docs), "digest", "left").where(
        F.coalesce("same", F.raise_error(F.lit("a text to compare is gone")).cast("boolean"))).select(
        "digest", F.col("keep_id").alias("batch_id"), F.col("n").alias("more"))
    grown = known.buckets.join(checked, "digest", "left").select(
        "digest", F.least("keep_id", "batch_id").alias("keep_id"),
        (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"))
    new = [x.select("digest", "keep_id", "n") for x in
           (screened.where(~F.col("maybe")), positive.where(F.col("hit").isNull()))]
    return grown.unionByName(new[0]).unionByName(new[1])


def exact_dedup(docs: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """Rows (doc_id, keep_id, group_size, kept, text_sha256), one for each document.

    About half of the documents, by a hash of doc_id, are the snapshot and the
    others the incoming batch; results are the same for any split.  Only digests
    move; texts move for the byte check of one pair for each matched digest.

    A null text counts as empty.  Null doc_ids come after all others, so a
    group keeps one only if it has nothing else.  Of repeated rows (same doc_id
    and text) one is kept.  Other columns are ignored.
    """
    rows = cut(docs.select("doc_id", digest().alias("digest")).groupBy("doc_id", "digest").agg(
        F.count(F.lit(1)).alias("n")))
    early = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    known = snapshot(rows.where(early), shard_keys)
    classes = merge_batch(known, rows.where(~early), docs).withColumnRenamed("n", "group_size")
    joined = rows.join(classes, "digest").select(
        "doc_id", "keep_id", "group_size", "digest", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    return joined.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def without_copies(docs: DataFrame) -> DataFrame:
    """The kept rows of ``docs`` with all their columns, whatever their names.

    Of equal texts the row with the smallest doc_id stays, a null doc_id only if
    there is no other; of repeated rows (same doc_id and text) any one.  A null
    text is the copy of an empty one.  An empty table stays empty.
    """
    judged = cut(exact_dedup(docs))
    own, id_, sha = absent(docs, "digest", "gone_id", "gone_sha")
    marked = docs.withColumn(own, F.lower(F.hex(digest())))
    # a (doc_id, text) with no kept row goes; where it was there twice, one row stays
    keys = judged.groupBy("doc_id", "text_sha256").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows")).toDF(id_, sha, "kept", "rows")
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(own) == F.col(sha))

    def matching(which: Column) -> DataFrame:
        some = keys.where(which).select(id_, sha)
        return F.broadcast(some) if some.count() <= BROADCAST_PAIRS else some

    left = marked.join(matching(~F.col("kept")), same, "left_anti")
    repeated = F.col("kept") & (F.col("rows") > 1)
    if not keys.where(repeated).isEmpty():  # only rows that are there twice move
        twice = matching(repeated)
        once = left.join(twice, same, "left_semi").groupBy("doc_id", own).agg(
            F.first(F.struct(*[F.col(f"`{c}`") for c in left.columns])).alias("row")).select("row.*")
        left = left.join(twice, same, "left_anti").unionByName(once)
    return left.drop(own)
