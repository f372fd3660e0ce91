"""A Bloom filter as a table: screens rows where they lie, with nothing but a broadcast join.

Keys fall on blocks of eight longs, and set one bit in each.  With 32 keys a
block, about one in 1,600 other keys passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANES = 8
KEYS_PER_BLOCK = 32
#: A row of the table takes about 100 bytes in a broadcast.
MOST_BLOCKS = 500_000


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), key), F.lit(blocks)).cast("int")


def _bit(key: str, lane: int) -> Column:
    """The bit of ``key`` in a lane: six bits of its second hash choose it."""
    return F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(2, `{key}`), {6 * lane}) & 63 as int))")


def block_count(keys: int) -> int:
    return max(1, -(-keys // KEYS_PER_BLOCK))


def build(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(``_block``, ``_lane0`` ..): the bits that ``keys`` set, put together map-side first."""
    rows = keys.select(_block(key, blocks).alias("_block"), *[_bit(key, i).alias(f"_lane{i}") for i in range(LANES)])
    return rows.groupBy("_block").agg(*[F.bit_or(f"_lane{i}").alias(f"_lane{i}") for i in range(LANES)])


def passing(rows: DataFrame, key: str, table: DataFrame, blocks: int) -> DataFrame:
    """The rows whose ``key`` may be among those of ``table``; all that are among them pass, nulls don't."""
    hit = F.col(key).isNotNull()
    for i in range(LANES):
        hit = hit & (F.col(f"_lane{i}").bitwiseAND(_bit(key, i)) == _bit(key, i))
    names = rows.columns
    asked = rows.withColumn("_of", _block(key, blocks))
    return asked.join(F.broadcast(table), F.col("_of") == F.col("_block")).where(hit).select(*[f"`{c}`" for c in names])
