"""Stage 2a: segments and greedy merge, exact and bucket-independent."""

import numpy as np
import pytest
from greedy_model import bucketed_groups, sequential_groups
from pyspark.sql import functions as F

from quire.operators import aggregate as A
from quire.operators import ordering
from quire.plans import queries as Q
from quire.sources import io

SCHEMA = ("paragraphs string, chapters string, n_words bigint, text_ids bigint, paragraphs_index bigint, "
          "spans array<bigint>")
# worked out by hand: a chapter change, a gap in the index, a new book, a row over the threshold by itself
ROWS = [
    ("Rain fell.", "One", 2, 7, 10, [0, 10]),
    ("Nobody came that day.", "One", 4, 7, 11, [14, 35]),
    ("The lamp went out.", "Two", 4, 7, 12, [40, 58]),
    ("We waited in the dark for a very long while.", "Two", 10, 7, 14, [60, 104]),
    ("Then it stopped.", "Two", 3, 7, 15, [110, 126]),
    ("Another book opens.", "Two", 3, 8, 16, [0, 19]),
    ("It closes.", "Two", 2, 8, 17, [20, 30]),
    ("Too late.", None, 2, 8, 18, [33, 42]),
]
MERGED = [
    ("Rain fell.\n\nNobody came that day.", "One", 6, 7, [0, 35]),
    ("The lamp went out.", "Two", 4, 7, [40, 58]),
    ("We waited in the dark for a very long while.", "Two", 10, 7, [60, 104]),
    ("Then it stopped.", "Two", 3, 7, [110, 126]),
    ("Another book opens.\n\nIt closes.", "Two", 5, 8, [0, 30]),
    ("Too late.", None, 2, 8, [33, 42]),
]


@pytest.mark.parametrize("bucket,block", [(A.ROWS_PER_BUCKET, A.BUCKETS_PER_BLOCK), (1, 1), (2, 2), (3, 1), (4, 3)])
def test_aggregate_by_hand(spark, bucket, block):
    df = spark.createDataFrame([(*r, 100 - 7 * i) for i, r in enumerate(reversed(ROWS))], SCHEMA + ", back bigint")
    out = A.aggregate_paragraphs(df.orderBy(F.rand(3)), 5, order_col="back", rows_per_bucket=bucket, per_block=block)
    got = [(r.paragraphs, r.chapters, r.n_words, r.text_ids, r.spans) for r in out.orderBy("agg_order").collect()]
    assert got == MERGED


def _segment_then_greedy(rows, T):
    """Test model: start a segment where id / index / chapter break, merge greedily."""
    out, cur, prev = [], None, None
    for p, c, n, t, i in rows:
        new = prev is None or (prev[0] is not None and prev[0] != t) or (i - 1 != prev[1]) or prev[2] != c
        if new and cur is not None:
            out.append(cur)
            cur = None
        cur = [p] + [n] if cur is None else [cur[0] + "\n\n" + p, cur[1] + n]
        if cur[1] >= T:
            out.append(cur)
            cur = None
        prev = (t, i, c)
    if cur is not None:
        out.append(cur)
    return [tuple(x) for x in out]


def test_aggregate_random_against_model(spark):
    rng = np.random.default_rng(3)
    rows = []
    idx = 0
    for k in range(300):
        idx += 1 if rng.random() > 0.05 else 2
        rows.append((f"p{k}", ["A", "B", None][int(rng.integers(0, 3)) if rng.random() < 0.1 else 0],
                     int(rng.integers(1, 9)), int(k // 40), idx))
    df = spark.createDataFrame([(p, c, n, t, i, [i, i + 1]) for p, c, n, t, i in rows], SCHEMA)
    want = _segment_then_greedy(rows, 12)
    for bucket, block in ((A.ROWS_PER_BUCKET, 1024), (7, 3), (50, 2)):
        got = [(r.paragraphs, r.n_words) for r in A.aggregate_paragraphs(
            df, 12, rows_per_bucket=bucket, per_block=block).orderBy("agg_order").collect()]
        assert got == want


def test_greedy_bucketed_equals_sequential():
    rng = np.random.default_rng(0)
    for _ in range(3000):
        size = int(rng.integers(1, 60))
        n = rng.integers(0, 10, size)
        new = rng.random(size) < rng.choice([0.0, 0.1, 0.4])
        limit, bucket, block = int(rng.integers(0, 20)), int(rng.integers(1, 10)), int(rng.integers(1, 5))
        assert (sequential_groups(new, n, limit) == bucketed_groups(new, n, limit, bucket, block)).all()


def test_hot_segment_split_over_buckets(spark):
    """One segment holding every row is still processed bucket by bucket."""
    n = 2000
    rows = [(f"w{i}", None, 1 + i % 3, 1, i) for i in range(n)]
    df = spark.createDataFrame([(*r, [i, i]) for i, r in enumerate(rows)], SCHEMA)
    for limit in (10, 500):  # the second: groups longer than three buckets
        got = [r.n_words for r in A.aggregate_paragraphs(df, limit, rows_per_bucket=64, per_block=4).orderBy(
            "agg_order").collect()]
        assert got == [x[1] for x in _segment_then_greedy(rows, limit)]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert A.aggregate_paragraphs(df, 5).count() == 0


def test_reindex_recounts_words_and_positions(spark):
    df = spark.createDataFrame([("a b  c", 10), ("d", 30), (" e f ", 20)], "paragraphs string, paragraphs_index bigint")
    got = [(r.paragraphs_index, r.n_words) for r in A.reindex(df).orderBy("paragraphs_index").collect()]
    assert got == [(0, 3), (1, 2), (2, 1)]


def test_reindex_follows_files_not_the_index(spark, tmp_path):
    """Two tables with the same index, and one without any: file order counts."""
    one = spark.createDataFrame([(f"a{i}", i) for i in range(4)], "paragraphs string, paragraphs_index bigint")
    two = spark.createDataFrame([(f"b{i}", i) for i in range(3)], "paragraphs string, paragraphs_index bigint")
    paths = [f"{tmp_path}/{x}.parquet" for x in "ab"]
    for path, df in zip(paths, (one, two), strict=True):
        io.write_parquet(df, path, order_cols=("paragraphs_index",))
    want = ["a0", "a1", "a2", "a3", "b0", "b1", "b2"]
    for df in (io.read_paragraphs(spark, *paths), io.read_paragraphs(spark, *paths).drop("paragraphs_index")):
        out = A.reindex(df).orderBy("paragraphs_index").collect()
        assert [r.paragraphs for r in out] == want and [r.paragraphs_index for r in out] == list(range(7))


def test_repeated_index_without_files_is_rejected(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0), ("c", 2)], "paragraphs string, paragraphs_index bigint")
    with pytest.raises(ValueError, match="unique"):
        A.reindex(df)


def test_conversations_bucket_independent(spark):
    """Two order keys, not dense: tiny buckets give the same aggregates as large ones."""
    rows = Q.conversation_rows(spark, "/root/testdata/sf0.001")
    key = lambda r: (tuple(r.agg_order), r.paragraphs, r.n_words, r.text_ids, tuple(r.spans))
    one = sorted(map(key, A.aggregate_paragraphs(rows, 150, order_col=("conv_id", "turn")).collect()))
    many = sorted(map(key, A.aggregate_paragraphs(rows, 150, order_col=("conv_id", "turn"),
                                                  rows_per_bucket=8, per_block=2).collect()))
    assert one == many and len(one) > 0


@pytest.mark.parametrize("keys", [(None, 5), (4, 4)])
def test_open_order_is_rejected(spark, keys):
    df = spark.createDataFrame([(*ROWS[0], keys[0]), (*ROWS[1], keys[1])], SCHEMA + ", o bigint")
    with pytest.raises(ValueError, match="unique"):
        A.aggregate_paragraphs(df, 3, order_col="o")


def test_numbering_without_moving_rows(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 3).alias("k"))
    d = ordering.in_order(df.orderBy(F.rand(1)), ["k"])
    for n in (ordering.number(d, "pos"), ordering.number_rows(d, "pos"), ordering.number(d, "pos", broadcast_rows=-1)):
        assert [r.pos for r in n.orderBy("k").collect()] == list(range(1000))
    # rows that a shuffle has torn apart, or that lack some of their file, are put in order first
    torn = ordering.number(d.repartition(7, "k"), "pos").orderBy("k").collect()
    assert [r.pos for r in torn] == list(range(1000))
    some = ordering.number_rows(d.where("k % 2 = 0"), "pos").orderBy("k").collect()
    assert [r.pos for r in some] == list(range(500))
