"""Work that has to grow with the input only: as many tasks, patterns and hashes as the rows ask for."""

import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.functions import constants as K
from quire.functions import text as X
from quire.operators import abbreviations, aggregate, chunks, paragraphs
from quire.plans import queries

SCHEMA = "paragraphs string, text_ids long, spans array<long>, chapters string, paragraphs_index long, n_words long"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, n=400):
    rng = random.Random(5)
    rows = [(f"p{i}", i // 90, [i, i + 1], f"c{i // 40}", i, rng.randint(0, 9)) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_tiny_buckets_share_tasks(spark):
    """Tasks of the text shuffle are as many as rows ask for, not one for 16 buckets of any size."""
    plan = plan_of(aggregate.aggregate_paragraphs(table(spark), 20, rows_per_bucket=2, n_rows=400))
    width = spark.conf.get("spark.sql.shuffle.partitions")
    dealt = [line for line in plan.splitlines() if "REPARTITION_BY_NUM" in line and "_b" in line]
    assert dealt and all(f", {width})" in line for line in dealt)


@pytest.mark.parametrize("per_block", [2, 3])
def test_blocks_are_folded_as_a_tree(spark, monkeypatch, per_block):
    want = aggregate.aggregate_paragraphs(table(spark), 20).collect()
    calls, carried = [], aggregate.carried

    def counted(*args):
        calls.append(args)
        return carried(*args)

    monkeypatch.setattr(aggregate, "BUCKETS_PER_BLOCK", 8)
    monkeypatch.setattr(aggregate, "carried", counted)
    got = aggregate.aggregate_paragraphs(table(spark), 20, rows_per_bucket=3, per_block=per_block).collect()
    assert len(calls) > 1 and sorted(got, key=str) == sorted(want, key=str)


def test_rows_of_a_bucket_stay_together():
    keys = [0, 0, 1, 1, 1, 1, 1, 2, 5, 5]
    for size in (1, 2, 3, 4, 20):
        batches = [pa.record_batch({"k": keys[i:i + size]}) for i in range(0, len(keys), size)]
        found = [t.column("k").to_pylist() for t in aggregate._whole(iter([*batches, batches[0].slice(0, 0)]), "k")]
        assert [k for t in found for k in t] == keys and all(not set(a) & set(b) for a, b in zip(found, found[1:]))
    assert aggregate._runs(pa.array(keys).to_numpy()) == [(0, 2), (2, 7), (7, 8), (8, 10)]


def test_sentences_are_not_made_once_a_piece(spark):
    df = spark.createDataFrame([(" ".join(f"Word{i} ends here." for i in range(50)), 7)], "p string, n long")
    df = df.select(chunks.split_paragraph(F.col("p"), F.col("n")).alias("x"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 2  # for the counts and for the pieces
    assert [len(x.split()) for x in df.first().x] == [6] * 25


def test_few_paragraphs_need_no_hashes(monkeypatch):
    rng = random.Random(3)
    parts = [" ".join(rng.choice(["ka", "lo", "mi é", "𝒳"]) for _ in range(rng.randint(0, 12))) for _ in range(900)]
    book, begins, at = K.PARAGRAPH_MARKER.join(parts), [], 0
    for p in parts:
        begins.append(at)
        at += len(p) + len(K.PARAGRAPH_MARKER)
    lengths, want = [len(p) for p in parts], [book.find(p) for p in parts]
    assert paragraphs.hashed_offsets(book, begins, lengths) == want
    assert paragraphs.first_offsets(book, begins, lengths) == want  # by hashes: too many
    monkeypatch.setattr(paragraphs, "hashed_offsets", None)
    assert paragraphs.first_offsets(book, begins[:100], lengths[:100]) == want[:100]
    with pytest.raises(TypeError):
        paragraphs.first_offsets(book, begins, lengths)


def test_heading_start_admits_every_heading(spark):
    some = ["CHAPTER IV", "chapter X", "cHapter I. More", "I", "X", "IV", "AB", "A.", "A B.", " .", "  ", "No. 3--THE END", "Nob", "Part I.",
            "Part", "Chapter Ten", "* * * *", " \t****", "****", "***", "A quiet", "I\n", "I\r\n", "", " ", "é", "Ch", "V ", "\n* ** *", "M", "Z", None]
    df = spark.createDataFrame([(t,) for t in some], "t string")
    old = F.regexp_extract("t", K.HEADING_PATTERN, 0)
    assert df.where(~X.heading_or_empty(F.col("t")).eqNullSafe(old)).count() == 0
    assert df.where(~X.no_chapterization(F.col("t")).eqNullSafe(~F.col("t").rlike(K.HEADING_PATTERN))).count() == 0
    assert "substring(" in df.select(X.heading_or_empty(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()


def test_words_are_counted_before_patterns_read_them(spark):
    df = spark.createDataFrame([("Dr. Who met dr. Who. 12. 'x",), (None,)], "paragraphs string")
    found = abbreviations.period_statistics(df)
    assert "keys=[t#" in plan_of(found)
    assert sorted((r.word, r.n, r.n_period) for r in found.collect()) == [("dr", 2, 2), ("who", 2, 1)]


def test_encoder_hashes_a_token_once(monkeypatch):
    calls, md5 = [], hashlib.md5
    monkeypatch.setattr(hashlib, "md5", lambda x: calls.append(x) or md5(x))
    out = queries._hash_encoder()(["a b a", "B é a", ""])
    assert sorted(calls) == [b"a", b"b", "é".encode()] and out.sum(axis=1).tolist() == [3, 3, 0]


SPACED = ["", " ", "a", " a", "a ", "a b", " a  b ", "a\nb", "a\n\nb c", "\ta", "a b", "a\u0085", "　a", "a b c", "é ü", "𝒳 𝒴",
          "a​b", "\x1fa\x1c", "a  ", "  ", "a b c", None]


def test_single_spaces_need_no_pattern(spark):
    df = spark.createDataFrame([(t,) for t in SPACED], "t string")
    plan = df.select(X.word_count(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "replace(" in plan
    for r in df.select("t", X.word_count(F.col("t")).alias("n"), chunks._words(F.trim(F.col("t"))).alias("w")).collect():
        assert r.n == (None if r.t is None else len(r.t.split()))
        if r.t is not None and r.t.strip() == r.t.strip(" "):
            assert r.w == len(r.t.split()), r.t


def test_normalising_leaves_the_pattern_to_odd_books(spark):
    df = spark.createDataFrame([(t,) for t in [*SPACED, "a\r\n b\xa0  c", "a\n\n\n b", "a     b", "\t \n"]], "t string")
    old = F.col("t")
    for a, b in K.NORMALISE_REPLACEMENTS:
        old = F.replace(old, F.lit(a), F.lit(b))
    got = X.normalize_book(F.col("t")).alias("got")
    assert df.select("t", got).where(~F.col("got").eqNullSafe(F.regexp_replace(old, K.WS + "+", " "))).count() == 0
    plan = df.select(got)._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan and plan.count("regexp_replace") == 1


def test_books_are_sent_to_python_once(spark):
    text = "CHAPTER I\n\nA quiet night in town.\n\nA quiet night in town."
    corpus = spark.createDataFrame([("1", text)], "id string, text string")
    books = paragraphs.book_paragraph_arrays(corpus, true_spans=True)
    assert plan_of(books).count("ArrowEvalPython") == 1
    row = books.first()
    assert row["_starts"] == [13, 13] and row["_tstarts"] == [13, 39]


def test_both_kinds_of_groups_read_one_shuffle_and_join_texts_once(spark):
    path = aggregate.cut(table(spark))
    df = aggregate.aggregate_paragraphs(path, 20, rows_per_bucket=7, n_rows=400)
    optimised = df._jdf.queryExecution().optimizedPlan().toString()
    assert optimised.count("array_join(") == 2 and optimised.count("sort_array(") == 2  # once in each branch
    df.collect()
    assert "ReusedExchange" in plan_of(df)


def test_narrow_tasks_follow_buckets(spark, monkeypatch):
    monkeypatch.setattr(aggregate, "LEAST_BUCKETS", 20)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert aggregate._narrow_tasks(table(spark), 1) == 1
    assert aggregate._narrow_tasks(table(spark), 10**6) == width
    marks = plan_of(aggregate.start_marks(table(spark), 20, K.COL_INDEX, 2, 3, 400))
    assert f"{min(width, 10)}), REPARTITION_BY_NUM" in marks


def test_words_that_are_counted_are_not_counted_again(spark):
    df = spark.createDataFrame([("a b", 2, 1, [0, 3], None, 0)], "paragraphs string, n_words long, text_ids long, spans array<long>, "
                               "chapters string, agg_order long")
    plans = [chunks.break_paragraphs(df, 5, counted=c)._jdf.queryExecution().optimizedPlan().toString() for c in (True, False)]
    assert plans[0].count("split(") < plans[1].count("split(")
    assert chunks.break_paragraphs(df, 5, counted=True).collect() == chunks.break_paragraphs(df, 5).collect()
