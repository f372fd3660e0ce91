"""Jobs: one run of stage 2, faults that are counted or raised, tables that are swapped in, slices, placement."""

import glob
import gzip
import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import text as X
from quire.operators import abbreviations, bloom, embed, ordering
from quire.operators import catalog as C
from quire.operators import paragraphs as P
from quire.plans import jobs
from quire.sources import io

HEADER = "Text#,Type,Issued,Title,Language,Authors,Subjects,LoCC,Bookshelves\n"


def write_corpus(spark, path, ids):
    rows = [(i, f"CHAPTER I\n\nthe book {i} has a first paragraph\n\nand the book {i} has a second one. It ends here.", "s", "a",
             ("l", "en", f"u/{i}", f"T{i}")) for i in ids]
    spark.createDataFrame(rows, io.CORPUS_SCHEMA).coalesce(1).write.parquet(path)


def write_catalog(path, lines):
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(HEADER + "".join(f"{x}\n" for x in lines))


@pytest.fixture
def shelf(spark, tmp_path):
    """A corpus of 12 books, three of which have an id that is no number, and a catalog with faults."""
    write_corpus(spark, f"{tmp_path}/corpus.parquet", [*map(str, range(1, 10)), "draft", "x7", "8.5"])
    good = [f"{i},Text,1903,T{i},en,A,S,PZ,Crime" for i in range(1, 9)]
    write_catalog(f"{tmp_path}/good.csv.gz", [*good, "n.a.,Text,1903,T,en,A,S,PZ,Crime", "9,Text,1903,short"])
    write_catalog(f"{tmp_path}/long.csv.gz", [*good, '9,Text,1903,T9,en,A,"S, S",PZ,Crime,more'])
    return tmp_path


def test_the_books_job_counts_faults(spark, shelf):
    got = jobs.books_to_paragraphs(spark, f"{shelf}/corpus.parquet", f"{shelf}/good.csv.gz", f"{shelf}/p.parquet",
                                   metadata_csv=f"{shelf}/m.csv")
    assert got == {"books": 12, "junk_ids": 3, "lines": 10, "long_lines": 0, "odd_ids": 1, "paragraphs": 16}
    assert spark.read.parquet(f"{shelf}/p.parquet").count() == 16
    meta = io.read_csv_with_index(spark, f"{shelf}/m.csv", "i long, license string, language string, url string, title string, id long")
    assert [r.id for r in meta.orderBy("i").collect()] == [*range(1, 10), None, None, None]


def test_a_long_catalog_line_fails_the_job_and_leaves_its_old_output(spark, shelf):
    out = f"{shelf}/p.parquet"
    jobs.books_to_paragraphs(spark, f"{shelf}/corpus.parquet", f"{shelf}/good.csv.gz", out)
    before = sorted(glob.glob(f"{out}/*"))
    with pytest.raises(Exception, match="too many fields: 9"):
        jobs.books_to_paragraphs(spark, f"{shelf}/corpus.parquet", f"{shelf}/long.csv.gz", out)
    assert sorted(glob.glob(f"{out}/*")) == before and spark.read.parquet(out).count() == 16
    got = jobs.books_to_paragraphs(spark, f"{shelf}/corpus.parquet", f"{shelf}/long.csv.gz", out, malformed="null")
    assert got["long_lines"] == 1 and got["paragraphs"] == 18 == spark.read.parquet(out).count()


def test_catalog_lines_are_marked(spark, shelf):
    for name, want in (("good", {None: 9, "id": 1}), ("long", {None: 8, "long": 1})):
        got = io.read_catalog(spark, f"{shelf}/{name}.csv.gz", malformed="mark")
        assert {r.malformed: r["count"] for r in got.groupBy("malformed").count().collect()} == want
        plain = io.read_catalog(spark, f"{shelf}/{name}.csv.gz")
        assert plain.schema == io.CATALOG_SCHEMA and plain.count() == sum(want.values())
    short = io.read_catalog(spark, f"{shelf}/good.csv.gz").where("`Text#` = 9").first()
    assert short.Title == "short" and short.Bookshelves is None
    with pytest.raises(ValueError, match="malformed"):
        io.read_catalog(spark, f"{shelf}/good.csv.gz", malformed="skip")


def failing(df):
    return df.withColumn("n", F.when(F.col("n") == 7, F.raise_error(F.lit("no more")).cast("long")).otherwise(F.col("n")))


def test_a_failing_task_leaves_the_old_table(spark, tmp_path):
    old = spark.range(5).select(F.col("id").alias("n"))
    io.write_parquet(old, f"{tmp_path}/t.parquet")
    io.write_csv_with_index(old, f"{tmp_path}/t.csv")
    new = spark.range(20).select(F.col("id").alias("n")).repartition(4)
    for write in (lambda: io.write_parquet(failing(new), f"{tmp_path}/t.parquet"),
                  lambda: io.write_csv_with_index(failing(new), f"{tmp_path}/t.csv")):
        with pytest.raises(Exception, match="no more"):
            write()
    assert spark.read.parquet(f"{tmp_path}/t.parquet").count() == 5
    assert io.read_csv_with_index(spark, f"{tmp_path}/t.csv", "i long, n long").count() == 5
    assert sorted(os.listdir(tmp_path)) == ["t.csv", "t.parquet"]
    # a table may be made from itself
    io.write_parquet(spark.read.parquet(f"{tmp_path}/t.parquet").where("n > 1"), f"{tmp_path}/t.parquet")
    assert sorted(r.n for r in spark.read.parquet(f"{tmp_path}/t.parquet").collect()) == [2, 3, 4]
    assert sorted(os.listdir(tmp_path)) == ["t.csv", "t.parquet"]


def paragraph_rows(spark, n=200):
    rows = [(f"Paragraph {i} has some words. It goes on " + "and on " * (i % 40) + "Then it ends.", i // 50, [0, 9], f"CHAPTER {i // 25}", i)
            for i in range(n)]
    return spark.createDataFrame(rows, "paragraphs string, text_ids long, spans array<long>, chapters string, paragraphs_index long")


def test_stage_two_runs_once_for_its_files(spark, tmp_path, monkeypatch):
    """Rows that pass the sentence packing, counted in the tasks."""
    io.write_parquet(paragraph_rows(spark), f"{tmp_path}/p.parquet", order_cols=("paragraphs_index",))
    seen = spark.sparkContext.accumulator(0)
    real = jobs.chunks.break_paragraphs

    def watched(df, *args, **kwargs):
        def look(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch
        return real(df.mapInArrow(look, df.schema), *args, **kwargs)

    monkeypatch.setattr(jobs.chunks, "break_paragraphs", watched)
    whole = jobs.paragraphs_to_chunks_df(io.read_paragraphs(spark, f"{tmp_path}/p.parquet"), 60, 40).collect()
    once, at = seen.value, len({r.agg_order for r in whole})
    assert once == at
    jobs.paragraphs_to_chunks(spark, f"{tmp_path}/p.parquet", f"{tmp_path}/c", 60, 40, keep_order=True)
    assert seen.value == 2 * once
    # files, and rows in them, are in chunk order
    back = ordering.number_rows(ordering.with_place(spark.read.parquet(f"{tmp_path}/c")), "row").orderBy("row").collect()
    assert [(r.agg_order, r.piece) for r in back] == sorted((r.agg_order, r.piece) for r in whole)
    assert len(glob.glob(f"{tmp_path}/c/*.parquet")) > 1


def test_ranges_follow_the_stored_bytes(spark, tmp_path):
    spark.range(200_000).selectExpr("id", "sha2(cast(id as string), 256) as h").write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    size = sum(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/t/*.parquet"))
    assert ordering.stored_bytes(t) == size
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert ordering.range_count(t) == least
    assert ordering.range_count(t, size // 50) in (50, 51) and ordering.range_count(t.join(t, "id"), size // 50) in (100, 101, 102)
    spread = ordering.dealt_by_position(t, "id", 200_000, ranges=40).groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) == 40 and {r["count"] for r in spread} == {5000}
    odd = ordering.dealt_by_position(spark.createDataFrame([(-5,), (0,), (10 ** 12,)], "p long"), "p", 10, ranges=3)
    assert [r.p for r in odd.collect()] == [-5, 0, 10 ** 12]


def test_no_path_is_broadcast(spark, tmp_path):
    """What reaches the rows of a block is two longs, whatever the paths' lengths."""
    long = tmp_path / ("a" * 120) / ("b" * 120)
    spark.range(3000).repartition(5).write.parquet(f"{long}/t")
    rows = ordering.with_place(spark.read.parquet(f"{long}/t"))
    for df in (ordering.number(rows, "n"), ordering.number_rows(rows, "n")):
        assert sorted(r.n for r in df.select("n").collect()) == list(range(3000))
        plan = df._jdf.queryExecution().executedPlan().toString()
        sent = [plan[m:] for m in range(len(plan)) if plan.startswith("BroadcastExchange", m)]
        assert sent and all("HashedRelationBroadcastMode(List(input[0, bigint" in s.splitlines()[0] for s in sent)
        for s in sent:  # the side's own output: key and number
            assert ordering.FILE not in s.splitlines()[1]


def test_keys_are_told_apart(spark):
    counted = spark.createDataFrame([(f"f{i}", b, 3) for i in range(50) for b in (0, 128)], f"{ordering.FILE} string, {ordering.BLOCK} long, _n long")
    salt = ordering.salt_of(counted, ordering.FILE, ordering.BLOCK)
    totals = ordering.block_totals(counted, salt, ordering.FILE, ordering.BLOCK)
    assert sorted(r._before for r in totals.collect()) == [3 * k for k in range(100)]
    assert all(ordering.FILE != c for c in totals.columns)
    with pytest.raises(RuntimeError, match="no keys"):
        ordering.salt_of(counted.unionByName(counted), ordering.FILE, ordering.BLOCK)


def test_screened_corpus_keeps_its_text_in_place(spark, tmp_path, monkeypatch):
    write_corpus(spark, f"{tmp_path}/c.parquet", [*map(str, range(3000)), "junk", "007"])
    corpus = io.read_corpus(spark, f"{tmp_path}/c.parquet")
    monkeypatch.setattr(ordering, "restored", lambda *a: pytest.fail("rows were moved"))
    keep = [*range(0, 3000, 3), 10 ** 9]
    got = C.filter_corpus(corpus, spark.createDataFrame([(k,) for k in [*keep, None, 3]], "text_id long"), broadcast_rows=-1)
    assert sorted(int(r.id) for r in got.select("id").collect()) == sorted([k for k in keep if k < 3000])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2
    monkeypatch.undo()
    # too many mistakes, or too large a filter: rows move, results don't change
    monkeypatch.setattr(bloom, "KEYS_PER_BLOCK", 10 ** 6)
    far = C.filter_corpus(corpus, keep, broadcast_rows=-1, false_ids=0)
    assert sorted(int(r.id) for r in far.select("id").collect()) == sorted([k for k in keep if k < 3000])
    monkeypatch.setattr(bloom, "MOST_BLOCKS", 0)
    far = C.filter_corpus(corpus, keep, broadcast_rows=-1)
    assert far.count() == 1000
    want = [r.paragraphs for r in P.paragraphs(C.filter_corpus(corpus, keep)).orderBy("paragraphs_index").collect()]
    assert [r.paragraphs for r in P.paragraphs(got).orderBy("paragraphs_index").collect()] == want


def test_a_filter_passes_its_keys_and_few_others(spark):
    keys = spark.range(20_000).selectExpr("id * 7 as k")
    blocks = bloom.block_count(20_000)
    table = bloom.build(keys, "k", blocks)
    assert table.count() <= blocks
    assert bloom.passing(keys, "k", table, blocks).count() == 20_000
    others = spark.range(200_000).selectExpr("id * 7 + 1 as k", "'x' as _lane0_", "cast(null as long) as n")
    assert bloom.passing(others, "k", table, blocks).count() < 400
    assert bloom.passing(others, "n", table, blocks).count() == 0
    assert bloom.passing(others, "k", table, blocks).columns == others.columns


def test_slice_reads_only_its_files(spark, tmp_path):
    path = f"{tmp_path}/a table%20"
    ordering.dealt_by_position(spark.range(1000).selectExpr("id", "id % 7 as v"), "id", 1000, ranges=10).write.parquet(path)
    every = [r.id for r in ordering.number_rows(ordering.with_place(spark.read.parquet(path)), "n").orderBy("n").collect()]
    for start, stop, files in ((0, 1000, 10), (250, 260, 1), (199, 201, 2), (0, 1, 1), (999, 5000, 1), (300, 700, 4)):
        got = io.read_slice(spark, path, start, stop)
        assert sorted(r.id for r in got.collect()) == sorted(every[start:stop])
        assert len(got.inputFiles()) == files and got.columns == ["id", "v"]
    for start, stop in ((1000, 1010), (5, 5), (7, 3), (-9, 0)):
        assert io.read_slice(spark, path, start, stop).collect() == []


def test_learned_abbreviations_keep_sentences_whole(spark):
    names = ["Smith", "Jones", "Baker", "Cole", "Reed"]
    lines = [f"Then Mr. {names[i % 5]} met Dr. {names[i % 3]} at the house number {i}. They spoke of tea, e.g. Assam, for an hour."
             f" The house was old. It had a garden. An hour in an old garden was well spent" for i in range(200)]
    df = spark.createDataFrame([(x,) for x in lines] + [(None,), ("",)], "paragraphs string")
    words = abbreviations.learned(df)
    assert {"mr", "dr", "e.g"} <= set(words) and not {"house", "old", "garden", "hour"} & set(words)
    text = "Mr. Smith went. He met DR. Cole, e.g. Then he left a mr. (Reed) Or not."
    got = spark.createDataFrame([(text,)], "t string").select(
        X.sentences(F.col("t"), words).alias("a"), X.sentences(F.col("t")).alias("b")).first()
    assert got.a == ["Mr. Smith went.", "He met DR. Cole, e.g. Then he left a mr. (Reed) Or not."]
    assert got.b[0] == "Mr." and len(got.b) > len(got.a)
    assert X.sentence_pattern([]) == X.SENTENCE
    # a word that ends in one of them is not one of them
    got = spark.range(1).select(X.sentences(F.lit("It was a kmr. Smith saw it. See x.mr. Go."), ["mr"]).alias("a")).first()
    assert got.a == ["It was a kmr.", "Smith saw it.", "See x.mr.", "Go."]


def test_learned_list_is_bounded_and_needs_both_kinds(spark):
    df = spark.createDataFrame([("a. b. c. d.",)] * 5 + [("x y z",)] * 5, "paragraphs string")
    assert len(abbreviations.learned(df, threshold=0.0, most=3)) <= 3
    for lines in (["a. b."], ["a b"], []):
        none = spark.createDataFrame([(x,) for x in lines], "paragraphs string")
        assert abbreviations.learned(none) == []


def test_job_two_with_abbreviations(spark, tmp_path):
    rows = [("He met Mr. Smith there. " * 30, 1, [0, 9], "CHAPTER I", 0)]
    spark.createDataFrame(rows, "paragraphs string, text_ids long, spans array<long>, chapters string, paragraphs_index long").write.parquet(
        f"{tmp_path}/p.parquet")
    jobs.paragraphs_to_chunks(spark, f"{tmp_path}/p.parquet", f"{tmp_path}/c", 20, 10, abbreviations=["mr"])
    assert all(r.paragraphs.startswith("He met Mr. Smith") for r in spark.read.parquet(f"{tmp_path}/c").collect())


def test_batches_are_sorted_by_length_and_put_back(spark):
    lengths = spark.sparkContext.accumulator(0)

    def make():
        def encode(texts):
            sizes = [len(t) for t in texts]
            assert sizes == sorted(sizes) and len(texts) <= 50
            lengths.add(max(sizes) * len(texts) - sum(sizes))
            return np.array([[n + 1.0, 1.0] for n in sizes])
        return encode

    data = [(i, None if i == 3 else "x" * (i * 37 % 400)) for i in range(1000)]
    df = spark.createDataFrame(data, "i long, paragraphs string").coalesce(1)
    out = embed.embed_with(df, make, batch_size=50, normalize=False).collect()
    assert [(r.i, r.paragraphs) for r in out] == data
    assert [r.embedding[0] for r in out] == [len(t or "") + 1 for _, t in data]
    padding = lengths.value
    unsorted = sum(max(len(t or "") for _, t in data[k:k + 50]) * 50 - sum(len(t or "") for _, t in data[k:k + 50]) for k in range(0, 1000, 50))
    assert padding < unsorted / 5


def test_a_profile_places_the_encoder(spark, monkeypatch):
    got = {}

    class Frame:
        schema = T.StructType([T.StructField("paragraphs", T.StringType())])

        def mapInPandas(self, run, schema, profile=None):
            got.update(schema=schema, profile=profile)
            return self

    profile = embed.device_profile("gpu", 2, 4)
    embed.embed_with(Frame(), lambda: None, profile=profile)
    assert got["profile"] is profile and got["schema"].names == ["paragraphs", "embedding"]
    assert profile.executorResources["gpu"].amount == 2 and profile.taskResources["gpu"].amount == 0.25
