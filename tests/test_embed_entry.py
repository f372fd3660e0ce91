"""Embeddings, jobs end to end, and the driver contract."""

import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as E
from quire.operators import embed
from quire.plans import jobs, oracle, queries
from quire.sources import io

SF = "/root/testdata/sf0.001"


def test_unit_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    got = [r.u for r in df.select(embed.unit_vector(F.col("v")).alias("u")).collect()]
    assert got == [[0.6, 0.8], [0.0, 0.0]]


def test_unit_vectors_grow_linearly(spark):
    """Time for 2,000 vectors must not grow faster than their length (with room for noise)."""
    import time

    took = {}
    for d in (256, 256, 2048):  # the first warms up
        df = spark.range(2000).select(F.transform(F.sequence(F.lit(1), F.lit(d)), lambda x: x.cast("float")).alias("v"))
        df = df.select(embed.unit_vector(F.col("v")).alias("u"))
        t = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        took[d] = time.perf_counter() - t
    assert took[2048] < 8 * 3 * took[256] + 2


def test_embed_with_custom_encoder(spark):
    def make():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    df = spark.createDataFrame([("abc",), ("",)], "paragraphs string")
    out = embed.embed_with(df, make, batch_size=1).collect()
    for r in out:
        assert abs(sum(x * x for x in r.embedding) - 1.0) < 1e-5


def test_embed_hashing_unit_length(spark):
    df = spark.createDataFrame([("The cat sat.",), ("Dogs, dogs and more dogs",)], "paragraphs string")
    for r in embed.embed_hashing(df, dim=32).collect():
        assert len(r.embedding) == 32 and abs(sum(x * x for x in r.embedding) - 1) < 1e-9


def cut_tables(spark):
    ckpt = spark.sparkContext.getCheckpointDir().replace("file:", "")
    return {f for f in os.listdir(ckpt) if f.startswith("quire-")}


def test_jobs_round_trip(spark):
    d = tempfile.mkdtemp(prefix="quire-jobs-")
    rows = [(str(i), f"CHAPTER I\n\nBook {i} has a first paragraph of words.\n\nAnd a second one that is longer. "
                     f"It has two sentences here.", "s", "a", (None, "en", "u", "t")) for i in range(1, 5)]
    spark.createDataFrame(rows, io.CORPUS_SCHEMA).write.parquet(f"{d}/corpus.parquet")
    with open(f"{d}/catalog.csv", "w") as f:
        f.write("Text#,Type,Issued,Title,Language,Authors,Subjects,LoCC,Bookshelves\n")
        for i, (lang, shelf) in enumerate([("en", "Novels"), ("en", "Poetry"), ("fr", "Novels"),
                                           ("en", '"Category: Novels; Category: Romance"')], start=1):
            f.write(f"{i},Text,2000,T,{lang},A,S,PZ,{shelf}\n")
    before = cut_tables(spark)
    jobs.books_to_paragraphs(spark, f"{d}/corpus.parquet", f"{d}/catalog.csv", f"{d}/paragraphs.parquet",
                             metadata_csv=f"{d}/metadata_ids.csv")
    p = spark.read.parquet(f"{d}/paragraphs.parquet")
    assert sorted({r.text_ids for r in p.collect()}) == [1, 4]
    assert sorted(r.paragraphs_index for r in p.collect()) == list(range(4))
    jobs.paragraphs_to_chunks(spark, f"{d}/paragraphs.parquet", f"{d}/chunks", max_p_length=8, threshold_min=5)
    c = spark.read.parquet(f"{d}/chunks")
    assert c.count() > 0 and c.columns == ["paragraphs", "n_words", "text_ids", "spans", "chapters", "splitted_paragraphs"]
    assert os.path.exists(f"{d}/metadata_ids.csv")
    assert cut_tables(spark) <= before, "a job left its cut tables behind"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "paragraphs" in df.columns


def test_contract_keys():
    assert set(E.oracle_sql()) <= set(E.queries())
    # each of the reference's own operators has SQL to hold it against
    assert set(oracle.ORACLE) == set(queries.QUERIES) <= set(E.queries())


def test_embed_slice(spark):
    rows = [(f"paragraph number {i} text", 0, [i, i + 1], "I", i, 3) for i in range(50)]
    df = spark.createDataFrame(rows, "paragraphs string, text_ids bigint, spans array<bigint>, chapters string, "
                                     "paragraphs_index bigint, n_words bigint")
    out = jobs.embed_slice(df, 10, 20).collect()
    assert sorted(r.paragraphs_index for r in out) == list(range(10, 20))
    assert all(abs(sum(x * x for x in r.embedding) - 1) < 1e-9 for r in out)
    assert jobs.embed_slice(df).count() == 50


def test_left_tables_are_deleted_in_the_end(spark):
    """What lazy results read outside jobs goes when the process ends (called here by hand)."""
    from quire.sources import checkpoint

    queries.QUERIES["chunks"](spark, SF).count()
    assert cut_tables(spark)
    checkpoint.delete_left()
    assert not cut_tables(spark)
    assert queries.QUERIES["chunks"](spark, SF).count() > 0  # derived anew
