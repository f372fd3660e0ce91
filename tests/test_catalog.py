"""Catalog side and I/O round trips."""

import os

import pytest

from quire.operators import catalog as C
from quire.operators import ordering
from quire.sources import io


def test_extract_metadata(spark):
    df = spark.createDataFrame(
        [("12", ("it", "u/12"), 5), (" 007 ", ("pt", "u/7"), 6), ("draft", ("pt", None), 7)],
        "id string, metadata struct<language string, url string>, other int")
    got = C.extract_metadata(df)
    assert got.columns == ["language", "url", "text_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        [("it", "u/12", 12), ("pt", "u/7", 7), ("pt", None, None)], key=str)


def test_merge_and_select(spark):
    cat = spark.createDataFrame([(i, "Text", "1901", f"T{i}", lang, "a", "s", "PZ", shelf)
                                 for i, lang, shelf in ((3, "it", "Novels"), (4, "pt", None), (9, "it", "Crime"))],
                                io.CATALOG_SCHEMA)
    meta = spark.createDataFrame([("it", 4), ("xx", 9), ("it", 10), ("it", None), ("yy", 9)], "language string, text_id bigint")
    got = C.merge_catalog(cat, meta)
    assert got.columns == ["Language", "text_id", "Bookshelves"]
    assert [tuple(r) for r in got.orderBy("text_id").collect()] == [("pt", 4, None), ("it", 9, "Crime"), ("it", 9, "Crime")]


def test_kept_books(spark):
    rows = [("it", "Crime, Romance", 1), ("it", "Crime; Cooking", 2), ("pt", "mythology & legends", 3),
            ("nl", "Fantasy", 4), ("pt", "Category: Short Stories", 5)]
    df = spark.createDataFrame(rows, "Language string, Bookshelves string, text_id int")
    got = C.kept_books(df, ["it", "pt"])
    assert got.columns == df.columns
    assert [r.text_id for r in got.orderBy("text_id").collect()] == [1, 3, 5]


def test_kept_books_null_shelf_and_trailing_separator(spark):
    df = spark.createDataFrame([("en", None, 0), ("en", "fantasy;", 1), ("en; fr", "fantasy", 2)],
                               "Language string, Bookshelves string, text_id int")
    assert C.kept_books(df).count() == 0


def test_filter_corpus(spark):
    df = spark.createDataFrame([("a", "20"), ("b", "021"), ("c", "22"), ("d", "none"), ("e", None)], "note string, id string")
    for bound in (-1, 100):
        got = C.filter_corpus(df, [21, 22, 30], broadcast_rows=bound)
        assert sorted(r.note for r in got.collect()) == ["b", "c"]


def test_csv_round_trip_with_index(spark, tmp_path):
    df = spark.createDataFrame([(f"v{i}", i) for i in range(30)], "name string, o long")
    io.write_csv_with_index(ordering.in_order(df, ["o"], keep_order=False), f"{tmp_path}/m.csv")
    back = io.read_csv_with_index(spark, f"{tmp_path}/m.csv", "idx long, name string")
    assert [(r.idx, r.name) for r in back.orderBy("idx").collect()] == [(i, f"v{i}") for i in range(30)]
    io.write_csv_with_index(df.select("name"), f"{tmp_path}/n.csv")
    back = io.read_csv_with_index(spark, f"{tmp_path}/n.csv", "idx long, name string")
    assert sorted(r.idx for r in back.collect()) == list(range(30))


def test_parquet_suffix_required(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        io.write_parquet(df, "/tmp/not-a-parquet-name")


def test_read_corpus_order_follows_files_and_rows(spark, tmp_path):
    for k in range(2):
        rows = [(str(10 * k + i), f"t{i}", "s", "a", ("l", "en", "u", "t")) for i in range(3)]
        spark.createDataFrame(rows, io.CORPUS_SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/part{k}.parquet")
    c = io.read_corpus(spark, f"{tmp_path}/part*.parquet")
    assert [r.id for r in c.orderBy(*ordering.PLACE).collect()] == ["0", "1", "2", "10", "11", "12"]
    assert ordering.number_rows(c, "n").where("cast(id as int) % 10 + 3 * (cast(id as int) div 10) != n").count() == 0


def test_read_catalog_gzip_multiline(spark, tmp_path):
    import gzip

    text = ('Text#,Type,Issued,Title,Language,Authors,Subjects,LoCC,Bookshelves\n'
            '31,Text,1903-05-01,"Tides, and other tales","it","Rossi, Ada","Sea;\nstories",PZ,"Category: Crime; Romance"\n'
            '32,Text,1904-06-02,"The ""last"" one",pt,Nobody,,PQ,\n')
    with gzip.open(os.path.join(tmp_path, "catalog.csv.gz"), "wt", encoding="utf-8") as f:
        f.write(text)
    got = io.read_catalog(spark, f"{tmp_path}/catalog.csv.gz", partitions=2)
    rows = {r["Text#"]: r for r in got.collect()}
    assert rows[31].Title == "Tides, and other tales" and rows[31].Subjects == "Sea;\nstories"
    assert rows[31].Bookshelves == "Category: Crime; Romance"
    assert rows[32].Title == 'The "last" one' and rows[32].Bookshelves is None
