"""Incremental stage 1 over a growing corpus folder."""

import tempfile

from quire.operators import paragraphs as P
from quire.sources import io
from quire.streaming import paragraph_stream as S


def _write(spark, d, name, ids):
    rows = [(str(i), f"CHAPTER I\n\nBook {i} opens with this paragraph.\n\nThen book {i} goes on here.",
             "s", "a", (None, "en", "u", "t")) for i in ids]
    spark.createDataFrame(rows, io.CORPUS_SCHEMA).coalesce(1).write.parquet(f"{d}/corpus/{name}")


def test_stream_is_incremental_and_matches_batch(spark):
    d = tempfile.mkdtemp(prefix="quire-stream-")
    _write(spark, d, "f0.parquet", [1, 2])
    kept = spark.createDataFrame([(1,), (2,), (4,)], "text_id bigint")
    q = S.start(spark, f"{d}/corpus/*.parquet", f"{d}/out", f"{d}/ckpt", kept)
    q.awaitTermination()
    assert spark.read.parquet(f"{d}/out").count() == 4
    _write(spark, d, "f1.parquet", [3, 4])
    q = S.start(spark, f"{d}/corpus/*.parquet", f"{d}/out", f"{d}/ckpt", kept)
    q.awaitTermination()
    got = S.index_stream_output(spark, f"{d}/out")
    assert got.count() == 6  # book 3 is not kept; nothing is processed twice
    batch = P.paragraphs(io.read_corpus(spark, f"{d}/corpus/*.parquet").where("id in ('1','2','4')"))
    key = lambda r: (r.paragraphs_index, r.paragraphs, r.text_ids, tuple(r.spans), r.chapters)
    assert sorted(map(key, got.collect())) == sorted(map(key, batch.collect()))
