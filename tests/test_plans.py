"""Scale properties of the physical plans: how often the text is shuffled."""

import re

from quire.operators import aggregate as A
from quire.operators import catalog as C
from quire.operators import ordering
from quire.operators import paragraphs as P
from quire.plans import bookview
from quire.plans import queries as Q

SF = "/root/testdata/sf0.001"


def _nodes(plan: str):
    """(depth, text) per plan line; depth from the tree-drawing prefix."""
    out = []
    for line in plan.splitlines():
        m = re.match(r"^([ :|+\-]*)(\S.*)$", line)
        if m:
            out.append((len(m.group(1)), m.group(2)))
    return out


def shuffles_above_text_scans(df, needle="paragraphs:string"):
    """For every scan whose schema contains ``needle``: shuffle exchanges above it."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    nodes = _nodes(plan)
    counts = []
    for i, (depth, text) in enumerate(nodes):
        if "FileScan" in text and needle in text:
            n, d = 0, depth
            for pd_, pt in reversed(nodes[:i]):
                if pd_ < d:
                    d = pd_
                    if pt.startswith("Exchange") and "SinglePartition" not in pt:
                        n += 1
                    if pt.startswith("Exchange SinglePartition"):
                        n += 100  # never acceptable above text
            counts.append(n)
    return counts


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_stage1_does_not_shuffle_text(spark, monkeypatch):
    """From the corpus scan to the numbered paragraphs, also if no side may be broadcast for the numbering."""
    counts = shuffles_above_text_scans(Q.paragraphs_job(spark, SF))
    assert counts and max(counts) == 0
    corpus = bookview.corpus(spark, SF)
    rows = P.explode_paragraphs(P.book_paragraph_arrays(corpus, keep=ordering.PLACE), keep=ordering.PLACE)
    counts = shuffles_above_text_scans(rows, needle="text:string")
    assert counts and max(counts) == 0


def test_stage1_book_pipeline_does_not_shuffle_text(spark):
    """Corpus scan -> kept-ids semi-join -> per-book arrays: the text stays put."""
    kept = Q.kept_books(spark, SF).select("text_id")
    books = P.book_paragraph_arrays(C.filter_corpus(bookview.corpus(spark, SF), kept))
    counts = shuffles_above_text_scans(books, needle="text:string")
    assert counts and max(counts) == 0


def test_stage2_shuffles_text_once(spark):
    """One shuffle by bucket; only the rows of groups over an edge meet again, in the second branch of the union."""
    df = A.aggregate_paragraphs(Q.paragraphs_indexed_df(spark, SF), 120, rows_per_bucket=100)
    plan = plan_of(df)
    by_bucket = [line for line in plan.splitlines() if "REPARTITION_BY_NUM" in line]
    assert by_bucket and all("hashpartitioning(_b" in line for line in by_bucket)
    assert sorted(shuffles_above_text_scans(df)) == [1, 2]
    assert "SinglePartition" not in plan and "Broadcast" not in plan


def test_marks_have_no_group_for_all(spark):
    """The scan's plan: the only single partition holds one row per block of buckets."""
    p = Q.paragraphs_indexed_df(spark, SF)
    plan = plan_of(A.start_marks(p, 120, "paragraphs_index"))
    assert plan.count("SinglePartition") <= plan.count("MapInPandas") and "_one" not in plan
    assert "paragraphs:string" not in plan
