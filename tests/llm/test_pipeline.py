"""The pipeline against a brute-force version, and the registered queries."""

from collections import Counter

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from quire.llm import qualityrules

from .conftest import frame, prose
from .test_dedup import brute_exact, brute_near
from .test_scans import brute_mask


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "secret_scan", "pack"]


def test_pipeline(spark, rows, labels, tmp_path):
    import random

    rng = random.Random(1)
    rows = [*rows, (400, prose(rng, 90) + " password: abcdefgh12345"), (401, "bad### " * 70)]
    docs = frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    forest = qualityrules.fit(docs, labels)
    judged = qualityrules.verdicts(qualityrules._statistics([t or "" for _, t in rows]), forest)
    left = [r for r, ok in zip(rows, judged, strict=True) if ok]
    assert 5 < len(left) < len(rows)
    kept = Counter(k[0] for k in brute_exact(left) if k[3])
    left = list({(i, t) for i, t in left if kept[i]})
    kept = {k[0] for k in brute_near(left) if k[3]}
    left = [(i, brute_mask(t)) for i, t in left if i in kept]
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = Counter({i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in left})
    found = Counter()
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        found[r.doc_id] += r.length
    assert found == want
    assert np.all([n > 0 for n in found.values()])


def test_queries_are_registered():
    names = list(entry.queries())
    assert sum(n.startswith("op") and n[2].isdigit() for n in names) == 13 and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
