"""Exact and near dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import exactdedup, fuse, neardedup
from quire.llm.components import components

from .conftest import frame, prose


def test_filters_hold_all_their_keys():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 10, 1000, 50_000):
        keys = rng.integers(0, 2 ** 64, n, dtype=np.uint64)
        data = fuse.build(np.concatenate([keys, keys[:5]]))
        assert fuse.probe(data, keys).all()
        others = rng.integers(0, 2 ** 64, 20_000, dtype=np.uint64)
        assert fuse.probe(data, others).mean() < 0.02
    assert len(data) < 1.3 * n


def brute_exact(rows):
    sha = [hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest() for _, t in rows]
    size = Counter(sha)
    keep = {}
    for (i, _), s in zip(rows, sha, strict=True):
        keep[s] = min((x for x in (keep.get(s), i) if x is not None), default=None)
    out, seen = Counter(), set()
    for (i, _), s in zip(rows, sha, strict=True):
        first = i == keep[s] and s not in seen
        if first:
            seen.add(s)
        out[(i, keep[s], size[s], first, s)] += 1
    return out


@pytest.mark.parametrize("shard_keys", [4, exactdedup.SHARD_KEYS])
def test_exact(docs, rows, shard_keys):
    found = Counter(tuple(r) for r in exactdedup.exact_dedup(docs, shard_keys).collect())
    assert found == brute_exact(rows)


def test_exact_when_pairs_are_not_broadcast(docs, rows, monkeypatch):
    monkeypatch.setattr(exactdedup, "BROADCAST_PAIRS", -1)
    assert Counter(tuple(r) for r in exactdedup.exact_dedup(docs).collect()) == brute_exact(rows)
    left = exactdedup.without_copies(docs)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(k[0] for k in brute_exact(rows) if k[3])


def test_texts_that_differ_under_one_digest_fail(spark, monkeypatch):
    """With a digest that all texts of a length share, equal digests aren't equal texts."""
    monkeypatch.setattr(exactdedup, "digest", lambda: F.sha2(F.length(exactdedup.normalised()).cast("string"), 256).cast("binary"))
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.when(
        F.pmod(F.xxhash64("id"), F.lit(2)) == 0, "same").otherwise("text").alias("text"))
    with pytest.raises(Exception, match="texts of one digest differ"):
        exactdedup.exact_dedup(docs).collect()
    same = docs.withColumn("text", F.lit("same"))
    assert exactdedup.exact_dedup(same).where("kept").count() == 1


def test_a_text_that_is_gone_fails(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "doc_id long, text string")
    sha = hashlib.sha256(b"a").digest()
    matched = spark.createDataFrame([(bytearray(sha), 1, 2)], "digest binary, keep_id long, old_id long")
    with pytest.raises(Exception, match="a text to compare is gone"):
        exactdedup._byte_checked(matched, docs).collect()


@pytest.mark.parametrize("pairs", [exactdedup.BROADCAST_PAIRS, -1])
def test_repeated_rows_keep_their_columns(spark, pairs, monkeypatch):
    monkeypatch.setattr(exactdedup, "BROADCAST_PAIRS", pairs)
    data = [(1, "a  b", "x", 1.5), (1, "a b", "x", 1.5), (2, "a\tb", "y", None), (3, "c", None, 2.0), (None, "c", "z", 2.0), (None, None, "q", None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, __digest string, `odd name` double")
    left = exactdedup.without_copies(docs).collect()
    assert sorted(((r.doc_id, r["__digest"], r["odd name"]) for r in left), key=repr) == sorted(
        [(1, "x", 1.5), (3, None, 2.0), (None, "q", None)], key=repr)


def test_without_copies(docs, rows):
    left = exactdedup.without_copies(docs)
    assert left.columns == docs.columns
    want = Counter(k[0] for k in brute_exact(rows) if k[3])
    assert Counter(r.doc_id for r in left.collect()) == want


def shingle_set(text):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", words)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)])


def brute_near(rows, percent=80):
    sets = [shingle_set(t) for _, t in rows]
    head = list(range(len(rows)))

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and 100 * len(x & y) >= percent * len(x | y):
                head[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min((x for x in (least.get(find(k)), i) if x is not None), default=None)
    out = Counter()
    for k, (i, _) in enumerate(rows):
        comp = least[find(k)] if sets[k] else i
        out[(i, len(sets[k]), comp, comp == i)] += 1
    return out


@pytest.mark.parametrize("percent", [80, 85])
def test_near(docs, rows, percent):
    found = Counter(tuple(r) for r in neardedup.near_duplicates(docs, neardedup.MinHash(percent=percent)).collect())
    assert found == brute_near(rows, percent)


def test_default_is_four_fifths(spark):
    """Two texts of similarity 0.82 are near copies unless 0.85 is asked for."""
    words = prose(random.Random(2), 400).split()
    near = [f"x{k}" if k in (50, 90, 130, 170, 210, 250, 290, 330) else w for k, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(near))]
    x, y = (shingle_set(t) for _, t in rows)
    assert 0.80 < len(x & y) / len(x | y) < 0.85
    docs = frame(spark, rows)
    assert [r.doc_id for r in neardedup.without_near_copies(docs).collect()] == [1]
    assert neardedup.without_near_copies(docs, neardedup.MinHash(percent=85)).count() == 2


def test_near_chains_and_stragglers(spark, monkeypatch):
    """A group whose members mostly aren't like its smallest: later links must still be found, over several blocks."""
    monkeypatch.setattr(neardedup, "BLOCK", 8)
    rng = random.Random(8)
    words = prose(rng, 150).split()
    rows = []
    for k in range(60):
        near = list(words)
        for _ in range(k % 7):
            near[rng.randrange(len(near))] = f"w{k}"
        rows.append((k + 1, " ".join(near)))
    chain = prose(rng, 100).split()
    for k in range(25):
        rows.append((1000 - k, " ".join(chain[k:] + [f"c{j}" for j in range(k)])))
    found = Counter(tuple(r) for r in neardedup.near_duplicates(frame(spark, rows)).collect())
    assert found == brute_near(rows)


def test_without_near_copies(docs, rows, monkeypatch):
    want = Counter(k[0] for k, n in brute_near(rows).items() if k[3] or k[0] is None for _ in range(n))
    for bound in (neardedup.BROADCAST_ROWS, -1):
        monkeypatch.setattr(neardedup, "BROADCAST_ROWS", bound)
        left = neardedup.without_near_copies(docs)
        assert left.columns == docs.columns
        assert Counter(r.doc_id for r in left.collect()) == want


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [
        (2000, 2001 + i) for i in range(50)] + [(5, 5)]
    head = {}

    def find(x):
        head.setdefault(x, x)
        while head[x] != x:
            x = head[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            head[max(a, b)] = min(a, b)
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {x: find(x) for x in list(head)}


def test_empty_tables(no_docs):
    assert exactdedup.exact_dedup(no_docs).count() == 0
    assert exactdedup.without_copies(no_docs).count() == 0
    assert neardedup.near_duplicates(no_docs).count() == 0
    assert neardedup.without_near_copies(no_docs).count() == 0
