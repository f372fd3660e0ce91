"""Quality classifier and rules: held-out accuracy, brute force, monotonic trees."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard

from quire.llm import compressed, labelled, qualityrules, trees

from .conftest import frame, prose


def made(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = prose(rng, rng.randint(60, 120))
        if i % 3 == 0:
            text = " ".join(w + rng.choice(["###", "$$$", "&&&"]) for w in text.split())
        elif i % 11 == 1:
            text = " ".join([text.split()[0]] * 80)
        out.append((i, text, int(i % 3 != 0 and i % 11 != 1)))
    return out


@pytest.fixture(scope="module")
def known(spark):
    rows = made(300, 7)
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows], "doc_id long, quality int, toxic int")
    return rows, frame(spark, [(i, t) for i, t, _ in rows]), labels


def test_samples_hold_nothing_out(known):
    rows, docs, labels = known
    got = labelled.sample(docs.unionByName(docs), labels, 40).collect()  # repeated rows count once
    assert Counter(r.quality for r in got) == {0: 40, 1: 40} and len({r.doc_id for r in got}) == 80
    assert all(r.text == dict((i, t) for i, t, _ in rows)[r.doc_id] for r in got)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 != 2 for r in got)
    assert set(got) == set(labelled.sample(docs.repartition(7), labels, 40).collect())


def brute_score(text, model):
    """Sizes and score of a whole text, with the library's compressor and plain loops."""
    if not text:
        return 0.0
    data = text.encode()
    parts = [data[i:i + 512] for i in range(0, len(data), 512)]
    g, b = [[len(zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=False,
                                          write_content_size=False, write_dict_id=False).compress(p)) for p in parts]
            for d in (model.good, model.bad)]
    ratio = math.log(((sum(g) + sum(b)) + 2) / 2 / (len(data) + 8))
    least = min(256, max(map(len, parts)))
    each = min(math.log((x + y) / 2 / (len(p) + 8)) for x, y, p in zip(g, b, parts) if len(p) >= least)
    x = [(sum(b) - sum(g)) / (sum(b) + sum(g)), ratio, ratio ** 2, min((y - x) / (x + y) for x, y in zip(g, b)), each, each ** 2]
    z = model.weights[0] + sum(w * (v - m) / s for w, v, m, s in zip(model.weights[1:], x, model.mean, model.scale, strict=True))
    return 1 / (1 + math.exp(-max(-50, min(50, z))))


def test_scores_are_those_of_whole_texts(known, spark):
    rows, docs, labels = known
    model = compressed.fit(docs, labels)
    assert model == compressed.fit(docs.repartition(3), labels)  # whatever the partitions
    long = [(1000, " ".join(t for _, t, q in rows if q)), (1001, "é" * 5000), (1002, ""), (1003, "x"), (1004, None)]
    every = docs.unionByName(frame(spark, long))
    text = {i: t for i, t, _ in rows} | dict(long)
    for r in compressed.quality_scores(every, labels).collect():
        assert math.isclose(r.score, brute_score(text[r.doc_id], model), abs_tol=1e-9)


def test_dictionaries_learn_from_whole_texts_and_own_lines(spark):
    """Segments come from all of a long text, and none from a line that two texts share."""
    rng = random.Random(4)
    shared = "licence " * 30
    rows = [(i, "\n".join([prose(rng, 2000 if i == 3 else 60), shared, f"last {i}"]), 1) for i in range(40)]
    found = compressed.segments(compressed.own_texts(spark.createDataFrame(rows, "doc_id long, text string, quality int"))).collect()
    whole = b"".join(bytes(r.segment) for r in found)
    assert b"licence" not in whole
    assert len(whole) == sum(len(t.replace(shared + "\n", "").encode()) for _, t, _ in rows)


def test_classifier(known):
    rows, docs, labels = known
    found = compressed.quality_scores(docs, labels).collect()
    truth = {i: q for i, _, q in rows}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    right = [r.predicted == truth[r.doc_id] for r in found if r.held_out]
    assert len(right) > 40 and np.mean(right) > 0.9


def test_scores_of_odd_texts(docs, rows, labels, no_docs):
    found = compressed.quality_scores(docs, labels).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in rows)
    assert all(r.score == 0 for r in found if r.doc_id in (100, 101, 105, 106))
    assert compressed.quality_scores(no_docs, labels).count() == 0
    assert compressed.quality_scores(docs, labels.limit(0)).count() == len(rows)


def brute_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def walk(forest, x):
    total = forest.bias
    for root in forest.roots:
        k = root
        while forest.left[k] != k:
            k = forest.left[k] if x[forest.feature[k]] <= forest.threshold[k] else forest.right[k]
        total += forest.value[k]
    return total


def test_rules(known, docs, rows, no_docs):
    _, train_docs, labels = known
    forest = qualityrules.fit(train_docs, labels)
    found = qualityrules.judged(docs, forest).collect()
    want = Counter()
    for i, t in rows:
        base = brute_statistics(t or "")
        fails = base[0] < 50 or 100 * base[4] > 50 * base[0]
        x = qualityrules.features(np.array([qualityrules.statistics(t or "")]))[0]
        keep = not fails and 1 / (1 + np.exp(-walk(forest, x))) >= qualityrules.KEEP
        want[(i, *base, fails, bool(keep))] += 1
    assert Counter(tuple(r)[:8] for r in found) == want
    left = qualityrules.passing(docs, forest)
    assert left.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter(
        (r.doc_id, t) for r in found for i, t in rows if r.kept and i == r.doc_id) or len(set(i for i, _ in rows)) < len(rows)
    assert qualityrules.judged(no_docs, forest).count() == 0
    assert qualityrules.passing(no_docs, forest).count() == 0
    assert qualityrules.judged(docs, qualityrules.fit(no_docs, labels)).count() == len(rows)


def test_rules_on_held_out(known):
    rows, docs, labels = known
    truth = {i: q for i, _, q in rows}
    found = qualityrules.judged(docs, qualityrules.fit(docs, labels)).collect()
    right = [r.kept == bool(truth[r.doc_id]) for r in found if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert np.mean(right) > 0.95


def test_trees_keep_their_direction():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 3))
    y = (np.sin(2 * x[:, 0]) + 0.8 * x[:, 1] - x[:, 2] + rng.normal(size=600) > 0).astype(float)
    forest = trees.train(x, y, [0, 1, -1], trees=40)
    assert ((forest.margin(x) > 0) == y).mean() > 0.8
    assert np.allclose(forest.margin(x[:50]), [walk(forest, r) for r in x[:50]])
    for f, sign in ((1, 1), (2, -1)):
        for r in x[:60]:
            line = np.tile(r, (80, 1))
            line[:, f] = np.linspace(-4, 4, 80)
            assert (sign * np.diff(forest.margin(line)) >= -1e-9).all()


def test_repeated_words_with_many_words():
    words = [str(i % 4001).encode() for i in range(9000)]
    assert qualityrules.repeated_words(words) == 9000
    assert qualityrules.repeated_words([b"a"] * 2) == 0


def test_model_of_few_rows(spark):
    docs = spark.createDataFrame([(1, "good text"), (3, "### bad"), (5, None), (5, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (3, 0), (5, 1), (7, 0)], "doc_id long, quality int")
    model = compressed.fit(docs, labels)
    assert compressed.score(["", "x"], model)[0] == 0


@pytest.mark.parametrize("size", [3, 8, 64])
def test_windows_cover_the_whole_text(size):
    rng = random.Random(size)
    for n in (0, 1, 2, 3, 7, 8, 9, 63, 64, 65, 200):
        words = [str(rng.randrange(12)).encode() for _ in range(n)]
        starts = [0] if n <= size else [*range(0, n - size, size), n - size]
        parts = [words[i:i + size] for i in starts]
        assert set().union(*(range(i, i + size) for i in starts)) >= set(range(n))
        ids = qualityrules._numbered(words)
        assert qualityrules.windowed(ids, qualityrules._runs(ids), size) == (
            sum(map(len, parts)), sum(len(set(p)) for p in parts), sum(map(qualityrules.repeated_words, parts)))


def test_clean_texts_of_any_length_stay(spark):
    """The trees judge whole texts by statistics that mean the same at every length that they were grown on."""
    rng = random.Random(12)
    rows = []
    for i in range(360):
        words = prose(rng, rng.choice([80, 200, 500, 2500])).split()
        if i % 3 == 0:  # the same few words all over
            words = [rng.choice(words[:40]) for _ in words]
        rows.append((i, " ".join(words), int(i % 3 != 0)))
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows], "doc_id long, quality int, toxic int")
    clean = [(1000 + k, prose(rng, n)) for k, n in enumerate([3000, 20_000, 100_000, 400_000])]
    assert len(clean[0][1]) > 15_000 and len(clean[-1][1]) > 2_000_000
    forest = qualityrules.fit(frame(spark, [(i, t) for i, t, _ in rows]), labels)
    found = {r.doc_id: r.kept for r in qualityrules.judged(frame(spark, clean), forest).collect()}
    assert found == {i: True for i, _ in clean}


def test_trees_are_grown_on_whole_texts(spark):
    """What the fit sees of a labelled text is what the verdict sees, however long it is."""
    rng = random.Random(3)
    rows = [(i, prose(rng, n)) for i, n in enumerate([1, 60, 3000, 9000] * 4)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    got = qualityrules.sampled(frame(spark, rows), labels)
    assert len(got) > 8 and all(zlib.crc32(str(i).encode()) % 4 != 2 for i in got.doc_id)
    assert got.equals(qualityrules.sampled(frame(spark, rows).repartition(7), labels))
    text = dict(rows)
    assert [tuple(r) for r in got[qualityrules.COUNTS].to_numpy()] == [qualityrules.statistics(text[i]) for i in got.doc_id]


def test_weights_count_like_repeated_rows():
    rng = np.random.default_rng(6)
    x, times = rng.normal(size=(80, 2)), rng.integers(1, 5, 80)
    y = (x[:, 0] + rng.normal(size=80) > 0).astype(float)
    again = np.repeat(np.arange(80), times)
    assert np.allclose(compressed._logistic(x, y, counts=times.astype(float)), compressed._logistic(x[again], y[again]), atol=1e-5)
    once, more = trees.train(x, y, [0, 0]), trees.train(x, y, [0, 0], weight=np.ones(80))
    assert np.array_equal(once.margin(x), more.margin(x))
    assert np.isclose(trees.train(x, y, [0, 0], weight=np.where(y == 1, 3.0, 1.0)).bias,
                      np.log(3 * y.sum() / (1 - y).sum()))


def test_scores_mean_the_same_when_the_sample_is_bounded(spark):
    """Texts of both classes are alike, so a score is the share of good labels, whatever the bound on rows."""
    rng = random.Random(9)
    rows = [(i, prose(rng, 70), int(i % 6 != 0)) for i in range(600)]
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows], "doc_id long, quality int, toxic int")
    docs = frame(spark, [(i, t) for i, t, _ in rows])
    free = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    share = np.mean([i % 6 != 0 for i in free])
    for most in (40, 4000):
        got = qualityrules.sampled(docs, labels, most)
        assert np.isclose(got.weight.mean(), 1)
        assert np.isclose(got.weight[got.quality == 1].sum() / got.weight.sum(), share)
        forest = qualityrules.fit(docs, labels, most)
        assert np.isclose(forest.bias, np.log(share / (1 - share)))
        score = [r.score for r in qualityrules.judged(docs, forest).collect()]
        assert abs(np.mean(score) - share) < 0.12
        score = [r.score for r in compressed.quality_scores(docs, labels, per_class=most).collect()]
        assert abs(np.mean(score) - share) < 0.12
