"""Vector codes against plain integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import vectorcodes as V


def brute(rows, rounds=2):
    """rows: (vec_id, vector, label)."""
    kept = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows
            if v and all(x is not None and math.isfinite(x) for x in v) and len(v) % 16 == 0]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], None
    d = len(first[0][1])
    kept, first = [r for r in kept if len(r[1]) == d], [r for r in first if len(r[1]) == d][:64]
    w = d // 16
    books = [[r[1][p * w:(p + 1) * w] for r in first] for p in range(16)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(16):
            groups = {}
            for _, v, _ in kept:
                x = v[p * w:(p + 1) * w]
                groups.setdefault(nearest(p, x)[1], []).append(x)
            for k, xs in groups.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    out, by_label = [], {}
    for i, v, lab in kept:
        hits = [nearest(p, v[p * w:(p + 1) * w]) for p in range(16)]
        out.append((i, lab, "".join(f"{k:02x}" for _, k in hits), sum(e for e, _ in hits)))
        by_label[lab] = by_label.get(lab, 0) + out[-1][3]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(*r, by_label[r[1]]) for r in out], sha


SCHEMA = "vec_id long, embedding array<double>, label int, code string, error string, vector string, k0 string, _of string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w", "v") for r in rows], SCHEMA).repartition(5)


def vectors(n, dims, seed=4, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(dims)] for _ in range(9)]
    return [(1000 - i, [c + rng.gauss(0, spread / 5) for c in rng.choice(centres)], rng.choice([None, 1, 2, 3])) for i in range(n)]


def odd_rows(dims):
    nan, inf = float("nan"), float("inf")
    return [(1, None, 1), (2, [], 1), (3, [nan] * dims, 1), (4, [inf] + [0.0] * (dims - 1), 2), (5, [None] + [0.5] * (dims - 1), 2),
            (6, [0.0] * dims, None), (7, [-0.001] * dims, 2), (2000, [0.25] * (dims + 16), 2), (2001, [0.25] * (dims - 1), 2),
            (8, [0.125] * dims, 1), (8, [0.125] * dims, 1), (8, [-0.125] * dims, 2), (None, [3.5] * dims, 1), (None, None, None)]


@pytest.mark.parametrize(("n", "dims"), [(300, 32), (20, 16), (200, 80)])
@pytest.mark.parametrize("broadcast", [V.BROADCAST_LABELS, -1])
def test_codes(spark, n, dims, broadcast, monkeypatch):
    monkeypatch.setattr(V.with_label_error, "__defaults__", (broadcast,))
    rows = vectors(n, dims) + odd_rows(dims)
    found, books = V.vector_codes(frame(spark, rows))
    got = [(r.vec_id, r.label, r.code.hex(), r.error, r.label_error) for r in found.collect()]
    want, sha = brute(rows)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert books.sha256() == sha


def test_no_rows(spark):
    for rows in ([], [(1, None, 1), (2, [0.0] * 3, 1)]):
        found, books = V.vector_codes(frame(spark, rows))
        assert found.collect() == [] and books is None
        assert found.columns == ["vec_id", "label", "code", "error", "label_error"]


def test_other_types_and_hot_label(spark):
    rows = [(f"v{i:04}", [float(x) for x in v], "all") for i, v, _ in vectors(150, 16)]
    df = spark.createDataFrame(rows, "id string, e array<float>, tag string")
    found, _ = V.vector_codes(df, "id", "e", "tag")
    out = found.collect()
    assert len(out) == 150 and {r.label_error for r in out} == {sum(r.error for r in out)}


def test_huge_components_count_as_the_bound(spark):
    rows = vectors(70, 16) + [(1, [1e300, -1e300] + [0.0] * 14, 1)]
    found, books = V.vector_codes(frame(spark, rows))
    bound = 1 << 28
    limited, _ = V.vector_codes(frame(spark, rows[:-1] + [(1, [bound / 256, -bound / 256] + [0.0] * 14, 1)]))
    assert found.count() == 71 and np.abs(books.books).max() <= bound
    assert found.select(F.sum("error")).first() == limited.select(F.sum("error")).first()


def test_slices_give_the_nearest_entry():
    rng = np.random.default_rng(9)
    for scale, k, d in ((3, 64, 4), (2, 64, 1), (1000, 64, 7), (1 << 27, 64, 4), (50, 1, 3), (1, 30, 2)):
        entries = rng.integers(-scale, scale + 1, (k, d))
        x = np.concatenate([rng.integers(-2 * scale, 2 * scale + 1, (500, d)), entries])
        distance = ((x[:, None] - entries) ** 2).sum(2)
        entry, least = V.Slices(entries).nearest(x)
        assert (entry == distance.argmin(1)).all() and (least == distance.min(1)).all()
    assert V.Slices(entries).nearest(np.zeros((0, d), np.int64))[0].tolist() == []
    with pytest.raises(ValueError, match="64 bits"):
        V.Slices(np.zeros((65, 2), np.int64))


def test_masks_keep_a_small_share():
    rng = np.random.default_rng(2)
    entries = rng.normal(0, 100, (64, 4)).astype(np.int64)
    x = entries[rng.integers(0, 64, 2000)] + rng.integers(-20, 21, (2000, 4))
    s = V.Slices(entries)
    _, least = s.guess(x)
    found = s.inside(x, np.sqrt(least).astype(np.int64) + 1)
    assert np.mean([int(m).bit_count() for m in found]) < 24
