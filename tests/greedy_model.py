"""Plain models of the greedy scan."""

import numpy as np

from quire.operators.greedy import carries, compose, starts, summarise


def sequential_groups(new, n, T):
    """One pass, row by row."""
    out, open_, acc, g = [], False, 0, -1
    for i, (s, k) in enumerate(zip(new, n, strict=True)):
        if s:
            open_, acc = False, 0
        if not open_:
            g, open_ = i, True
        out.append(g)
        acc += int(k)
        if acc >= T:
            open_, acc = False, 0
    return np.array(out, np.int64)


def bucketed_groups(new, n, T, B, F):
    """The scan on plain arrays, ``B`` rows a bucket and ``F`` buckets a block."""
    new, n = np.asarray(new), np.asarray(n, np.int64)
    r = np.arange(len(n), dtype=np.int64)
    cuts = [slice(a, min(len(n), a + B)) for a in range(0, len(n), B)]
    summ = [summarise(new[c], n[c], r[c], T) for c in cuts]
    blocks = [summ[i:i + F] for i in range(0, len(summ), F)]
    incoming, _ = carries([compose(b, T) for b in blocks], T)
    state = [s for b, first in zip(blocks, incoming, strict=True) for s in carries(b, T, first)[0]]
    out = np.empty(len(n), np.int64)
    for c, s in zip(cuts, state, strict=True):
        at, _ = starts(new[c], n[c], r[c], T, s)
        marks = np.full(c.stop - c.start, s[2] if s[0] else -1)
        last = np.maximum.accumulate(np.where(np.isin(np.arange(len(marks)), at), np.arange(len(marks)), -1))
        out[c] = np.where(last >= 0, r[c][np.maximum(last, 0)], marks)
    return out
