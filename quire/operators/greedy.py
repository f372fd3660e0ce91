"""Greedy "close when the sum reaches T" grouping, split across buckets.

Rows are in global order and cut into buckets of consecutive rows.  Inside a
segment, every row joins the open group (or opens one), adds its words, and the
group closes once its words reach ``T``; a segment start closes whatever is
open.  The state between rows is ``(open, acc, gid)``; a group's id is the
position of its first row.

A segment may be far longer than a bucket (one book, or copies of one book,
may hold a large share of all rows), so a bucket cannot assume it starts
fresh.  The scan stays exact without putting a segment in one task:

1. ``summarise`` (per bucket): with a segment start in the bucket its end state
   is fixed by the rows from the last start on.  Otherwise the end state is a
   function of the incoming words ``a``: the first closure is at the first row
   where the running sum reaches ``T - a``; after that the run no longer
   depends on ``a``.  Only the distinct running sums up to ``T`` are kept, so a
   summary is at most ``T + 1`` numbers.
2. ``compose`` (per block of buckets): the same kind of summary of the block;
   ``carries`` then gives the incoming state of each.
3. ``starts`` (per bucket): the group starts, from the incoming state.

Only positions and word counts reach Python, never the text; loops run over
groups and segments, not over rows.
"""

from __future__ import annotations

import numpy as np

FRESH = (False, 0, -1)


def _run(r, sums, i, base, last, T):
    """Group starts from row ``i`` (a fresh group) up to ``last``, and the end state.

    ``sums`` are running word sums, ``base`` the sum before row ``i``.
    """
    found = []
    while i < last:
        found.append(i)
        j = int(np.searchsorted(sums, base + T, side="left")) if T > 0 else i
        j = max(j, i)
        if j >= last:
            return found, (True, int(sums[last - 1] - base), int(r[i]))
        i, base = j + 1, int(sums[j])
    return found, FRESH


def starts(new, n, r, T, carry=FRESH):
    """Positions in the bucket where groups start, and the end state."""
    new, n, r = np.asarray(new, bool), np.asarray(n, np.int64), np.asarray(r, np.int64)
    sums = np.cumsum(n)
    bounds = [*np.flatnonzero(new).tolist(), len(n)]
    found, state = [], carry
    first = bounds[0]
    if first > 0:  # rows before the first segment start go on with what is carried in
        open_, acc, g = carry
        i, base = 0, 0
        if open_:
            j = int(np.searchsorted(sums, T - acc, side="left"))
            if j >= first:
                state, i = (True, acc + int(sums[first - 1]), g), first
            else:
                state, i, base = FRESH, j + 1, int(sums[j])
        if i < first:
            own, state = _run(r, sums, i, base, first, T)
            found += own
    for a, b in zip(bounds, bounds[1:]):
        own, state = _run(r, sums, a, int(sums[a - 1]) if a else 0, b, T)
        found += own
    return np.array(found, np.int64), state


def summarise(new, n, r, T):
    """One bucket's summary (see module doc)."""
    new, n, r = np.asarray(new, bool), np.asarray(n, np.int64), np.asarray(r, np.int64)
    out = {"fixed": bool(new.any()) or T <= 0, "first_r": int(r[0]), "total": int(n.sum()),
           "fixed_open": False, "fixed_acc": 0, "fixed_g": -1, "cand_s": [], "cand_open": [], "cand_acc": [], "cand_g": []}
    if out["fixed"]:
        if T > 0:  # the rows from the last segment start on decide
            at = int(np.flatnonzero(new)[-1])
            _, state = starts(new[at:], n[at:], r[at:], T)
            out.update(zip(("fixed_open", "fixed_acc", "fixed_g"), state, strict=True))
        return out
    sums = np.cumsum(n)
    last = int(np.searchsorted(sums, T, side="left"))
    vals, first = np.unique(sums[:min(last, len(sums) - 1) + 1], return_index=True)
    for s, i in zip(vals.tolist(), first.tolist(), strict=True):
        state = FRESH
        if i + 1 < len(n):
            state = _run(r, sums, i + 1, s, len(n), T)[1]
        for k, v in zip(("cand_s", "cand_open", "cand_acc", "cand_g"), (s, *state), strict=True):
            out[k].append(v)
    return out


def advance(state, s, T):
    """State after a bucket or block with summary ``s``."""
    if s["fixed"]:
        return (bool(s["fixed_open"]), int(s["fixed_acc"]), int(s["fixed_g"]))
    open_, a, g = state
    a = a if open_ else 0
    if a + s["total"] < T:
        return (True, a + int(s["total"]), g if open_ else int(s["first_r"]))
    j = int(np.searchsorted(np.asarray(s["cand_s"]), T - a, side="left"))
    return (bool(s["cand_open"][j]), int(s["cand_acc"][j]), int(s["cand_g"][j]))


def carries(summaries, T, state=FRESH):
    """Incoming state of each of consecutive summaries, and the state after all."""
    out = []
    for s in summaries:
        out.append(state)
        state = advance(state, s, T)
    return out, state


def compose(summaries, T):
    """The summary of consecutive buckets taken together."""
    summaries = list(summaries)
    out = {"fixed": any(s["fixed"] for s in summaries), "first_r": int(summaries[0]["first_r"]),
           "total": int(sum(s["total"] for s in summaries)), "fixed_open": False, "fixed_acc": 0, "fixed_g": -1,
           "cand_s": [], "cand_open": [], "cand_acc": [], "cand_g": []}
    if out["fixed"]:
        state = carries(summaries, T)[1]  # what comes before the last fixed one doesn't matter
        out.update(zip(("fixed_open", "fixed_acc", "fixed_g"), state, strict=True))
        return out
    before = 0
    for k, s in enumerate(summaries):
        for i, c in enumerate(s["cand_s"]):
            total = before + int(c)
            if out["cand_s"] and total <= out["cand_s"][-1]:
                continue  # an earlier row reaches this sum
            state = (bool(s["cand_open"][i]), int(s["cand_acc"][i]), int(s["cand_g"][i]))
            state = carries(summaries[k + 1:], T, state)[1]
            for name, v in zip(("cand_s", "cand_open", "cand_acc", "cand_g"), (total, *state), strict=True):
                out[name].append(v)
        before += int(s["total"])
        if before >= T:
            break
    return out
