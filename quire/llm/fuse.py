"""Static binary-fuse filters (three places, 8-bit fingerprints) in numpy."""

from __future__ import annotations

import math
import struct

import numpy as np

_HEAD = struct.Struct("<4sQIII")  # magic, seed, bits of a segment, segments that start a key, places
_MAGIC = b"BFU1"
_U = np.uint64


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + _U(seed)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53), (33, 1)):
        h = (h ^ (h >> _U(shift))) * _U(factor)
    return h


def _places(h: np.ndarray, bits: int, starts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size, mask = 1 << bits, _U((1 << bits) - 1)
    first = ((h >> _U(32)) * _U(starts * size)) >> _U(32)
    second = (first + _U(size)) ^ ((h >> _U(18)) & mask)
    third = (first + _U(2 * size)) ^ (h & mask)
    return first.astype(np.int64), second.astype(np.int64), third.astype(np.int64)


def _prints(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> _U(32))).astype(np.uint8)


def _peel(places: np.ndarray, n_places: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, the place that each has alone), or None if some keys stay."""
    n = places.shape[1]
    count = np.bincount(places.ravel(), minlength=n_places)
    owner = np.bincount(places.ravel(), np.tile(np.arange(n, dtype=np.float64), 3), n_places).astype(np.int64)
    alone, rounds, left = np.flatnonzero(count == 1), [], n
    while len(alone):
        keys, at = np.unique(owner[alone], return_index=True)
        rounds.append((keys, alone[at]))
        left -= len(keys)
        touched = places[:, keys]
        np.subtract.at(count, touched.ravel(), 1)
        np.subtract.at(owner, touched.ravel(), np.tile(keys, 3))
        alone = np.unique(touched)
        alone = alone[count[alone] == 1]
    return None if left else rounds


def build(keys: np.ndarray) -> bytes:
    """A filter over the distinct unsigned 64-bit ``keys``; an empty one holds none."""
    keys = np.unique(keys.astype(_U))
    n = len(keys)
    if not n:
        return b""
    bits = min(18, max(2, int(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    starts = max(1, math.ceil(n * factor / (1 << bits)) - 2)
    seed = 0
    while True:
        h = _mix(keys, seed)
        places = np.stack(_places(h, bits, starts))
        n_places = (starts + 2) << bits
        rounds = _peel(places, n_places)
        if rounds is not None:
            break
        seed += 0x9E3779B97F4A7C15
        seed &= (1 << 64) - 1
        starts += 1
    table, prints = np.zeros(n_places, np.uint8), _prints(h)
    for own, place in reversed(rounds):
        a, b, c = places[:, own]
        table[place] = prints[own] ^ table[a] ^ table[b] ^ table[c]
    return _HEAD.pack(_MAGIC, seed, bits, starts, n_places) + table.tobytes()


def probe(data: bytes, keys: np.ndarray) -> np.ndarray:
    """Which keys the filter may hold: all that it was built from, about 1 in 256 others."""
    if not data:
        return np.zeros(len(keys), bool)
    magic, seed, bits, starts, n_places = _HEAD.unpack_from(data)
    if magic != _MAGIC:
        raise ValueError("not a filter")
    table = np.frombuffer(data, np.uint8, n_places, _HEAD.size)
    h = _mix(keys.astype(_U), seed)
    a, b, c = _places(h, bits, starts)
    return _prints(h) == table[a] ^ table[b] ^ table[c]
