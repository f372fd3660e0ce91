"""Packing along the curve: exact cover, ids of the library, neighbours, and no padding."""

import itertools
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quire.llm import curvepack, wordtokens

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def check(found, rows, capacity):
    of = defaultdict(list)
    for i, t in rows:
        of[i].append([*library_ids(t), 1])
    places = defaultdict(list)
    for r in found:
        assert any(r.start + r.length <= len(x) == r.doc_tokens and r.ids_crc32 == zlib.crc32(
            array("I", x[r.start:r.start + r.length]).tobytes()) for x in of[r.doc_id])
        places[r.sequence_id].append((r.offset, r.length))
    # each id of each document lies in exactly one piece
    covered, want = Counter(), Counter()
    for r in found:
        covered.update((r.doc_id, r.doc_tokens, k) for k in range(r.start, r.start + r.length))
    for i, texts in of.items():
        for x in texts:
            want.update((i, len(x), k) for k in range(len(x)))
    assert covered == want
    sizes = []
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        sizes.append(at)
    assert max(sizes) <= capacity and all(n & (n - 1) == 0 for n in sizes)
    total = sum(want.values())
    assert len(sizes) == total // capacity + (total % capacity).bit_count()


@pytest.mark.parametrize(("capacity", "range_bytes"), [(2048, 32 << 20), (64, 5000)])
def test_packed(docs, rows, capacity, range_bytes):
    found = curvepack.with_crc32(curvepack.pack(docs, PATH, 1, capacity, range_bytes)).collect()
    check(found, rows, capacity)


def test_no_rows(no_docs):
    assert curvepack.with_crc32(curvepack.pack(no_docs, PATH, 1)).collect() == []


def test_neighbours_share_words(spark):
    """Documents of eight made-up vocabularies, mixed, come out by vocabulary."""
    rng = np.random.default_rng(3)
    data = [(i, " ".join(f"{'abcdefgh'[i % 8]}{w}" for w in rng.integers(0, 40, 60)), i % 8) for i in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, text string, kind int").repartition(7)
    found = curvepack.pack(docs, PATH, 1, range_bytes=20_000).orderBy("sequence_id", "offset").collect()
    kinds = [r.doc_id % 8 for r in found if r.start == 0]
    assert np.mean([a == b for a, b in zip(kinds, kinds[1:])]) > 0.5  # 0.125 if dealt at random


def test_copies_of_one_text_spread_over_ranges(spark):
    docs = spark.createDataFrame([(7, "same words here " * 40)] * 300, "doc_id long, text string")
    rows = curvepack.cut(curvepack.token_rows(docs, PATH, 1).withColumn("row", curvepack.F.monotonically_increasing_id()))
    lain = curvepack.along_curve(rows, 10_000)
    by_range = [r["count"] for r in lain.groupBy("range").count().collect()]
    assert len(by_range) > 4 and max(by_range) < 150


def test_curve_steps_to_a_neighbour():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = curvepack.hilbert(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_tail():
    assert curvepack.tail_ends(2048, 2048) == [] and curvepack.tail_ends(0, 11) == [8, 10, 11]
    assert list(curvepack.cuts(60, 20, 64, 64, [80, 84])) == [(0, 4, 0, 60), (4, 16, 1, 0)]
    assert list(curvepack.cuts(79, 5, 64, 64, [80, 84])) == [(0, 1, 1, 15), (1, 4, 2, 0)]
    with pytest.raises(ValueError, match="power of two"):
        curvepack.pack(None, PATH, 1, 1000)


def test_ids_of_every_low_sign():
    own = wordtokens.encoder(PATH)
    for c in (*range(0x700), *range(0x1E00, 0x2100), 0x3000, 0x1F642, 0x1FAE9):
        for text in (f"a{chr(c)}b 1{chr(c)}", f"{chr(c)}'s {chr(c)}{chr(c)}x", chr(c)):
            assert own.encode(text) == array("H", library_ids(text)).tobytes(), hex(c)


def test_ids_of_long_texts_in_stretches(rows, monkeypatch):
    own = wordtokens.Encoder(PATH)
    monkeypatch.setattr(wordtokens, "STRETCH", 50)
    for text in [t for _, t in rows if t] + ["<|endoftext|>x <|startoftext|>" * 20, "é " * 90, "ΟΔΟΣ " * 30]:
        assert own.encode(text) == array("H", library_ids(text)).tobytes()


def test_other_files_are_refused():
    with pytest.raises(ValueError, match="word-level"):
        wordtokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
