"""Tokens: ids, counts, files and packing against the libraries themselves."""

import json
import os
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quire.llm import bpe, hftokens, packing, pfor, piececount, pretoken

MULTI, PLAIN, PIECE = (P.path(x) for x in ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"))
SIGNS = st.text(st.sampled_from(list("ab 's 're \n\t\r12३é漢👍!?#<|>\xa0՘࢏▁\x00 ")), max_size=120)


def le(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.codec(MULTI).ranks
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PLAIN)


def test_pattern_is_the_files():
    assert pretoken.PATTERN == P.PATTERN


@settings(max_examples=150, deadline=None)
@given(SIGNS, st.integers(1, 40), st.integers(0, 30))
def test_stitched_chunks_are_the_whole(text, chunk, overlap):
    spans = pretoken.chunk_spans(len(text), chunk, overlap)
    chunks = [(a, pretoken.settled([a + e for e in pretoken.ends(text[a:b])], a, b, len(text))) for a, b in spans]
    assert pretoken.stitch(text, chunks) == pretoken.ends(text)
    assert "".join(pretoken.split(text)) == text


@settings(max_examples=150, deadline=None)
@given(SIGNS)
def test_ids_equal_the_libraries(text):
    own = bpe.codec(MULTI)
    ref = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    ids = own.encode(pretoken.split(text))
    assert ids == le(ref.encode_ordinary(text))
    assert own.decode(ids) == text.encode()


def test_counts_equal_the_library():
    ref, own = sentencepiece.SentencePieceProcessor(model_file=PIECE), piececount.model(PIECE)
    rng = random.Random(3)
    for _ in range(400):
        text = "".join(rng.choice("ab the ▁ é漢👍\n\t<s>") for _ in range(rng.randint(0, 80)))
        assert own.count(text) == len(ref.encode(text)), text


@pytest.mark.parametrize("chunk,overlap", [(1 << 16, 1 << 9), (300, 20), (50, 0)])
def test_encode(docs, rows, reference, chunk, overlap):
    found = bpe.encode(docs, MULTI, chunk, overlap).collect()
    want = Counter((i, le(reference.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)
    assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in found) == want
    assert all(r.n_tokens * 4 == len(r.ids) for r in found)


def test_token_counts(docs, rows):
    ref = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    found = Counter(tuple(r) for r in piececount.token_counts(docs, PIECE, 100).collect())
    want = Counter()
    for i, t in rows:
        n = len(ref.encode(t or ""))
        want[(i, len((t or "").encode()), n, n > 100)] += 1
    assert found == want


def test_other_models_are_refused(tmp_path):
    with pytest.raises((ValueError, KeyError, IndexError, StopIteration)):
        bad = tmp_path / "x.model"
        bad.write_bytes(b"")
        piececount.Model(str(bad))


@pytest.mark.parametrize("bins", [1, 3, 8192])
def test_packing(docs, rows, tokenizer, bins):
    found = packing.pack(docs, PLAIN, 2, 64, bins, 50).collect()
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])
    want = Counter()
    for i, each in ids.items():
        for own in each:
            start = 0
            for k, n in enumerate(packing.cut_lengths(len(own), 64)):
                want[(i, k, start, n, zlib.crc32(le(own[start:start + n])))] += 1
                start += n
    assert Counter(tuple(r)[:5] for r in found) == want
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    if bins > 100:
        assert len(places) <= 1.1 * sum(r.length for r in found) / 64 + 3


def test_fullest_bin_closes_first():
    fit = packing.BestFit(10, 2)
    assert [fit.place(n) for n in (4, 7, 9)] == [(0, 0), (1, 0), (2, 0)]  # the third closes at once: one free
    assert fit.place(1) == (1, 7) and fit.place(2) == (1, 8)
    assert fit.place(6) == (0, 4)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2 ** 32 - 1) | st.integers(0, 300), max_size=700), st.sampled_from([50, 90, 100]))
def test_blocks_round_trip(ids, percentile):
    ids = np.array(ids, np.uint32)
    data = pfor.encode_segment(ids, np.array([len(ids)]), percentile)
    back, lengths = pfor.decode_segment(data)
    assert back.tolist() == ids.tolist() and lengths.tolist() == [len(ids)]
    for a, b in ((0, 5), (100, 300), (127, 129), (650, 800)):
        assert pfor.decode_range(data, a, b).tolist() == ids[a:b].tolist()


def test_blocks_are_small():
    ids = np.random.default_rng(1).integers(1000, 1200, 1 << 14).astype(np.uint32)
    ids[::200] = 50_000
    assert len(pfor.encode_segment(ids, np.array([len(ids)]))) < 1.4 * len(ids)


def test_files(spark, docs, rows, tokenizer, tmp_path):
    path = str(tmp_path / "t")
    pfor.write_tokens(docs, path, PLAIN, 2, segment_ids=500)
    found = pfor.read_tokens(spark, path).orderBy("start").collect()
    order = [r.doc_id for r in found]
    assert order == sorted(order, key=lambda x: -1 if x is None else x)
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
    want = Counter((i, le(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])) for i, t in rows)
    assert Counter((r.doc_id, bytes(r.ids)) for r in found) == want


def test_empty_tables(spark, no_docs, tmp_path):
    assert bpe.encode(no_docs, MULTI).count() == 0
    assert piececount.token_counts(no_docs, PIECE, 5).count() == 0
    assert packing.pack(no_docs, PLAIN, 2).count() == 0
    pfor.write_tokens(no_docs, str(tmp_path / "e"), PLAIN, 2)
    assert pfor.read_tokens(spark, str(tmp_path / "e")).count() == 0


def test_encoder_refuses_other_files():
    with pytest.raises(ValueError):
        hftokens.Encoder(P.path("word_bpe_49k.json"))


@pytest.mark.parametrize("change", [
    {"model": {"dropout": 0.1}}, {"pre_tokenizer": {"use_regex": False}}, {"pre_tokenizer": {"add_prefix_space": True}},
    {"normalizer": {"type": "NFC"}}, {"truncation": {"direction": "Right", "max_length": 5, "strategy": "LongestFirst", "stride": 0}}])
def test_files_with_other_options_are_refused(tmp_path, change):
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    for part, options in change.items():
        spec[part] = (spec[part] or {}) | options
    (tmp_path / "other.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="byte-level"):
        hftokens.Encoder(str(tmp_path / "other.json"))


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01"), reason="driver tables not present")
def test_ids_of_a_whole_table_are_the_librarys():
    own, library = hftokens.encoder(P.path("byte_bpe_50k.json")), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist()]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert own.encode(text) == np.array(want.ids, "<u4").tobytes()
