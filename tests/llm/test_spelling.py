"""Spelling variants against all pairs in plain Python."""

import random
import re
import zlib
from collections import Counter
from itertools import groupby

import pytest

from quire.llm import spelling

from .conftest import CLASHING, frame

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    near = {w: sorted((x for x in n if one_edit(w, x)), key=lambda x: (-n[x], x)) for w in n}
    form = {w: near[w][0] if near[w] and n[near[w][0]] >= 10 * n[w] else None for w in n}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, n[w], len(near[w]), form[w], form[w] and n[form[w]], root(w)) for w in n}


def typos(rng, words, signs):
    for w in words:
        k, sign = rng.randrange(len(w)), rng.choice(signs)
        yield rng.choice([w[:k] + sign + w[k:], w[:k] + w[k + 1:], w[:k] + sign + w[k + 1:]])


@pytest.fixture(scope="module")
def spelled():
    """Texts with chains of ever rarer spellings, ties, upper case, accents, a hot word and a long run."""
    rng = random.Random(5)
    stems = ["".join(rng.choice("abceén") for _ in range(rng.randint(7, 12))) for _ in range(25)]
    rows = []
    for k, stem in enumerate(stems):
        line = [stem, *typos(rng, [stem] * 4, "abé")]
        chain = next(typos(rng, [line[1]], "ab"))
        rows.append((1000 + k, " ".join([stem] * 230 + line[1:2] * 21 + [chain] * 2 + line[2:] * 2)))
    rows += [(1, "Haupthaus HAUPTHAUS haupthaus1Haupthaus_hauptHaus"), (2, "ÉTRANGER étranger Étranger étranger"),
             (3, "x" * 500 + " " + "x" * 500 + " " + "x" * 499), (4, "x" * 499), (5, None), (6, ""), (7, "kurz kurz"),
             (8, "garden-gardens gardens garden's gardens"), (8, "garden-gardens gardens garden's gardens")]
    rows += [(2000 + i, "meeting " * 400 + "meetinq meating") for i in range(6)]
    rows += [(None, " ".join(stems * 2))]
    return rows


@pytest.mark.parametrize("sizes", [(8192, 1 << 15), (16, 5)])
def test_variants(spark, spelled, sizes):
    found = spelling.variants(frame(spark, spelled).repartition(4), *sizes).collect()
    got = [(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in found]
    want = brute(spelled)
    assert len(got) == len(set(got)) and set(got) == want
    assert sum(w[3] is not None and w[5] != w[3] for w in want) > 5
    assert "meeting" in {w[3] for w in want}


def test_texts_of_all_kinds(docs, rows):
    found = spelling.variants(docs.select("doc_id", "text", *CLASHING), block_words=64)
    assert {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in found.collect()} == brute(rows)


def test_no_rows(no_docs):
    assert spelling.variants(no_docs).collect() == []


def test_rows_of_the_matrix_are_shared_down_the_list():
    rng = random.Random(8)
    for signs in ("ab", "abcdefgh", "a🙂é"):
        words = {"".join(rng.choice(signs) for _ in range(rng.randint(7, 10))) for _ in range(60)}
        words |= {w for w in typos(rng, list(words) * 3, signs) if len(w) > 6} | {"a" * 7, "a" * 8, "a" * 300, "a" * 301}
        index = spelling.SortedWords(sorted(words))
        for size, group in groupby(sorted(words, key=len), len):
            own = list(group)
            for keep in (0, spelling.kept_prefix(own[0]), size):
                found = [(own[q], index.words[k]) for q, k in zip(*index.near(own, keep), strict=True)]
                assert sorted(found) == sorted((w, x) for w in own for x in words if one_edit(w, x) and x[:keep] == w[:keep])


def test_blocks_that_cannot_hold_a_near_word_are_left_out():
    assert spelling.could_hold("abcdefgh", 4, "abcdxfga", "abcdxfgz")
    assert not spelling.could_hold("abcdefgh", 4, "abcdxyga", "abcdxygz")
    assert spelling.could_hold("abcdefgh", 4, "abcd", "abcdz")
    assert spelling.shared("abc", "abd") == 2 and spelling.shared("ab", "abd") == 2 and spelling.shared("", "a") == 0
