"""Stage 2b: sentence packing and breaking over-long aggregates."""

import random

import pytest
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import chunks as C

# sentences of 6, 2, 4 and 3 words
S = ["The old mill turned all night.", "Nobody slept.", "Dogs barked at dawn.", "Then came silence."]
P = " ".join(S)


@pytest.mark.parametrize("limit,cuts", [
    (0, [[0], [1], [2], [3]]),
    (5, [[0], [1], [2], [3]]),
    (6, [[0], [1, 2], [3]]),
    (8, [[0, 1], [2, 3]]),
    (9, [[0, 1], [2, 3]]),
    (12, [[0, 1, 2], [3]]),
    (15, [[0, 1, 2, 3]]),
])
def test_split_paragraph(spark, limit, cuts):
    df = spark.createDataFrame([(P,)], "p string")
    got = df.select(C.split_paragraph(F.col("p"), F.lit(limit))).first()[0]
    assert got == [" ".join(S[i] for i in c) for c in cuts]


def _agg(spark, text, n=15):
    return spark.createDataFrame([(text, 3, "Nine", n, [20, 24], 0)],
                                 "paragraphs string, text_ids bigint, chapters string, n_words bigint, "
                                 "spans array<bigint>, agg_order bigint")


def test_break_long_row(spark):
    # 15 words over 14: two cuts, so 7 words a piece
    got = [(r.paragraphs, r.n_words, r.text_ids, r.spans, r.chapters, r.splitted_paragraphs)
           for r in C.break_paragraphs(_agg(spark, P), 14).orderBy("piece").collect()]
    assert got == [(t, n, 3, [20, 24], "Nine", True) for t, n in
                   ((S[0], 6), (f"{S[1]} {S[2]}", 6), (S[3], 3))]


def test_break_equal_to_max_is_flagged(spark):
    got = C.break_paragraphs(_agg(spark, P), 15).collect()
    assert [(r.n_words, r.splitted_paragraphs) for r in got] == [(15, True)]


def test_break_short_passes_through(spark):
    got = C.break_paragraphs(_agg(spark, P), 16).collect()
    assert [(r.paragraphs, r.n_words, r.splitted_paragraphs) for r in got] == [(P, 15, False)]


def test_text_without_sentence_end_is_not_cut(spark):
    text = " ".join(["word"] * 50)
    got = C.break_paragraphs(_agg(spark, text, 50), 10).collect()
    assert [(r.n_words, r.splitted_paragraphs) for r in got] == [(50, True)]


def test_max_length_must_be_positive(spark):
    with pytest.raises(ValueError):
        C.break_paragraphs(_agg(spark, P), 0)


def test_pack_starts_against_a_loop():
    rng = random.Random(6)
    assert C.pack_starts_list([], 5) == [0]
    for _ in range(2000):
        ks = [rng.randint(0, 9) for _ in range(rng.randint(1, 30))]
        limit = rng.choice([0, 1, 5, 9, 14.5, 40])
        starts, words = [], None
        for j, k in enumerate(ks):
            if words is None or words + k > limit:
                starts.append(j)
                words = k
            else:
                words += k
        assert C.pack_starts_list(ks, limit) == starts, (ks, limit)


def test_unrounded_limit_gives_same_pieces(spark):
    text = " ".join(f"Sentence number {i} has some words here." for i in range(40))
    a = _agg(spark, text, 280)
    key = lambda r: (r.piece, r.paragraphs, r.n_words)
    floor = sorted(map(key, C.break_paragraphs(a, 60).collect()))
    exact = sorted(map(key, C.break_paragraphs(a, 60, floor_limit=False).collect()))
    assert floor == exact and len(floor) > 1


def _sentences(text):
    """The rule letter by letter: end sign, closers, white space, one opener at most, upper case."""
    text = text.strip()
    out, start, i = [], 0, 0
    while i < len(text):
        if text[i] in ".!?":
            j = i + 1
            while j < len(text) and text[j] in "\"”’')]":
                j += 1
            k = j
            while k < len(text) and text[k].isspace():
                k += 1
            upper = k + 1 if text[k:k + 1] and text[k] in "\"“‘'([" else k
            if k > j and any(text[u:u + 1].isupper() and text[u:u + 1].isalpha() for u in (k, upper)):
                out.append(text[start:j])
                start = i = k
                continue
        i += 1
    return out + [text[start:]] if text else []


def test_sentences_with_runs_of_closers(spark):
    rng = random.Random(9)
    texts = ["", " ", "A.", "One.\"\"\"\"\"\"\"\"\"\"\"\" Two.", "x.') ('Y z", "Mr. Smith came. he left.  It rained!"]
    for _ in range(300):
        parts = []
        for _ in range(rng.randint(1, 12)):
            parts += [rng.choice(["word", "Word", "Été", "x", "9", "“Yes", "(No", "'(No"]),
                      rng.choice(["", ".", "!", "?", "..."]) + "".join(
                          rng.choice("\"”’')]") for _ in range(rng.choice([0, 0, 1, 3, rng.randint(0, 20)]))),
                      rng.choice([" ", "  ", "\n", "\t ", "", " "])]
        texts.append("".join(parts))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.s for r in df.select("i", X.sentences(F.col("t")).alias("s")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == _sentences(t), t


def test_sentences_of_a_very_long_text(spark):
    text = "no end in sight " * 40_000 + "stop. Go on."
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(X.sentences(F.col("t"))).first()[0]
    assert len(got) == 2 and got[1] == "Go on."
