"""Stage 1: books -> paragraphs, spans, chapters, global index."""

import random
import time

import pytest

from quire.operators import catalog as C
from quire.operators import ordering
from quire.operators import paragraphs as P

# worked out by hand; normalised: "Two tales|||| CHAPTER IV |||| The ferry left at six in the morning" ...
BOOK = ("Two tales\n\n CHAPTER IV \n\n The ferry left\nat six in the \xa0morning \n\n and nobody was\r\naboard it."
        " \n\n CHAPTER V \n\n Short one \n\n It came back at noon.")


def corpus(spark, rows):
    df = spark.createDataFrame(rows, "id string, text string, o bigint")
    return ordering.in_order(df, ["o"], keep_order=False)


def collect(df):
    return [(r.paragraphs, r.text_ids, tuple(r.spans), r.chapters)
            for r in df.orderBy("paragraphs_index").collect()]


def test_book_by_hand(spark):
    norm = ("Two tales|||| CHAPTER IV |||| The ferry left at six in the morning |||| and nobody was aboard it."
            " |||| CHAPTER V |||| Short one |||| It came back at noon.")
    want = []
    for text, chapter in (("The ferry left at six in the morning", "CHAPTER IV"),
                          ("and nobody was aboard it.", "CHAPTER IV"), ("It came back at noon.", "CHAPTER V")):
        want.append((text, 1, (norm.index(text), norm.index(text) + len(text)), chapter))
    assert want[0][2] == (30, 66)
    assert collect(P.paragraphs(corpus(spark, [("1", BOOK, 0)]))) == want


def test_copies_of_a_book_are_numbered_through(spark):
    out = P.paragraphs(corpus(spark, [("1", BOOK, 0), ("2", BOOK, 1), ("1", BOOK, 2)]))
    rows = collect(out)
    assert [r[1] for r in rows] == [1] * 3 + [2] * 3 + [1] * 3
    assert rows[:3] == rows[6:] == [(a, 1, s, c) for a, _, s, c in rows[3:6]]
    assert [r.paragraphs_index for r in out.orderBy("paragraphs_index").collect()] == list(range(9))


def test_text_before_first_heading_kept_with_null_chapter(spark):
    book = "Some opening words of the book.\n\nCHAPTER I\n\nThe first real paragraph is here."
    out = collect(P.paragraphs(corpus(spark, [("5", book, 0)])))
    # only a heading at the very start of a book sets the flag that drops text before the first chapter
    assert [(p, c) for p, _, _, c in out] == [("Some opening words of the book.", None),
                                              ("The first real paragraph is here.", "CHAPTER I")]


def test_span_is_first_occurrence(spark):
    # the 2nd and 3rd paragraphs first occur inside the 1st one
    book = "CHAPTER I\n\nxx the same four words yy\n\nthe same four words\n\nthe same four words"
    out = collect(P.paragraphs(corpus(spark, [("3", book, 0)])))
    assert [s for _, _, s, _ in out] == [(13, 38), (16, 35), (16, 35)]


def test_scene_break_becomes_chapter(spark):
    book = "CHAPTER I\n\none two three four\n\n* * * * *\n\nfive six seven eight"
    out = collect(P.paragraphs(corpus(spark, [("3", book, 0)])))
    assert [c for *_, c in out] == ["CHAPTER I", "* * * * *"]


def test_index_follows_corpus_order(spark):
    rows = [(str(i), f"CHAPTER I\n\nbook {i} paragraph one here\n\nbook {i} paragraph two here", 100 - i)
            for i in range(12)]
    for bound in (-1, 1000):  # offsets of blocks joined, and broadcast
        out = P.paragraphs(corpus(spark, rows), broadcast_rows=bound)
        got = [(r.text_ids, r.paragraphs_index) for r in out.orderBy("paragraphs_index").collect()]
        assert got == [(i, 2 * k + j) for k, i in enumerate(reversed(range(12))) for j in (0, 1)]


def test_index_after_a_shuffled_semi_join(spark):
    """Ids beyond the broadcast bound: the join sorts books by id, the index still follows the files."""
    rows = [(str(7 * i % 41), f"CHAPTER I\n\nbook {i} has this one paragraph", i) for i in range(41)]
    books = corpus(spark, rows)
    keep = [k for k in range(41) if k % 3]
    got = [collect(P.paragraphs(C.filter_corpus(books, keep, broadcast_rows=bound))) for bound in (1000, -1)]
    assert got[0] == got[1] and [r[1] for r in got[0]] == [7 * i % 41 for i in range(41) if (7 * i % 41) % 3]


def test_split_book_positions(spark):
    s = P.split_book(corpus(spark, [("7", "A\n\nCHAPTER I\n\nB b b b\n\n", 0)]))
    got = [(r.pos, r.paragraph, r.heading, r.chapter) for r in s.orderBy("pos").collect()]
    assert got == [(0, "A", None, None), (1, "CHAPTER I", "CHAPTER I", "CHAPTER I"),
                   (2, "B b b b", None, "CHAPTER I"), (3, "", None, "CHAPTER I")]


def test_true_spans_are_actual_positions(spark):
    book = "CHAPTER I\n\nxx the same four words yy\n\nthe same four words\n\nthe same four words"
    out = P.paragraphs(corpus(spark, [("3", book, 0)]), true_spans=True).orderBy("paragraphs_index")
    got = [(tuple(r.spans), tuple(r.spans_true)) for r in out.collect()]
    assert got == [((13, 38), (13, 38)), ((16, 35), (42, 61)), ((16, 35), (65, 84))]


def test_spans_count_code_points_with_astral_characters(spark):
    book = "CHAPTER I\n\n\U0001F600 smile \U0001D49C at the start\n\nplain words come after here"
    out = collect(P.paragraphs(corpus(spark, [("9", book, 0)])))
    norm = "CHAPTER I||||\U0001F600 smile \U0001D49C at the start||||plain words come after here"
    assert [s for _, _, s, _ in out] == [(norm.find(p), norm.find(p) + len(p)) for p, *_ in out]
    assert out[1][2] == (39, 66)


def _places(parts):
    """Text of the parts, and begin and length of each after its blanks."""
    begins, at = [], 0
    for p in parts:
        begins.append(at + len(p) - len(p.lstrip(" ")))
        at += len(p) + 4
    return "||||".join(parts), begins, [len(p.strip(" ")) for p in parts]


def test_first_offsets_equal_find():
    rng = random.Random(5)
    words = ["a", "bb", "ab", "\U0001F600", "é", "x y", "the", " "]
    for _ in range(400):
        text, begins, lengths = _places(
            [" ".join(rng.choice(words) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 40))])
        assert P.first_offsets(text, begins, lengths) == [
            text.find(text[b:b + n]) for b, n in zip(begins, lengths, strict=True)]
    assert P.first_offsets("", [], []) == [] and P.first_offsets("ab", [0], [0]) == [0]


def test_first_offsets_of_a_large_repetitive_book():
    rng = random.Random(1)
    stock = [" ".join(rng.choice("ab cd ef gh".split()) for _ in range(rng.randint(5, 120))) for _ in range(400)]
    parts = [rng.choice(stock)[:rng.randint(20, 300)].strip() or "x" for _ in range(30_000)]
    text, begins, lengths = _places(parts)
    assert len(text) > 3_000_000
    t = time.process_time()
    got = P.first_offsets(text, begins, lengths)
    assert time.process_time() - t < 60
    for i in rng.sample(range(len(parts)), 60):
        assert got[i] == text.find(text[begins[i]:begins[i] + lengths[i]])


@pytest.mark.parametrize("orders", [(None, 1), (7, 7)])
def test_open_corpus_order_is_rejected(spark, orders):
    df = spark.createDataFrame([("1", BOOK, orders[0]), ("2", BOOK, orders[1])], "id string, text string, o bigint")
    with pytest.raises(ValueError, match="unique"):
        ordering.positions(df, ["o"], "pos")
