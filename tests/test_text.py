"""Column functions: normalisation, words, headings, inclusion, shelves."""

import random

import pytest
from pyspark.sql import functions as F

from quire.functions import constants as K
from quire.functions import text as X


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col(F.col("v")).alias("r")).first().r


def many(spark, fn, values, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, " + schema)
    return [r.r for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


def test_normalize_by_hand(spark):
    got = one(spark, X.normalize_book, "The\r\nsea \xa0was\t calm\n\nand 'blue'\ntoday")
    assert got == "The sea was calm||||and 'blue' today"


def test_normalize_blank_line_rules(spark):
    got = many(spark, X.normalize_book, ["a\n\n\nb", "a\n\n\n\nb", "a\n \nb", "a\n\xa0\nb", "a||||b"])
    assert got == ["a|||| b", "a||||||||b", "a b", "a||||b", "a||||b"]


def test_whitespace_class_matches_python(spark):
    pts = K.python_whitespace_points()
    sample = pts + [0x41, 0x1B, 0x200B, 0xFEFF, 0x180E, 0x1F600]
    df = spark.createDataFrame([(c, chr(c)) for c in sample], "cp int, ch string")
    got = {r.cp for r in df.where(F.col("ch").rlike("^" + K.WS + "$")).collect()}
    assert got == set(pts)


def test_word_count_matches_python_split(spark):
    rng = random.Random(7)
    alphabet = ["a", "é", "Z", " ", "\t", "\n", "\x1c", "\x85", "\xa0", "　", "\U0001F600", "-", "​"]
    texts = ["", " ", "a", " a ", "a  b"] + [
        "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    assert many(spark, X.word_count, texts) == [len(t.split()) for t in texts]


@pytest.mark.parametrize("text", ["CHAPTER XL of ships", "MCM", "A STORM AT SEA", "No. 7--OLD HARBOUR",
                                  "Part VI:", "Chapter Seven", "**** ** *"])
def test_heading_shapes_block_chapterisation_flag(spark, text):
    assert one(spark, X.no_chapterization, text) is False


def test_heading_extracts(spark):
    cases = {"CHAPTER VI. text": "CHAPTER VI", "Chapter Dinner": "Chapter D", "CHAPTER MY DOG": "CHAPTER M",
             "CHAPTER 12": None, "chapter vi": None, "THE END": "THE END", "IT": "IT",
             "* * * * *": "* * * * *", "* * *": None, "* * * *": "* * * *",
             "Part IV": "Part IV", "No. 3--THE SEA": "No. 3--THE SEA", "A plain sentence.": None}
    got = many(spark, X.heading, list(cases))
    assert dict(zip(cases, got)) == cases


def test_heading_long_asterisk_run_is_safe(spark):
    assert one(spark, X.heading, "*" * 20000) == "*" * 20000


def test_is_all_upper_matches_python(spark):
    texts = ["ABC", "ABC 12", "abc", "Abc", "123", "", "ǅ", "ÉTÉ", "ß", "ΑΒΓ", "ⒶⒷ", "Ⅻ", "HELLO, world"]
    assert many(spark, X.is_all_upper, texts) == [t.isupper() for t in texts]


@pytest.mark.parametrize("p,keep", [
    ("[Footnote 3: on tides, see the table]", False),
    ("As said before [TRANSCRIBER'S note added]", False),
    ("A long look [illustration of the pier] was taken there", False),
    ("'Come in,' he called from upstairs", False),
    ("\"Come in,\" he called from upstairs, and so we all went in at once", True),
    ("Nobody answered", False),
    ("Waves rose over the wall and took the boats away.", True),
    ("“Is it late?” asked the tired old clerk.", False),
    ("She called it ”odd” and left the room.", True),
    ("NO SHIP HAS COME TO PORT SINCE 1890", False),
    ("five six seven eight", True),
    ("five six seven", False),
])
def test_inclusion(spark, p, keep):
    assert one(spark, lambda c: X.inclusion_condition(c), p) is keep


def test_bookshelves(spark):
    got = many(spark, X.bookshelves, ["Category: Sea-Tales, Crime &Old Maps ; x", None, "legends,",
                                       "History - Warfare (to 1900)"])
    assert got == [["seatales", "crime", "oldmaps", "x"], None, ["legends", ""], ["historywarfare(to1900)"]]


def test_genre_exclusive(spark):
    df = spark.createDataFrame([(["fantasy", "legends"],), (["fantasy", "cooking"],), (["crime", ""],), ([],)],
                               "s array<string>")
    got = [r.k for r in df.select(X.genre_exclusive(F.col("s")).alias("k")).collect()]
    assert got == [True, False, False, True]


def test_piece_limit(spark):
    df = spark.createDataFrame([(18, 17), (34, 17), (35, 17), (17, 17), (1000, 17)], "n long, m int")
    got = [r.l for r in df.select(X.piece_limit(F.col("n"), F.col("m")).alias("l")).collect()]
    assert got == [8, 8, 5, 17, 0]


def test_fixed_values_are_the_agreed_ones():
    """Literal values that the oracle SQL takes from the code under test."""
    from quire.plans import bookview as V
    from quire.plans import queries as Q

    assert len(K.GENRES_KEPT) == len(set(K.GENRES_KEPT)) == 27
    assert K.GENRES_KEPT[0] == "novels" and K.GENRES_KEPT[-1] == "classicsofliterature"
    assert {"crime", "folklore", "sciencefiction", "historyearlymodern(c.14501750)"} < set(K.GENRES_KEPT)
    assert (K.SHELF_PREFIX, K.SHELF_SEPARATORS) == ("Category: ", "[,;&]")
    assert K.NORMALISE_REPLACEMENTS[:4] == (("\r\n", "\n"), ("\xa0", ""), ("\n\n", "||||"), ("\n", " "))
    assert (K.PARAGRAPH_MARKER, K.AGGREGATE_JOIN, K.SENTENCE_JOIN) == ("||||", "\n\n", " ")
    assert (K.MIN_WORDS, K.DIALOGUE_MAX_WORDS, K.DIALOGUE_QUOTES) == (3, 10, ('"', "\u201c", "'"))
    assert (K.FOOTNOTE_PATTERN, K.TRANSCRIBER_PATTERN, K.ILLUSTRATION_PATTERN) == (
        r"\[footnote.+", r"\[transcriber.+", r"\[illustration")
    assert K.HEADING_PATTERN.count("|^") == 6
    assert (Q.THRESHOLD, Q.MAX_LEN, Q.SPLIT_MAX, Q.PIECE_MAX, Q.CONV_THRESHOLD) == (120, 200, 60, 17, 150)
    assert V.BOOK_BLOCK == 32


def test_documents_hold_no_marker_of_the_oracle(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert docs.where(F.instr("text", "\x01") > 0).count() == 0
