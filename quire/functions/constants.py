"""Fixed values that must equal the original pipeline's for identical results.

Everything below is stated as plain text, in the order the original states it.
"""

# --- FIXED VALUES -----------------------------------------------------------

# Bookshelf tokens a book may carry to be kept (after shelf parsing, see
# ``bookshelves``).  A book is kept only if *every* one of its shelves is here.
GENRES_KEPT = (
    "novels",
    "britishliterature",
    "adventure",
    "americanliterature",
    "children",
    "youngadultreading",
    "sciencefiction",
    "biographies",
    "historyamerican",
    "historymodern(1750+)",
    "fantasy",
    "shortstories",
    "historicalnovels",
    "historybritish",
    "travelwriting",
    "historywarfare",
    "historyother",
    "folklore",
    "mythology",
    "legends",
    "historyeuropean",
    "romance",
    "crime",
    "thrillersandmystery",
    "historyearlymodern(c.14501750)",
    "frenchliterature",
    "classicsofliterature",
)

# Shelf parsing: this prefix is removed (case-sensitive, before lower-casing),
# then '-' and ' ' are removed, then the string is split on any of ``,;&``.
SHELF_PREFIX = "Category: "
SHELF_SEPARATORS = "[,;&]"

# Heading pattern, seven alternatives, first match wins.  The seventh
# alternative is written ``\*\s*\*\s*\*\s*\*[*\s]*`` instead of the original
# ``(\*\s*){3,}\*\s*``: both accept exactly the strings made of four or more
# asterisks mixed with whitespace, but Java's backtracking matcher recurses per
# repetition of the group form and overflows its stack on long asterisk runs.
HEADING_PATTERN = (
    r"^(?i:CHAPTER) [IVXLCDM]+"
    r"|^[IVXLCDM]+$"
    r"|^[A-Z ]{2,}\.{0,1}$"
    r"|^No. [0-9]+--[A-Z ]+"
    r"|^Part [IVXLCDM]+.{0,1}$"
    r"|^Chapter [A-Z][a-zA-Z]{2,13}"
    r"|^\s*\*\s*\*\s*\*\s*\*[*\s]*$"
)

# Note patterns, searched anywhere in the lower-cased paragraph.
FOOTNOTE_PATTERN = r"\[footnote.+"
TRANSCRIBER_PATTERN = r"\[transcriber.+"
ILLUSTRATION_PATTERN = r"\[illustration"

# A paragraph of at most ten words containing one of these is dialogue.
DIALOGUE_QUOTES = ('"', "“", "'")

# Inclusion thresholds (strictly more than).
MIN_WORDS = 3
DIALOGUE_MAX_WORDS = 10

# Book normalisation, applied in this order as literal replacements; then every
# whitespace run becomes one space.
NORMALISE_REPLACEMENTS = (
    ("\r\n", "\n"),
    ("\xa0", ""),
    ("\n\n", "||||"),
    ("\n", " "),
    ("'", "'"),
)
PARAGRAPH_MARKER = "||||"

# Separators used when text is re-joined.
AGGREGATE_JOIN = "\n\n"
SENTENCE_JOIN = " "

# Column names of the paragraph / aggregate / chunk tables.
COL_PARAGRAPH = "paragraphs"
COL_TEXT_ID = "text_ids"
COL_SPANS = "spans"
COL_CHAPTER = "chapters"
COL_INDEX = "paragraphs_index"
COL_WORDS = "n_words"
COL_SPLIT = "splitted_paragraphs"

# --- END FIXED VALUES -------------------------------------------------------


def _whitespace_class() -> str:
    """Java character class of exactly the code points ``str.isspace()`` accepts.

    Java's ``\\s`` is ASCII only.  ``\\p{javaWhitespace}`` (a table lookup)
    lacks the four no-break / next-line spaces Python counts, so they are
    added; the union was checked equal to ``str.isspace()`` over every code
    point.  ``python_whitespace_points`` gives the rule for tests.
    """
    return r"[\p{javaWhitespace}\x{85}\x{a0}\x{2007}\x{202f}]"


def python_whitespace_points() -> list[int]:
    return [c for c in range(0x110000) if chr(c).isspace()]


WS = _whitespace_class()
NON_WS = "[^" + WS[1:]
