"""Text cleaning and tokenising as Column expressions.

Everything here is a built-in Spark expression (regex, lower, array functions), so it runs
inside whole-stage code generation, adds no shuffle and no Python worker, and works the
same on a batch or a streaming DataFrame.

Regex dialect notes (Java regex in Spark):
* Python's ``str.strip()`` and ``\\s`` on ``str`` use Unicode whitespace; Java's ``\\s`` is
  ASCII only and ``trim`` removes only spaces, so the class is spelled out below.
* Python's ``\\w`` on ``str`` is Unicode letters, digits and ``_``; we spell it
  ``[\\p{L}\\p{N}_]`` so that "café" stays one word.
* Java rejects ``[\\b]`` (backspace) and reads ``[\\v]`` as a wider class, so the escape
  characters are written as hex escapes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must stay as they are for results to match the reference semantics)
# ---------------------------------------------------------------------------

# Characters Python's str.strip() / str.split() treat as whitespace.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# A "word" character as Python's re understands \w on str.
WORD_CLASS = r"[\p{L}\p{N}_]"
# URL: http or https, a colon, then everything up to the next whitespace.
URL_PATTERN = "https?:[^" + PY_WHITESPACE + "]+"
# Escape sequences replaced by one space each: LF, CR, BEL, BS, backslash, FF, TAB, VT.
ESCAPE_PATTERN = r"[\x0A\x0D\x07\x08\x5C\x0C\x09\x0B]"
# Default tokeniser: runs of two or more ASCII lower-case letters.
DEFAULT_TOKEN_PATTERN = "[a-z]{2,}"
# Prefix of a "YYYY-MM-DD HH:MM:SS" timestamp.
TIMESTAMP_PREFIX_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"
# Numbers with separators behind an optional sign and currency mark; ordinals written with digits.
NUMBER_PATTERN = r"^[+\-\x{B1}~]?\p{Sc}?\p{Nd}+([.,/]\p{Nd}+)*[.,]?$"
ORDINAL_PATTERN = r"^\p{Nd}+([sS][tT]|[nN][dD]|[rR][dD]|[tT][hH])$"

# English number words ("like a number" tokens).
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
    "fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy "
    "eighty ninety hundred thousand million billion trillion quadrillion "
    "first second third fourth fifth sixth seventh eighth ninth tenth"
).split()

# English stop words (the list Spark ships for StopWordsRemover, in its own order).
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did "
    "doing a an the and but if or because as until while of at by for with about against "
    "between into through during before after above below to from up down in out on off over "
    "under again further then once here there when where why how all any both each few more "
    "most other some such no nor not only own same so than too very s t can will just don "
    "should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm "
    "you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't "
    "weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't "
    "mustn't can't couldn't cannot could here's how's let's ought that's there's what's "
    "when's where's who's why's would"
).split()

_WS_CLASS = "[" + PY_WHITESPACE + "]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# T1-T5, T7, T9, T10
# ---------------------------------------------------------------------------


def lower_strip(c) -> Column:
    """Lower case, then strip leading/trailing (Unicode) whitespace.

    ``btrim`` with an explicit character set: no regex, only the two ends are looked at."""
    return F.btrim(F.lower(_c(c)), F.lit(PY_WHITESPACE))


def remove_url(c) -> Column:
    """Every ``https?:`` run up to whitespace becomes one space."""
    return F.regexp_replace(_c(c), URL_PATTERN, " ")


def remove_escapes(c) -> Column:
    """Each LF, CR, BEL, BS, backslash, FF, TAB, VT becomes one space (no collapsing)."""
    return F.regexp_replace(_c(c), ESCAPE_PATTERN, " ")


def repeated_word_pattern(n: int) -> str:
    """Regex for a word holding one ASCII letter repeated at least ``n`` times in a row."""
    if n < 2:
        raise ValueError("n must be >= 2")
    return WORD_CLASS + "*([a-zA-Z])\\1{" + str(n - 1) + ",}" + WORD_CLASS + "*"


def find_repeated(c, n: int = 3) -> Column:
    """T4: array of the words that hold a letter repeated ``n`` or more times."""
    return F.regexp_extract_all(_c(c), F.lit(repeated_word_pattern(n)), 0)


def drop_repeated(c, n: int = 3, keep_double: bool = False) -> Column:
    """T5: collapse each run of >= n identical ``[a-z0-9]`` to one char (two with keep_double)."""
    if n < 2:
        raise ValueError("n must be >= 2")
    pattern = "([a-z]|[0-9])\\1{" + str(n - 1) + ",}"
    return F.regexp_replace(_c(c), pattern, "$1$1" if keep_double else "$1")


def tokenize(c, pattern: str = DEFAULT_TOKEN_PATTERN) -> Column:
    """All matches of ``pattern``, in order."""
    return F.regexp_extract_all(_c(c), F.lit(pattern), 0)


def word_pieces(c) -> Column:
    """Split a text into alternating word / non-word pieces; concatenating them gives the text back."""
    return F.regexp_extract_all(_c(c), F.lit(WORD_CLASS + "+|[^" + WORD_CLASS[1:-1] + "]+"), 0)


def is_punct(c) -> Column:
    """Token made only of punctuation characters."""
    return _c(c).rlike(r"^\p{P}+$")


def is_space(c) -> Column:
    """Token made only of whitespace."""
    return _c(c).rlike("^" + _WS_CLASS + "+$")


def is_digit(c) -> Column:
    """Token made only of digits."""
    return _c(c).rlike(r"^\p{Nd}+$")


def like_number(c) -> Column:
    """Digits with separators (``1,000``, ``3.5``, ``1/2``), also behind a sign or a currency mark, digit
    ordinals (``2nd``), or an English number word."""
    col = _c(c)
    return col.rlike(NUMBER_PATTERN) | col.rlike(ORDINAL_PATTERN) | F.lower(col).isin(*NUMBER_WORDS)


def looks_like_timestamp(c) -> Column:
    """Value starts with ``YYYY-MM-DD HH:MM:SS`` (prefix match, like ``re.match``)."""
    return _c(c).rlike(TIMESTAMP_PREFIX_PATTERN)


def parse_timestamp(c) -> Column:
    """The timestamp that a value starts with; null without the prefix or for an impossible one (month 13)."""
    return F.when(looks_like_timestamp(c), F.try_to_timestamp(F.substring(_c(c), 1, 19), F.lit("yyyy-MM-dd HH:mm:ss")))


def contains_ci(c, needle: str) -> Column:
    """Null-safe, case-insensitive substring test (null -> false)."""
    return F.coalesce(F.contains(F.lower(_c(c)), F.lit(needle.lower())), F.lit(False))


def clean_text(c) -> Column:
    """The notebook's cleaning order: lower/strip, then URLs, then escape sequences."""
    return remove_escapes(remove_url(lower_strip(c)))
