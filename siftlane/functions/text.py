"""String expressions: whitespace collapse, sentence split, token counts,
previews, ids.  All are built-in Spark SQL functions (JVM side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (they decide results, so they must match exactly):
# the 29 code points that Python's str.split() treats as whitespace,
# written as a regex class body usable by both Java regex and RE2.
WS_CLASS_BODY = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS_RUN = f"[{WS_CLASS_BODY}]+"
# A sentence ends after '.' or ';' followed by whitespace and an ASCII capital.
SENTENCE_BOUNDARY = r"(?<=[.;]) (?=[A-Z])"
# Sentences must be longer than this many characters.
MIN_SENTENCE_CHARS = 15
# Token-count proxy: an ASCII letter/digit run, or any single other
# non-whitespace character.
TOKEN_COUNT_PATTERN = f"[A-Za-z0-9]+|[^{WS_CLASS_BODY}A-Za-z0-9]"
# The same two sets of characters for Java alone, which asks the parts of a
# class in turn: printable ASCII and Latin letters, then a space, and the long
# list of white space only for what is left.
_FAST = "!-~\u00c0-\u024f"
WORD_RUN_JAVA = f"[{_FAST}[[^ ]&&[^{WS_CLASS_BODY}]]]+"
TOKEN_COUNT_JAVA = f"[A-Za-z0-9]+|[{_FAST}[[^ ]&&[^{WS_CLASS_BODY}]]]"
# Tokens of the hash embedder: ASCII letter/digit runs, ASCII-lowercased.
WORD_PATTERN = "[A-Za-z0-9]+"
PREVIEW_CHARS = 200


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_ws(text) -> Column:
    """Every whitespace run becomes one space, ends trimmed."""
    return F.trim(F.regexp_replace(_col(text), WS_RUN, " "))


def split_sentences(text) -> Column:
    """ARRAY<STRING> of sentences longer than MIN_SENTENCE_CHARS."""
    parts = F.split(collapse_ws(text), SENTENCE_BOUNDARY, -1)
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: F.length(s) > MIN_SENTENCE_CHARS)


def _count_runs(text, pattern: str) -> Column:
    """Matches of a pattern that leaves only white space: each becomes one mark, and marks are counted (no array of matches)."""
    marks = F.regexp_replace(_col(text), pattern, "x")
    return F.length(marks) - F.length(F.replace(marks, F.lit("x"), F.lit("")))


def count_tokens(text) -> Column:
    """token count by the regex proxy (declared, not a BPE)."""
    return _count_runs(text, TOKEN_COUNT_JAVA).cast("long")


def word_count(text) -> Column:
    """len(text.split())."""
    return _count_runs(text, WORD_RUN_JAVA).cast("int")


def preview(text, n: int = PREVIEW_CHARS) -> Column:
    """First n characters, newlines as spaces, then '...'."""
    return F.concat(F.translate(F.substring(_col(text), 1, n), "\n", " "), F.lit("..."))


def words(text) -> Column:
    """Tokens for the hash embedder: ASCII alnum runs, lowercased."""
    return F.transform(
        F.regexp_extract_all(_col(text), F.lit(WORD_PATTERN), 0), lambda t: F.lower(t)
    )


def doc_label(doc_id, fmt: str = "doc-%03d") -> Column:
    """F8: printf-style document label, e.g. ``doc-007``."""
    return F.format_string(fmt, _col(doc_id))


def chunk_id(doc_id, chunk_ix) -> Column:
    """F8: '<doc_id>-c<chunk_ix>'."""
    return F.format_string("%s-c%d", _col(doc_id), _col(chunk_ix))
