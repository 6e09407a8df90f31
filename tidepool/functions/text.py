"""Column expressions for text: all JVM-side, no Python UDFs.

Patterns keep to plain character classes (no ``\\s``, no look-around) so the
Java regex used by Spark and RE2 used by the DuckDB oracle agree.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
# Sentence boundary: a run of . ! ? followed by spaces, or a run of newlines.
SENTENCE_SPLIT = r"[.!?]+[ ]+|\n+"
# Host part of an absolute URL: scheme in any case, user information left out, then up to / : ? #.
HOST_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/:?#@]+)"
TAG_PATTERN = r"<[^>]*>"
# A word without the signs at its edges: from its first letter or digit to its last one before a blank.
PLAIN_WORD = r"[\p{L}\p{N}](?:[^ \t\r\n]*[\p{L}\p{N}])?"
BLANK_RUN = r"[ \t\r\n]+"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def url_host(url: str | Column, exact_regex: bool = True) -> Column:
    """Host of a URL, sub-domain kept (``www.`` stays); NULL where there is none.

    ``exact_regex`` uses the portable pattern above; otherwise Spark's URL
    parser (``try_parse_url``), which yields NULL rather than failing on
    malformed input.
    """
    if exact_regex:
        return F.nullif(F.regexp_extract(_c(url), HOST_PATTERN, 2), F.lit(""))
    return F.try_parse_url(_c(url), F.lit("HOST"))


def strip_tags(html: str | Column) -> Column:
    """Markup to plain text: tags become blanks, blank runs collapse, trimmed."""
    no_tags = F.regexp_replace(_c(html), TAG_PATTERN, " ")
    return F.trim(F.regexp_replace(no_tags, BLANK_RUN, " "))


def tokenize(text: str | Column, pattern: str = " ", lower: bool = True,
             drop_empty: bool = True) -> Column:
    """Split into an array of tokens; punctuation stays attached.

    With ``pattern="\\s"`` and ``drop_empty=False`` this is the ML
    ``Tokenizer`` rule (lower-case, split on each white-space character,
    doubled blanks give empty tokens, those at the end are left out).
    """
    t = _c(text)
    if lower:
        t = F.lower(t)
    arr = F.split(t, pattern)
    if drop_empty:
        return F.filter(arr, lambda x: x != F.lit(""))
    # Java's split leaves out empty pieces at the end, but an empty text is one empty piece.
    # A trim finds the end in one step where the separator is any white space; a pattern has to look for it.
    solid = F.rtrim(t, F.lit(" \t\n\x0b\f\r")) if pattern == r"\s" else F.regexp_replace(t, f"(?:{pattern})+$", "")
    none = F.array().cast("array<string>")
    return F.when((F.length(t) > 0) & (F.length(solid) == 0), none).otherwise(F.split(solid, pattern))

def remove_stop_words(tokens: str | Column, stop_words: Iterable[str]) -> Column:
    """Drop stop words from a token array, keeping order and duplicates."""
    words = sorted(set(stop_words))
    return F.filter(_c(tokens), lambda x: ~x.isin(*words))


def ngram_array(tokens: str | Column, n: int) -> Column:
    """Array of space-joined n-grams; empty when there are fewer than n tokens."""
    t = _c(tokens)
    if n == 1:
        return t
    # Guard: sequence(0, size-n) would run backwards for short arrays.
    return F.when(F.size(t) >= n, F.transform(
        F.sequence(F.lit(0), F.size(t) - n),
        lambda i: F.array_join(F.slice(t, i + 1, n), " "),
    )).otherwise(F.array().cast("array<string>"))


def plain_words(text: str | Column) -> Column:
    """Lower-case words without the signs at their edges; what is only signs is left out."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(PLAIN_WORD), F.lit(0))


def words_and_phrases(words: str | Column, n: int = 2) -> Column:
    """The words of a ready word array and its phrases of 2 to ``n`` words, in one array."""
    out = _c(words)
    for k in range(2, n + 1):
        out = F.concat(out, ngram_array(words, k))
    return out


def split_sentences(text: str | Column, pattern: str = SENTENCE_SPLIT) -> Column:
    """Array of sentences (separators removed)."""
    return F.split(_c(text), pattern)


def strip_trailing(col: str | Column, chars: str = ".,") -> Column:
    """Remove a trailing run of the given punctuation (variant merge)."""
    klass = "".join("\\" + ch if ch in "]\\^-" else ch for ch in chars)
    return F.regexp_replace(_c(col), f"[{klass}]+$", "")


def word_array(col: str | Column) -> Column:
    """Whole words of a short label (single blanks), for whole-word tests."""
    return F.split(_c(col), " ")


def contains_phrase(text: str | Column, phrase: str | Column) -> Column:
    """True when ``phrase`` occurs in ``text`` on word boundaries (blank-delimited)."""
    padded = F.concat(F.lit(" "), _c(text), F.lit(" "))
    return F.contains(padded, F.concat(F.lit(" "), _c(phrase), F.lit(" ")))
