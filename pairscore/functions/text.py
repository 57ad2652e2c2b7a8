"""Tokenising and text Column functions.

``tokenize`` reproduces Spark ML's ``Tokenizer`` (lowercase, split on Java
``\\s``, trailing empty tokens dropped as ``String.split`` does) as native
expressions, so the projection stays free of the Scala UDF the Tokenizer
wraps and NULL input gives NULL instead of an exception.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .stopwords import ENGLISH

# Java's \s: space, tab, newline, vertical tab, form feed, carriage return.
JAVA_WS = "[ \\t\\n\\x0B\\f\\r]"
JAVA_WS_CHARS = " \t\n\x0b\f\r"
# Python's str.split() whitespace (str.isspace), used by the term length.
PY_WS = ("[\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
         "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_space(c) -> Column:
    """Split on a literal single space; case and empty tokens are kept."""
    return F.split(_col(c), " ")


def tokenize(c) -> Column:
    """Tokenizer semantics: ``''`` -> ``['']``, all-blank -> ``[]``,
    ``' a  B\\tc '`` -> ``['', 'a', '', 'b', 'c']``, NULL -> NULL."""
    c = _col(c)
    # rtrim is linear; a regex for the trailing run would retry inside every blank run of the text
    trimmed = F.rtrim(F.lower(c), F.lit(JAVA_WS_CHARS))
    return (F.when(c.isNull(), F.lit(None).cast("array<string>"))
             .when(c == "", F.array(F.lit("")))
             .when(trimmed == "", F.array().cast("array<string>"))
             .otherwise(F.split(trimmed, JAVA_WS)))


def remove_stop_words(tokens, words=ENGLISH) -> Column:
    """StopWordsRemover (case-insensitive, order and duplicates kept). The
    literal list becomes a hash set lookup (InSet) per token."""
    return F.filter(_col(tokens), lambda t: ~F.lower(t).isin(*words))


def term_length(c) -> Column:
    """Number of whitespace-separated words (Python ``len(s.split())``)."""
    return F.regexp_count(_col(c), F.lit("[^" + PY_WS[1:-1] + "]+")).cast("int")
