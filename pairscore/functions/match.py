"""Word-match score between a query token array and a document token array.

score(q, d) = sum over x in q, y in d of w(x, y), compared lowercased, with
w = 2 if x == y, 1 if one is a substring of the other, else 0. Every pair
counts (no max, no de-duplication). Since w(x, y) = [x in y] + [y in x]
(substring tests), it is two ``contains`` calls per pair, evaluated by nested
``aggregate`` higher-order functions inside the JVM projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _w(x: Column, y: Column) -> Column:
    return F.contains(y, x).cast("int") + F.contains(x, y).cast("int")


def _bind(q, d, body) -> Column:
    """``body(q, d)`` with both sides evaluated once a row, whatever expressions they are: inside the lambda they
    are fields of one array element, so the lambdas over query words do not evaluate them again."""
    one = F.transform(F.array(F.struct(q.alias("q"), d.alias("d"))), lambda s: body(s["q"], s["d"]))
    return F.element_at(one, 1)


def _lower(c) -> Column:
    return F.transform(_col(c), F.lower)


def word_match(q, d) -> Column:
    """Plain form: O(|q| * |d|) per row. NULL on either side gives NULL."""
    return _bind(_lower(q), _lower(d), lambda ql, dl: F.aggregate(
        ql, F.lit(0), lambda acc, x: acc + F.aggregate(dl, F.lit(0), lambda a, y: a + _w(x, y))))


def word_match_bag(q, bag) -> Column:
    """Same score against a bag ``array<struct<t: string, n: int>>`` of
    distinct lowercased tokens with their counts (see
    ``operators.catalog.token_bags``): sum of n * w(x, t). Equal to
    ``word_match`` on the expanded tokens, at O(|q| * distinct(d)). Most
    tokens do not match, so they are ruled out by one short test each, and
    only the others are weighed (an unknown test is kept, so it stays NULL)."""
    near = lambda x: lambda e: F.coalesce(F.contains(e["t"], x) | F.contains(x, e["t"]), F.lit(True))
    return _bind(_lower(q), _col(bag), lambda ql, b: F.aggregate(
        ql, F.lit(0),
        lambda acc, x: acc + F.aggregate(F.filter(b, near(x)), F.lit(0), lambda a, e: a + e["n"] * _w(x, e["t"]))))


#: Query words up to this many characters find their own parts among the text's words by one pattern.
PATTERN_LENGTH = 24


def token_text(tokens) -> Column:
    """Tokens, lowercased, as one string: a space before the first and after each. Tokens hold no spaces themselves."""
    return F.concat(F.lit(" "), F.array_join(F.transform(_col(tokens), lambda t: F.concat(F.lower(t), F.lit(" "))), ""))


def _quoted(c: Column) -> Column:
    """Pattern text that matches ``c`` literally."""
    return F.regexp_replace(c, r"([^\p{L}\p{N}])", r"\\$1")


def _part_pattern(x: Column) -> Column:
    """Pattern of a whole word of the text that is a part of ``x``: from each of its characters on, the next ones may follow."""
    chars = F.transform(F.split(x, ""), _quoted)
    suffix = lambda i: F.aggregate(F.reverse(F.slice(chars, i, F.size(chars))), F.lit(""),
                                   lambda rest, c: F.concat(c, F.when(rest == "", "").otherwise(F.concat(F.lit("(?:"), rest, F.lit(")?")))))
    ways = F.transform(F.sequence(F.lit(1), F.size(chars)), suffix)
    return F.concat(F.lit(" (?:"), F.array_join(F.array_distinct(ways), "|"), F.lit(")(?= )"))


def word_match_text(q, text) -> Column:
    """Same score against a long text given as ``token_text``, without a loop over its words: for each query word one pass
    over the text counts the words that hold it, and one the words that it holds. Long query words, whose parts make no
    short pattern, are compared word by word for the second count. NULL on either side gives NULL."""
    def score(ql, d):
        words = F.length(d) - F.length(F.replace(d, F.lit(" "))) - 1
        empty = F.regexp_count(d, F.lit(" (?= )"))
        split = lambda: F.split(F.substr(d, F.lit(2), F.length(d) - 2), " ")

        def one(x):
            holding = F.regexp_count(d, F.concat(_quoted(x), F.lit("[^ ]*")))
            held = F.when(F.length(x) <= PATTERN_LENGTH, F.regexp_count(d, _part_pattern(x))).otherwise(
                F.size(F.filter(split(), lambda y: (y != "") & F.contains(x, y))))
            return empty + F.when(x == "", words).otherwise(holding + held)
        return F.aggregate(ql, F.lit(0), lambda acc, x: acc + one(x))
    return _bind(_lower(q), _col(text), score)


def _min_distances(q, d) -> Column:
    """For each query token, its smallest edit distance to any document token
    (NULL when the document has no tokens)."""
    return _bind(_col(q), _col(d), lambda ql, dl: F.transform(ql, lambda x: F.array_min(
        F.transform(dl, lambda y: F.levenshtein(x, y)))))


def min_levenshtein(q, d) -> Column:
    """Smallest edit distance between any query token and any document
    token; NULL if either side has no tokens."""
    return F.array_min(_min_distances(q, d))


def inverse_levenshtein(q, d) -> Column:
    """sum over query tokens x of 1 / (1 + min_y levenshtein(x, y)): 1 per
    exact hit, less for near misses, 0 when the document has no tokens."""
    return _inverse(_min_distances(q, d))


def _inverse(distances) -> Column:
    return F.aggregate(distances, F.lit(0.0),
                       lambda acc, m: acc + F.coalesce(1.0 / (m + 1), F.lit(0.0)))


def levenshtein_scores(q, d) -> Column:
    """struct(lev_min, lev_inv): both scores above from one table of distances."""
    one = F.transform(F.array(_min_distances(q, d)), lambda m: F.struct(
        F.array_min(m).alias("lev_min"), _inverse(m).alias("lev_inv")))
    return F.element_at(one, 1)
