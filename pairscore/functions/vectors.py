"""Cosine similarity and Euclidean distance over ``array<double>`` columns.

Both are one pass of ``zip_with`` + ``aggregate``; vectors from Spark ML
(``VectorUDT``) go through ``pyspark.ml.functions.vector_to_array`` first.
Where all vectors have the same known, short length, ``size`` writes the sums
out term by term, in the same order: generated code instead of lambdas. The
JVM compiles no method above 8,000 bytes, so few such sums fit one projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Lengths up to this one are written out; the generated code grows with them.
WRITTEN_OUT = 16


def _sum(a: Column, b: Column, size: int, term) -> Column:
    total = F.lit(0.0)
    for i in range(size):
        total = total + term(F.get(a, F.lit(i)), F.get(b, F.lit(i)))
    return total


def dot(a, b, size: int) -> Column:
    """sum(x*y) of two vectors of length ``size``."""
    a, b = _col(a), _col(b)
    if size <= WRITTEN_OUT:
        return _sum(a, b, size, lambda x, y: x * y)
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def cosine_of(xy, xx, yy) -> Column:
    """The cosine from ``dot`` of both vectors and of each with itself; the latter can be worked out once per vector."""
    return F.try_divide(_col(xy), F.sqrt(_col(xx) * _col(yy)))


def cosine(a, b) -> Column:
    """sum(x*y) / sqrt(sum(x^2) * sum(y^2)). Zero vector -> NULL (no
    division error); vectors of different length -> NULL."""
    a, b = _col(a), _col(b)
    terms = F.zip_with(a, b, lambda x, y: F.struct((x * y).alias("xy"), (x * x).alias("xx"),
                                                   (y * y).alias("yy")))
    zero = F.struct(F.lit(0.0).alias("xy"), F.lit(0.0).alias("xx"), F.lit(0.0).alias("yy"))
    sums = F.aggregate(terms, zero, lambda acc, t: F.struct(
        (acc["xy"] + t["xy"]).alias("xy"), (acc["xx"] + t["xx"]).alias("xx"),
        (acc["yy"] + t["yy"]).alias("yy")),
        lambda acc: F.try_divide(acc["xy"], F.sqrt(acc["xx"] * acc["yy"])))
    return F.when(F.size(a) == F.size(b), sums)


def euclidean(a, b, size: int | None = None) -> Column:
    """sqrt(sum((x - y)^2)); the shorter vector is padded with zeros. ``size``: the length of every vector on both sides."""
    if size is not None and size <= WRITTEN_OUT:
        return F.sqrt(_sum(_col(a), _col(b), size, lambda x, y: (x - y) * (x - y)))
    diffs = F.zip_with(_col(a), _col(b),
                       lambda x, y: F.pow(F.coalesce(x, F.lit(0.0)) - F.coalesce(y, F.lit(0.0)), 2))
    return F.sqrt(F.aggregate(diffs, F.lit(0.0), lambda acc, v: acc + v))
