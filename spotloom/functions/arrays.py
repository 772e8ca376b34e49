"""Array and sequence functions as column expressions; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters of the base indices 0 to 4 (4: not called).
LETTERS = "GTACN"


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, v: s + v * v))


def cosine(a: Column, b: Column) -> Column:
    """Null where a vector is null or all zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def first_argmax(a: Column) -> Column:
    """0-based index of the largest value, the first on ties; null for null and empty arrays."""
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def has_nan(a: Column) -> Column:
    return F.exists(a, lambda v: v.isNull() | F.isnan(v))


def letters(indices: Column) -> Column:
    """Base indices as a string; an index outside 0 to 4 or null reads N."""
    return F.array_join(F.transform(indices, lambda i: F.when(i.between(0, 4), F.substring(F.lit(LETTERS), (i + 1).cast("int"), F.lit(1))).otherwise("N")), "")


def indices(bases: Column) -> Column:
    """A sequence as base indices; any other letter is 4."""
    return F.transform(F.split(bases, ""), lambda c: F.when(F.instr(F.lit("GTAC"), c) > 0, F.instr(F.lit("GTAC"), c) - 1).otherwise(4))


def hamming(a: Column, b: Column) -> Column:
    """Differing positions of two strings of one length; null where lengths differ."""
    n = F.length(a)
    d = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), lambda s, i: s + F.when(F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1)), 1).otherwise(0))
    return F.when(n == F.length(b), F.when(n == 0, 0).otherwise(d))


def half_even(v: Column) -> Column:
    """Rounding as raster indices are rounded: halves to the even number."""
    return F.rint(v).cast("bigint")


def clipped(v: Column, lo, hi) -> Column:
    return F.least(F.greatest(v, F.lit(lo)), F.lit(hi))
