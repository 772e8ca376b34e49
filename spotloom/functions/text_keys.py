"""Keys as they are compared: trimmed, of one letter case, null where nothing is left."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space that is trimmed.
BLANKS = " \t\n\r\x0b\x0c   　﻿​"


def trimmed(c: Column) -> Column:
    return F.trim(c, F.lit(BLANKS))


def gene_key(c: Column) -> Column:
    """Trimmed, lower case; null for null and empty."""
    return F.nullif(F.lower(trimmed(c)), F.lit(""))


def sequence_key(c: Column) -> Column:
    """Trimmed, upper case; null for null and empty."""
    return F.nullif(F.upper(trimmed(c)), F.lit(""))


def valid_score(c: Column) -> Column:
    """The score if it is a number from 0 to 1, else null (NaN included)."""
    return F.when((c >= 0.0) & (c <= 1.0), c)
