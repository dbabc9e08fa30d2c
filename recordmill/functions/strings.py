"""String helpers used by every normalizer.

A missing value is the empty string on output; null and blank are the same on input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Unicode calls white space, plus the four
# information separators U+001C..U+001F.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column) -> Column:
    """Trim all Unicode white space at both ends (``trim`` alone only drops U+0020)."""
    return F.btrim(c, F.lit(WHITESPACE))


def or_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def stripped(c: Column) -> Column:
    """Null-safe strip."""
    return strip(or_blank(c))


def not_blank(c: Column) -> Column:
    return stripped(c) != F.lit("")


def null_if_blank(c: Column) -> Column:
    """Empty string to null, so that ``coalesce`` picks the first non-empty value."""
    return F.nullif(c, F.lit(""))


def first_non_empty(*cols: Column) -> Column:
    return F.coalesce(*[null_if_blank(c) for c in cols], F.lit(""))
