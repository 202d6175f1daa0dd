"""Column expressions for text: whitespace strip, title case, numeric parse.

All are built-in Spark expressions (no Python UDF), so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Leading/trailing whitespace of any kind (``trim`` only removes spaces).
_OUTER_WS = r"^\s+|\s+$"
# Plain decimal text a numeric parser accepts: sign, digits, optional
# fraction, optional exponent. Rejects '1d', 'nan', 'inf', '0x1A', '1,000'.
_NUMERIC_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def strip_ws(c: Column) -> Column:
    """Remove leading and trailing whitespace, tabs and newlines included."""
    return F.regexp_replace(c, _OUTER_WS, "")


# Marker put after every non-letter that is not a plain space, so that
# ``initcap`` (which only starts words after spaces) starts a word there too.
_MARK = "\u0000 "


def title_case(c: Column) -> Column:
    """Python-style title case: the first letter of every run of letters is
    upper case, every other letter lower case ('MAY-x' -> 'May-X',
    '1st' -> '1St').

    Built from ``lower``, ``regexp_replace`` and ``initcap`` so it stays in
    generated code: a marker and a space go after each non-letter, ``initcap``
    capitalises the letter that follows, and the marker is removed again.
    """
    marked = F.regexp_replace(F.lower(c), r"([^\p{L} ])", "$1" + _MARK)
    return F.regexp_replace(F.initcap(marked), _MARK, "")


def finite_double(c: Column) -> Column:
    """NULL for NaN and infinities, so NULL is the only missing marker."""
    d = c.cast(T.DoubleType())
    return F.when(F.isnan(d) | (F.abs(d) == float("inf")), None).otherwise(d)


def parse_number_text(c: Column) -> Column:
    """Text -> double the way a strict numeric parser reads it, else NULL.

    Outer whitespace is ignored; anything but plain decimal or scientific
    notation is NULL (``try_cast`` alone would accept '1d', 'nan', 'inf').
    """
    t = strip_ws(c)
    return F.when(t.rlike(_NUMERIC_TEXT), finite_double(t.try_cast("double")))


def integral_or_null(d: Column) -> Column:
    """Double -> bigint when it holds a whole number, else NULL."""
    return F.when(d == F.floor(d), d.cast(T.LongType()))


def to_nullable_long(c: Column, dtype: T.DataType) -> Column:
    """Numeric parse to a nullable 64-bit integer for a column of any type.

    Unparseable text, fractions and infinities become NULL (the numeric parse
    of the original raises on fractions; we null them and count them, see
    :func:`quaybook.operators.clean.numeric_parse_rejects`).
    """
    if isinstance(dtype, T.StringType):
        return integral_or_null(parse_number_text(c))
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return integral_or_null(finite_double(c))
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return c.cast(T.LongType())
    if isinstance(dtype, T.BooleanType):
        return c.cast(T.LongType())
    return integral_or_null(parse_number_text(c.cast(T.StringType())))
