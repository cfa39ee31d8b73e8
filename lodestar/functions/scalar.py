"""Column expressions for the reference's row lambdas.

All of these are built-in Catalyst expressions, so they stay inside whole
stage code generation; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestar.functions.fixed import NUMERIC_PATTERN  # noqa: F401  (F11; re-exported)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_double(c: str | Column) -> Column:
    """String to double; dirty text gives null instead of an ANSI error."""
    return _col(c).try_cast("double")


def try_int(c: str | Column) -> Column:
    """String to int, null when it does not parse."""
    return _col(c).try_cast("int")


def round_half_up(c: str | Column) -> Column:
    """Java ``Math.round``: floor(x + 0.5), as bigint.

    ``F.round`` rounds half away from zero, so -2.5 would become -3; the
    reference gives -2.
    """
    return F.floor(_col(c) + F.lit(0.5))


def is_numeric(c: str | Column) -> Column:
    """True when the whole string is a plain decimal number."""
    return _col(c).rlike(NUMERIC_PATTERN)


def recode(c: str | Column, value, when_equal, otherwise, null_value=None) -> Column:
    """Two-way recode with an explicit rule for nulls."""
    col = _col(c)
    return (
        F.when(col.isNull(), F.lit(null_value))
        .when(col == F.lit(value), F.lit(when_equal))
        .otherwise(F.lit(otherwise))
    )


def impute(c: str | Column, fill: float, marker: str | None = None) -> Column:
    """Parse a numeric text; the missing marker (or anything unparsable) becomes ``fill`` (P10)."""
    col = _col(c)
    parsed = col.try_cast("double")
    if marker is not None:
        parsed = F.when(col == F.lit(marker), F.lit(None).cast("double")).otherwise(parsed)
    return F.coalesce(parsed, F.lit(float(fill)))


def java_split(c: str | Column, sep: str = " ") -> Column:
    """Java ``String.split(sep)``: keeps leading and inner empty strings, drops
    trailing ones (D9).  ``sep`` is a regular expression, as in Java.

    An input consisting only of separators yields an empty array, and the
    empty string ``[""]``, as in Java.
    """
    stripped = F.regexp_replace(_col(c), rf"(?:{sep})+\z", "")  # trailing separators
    return (F.when(_col(c) == "", F.array(F.lit("")))
            .when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, sep)))


def split_words(c: str | Column, sep: str = " ") -> Column:
    """Words of a line split on ``sep`` with empty tokens removed."""
    return F.filter(F.split(_col(c), sep), lambda w: w != F.lit(""))


def ratio_percent(c: str | Column) -> Column:
    """Ratio shown as a rounded percent, ``Math.round(100 * x)``."""
    return round_half_up(_col(c) * F.lit(100.0))
