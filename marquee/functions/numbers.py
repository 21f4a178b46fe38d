"""Numeric parsing from dirty text, range checks, rounding (Column -> Column).

Casts are ``try_cast`` so the engine runs with ANSI mode on: bad input
becomes null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions._col import col

# ---- fixed values (must equal the reference's for equal results) ----------
# Characters kept before an integer / decimal cast; everything else is dropped
# (so "120 min" -> 120, "95%" -> 95, "-5" -> 5, "95.5" -> 955 as an integer).
NON_DIGITS = "[^0-9]"
NON_DECIMAL = "[^0-9.]"
# Whole part of a decimal number.
DECIMALS = r"^(\s*[+-]?[0-9]+)\.[0-9]*\s*$"
# Rating text keeps the part before the first "/" ("8.5/10" -> 8.5).
RATING_SPLIT = "/"
# Inclusive valid ranges; values outside become null (the row is kept).
RUNTIME_RANGE = (1, 600)
RATING_RANGE = (0, 10)
SCORE_RANGE = (0, 10)
IMDB_RANGE = (0, 10)
RT_RANGE = (0, 100)
# ---------------------------------------------------------------------------


def parse_int(c) -> Column:
    """Drop every non-digit, then cast to int (overflow/empty -> null)."""
    return F.regexp_replace(col(c), NON_DIGITS, "").try_cast("int")


def parse_double(c) -> Column:
    """Keep digits and dots, then cast to double ("1.2.3", "." -> null)."""
    return F.regexp_replace(col(c), NON_DECIMAL, "").try_cast("double")


def parse_rating(c) -> Column:
    """Part before the first ``/``, then :func:`parse_double`."""
    return parse_double(F.split(col(c), RATING_SPLIT).getItem(0))


def range_or_null(c, lo, hi) -> Column:
    """The value when ``lo <= c <= hi``, else null."""
    c = col(c)
    return F.when(c.between(lo, hi), c)


def cast_ids(c) -> Column:
    """Identifier text -> bigint, null when not a number or out of range.  Decimals
    are cut off ("12.0" -> 12)."""
    return F.regexp_replace(col(c), DECIMALS, "$1").try_cast("bigint")


def round_avg(c, digits: int) -> Column:
    """Average rounded half-up to ``digits`` decimals, returned as double.

    Values are summed as decimals, exactly and in any order, and the average is rounded
    once.
    """
    return F.round(F.avg(col(c).cast("decimal(20,10)")), digits).cast("double")


def nan_to_null(c) -> Column:
    """Floating NaN -> null (other values, and null, unchanged)."""
    c = col(c)
    return F.when(~F.isnan(c), c)
