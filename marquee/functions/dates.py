"""Multi-format date parsing (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions._col import col

# ---- fixed values (must equal the reference's for equal results) ----------
# Accepted layouts, tried in this order; the first that parses wins.
# Single-letter M / d accept one or two digits.  The separators keep the
# layouts apart: "/" after a day means day-first, "-" before a year means
# month-first.
DATE_PATTERNS = (
    "yyyy-M-d",
    "d/M/yyyy",
    "M-d-yyyy",
    "yyyy/M/d",
    "MMMM d, yyyy",
    "MMM d yyyy",
)
ISO_DATE = "yyyy-MM-dd"
# ---------------------------------------------------------------------------

# Leading text that the layouts can parse ("yyyy" takes exactly four ASCII digits, "M"/"d" one or more,
# no signs, month names are letters).  What follows a date -- a time, a zone -- is ignored.
_PART = "0*([0-9]{1,2})(?![0-9])"
_YEAR = "([0-9]{4})(?![0-9])"
#: The four layouts of digits, in their order, as one pattern; year, month and day of whichever matches
#: (of none, only the dashes, which are no date).
_DIGITS = (f"^(?:{_YEAR}-{_PART}-{_PART}|{_PART}/{_PART}/{_YEAR}"
           f"|{_PART}-{_PART}-{_YEAR}|{_YEAR}/{_PART}/{_PART}|).*$")
_YEAR_MONTH_DAY = "$1$6$9$10-$2$5$7$11-$3$4$8$12"
_NAMED = {
    "MMMM d, yyyy": r"^[A-Za-z]+ [0-9]+, [0-9]{4}(?![0-9])",
    "MMM d yyyy": r"^[A-Za-z]+ [0-9]+ [0-9]{4}(?![0-9])",
}


def parse_date(c) -> Column:
    """First of ``DATE_PATTERNS`` that parses the trimmed text, as a DateType; else null.

    Layouts of digits are brought to one by one pattern and cast once; a layout with a month's
    name is attempted only on text of its shape.  ``try_cast`` and ``try_to_date`` keep ANSI mode on
    without failing on bad input.  Text after a valid date (``2021-03-04T10:00``) is ignored.
    """
    t = F.trim(col(c))
    digits = F.regexp_replace(t, "(?s)" + _DIGITS, _YEAR_MONTH_DAY).try_cast("date")
    named = [F.when(t.rlike(shape), F.try_to_date(F.regexp_extract(t, shape, 0), p))
             for p, shape in _NAMED.items()]
    return F.when(t.rlike("^[0-9]"), digits).otherwise(F.coalesce(*named))


def date_iso(c) -> Column:
    """DateType -> ``yyyy-MM-dd`` text."""
    return F.date_format(col(c), ISO_DATE)
