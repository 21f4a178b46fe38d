"""Column functions used by the cleaners and marts (all built-in Spark expressions)."""

from marquee.functions.dates import DATE_PATTERNS, date_iso, parse_date
from marquee.functions.numbers import (
    cast_ids, nan_to_null, parse_double, parse_int, parse_rating, range_or_null, round_avg,
)
from marquee.functions.text import (
    bool_map, coalesce_default, movie_key, movie_key_pair, nonblank, source_canon,
    str_initcap, str_lower_trim, str_trim,
)

__all__ = [
    "DATE_PATTERNS", "date_iso", "parse_date",
    "cast_ids", "nan_to_null", "parse_double", "parse_int", "parse_rating", "range_or_null",
    "round_avg",
    "bool_map", "coalesce_default", "movie_key", "movie_key_pair", "nonblank", "source_canon",
    "str_initcap", "str_lower_trim", "str_trim",
]
