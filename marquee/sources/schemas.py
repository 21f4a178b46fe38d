"""Fixed schemas: bronze is all nullable strings (raw tokens as-is), silver is typed."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


BRONZE = {
    "movies": _strings("id", "title", "type", "genre", "language", "release_date",
                       "runtime", "rating", "votes", "director"),
    "scores": _strings("title", "imdb_score", "rt_score", "source", "collected_at"),
    "watchlist": _strings("event_id", "user", "title", "action", "event_time", "device"),
    "awards": _strings("award_id", "title", "category", "year", "result"),
    "users": _strings("user_id", "username", "email", "country", "signup_date", "is_premium"),
    "ratings": _strings("rating_id", "user_id", "movie_title", "score", "watched_date", "review"),
    "reviews": _strings("review_id", "user_id", "movie_title", "sentiment", "body", "created_date"),
}


def _typed(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


STR, DATE, INT, LONG, DBL, BOOL = (StringType(), DateType(), IntegerType(), LongType(), DoubleType(),
                                   BooleanType())

SILVER = {
    "movies": _typed(("movie_key", STR), ("title", STR), ("type", STR), ("genre", STR), ("language", STR),
                     ("release_date", DATE), ("runtime_min", INT), ("rating", DBL), ("votes", INT),
                     ("director", STR)),
    "scores": _typed(("movie_key", STR), ("imdb_score", DBL), ("rt_score", INT), ("source", STR),
                     ("collected_at", DATE)),
    "watchlist": _typed(("username", STR), ("movie_key", STR), ("action", STR), ("event_date", DATE),
                        ("device", STR)),
    "awards": _typed(("movie_key", STR), ("category", STR), ("year", INT), ("result", STR)),
    "users": _typed(("user_id", LONG), ("username", STR), ("email", STR), ("country", STR),
                    ("signup_date", DATE), ("is_premium", BOOL)),
    "ratings": _typed(("rating_id", LONG), ("user_id", LONG), ("movie_key", STR), ("score", DBL),
                      ("watched_date", DATE)),
    "reviews": _typed(("review_id", LONG), ("user_id", LONG), ("movie_key", STR), ("sentiment", STR),
                      ("body", STR), ("created_date", DATE)),
}

# Append-only logs.
AUDIT = StructType([
    StructField("dataset", STR, True), StructField("layer", STR, True),
    StructField("table_name", STR, True), StructField("total_rows", LONG, True),
    StructField("status", STR, True),
])
