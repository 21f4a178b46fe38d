"""Bronze -> silver cleaners, one per dataset (DataFrame -> DataFrame).

Each cleaner is a single projection (+ filter) followed by one
deterministic dedupe, so the whole cleaner is one scan, one codegen'd
projection and one shuffle on the dedupe key (pre-reduced map-side).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import (
    bool_map, cast_ids, movie_key, movie_key_pair, nonblank, parse_date, parse_double,
    parse_int, parse_rating, range_or_null, source_canon, str_initcap, str_lower_trim,
    str_trim,
)
from marquee.functions.numbers import (
    IMDB_RANGE, RATING_RANGE, RT_RANGE, RUNTIME_RANGE, SCORE_RANGE,
)
from marquee.functions.text import DEFAULT_CONTENT_TYPE
from marquee.operators.dedupe import first_per_key, first_per_key_keep_nulls


def project_movies(df: DataFrame, content_type: str = DEFAULT_CONTENT_TYPE) -> DataFrame:
    """Normalised movie columns, blank titles dropped, before dedupe."""
    title = str_initcap("title")
    return (df.select(
                title.alias("title"),
                F.lit(content_type).alias("type"),
                str_initcap("genre").alias("genre"),
                str_lower_trim("language").alias("language"),
                parse_date("release_date").alias("release_date"),
                range_or_null(parse_int("runtime"), *RUNTIME_RANGE).alias("runtime_min"),
                range_or_null(parse_rating("rating"), *RATING_RANGE).alias("rating"),
                parse_int("votes").alias("votes"),
                str_trim("director").alias("director"))
              .filter(nonblank("title"))
              .select(movie_key_pair("title", "type").alias("movie_key"), "title", "type", "genre",
                      "language", "release_date", "runtime_min", "rating", "votes", "director"))


def clean_movies(df: DataFrame, content_type: str = DEFAULT_CONTENT_TYPE) -> DataFrame:
    """One row per ``movie_key``; case variants of a title merge."""
    return first_per_key(project_movies(df, content_type), ["movie_key"])


def project_users(df: DataFrame) -> DataFrame:
    return df.select(
        cast_ids("user_id").alias("user_id"),
        str_trim("username").alias("username"),
        str_lower_trim("email").alias("email"),
        str_initcap("country").alias("country"),
        parse_date("signup_date").alias("signup_date"),
        bool_map("is_premium").alias("is_premium"))


def clean_users(df: DataFrame) -> DataFrame:
    """One row per e-mail (lowest ``user_id`` wins); rows without e-mail all kept."""
    return first_per_key_keep_nulls(project_users(df), "email", first=["user_id"])


def project_ratings(df: DataFrame) -> DataFrame:
    return df.select(
        cast_ids("rating_id").alias("rating_id"),
        cast_ids("user_id").alias("user_id"),
        movie_key("movie_title").alias("movie_key"),
        range_or_null(parse_double("score"), *SCORE_RANGE).alias("score"),
        parse_date("watched_date").alias("watched_date"))


def clean_ratings(df: DataFrame) -> DataFrame:
    return first_per_key(project_ratings(df), ["rating_id"])


def project_reviews(df: DataFrame) -> DataFrame:
    return df.select(
        cast_ids("review_id").alias("review_id"),
        cast_ids("user_id").alias("user_id"),
        movie_key("movie_title").alias("movie_key"),
        str_lower_trim("sentiment").alias("sentiment"),
        str_trim("body").alias("body"),
        parse_date("created_date").alias("created_date"))


def clean_reviews(df: DataFrame) -> DataFrame:
    return first_per_key(project_reviews(df), ["review_id"])


def project_scores(df: DataFrame) -> DataFrame:
    """Normalised score columns; rows without a usable title dropped."""
    return (df.select(
                movie_key("title").alias("movie_key"),
                range_or_null(parse_double("imdb_score"), *IMDB_RANGE).alias("imdb_score"),
                range_or_null(parse_int("rt_score"), *RT_RANGE).alias("rt_score"),
                source_canon("source").alias("source"),
                parse_date("collected_at").alias("collected_at"))
              .filter(F.col("movie_key").isNotNull()))


def clean_scores(df: DataFrame) -> DataFrame:
    return first_per_key(project_scores(df), ["movie_key", "source"])


def project_watchlist(df: DataFrame) -> DataFrame:
    """Keeps ``event_id`` for the dedupe; :func:`clean_watchlist` drops it."""
    return df.select(
        F.col("event_id"),
        str_trim("user").alias("username"),
        movie_key("title").alias("movie_key"),
        str_lower_trim("action").alias("action"),
        parse_date("event_time").alias("event_date"),
        str_lower_trim("device").alias("device"))


def clean_watchlist(df: DataFrame) -> DataFrame:
    return first_per_key(project_watchlist(df), ["event_id"]).drop("event_id")


def project_awards(df: DataFrame) -> DataFrame:
    """Keeps ``award_id`` for the dedupe; :func:`clean_awards` drops it."""
    return df.select(
        F.col("award_id"),
        movie_key("title").alias("movie_key"),
        str_initcap("category").alias("category"),
        parse_int("year").alias("year"),
        str_lower_trim("result").alias("result"))


def clean_awards(df: DataFrame) -> DataFrame:
    return first_per_key(project_awards(df), ["award_id"]).drop("award_id")


CLEANERS = {
    "movies": clean_movies,
    "users": clean_users,
    "ratings": clean_ratings,
    "reviews": clean_reviews,
    "scores": clean_scores,
    "watchlist": clean_watchlist,
    "awards": clean_awards,
}
