"""Silver -> gold marts (DataFrame -> DataFrame).

Every per-title mart groups by ``movie_key``; its output is therefore
hash-partitioned on ``movie_key``, and :func:`movie_360` built in the same
plan joins them without another exchange (or AQE broadcasts a side whose
measured size is under ``spark.sql.autoBroadcastJoinThreshold``).
Aggregates are all partial-aggregatable, so a hot key is pre-reduced on
the map side before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import coalesce_default, round_avg

# ---- fixed values (must equal the reference's for equal results) ----------
# Counted category values after cleaning.
POSITIVE, NEGATIVE = "positive", "negative"
ADD, REMOVE = "add", "remove"
WON, NOMINATED = "won", "nominated"
# Number of rows in the trending list.
TRENDING_SIZE = 20
# User ids that share a bitmap of raters: a bigint's bits.
WORD_SHIFT = 6
RATERS_PER_WORD = 1 << WORD_SHIFT
# ---------------------------------------------------------------------------


def _rows():
    """COUNT(*)."""
    return F.count(F.lit(1))


def genre_summary(movies: DataFrame) -> DataFrame:
    """Titles, average rating (2 dp) and runtime (0 dp) per genre and type."""
    return (movies.groupBy(coalesce_default("genre").alias("genre"), "type")
                  .agg(_rows().alias("titles"),
                       round_avg("rating", 2).alias("avg_rating"),
                       round_avg("runtime_min", 0).alias("avg_runtime_min")))


def fact_ratings(ratings: DataFrame) -> DataFrame:
    """Per title over scored ratings: count, average (2 dp), distinct raters.

    ``countDistinct`` plans as two aggregation levels (first on
    ``(movie_key, user_id)``), so a title with a third of all ratings is
    spread over user ids in the first shuffle.
    """
    return (ratings.where(F.col("score").isNotNull())
                   .groupBy("movie_key")
                   .agg(_rows().alias("rating_count"),
                        round_avg("score", 2).alias("avg_score"),
                        F.countDistinct("user_id").alias("unique_raters")))


def rating_state(ratings: DataFrame) -> DataFrame:
    """``fact_ratings`` as partial state that merges: per title and word of ``RATERS_PER_WORD`` user
    ids, a bitmap of the raters, the scored ratings and the exact sum of their scores.  Ratings
    without a user have a word of their own, without a bitmap.

    A bitmap is one number, so the state is never more rows than the ratings, nor wider; its
    aggregates are of fixed size, so they are hashed and not sorted."""
    score = F.col("score").cast("decimal(20,10)")
    user = F.col("user_id").cast("bigint")
    rater = F.expr(f"shiftleft(1L, CAST(pmod(CAST(user_id AS BIGINT), {RATERS_PER_WORD}) AS INT))")
    return (ratings.where(F.col("score").isNotNull())
                   .groupBy("movie_key", F.shiftright(user, WORD_SHIFT).alias("bucket"))
                   .agg(F.bit_or(rater).alias("raters"),
                        _rows().alias("ratings"), F.sum(score).alias("score_sum")))


def merge_rating_states(*states: DataFrame) -> DataFrame:
    """One state for the ratings of all: a rater who is in several counts once.  The ratings
    themselves must differ, and are not read again."""
    both = reduce(DataFrame.unionByName, states)
    return (both.groupBy("movie_key", "bucket")
                .agg(F.bit_or("raters").alias("raters"), F.sum("ratings").alias("ratings"),
                     F.sum("score_sum").cast("decimal(30,10)").alias("score_sum")))


def fact_ratings_of(state: DataFrame) -> DataFrame:
    """``fact_ratings`` of a state, with exact numbers of distinct raters."""
    raters = F.when(F.col("bucket").isNotNull(), F.bit_count("raters")).otherwise(0)
    average = F.sum("score_sum") / F.sum("ratings").cast("decimal(20,0)")
    return state.groupBy("movie_key").agg(
        F.sum("ratings").alias("rating_count"),
        F.round(average.cast("decimal(24,14)"), 2).cast("double").alias("avg_score"),
        F.sum(raters).alias("unique_raters"))


def review_summary(reviews: DataFrame) -> DataFrame:
    return (reviews.where(F.col("movie_key").isNotNull())
                   .groupBy("movie_key")
                   .agg(_rows().alias("review_count"),
                        F.count_if(F.col("sentiment") == POSITIVE).alias("positive"),
                        F.count_if(F.col("sentiment") == NEGATIVE).alias("negative")))


def score_summary(scores: DataFrame) -> DataFrame:
    """Highest IMDb and RT score per title, each column on its own."""
    return (scores.groupBy("movie_key")
                  .agg(F.max("imdb_score").alias("imdb_score"),
                       F.max("rt_score").alias("rt_score")))


def title_popularity(watchlist: DataFrame) -> DataFrame:
    return (watchlist.where(F.col("movie_key").isNotNull())
                     .groupBy("movie_key")
                     .agg(F.count_if(F.col("action") == ADD).alias("adds"),
                          F.count_if(F.col("action") == REMOVE).alias("removes")))


def awards_won(awards: DataFrame) -> DataFrame:
    return (awards.where(F.col("movie_key").isNotNull())
                  .groupBy("movie_key")
                  .agg(F.count_if(F.col("result") == WON).alias("wins"),
                       F.count_if(F.col("result") == NOMINATED).alias("nominations")))


def users_by_country(users: DataFrame) -> DataFrame:
    """Users and premium users per country (null premium counts as not premium)."""
    return (users.groupBy(coalesce_default("country").alias("country"))
                 .agg(_rows().alias("users"),
                      F.sum(F.when(F.col("is_premium"), 1).otherwise(0)).cast("bigint")
                       .alias("premium_users")))


# dataset -> (gold table name, mart builder)
MARTS = {
    "movies": ("genre_summary", genre_summary),
    "ratings": ("fact_ratings", fact_ratings),
    "reviews": ("review_summary", review_summary),
    "scores": ("score_summary", score_summary),
    "watchlist": ("title_popularity", title_popularity),
    "awards": ("awards_won", awards_won),
    "users": ("users_by_country", users_by_country),
}

MOVIE_360_COLUMNS = ("movie_key", "title", "type", "genre", "release_date", "runtime_min",
                     "catalog_rating", "user_avg_score", "rating_count", "imdb_score",
                     "rt_score", "watchlist_adds", "award_wins", "review_count")


def left_join_on_key(left: DataFrame, right: DataFrame, key: str = "movie_key") -> DataFrame:
    """One left equi-join step; ``right`` is unique on ``key``."""
    return left.join(right, key, "left")


def movie_360(movies: DataFrame, fact_ratings_df: DataFrame, score_summary_df: DataFrame,
              title_popularity_df: DataFrame, awards_won_df: DataFrame,
              review_summary_df: DataFrame) -> DataFrame:
    """One row per silver movie with every source's measures; no match -> null."""
    base = movies.select("movie_key", "title", "type", "genre", "release_date", "runtime_min",
                         F.col("rating").alias("catalog_rating"))
    sides = [
        fact_ratings_df.select("movie_key", F.col("avg_score").alias("user_avg_score"),
                               "rating_count"),
        score_summary_df.select("movie_key", "imdb_score", "rt_score"),
        title_popularity_df.select("movie_key", F.col("adds").alias("watchlist_adds")),
        awards_won_df.select("movie_key", F.col("wins").alias("award_wins")),
        review_summary_df.select("movie_key", "review_count"),
    ]
    return reduce(left_join_on_key, sides, base).select(*MOVIE_360_COLUMNS)


def trending_titles(m360: DataFrame, n: int = TRENDING_SIZE) -> DataFrame:
    """Top ``n`` by watchlist adds, then user score (missing = 0), then key.

    ``orderBy().limit()`` plans as ``TakeOrderedAndProject``: each task keeps
    its own top ``n`` and only those rows reach the final merge.
    """
    return (m360.orderBy(F.coalesce("watchlist_adds", F.lit(0)).desc(),
                         F.coalesce("user_avg_score", F.lit(0.0)).desc(),
                         F.col("movie_key").asc_nulls_first())
                .limit(n)
                .select("movie_key", "title", "genre", "watchlist_adds", "user_avg_score",
                        "award_wins"))


def table_counts(tables: dict[str, DataFrame | None]) -> DataFrame:
    """One row ``total_<name>`` per input (0 for a missing table), in one job.

    Each table is reduced to a single partial count on its own; the counts
    are then folded into one row by a global aggregate (no cross join).
    """
    parts = [df.agg(_rows().alias("n")).select(F.lit(name).alias("t"), "n")
             for name, df in tables.items() if df is not None]
    cols = [F.coalesce(F.sum(F.when(F.col("t") == name, F.col("n"))), F.lit(0)).cast("bigint")
             .alias(f"total_{name}") for name in tables]
    if not parts:
        raise ValueError("table_counts needs at least one existing table")
    return reduce(DataFrame.unionByName, parts).agg(*cols)
