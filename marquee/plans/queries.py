"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Pure-plan queries (scalars, dedupe, cleaners, marts, joins) build the dirty
bronze feed from the driver tables and run the operator on it.  Queries for
readers, writers and pipeline steps write under the session's shared
folder (``spark.checkpoint.dir``) and return the read-back result.
Non-deterministic columns (``created_at``, ``run_time``) are dropped from
what is returned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import functions as fn
from marquee.operators import cleaners as cl
from marquee.operators import marts as mt
from marquee.operators.dedupe import first_per_key, first_per_key_by
from marquee.plans import fixtures as fx
from marquee.session import apply_settings

Query = Callable[[SparkSession, str], DataFrame]


def _silver(spark: SparkSession, sf_dir: str, ds: str) -> DataFrame:
    return cl.CLEANERS[ds](fx.bronze(spark, sf_dir, ds))


def _gold(spark: SparkSession, sf_dir: str, mart: str) -> DataFrame:
    for ds, (name, build) in mt.MARTS.items():
        if name == mart:
            return build(_silver(spark, sf_dir, ds))
    raise ValueError(f"no gold mart {mart}")


def _movie_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = {ds: _silver(spark, sf_dir, ds)
         for ds in ("movies", "ratings", "scores", "watchlist", "awards", "reviews")}
    return mt.movie_360(s["movies"], mt.fact_ratings(s["ratings"]), mt.score_summary(s["scores"]),
                        mt.title_popularity(s["watchlist"]), mt.awards_won(s["awards"]),
                        mt.review_summary(s["reviews"]))


# ---- scalar functions, each on a fixture column --------------------------

def q_str_trim(spark, d):
    return fx.bronze(spark, d, "movies").select("id", fn.str_trim("director").alias("director"))


def q_str_lower_trim(spark, d):
    return fx.bronze(spark, d, "movies").select("id", fn.str_lower_trim("language").alias("language"))


def q_str_initcap(spark, d):
    return fx.bronze(spark, d, "movies").select("id", fn.str_initcap("genre").alias("genre"))


def q_parse_int(spark, d):
    return fx.bronze(spark, d, "movies").select("id", fn.parse_int("runtime").alias("runtime_min"))


def q_parse_double(spark, d):
    return fx.bronze(spark, d, "ratings").select("rating_id", fn.parse_double("score").alias("score"))


def q_parse_rating(spark, d):
    return fx.bronze(spark, d, "movies").select("id", fn.parse_rating("rating").alias("rating"))


def q_range_or_null(spark, d):
    return fx.bronze(spark, d, "movies").select(
        "id", fn.range_or_null(fn.parse_rating("rating"), 0, 10).alias("rating"))


def q_parse_date(spark, d):
    return fx.bronze(spark, d, "ratings").select("rating_id",
                                       fn.parse_date("watched_date").alias("watched_date"))


def q_date_iso(spark, d):
    return fx.bronze(spark, d, "movies").select(
        "id", fn.date_iso(fn.parse_date("release_date")).alias("release_date"))


def q_bool_map(spark, d):
    return fx.bronze(spark, d, "users").select("user_id", fn.bool_map("is_premium").alias("is_premium"))


def q_source_canon(spark, d):
    return fx.bronze(spark, d, "scores").select(F.col("source").alias("source_raw"),
                                      fn.source_canon("source").alias("source"))


def q_movie_key(spark, d):
    return fx.bronze(spark, d, "ratings").select("rating_id", fn.movie_key("movie_title").alias("movie_key"))


def q_movie_key_pair(spark, d):
    return fx.bronze(spark, d, "movies").select(
        "id", fn.movie_key_pair(fn.str_initcap("title"), fn.str_lower_trim("type"))
        .alias("movie_key"))


def q_cast_ids(spark, d):
    return fx.bronze(spark, d, "ratings").select(fn.cast_ids("rating_id").alias("rating_id"),
                                       fn.cast_ids("user_id").alias("user_id"))


def q_coalesce_default(spark, d):
    return fx.bronze(spark, d, "movies").select(
        "id", fn.coalesce_default(fn.str_initcap("genre")).alias("genre"))


def q_round_avg(spark, d):
    r = _silver(spark, d, "ratings")
    return r.groupBy("user_id").agg(fn.round_avg("score", 2).alias("avg_score"))


def q_nan_to_null(spark, d):
    c = fx.read_table(spark, d, "customer")
    with_nan = F.when(F.col("c_custkey") % 9 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal"))
    return c.select("c_custkey", fn.nan_to_null(with_nan).alias("c_acctbal"))


# ---- filters ---------------------------------------------------------------

def q_filter_nonblank(spark, d):
    m = fx.bronze(spark, d, "movies").select("id", fn.str_initcap("title").alias("title"))
    return m.filter(fn.nonblank("title"))


def q_filter_key_not_null(spark, d):
    return cl.project_scores(fx.bronze(spark, d, "scores")).select("movie_key", "source")


# ---- dedupe ----------------------------------------------------------------

def _last_per_key(df, keys):
    """The window form with the order turned round: the last row of each key."""
    return first_per_key_by(df, keys, [F.col(c).desc_nulls_last() for c in df.columns
                                       if c not in keys])


def q_dedupe_movies(spark, d):
    return _last_per_key(cl.project_movies(fx.bronze(spark, d, "movies")), ["movie_key"])


def q_dedupe_ratings(spark, d):
    """The last rating of each user for each title."""
    return _last_per_key(cl.project_ratings(fx.bronze(spark, d, "ratings")),
                         ["user_id", "movie_key"])


def q_dedupe_reviews(spark, d):
    return _last_per_key(cl.project_reviews(fx.bronze(spark, d, "reviews")), ["review_id"])


def q_dedupe_scores(spark, d):
    return _last_per_key(cl.project_scores(fx.bronze(spark, d, "scores")), ["movie_key", "source"])


def q_dedupe_watchlist(spark, d):
    return first_per_key(cl.project_watchlist(fx.bronze(spark, d, "watchlist")), ["event_id"])


def q_dedupe_awards(spark, d):
    return first_per_key(cl.project_awards(fx.bronze(spark, d, "awards")), ["award_id"])


def q_dedupe_email(spark, d):
    """One row per e-mail, null e-mails as one key, the highest user id first."""
    return _last_per_key(cl.project_users(fx.bronze(spark, d, "users")), ["email"])


# ---- marts, joins, top-k ---------------------------------------------------

def _mart_query(mart: str) -> Query:
    def q(spark, d):
        return _gold(spark, d, mart)
    q.__name__ = f"q_{mart}"
    return q


def q_movie_360(spark, d):
    return _movie_360(spark, d)


def q_trending_titles(spark, d):
    return mt.trending_titles(_movie_360(spark, d))


def q_left_join_ratings(spark, d):
    m = _silver(spark, d, "movies").select("movie_key", "title")
    fr = mt.fact_ratings(_silver(spark, d, "ratings")).select(
        "movie_key", F.col("avg_score").alias("user_avg_score"), "rating_count")
    return mt.left_join_on_key(m, fr)


def q_run_metrics_counts(spark, d):
    return mt.table_counts({ds: _silver(spark, d, ds)
                            for ds in ("movies", "users", "ratings", "reviews")})


def _cleaner_query(ds: str) -> Query:
    def q(spark, d):
        return _silver(spark, d, ds)
    q.__name__ = f"q_clean_{ds}"
    return q


def plan_queries() -> dict[str, Query]:
    """Queries that are pure DataFrame plans over the driver tables."""
    qs: dict[str, Query] = {
        "str_trim": q_str_trim,
        "str_lower_trim": q_str_lower_trim,
        "str_initcap": q_str_initcap,
        "parse_int": q_parse_int,
        "parse_double": q_parse_double,
        "parse_rating": q_parse_rating,
        "range_or_null": q_range_or_null,
        "parse_date": q_parse_date,
        "date_iso": q_date_iso,
        "bool_map": q_bool_map,
        "source_canon": q_source_canon,
        "movie_key": q_movie_key,
        "movie_key_pair": q_movie_key_pair,
        "cast_ids": q_cast_ids,
        "coalesce_default": q_coalesce_default,
        "round_avg": q_round_avg,
        "nan_to_null": q_nan_to_null,
        "filter_nonblank": q_filter_nonblank,
        "filter_key_not_null": q_filter_key_not_null,
        "dedupe_movies": q_dedupe_movies,
        "dedupe_ratings": q_dedupe_ratings,
        "dedupe_reviews": q_dedupe_reviews,
        "dedupe_scores": q_dedupe_scores,
        "dedupe_watchlist": q_dedupe_watchlist,
        "dedupe_awards": q_dedupe_awards,
        "dedupe_email": q_dedupe_email,
    }
    for ds in cl.CLEANERS:
        qs[f"clean_{ds}"] = _cleaner_query(ds)
    for _, (mart, _) in mt.MARTS.items():
        qs[mart] = _mart_query(mart)
    qs.update({
        "run_metrics_counts": q_run_metrics_counts,
        "left_join_ratings": q_left_join_ratings,
        "movie_360": q_movie_360,
        "trending_titles": q_trending_titles,
    })
    return qs


def with_settings(q: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_settings(spark)
        return q(spark, sf_dir)
    run.__name__ = getattr(q, "__name__", "query")
    return run
