"""DuckDB oracle SQL keyed like :mod:`marquee.plans.queries`."""

from __future__ import annotations

from marquee.plans import oracles as o
from marquee.plans.oracles import initcap, mkey, title, with_


def _movies_bronze_scalar(select: str) -> str:
    return with_(o.M_ALL) + f"SELECT CAST(p + 1000 AS VARCHAR) AS id, {select} FROM m_all"


def _ratings_bronze_scalar(select: str) -> str:
    return with_(o.R_ALL) + f"SELECT CAST(rating_id AS VARCHAR) AS rating_id, {select} FROM r_all"


RT = "CASE p % 4 WHEN 0 THEN p_size * 13 WHEN 1 THEN p_size * 13 WHEN 2 THEN p_size * 130 END"
R = "CAST(p % 100 AS DOUBLE) / 10"

SCALAR = {
    "str_trim": _movies_bronze_scalar(
        "CASE (p + cp) % 4 WHEN 1 THEN lower(p_brand) WHEN 2 THEN upper(p_brand) ELSE p_brand END"
        " AS director"),
    "str_lower_trim": _movies_bronze_scalar(
        "CASE p % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'en' WHEN 2 THEN 'english' END AS language"),
    "str_initcap": _movies_bronze_scalar(
        f"CASE WHEN p % 19 = 0 THEN NULL ELSE {initcap('p_type')} END AS genre"),
    "parse_int": _movies_bronze_scalar(f"CAST({RT} AS INTEGER) AS runtime_min"),
    "parse_double": _ratings_bronze_scalar(
        "CASE WHEN k % 23 IN (0, 2) THEN NULL WHEN k % 23 = 1 THEN CAST(999 AS DOUBLE) "
        "WHEN k % 23 = 3 THEN CAST(3 AS DOUBLE) "
        "ELSE CAST(CAST(l_quantity * 2 AS BIGINT) AS DOUBLE) / 10 END AS score"),
    "parse_rating": _movies_bronze_scalar(
        f"CASE WHEN p % 4 = 2 THEN CAST(999 AS DOUBLE) ELSE {R} END AS rating"),
    "range_or_null": _movies_bronze_scalar(
        f"CASE WHEN p % 4 = 2 THEN NULL ELSE {R} END AS rating"),
    "parse_date": _ratings_bronze_scalar(
        f"{o.date_or_null('CAST(l_shipdate AS DATE)', 'k')} AS watched_date"),
    "date_iso": _movies_bronze_scalar(
        f"strftime({o.date_or_null(o.day('p'), 'p + cp')}, '%Y-%m-%d') AS release_date"),
    "bool_map": with_(o.U_ALL) + (
        "SELECT CAST(c AS VARCHAR) AS user_id, CASE c % 7 WHEN 0 THEN TRUE WHEN 1 THEN TRUE "
        "WHEN 2 THEN FALSE WHEN 3 THEN FALSE WHEN 6 THEN TRUE END AS is_premium FROM u_all"),
    "source_canon": with_(o.SC_ALL) + (
        "SELECT CASE src WHEN 0 THEN ' rotten_tomatoes ' WHEN 1 THEN 'IMDB' WHEN 2 THEN 'RT' "
        "ELSE 'imdb' END AS source_raw, CASE WHEN src IN (0, 2) THEN 'rotten_tomatoes' "
        "ELSE 'imdb' END AS source FROM sc_all"),
    "movie_key": _ratings_bronze_scalar(f"{mkey()} AS movie_key"),
    "movie_key_pair": _movies_bronze_scalar(
        "CASE WHEN cp = 2 THEN CASE WHEN p % 2 = 0 THEN '|movie' ELSE 'movie' END "
        f"ELSE {initcap(title('p_name', 'p'))} || '|movie' END AS movie_key"),
    "cast_ids": with_(o.R_ALL) + (
        "SELECT CAST(rating_id AS BIGINT) AS rating_id, CAST(user_id AS BIGINT) AS user_id "
        "FROM r_all"),
    "coalesce_default": _movies_bronze_scalar(
        f"CASE WHEN p % 19 = 0 THEN 'Unknown' ELSE {initcap('p_type')} END AS genre"),
    "round_avg": with_(*o.silver("ratings")) + (
        f"SELECT user_id, {o.round_avg('score', 2)} AS avg_score FROM s_ratings GROUP BY user_id"),
    "nan_to_null": ("SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal END "
                    "AS c_acctbal FROM customer"),
    "filter_nonblank": with_(o.M_ALL) + (
        f"SELECT CAST(p + 1000 AS VARCHAR) AS id, {initcap(title('p_name', 'p'))} AS title "
        "FROM m_all WHERE cp < 2"),
    "filter_key_not_null": with_(o.SC_ALL, o.SC_CLEAN) + "SELECT movie_key, source FROM sc_clean",
}


def _keyed(ctes: tuple[str, ...], name: str, cols: list[str]) -> str:
    return with_(*ctes) + f"SELECT {', '.join(cols)} FROM {name}"


def _last(ctes: tuple[str, ...], src: str, cols: list[str], keys: list[str]) -> str:
    return with_(*ctes) + o.first_per_key(src, cols, keys, [c for c in cols if c not in keys],
                                          "DESC NULLS LAST")


DEDUPE = {
    "dedupe_movies": _last((o.M_ALL, o.M_CLEAN), "m_clean", o.MOVIE_COLS, ["movie_key"]),
    "dedupe_ratings": _last((o.R_ALL, o.R_CLEAN), "r_clean", o.RATING_COLS, ["user_id", "movie_key"]),
    "dedupe_reviews": _last((o.V_ALL, o.V_CLEAN), "v_clean", o.REVIEW_COLS, ["review_id"]),
    "dedupe_scores": _last((o.SC_ALL, o.SC_CLEAN), "sc_clean", o.SCORE_COLS, ["movie_key", "source"]),
    "dedupe_watchlist": _keyed((o.W_ALL, o.W_CLEAN, o.S_WATCHLIST_K), "s_watchlist_k",
                               o.WATCH_COLS),
    "dedupe_awards": _keyed((o.A_ALL, o.A_CLEAN, o.S_AWARDS_K), "s_awards_k", o.AWARD_COLS),
    "dedupe_email": _last((o.U_ALL, o.U_CLEAN), "u_clean", o.USER_COLS, ["email"]),
}


def plan_oracles() -> dict[str, str]:
    out = {**SCALAR, **DEDUPE}
    for ds in o.SILVER_CTES:
        out[f"clean_{ds}"] = o.silver_sql(ds)
    for mart in o.GOLD_BODY:
        out[mart] = o.gold_sql(mart)
    out.update({
        "run_metrics_counts": o.RUN_METRICS,
        "left_join_ratings": o.LEFT_JOIN_RATINGS,
        "movie_360": o.MOVIE_360,
        "trending_titles": o.TRENDING,
    })
    return out
