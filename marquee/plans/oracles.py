"""Independent DuckDB SQL for every registered query.

The oracle never parses the dirty text: it computes each *clean* value
directly from the driver table columns the fixture was derived from
(FIXTURES.md §3).  A cleaner that mis-parses a date, keeps a padded
string or picks a different duplicate therefore fails the comparison.
Only the ``scan_*`` / ``sink_bronze_*`` oracles produce the dirty bronze
text itself, because those queries check that readers keep raw tokens.
"""

from __future__ import annotations


def initcap(x: str) -> str:
    """Spark's initcap in DuckDB: lower-case, then upper-case the first
    character of every space-separated word."""
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


def title(name: str = "p_name", key: str = "p_partkey") -> str:
    return f"({name} || ' ' || CAST({key} AS VARCHAR))"


def mkey(name: str = "p_name", key: str = "p_partkey") -> str:
    """Clean movie key from the part columns (null when there is no part)."""
    return f"({initcap(title(name, key))} || '|movie')"


def day(x: str) -> str:
    return f"CAST(DATE '2016-01-01' + CAST(({x}) % 3000 AS INTEGER) AS DATE)"


def date_or_null(d: str, m: str) -> str:
    """The fixture writes style ``m % 9``; style 8 is null, all others parse back."""
    return f"CASE WHEN ({m}) % 9 = 8 THEN NULL ELSE {d} END"


def dirty_case(x: str, m: str) -> str:
    return (f"CASE ({m}) % 4 WHEN 0 THEN {x} WHEN 1 THEN lower({x}) WHEN 2 THEN upper({x}) "
            f"ELSE ' ' || {x} || ' ' END")


def dirty_date(d: str, m: str) -> str:
    styles = ("%Y-%m-%d", "%d/%m/%Y", "%B %d, %Y", "%m-%d-%Y", "%Y/%m/%d", "%b %d %Y",
              "%Y-%-m-%-d", "%-d/%-m/%Y")
    return (f"CASE ({m}) % 9 "
            + " ".join(f"WHEN {i} THEN strftime({d}, '{s}')" for i, s in enumerate(styles)) + " END")


def quoted(c: str, m: str) -> str:
    return (f"CASE ({m}) % 5 WHEN 0 THEN {c} WHEN 1 THEN 'Good, \"Bad\" and ' || {c} "
            f"WHEN 2 THEN 'say \"hi\", ' || {c} WHEN 3 THEN {c} || chr(10) || 'II' "
            f"WHEN 4 THEN {c} || chr(92) END")


def tenths_text(t: str) -> str:
    return f"(CAST(({t}) // 10 AS VARCHAR) || '.' || CAST(({t}) % 10 AS VARCHAR))"


def first_per_key(src: str, cols: list[str], keys: list[str], order: list[str],
                  direction: str = "ASC NULLS FIRST") -> str:
    o = ", ".join(f"{c} {direction}" for c in order)
    k = ", ".join(keys)
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {k} "
            f"ORDER BY {o}) AS rn__ FROM {src}) WHERE rn__ = 1")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --------------------------------------------------------------------------
# Source rows of each fixture (which table row, which copy)
# --------------------------------------------------------------------------

M_ALL = """m_all AS (
  SELECT p_partkey AS p, p_name, p_brand, p_type, p_size, 0 AS cp FROM part
  UNION ALL SELECT p_partkey, p_name, p_brand, p_type, p_size, 1 FROM part WHERE p_partkey % 7 = 0
  UNION ALL SELECT p_partkey, p_name, p_brand, p_type, p_size, 2 FROM part WHERE p_partkey % 31 = 5)"""

U_ALL = """u_base AS (SELECT c_custkey AS c, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
u_all AS (SELECT * FROM u_base UNION ALL SELECT * FROM u_base WHERE c % 101 = 0)"""

R_ALL = """r_all AS (
  SELECT l_orderkey * 10 + l_linenumber AS rating_id, o_custkey AS user_id, p_name, p_partkey,
         l_linenumber, l_orderkey * 7 + l_partkey * 3 + l_linenumber AS k, l_quantity, l_shipdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey)"""

V_ALL = """v_base AS (
  SELECT d.doc_id, d.text, lb.quality, p.p_name, p.p_partkey
  FROM documents d LEFT JOIN labels lb ON d.doc_id = lb.doc_id
  LEFT JOIN part p ON d.doc_id // 3 = p.p_partkey),
v_all AS (SELECT *, 0 AS rep FROM v_base UNION ALL SELECT *, 1 AS rep FROM v_base WHERE doc_id % 9 = 0)"""

SC_ALL = """sc_all AS (
  SELECT p_partkey AS p, p_name, p_size, 0 AS src FROM part
  UNION ALL SELECT p_partkey, p_name, p_size, 1 FROM part
  UNION ALL SELECT p_partkey, p_name, p_size, 2 FROM part WHERE p_partkey % 5 = 0
  UNION ALL SELECT p_partkey, p_name, p_size, 3 FROM part WHERE p_partkey % 37 = 0)"""

W_ALL = """w_base AS (
  SELECT e.event_id, e.user_id, e.event_type, e.ts, p.p_name, p.p_partkey
  FROM events e LEFT JOIN part p ON TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT) = p.p_partkey),
w_all AS (SELECT *, 0 AS rep FROM w_base UNION ALL SELECT *, 1 AS rep FROM w_base WHERE event_id % 50 = 0)"""

A_ALL = """a_base AS (
  SELECT o_orderkey AS o, o_orderpriority, o_orderstatus, o_orderdate, p_name, p_partkey
  FROM orders LEFT JOIN part ON o_orderkey // 8 = p_partkey),
a_all AS (SELECT *, 0 AS rep FROM a_base UNION ALL SELECT *, 1 AS rep FROM a_base WHERE o % 11 = 0)"""

# --------------------------------------------------------------------------
# Clean rows (before dedupe) computed from the source columns
# --------------------------------------------------------------------------

M_CLEAN = f"""m_clean AS (
  SELECT {mkey('p_name', 'p')} AS movie_key, {initcap(title('p_name', 'p'))} AS title,
    'movie' AS type,
    CASE WHEN p % 19 = 0 THEN NULL ELSE {initcap('p_type')} END AS genre,
    CASE p % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'en' WHEN 2 THEN 'english' END AS language,
    {date_or_null(day('p'), 'p + cp')} AS release_date,
    CAST(CASE WHEN rt BETWEEN 1 AND 600 THEN rt END AS INTEGER) AS runtime_min,
    CASE WHEN p % 4 = 2 THEN NULL ELSE CAST(p % 100 AS DOUBLE) / 10 END AS rating,
    CAST(CASE WHEN p % 5 = 0 THEN NULL ELSE (p % 1000000) * 37 END AS INTEGER) AS votes,
    CASE (p + cp) % 4 WHEN 1 THEN lower(p_brand) WHEN 2 THEN upper(p_brand) ELSE p_brand END
      AS director
  FROM (SELECT *, CASE p % 4 WHEN 0 THEN p_size * 13 WHEN 1 THEN p_size * 13
                             WHEN 2 THEN p_size * 130 END AS rt FROM m_all) WHERE cp < 2)"""

MOVIE_COLS = ["movie_key", "title", "type", "genre", "language", "release_date", "runtime_min",
              "rating", "votes", "director"]
S_MOVIES = ("s_movies AS (" + first_per_key("m_clean", MOVIE_COLS, ["movie_key"], MOVIE_COLS[1:])
            + ")")

U_CLEAN = f"""u_clean AS (
  SELECT CAST(c AS BIGINT) AS user_id,
    CASE WHEN c % 4 = 2 THEN 'USER' ELSE 'user' END || CAST(c AS VARCHAR) AS username,
    CASE WHEN c % 11 = 0 THEN NULL WHEN c % 23 = 0 THEN ''
         ELSE 'user' || CAST(CASE WHEN c % 13 = 1 THEN c - 1 ELSE c END AS VARCHAR) || '@example.com'
    END AS email,
    CASE WHEN c % 17 = 0 THEN NULL ELSE {initcap('n_name')} END AS country,
    {date_or_null(day('c'), 'c')} AS signup_date,
    CASE c % 7 WHEN 0 THEN TRUE WHEN 1 THEN TRUE WHEN 2 THEN FALSE WHEN 3 THEN FALSE
               WHEN 6 THEN TRUE END AS is_premium
  FROM u_all)"""

USER_COLS = ["user_id", "username", "email", "country", "signup_date", "is_premium"]
S_USERS = ("s_users AS (" + first_per_key("(SELECT * FROM u_clean WHERE email IS NOT NULL)",
                                          USER_COLS, ["email"],
                                          ["user_id", "username", "country", "signup_date",
                                           "is_premium"])
           + f" UNION ALL SELECT {', '.join(USER_COLS)} FROM u_clean WHERE email IS NULL)")

R_CLEAN = f"""r_clean AS (
  SELECT CAST(rating_id AS BIGINT) AS rating_id, CAST(user_id AS BIGINT) AS user_id,
    {mkey()} AS movie_key,
    CASE WHEN k % 23 IN (0, 1, 2) THEN NULL WHEN k % 23 = 3 THEN CAST(3 AS DOUBLE)
         ELSE CAST(CAST(l_quantity * 2 AS BIGINT) AS DOUBLE) / 10 END AS score,
    {date_or_null('CAST(l_shipdate AS DATE)', 'k')} AS watched_date
  FROM r_all)"""

RATING_COLS = ["rating_id", "user_id", "movie_key", "score", "watched_date"]
S_RATINGS = ("s_ratings AS (" + first_per_key("r_clean", RATING_COLS, ["rating_id"],
                                              RATING_COLS[1:]) + ")")

V_CLEAN = f"""v_clean AS (
  SELECT CAST(doc_id AS BIGINT) AS review_id, CAST(doc_id + 1 AS BIGINT) AS user_id,
    {mkey()} AS movie_key,
    CASE WHEN quality = 1 THEN 'positive' WHEN quality = 0 THEN 'negative'
         WHEN doc_id % 2 = 0 THEN 'neutral' END AS sentiment,
    trim(text, ' ') AS body,
    {date_or_null(day('doc_id'), 'doc_id + rep')} AS created_date
  FROM v_all)"""

REVIEW_COLS = ["review_id", "user_id", "movie_key", "sentiment", "body", "created_date"]
S_REVIEWS = ("s_reviews AS (" + first_per_key("v_clean", REVIEW_COLS, ["review_id"],
                                              REVIEW_COLS[1:]) + ")")

SC_CLEAN = f"""sc_clean AS (
  SELECT {mkey('p_name', 'p')} AS movie_key,
    CASE WHEN (p + src) % 3 = 0 THEN CAST(p % 100 AS DOUBLE) / 10 END AS imdb_score,
    CAST(CASE p % 3 WHEN 0 THEN p_size + src
                    WHEN 1 THEN CASE WHEN p_size * 3 <= 100 THEN p_size * 3 END END AS INTEGER)
      AS rt_score,
    CASE WHEN src = 1 THEN 'imdb' ELSE 'rotten_tomatoes' END AS source,
    {date_or_null(day('p'), 'p + src')} AS collected_at
  FROM sc_all WHERE src < 3)"""

SCORE_COLS = ["movie_key", "imdb_score", "rt_score", "source", "collected_at"]
S_SCORES = ("s_scores AS (" + first_per_key("sc_clean", SCORE_COLS, ["movie_key", "source"],
                                            ["imdb_score", "rt_score", "collected_at"]) + ")")

W_CLEAN = f"""w_clean AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
    CASE WHEN (event_id + rep) % 4 = 2 THEN 'USER' ELSE 'user' END || CAST(user_id AS VARCHAR)
      AS username,
    {mkey()} AS movie_key,
    CASE event_type WHEN 'error' THEN 'remove' WHEN 'view' THEN 'peek' ELSE 'add' END AS action,
    {date_or_null('CAST(ts AS DATE)', 'event_id + rep')} AS event_date,
    CASE event_id % 4 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' WHEN 2 THEN 'web' ELSE '' END
      AS device
  FROM w_all)"""

WATCH_COLS = ["event_id", "username", "movie_key", "action", "event_date", "device"]
S_WATCHLIST_K = ("s_watchlist_k AS (" + first_per_key("w_clean", WATCH_COLS, ["event_id"],
                                                      WATCH_COLS[1:]) + ")")
S_WATCHLIST = "s_watchlist AS (SELECT username, movie_key, action, event_date, device FROM s_watchlist_k)"

A_CLEAN = f"""a_clean AS (
  SELECT CAST(o AS VARCHAR) AS award_id, {mkey()} AS movie_key,
    {initcap('o_orderpriority')} AS category,
    CASE WHEN o % 6 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS year,
    CASE o_orderstatus WHEN 'F' THEN 'won' WHEN 'O' THEN 'nominated' WHEN 'P' THEN 'pending' END
      AS result
  FROM a_all)"""

AWARD_COLS = ["award_id", "movie_key", "category", "year", "result"]
S_AWARDS_K = ("s_awards_k AS (" + first_per_key("a_clean", AWARD_COLS, ["award_id"],
                                                AWARD_COLS[1:]) + ")")
S_AWARDS = "s_awards AS (SELECT movie_key, category, year, result FROM s_awards_k)"

SILVER_CTES = {
    "movies": (M_ALL, M_CLEAN, S_MOVIES),
    "users": (U_ALL, U_CLEAN, S_USERS),
    "ratings": (R_ALL, R_CLEAN, S_RATINGS),
    "reviews": (V_ALL, V_CLEAN, S_REVIEWS),
    "scores": (SC_ALL, SC_CLEAN, S_SCORES),
    "watchlist": (W_ALL, W_CLEAN, S_WATCHLIST_K, S_WATCHLIST),
    "awards": (A_ALL, A_CLEAN, S_AWARDS_K, S_AWARDS),
}


def silver(*datasets: str) -> list[str]:
    out: list[str] = []
    for ds in datasets:
        out.extend(SILVER_CTES[ds])
    return out


# --------------------------------------------------------------------------
# Dirty bronze rows (for the reader / sink checks)
# --------------------------------------------------------------------------

B_MOVIES = f"""b_movies AS (
  SELECT CAST(p + 1000 AS VARCHAR) AS id,
    CASE WHEN cp = 2 THEN CASE WHEN p % 2 = 0 THEN '   ' END
         ELSE {dirty_case(title('p_name', 'p'), 'p + cp')} END AS title,
    CASE (p + cp) % 3 WHEN 0 THEN 'movie' WHEN 1 THEN 'Movie' ELSE 'MOVIE' END AS type,
    CASE WHEN p % 19 <> 0 THEN {dirty_case('p_type', 'p + cp')} END AS genre,
    CASE p % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'EN' WHEN 2 THEN 'English' END AS language,
    {dirty_date(day('p'), 'p + cp')} AS release_date,
    CASE p % 4 WHEN 0 THEN s WHEN 1 THEN s || ' min' WHEN 2 THEN s || '.0' END AS runtime,
    CASE p % 4 WHEN 0 THEN r WHEN 1 THEN r || '/10' WHEN 2 THEN '999' ELSE ' ' || r END AS rating,
    CASE WHEN p % 5 <> 0 THEN CAST((p % 1000000) * 37 AS VARCHAR) END AS votes,
    {dirty_case('p_brand', 'p + cp')} AS director
  FROM (SELECT *, CAST(p_size * 13 AS VARCHAR) AS s, {tenths_text('p % 100')} AS r FROM m_all))"""

B_USERS = f"""b_users AS (
  SELECT CAST(c AS VARCHAR) AS user_id,
    {dirty_case("'user' || CAST(c AS VARCHAR)", 'c')} AS username,
    CASE WHEN c % 11 = 0 THEN NULL WHEN c % 23 = 0 THEN '  '
         ELSE {dirty_case("'user' || CAST(CASE WHEN c % 13 = 1 THEN c - 1 ELSE c END AS VARCHAR) || '@example.com'", 'c')}
    END AS email,
    CASE WHEN c % 17 <> 0 THEN {dirty_case('n_name', 'c')} END AS country,
    {dirty_date(day('c'), 'c')} AS signup_date,
    CASE c % 7 WHEN 0 THEN 'true' WHEN 1 THEN 'YES' WHEN 2 THEN ' 0 ' WHEN 3 THEN 'false'
               WHEN 5 THEN 'maybe' WHEN 6 THEN 'y' END AS is_premium
  FROM u_all)"""

B_RATINGS = f"""b_ratings AS (
  SELECT CAST(rating_id AS VARCHAR) AS rating_id, CAST(user_id AS VARCHAR) AS user_id,
    CASE WHEN p_partkey IS NULL THEN {dirty_case("''", 'l_linenumber')}
         ELSE {dirty_case(title(), 'l_linenumber')} END AS movie_title,
    CASE k % 23 WHEN 0 THEN 'four' WHEN 1 THEN '999' WHEN 2 THEN NULL WHEN 3 THEN '3'
         ELSE {tenths_text('CAST(l_quantity * 2 AS BIGINT)')} END AS score,
    {dirty_date('CAST(l_shipdate AS DATE)', 'k')} AS watched_date,
    CASE WHEN k % 3 <> 0 THEN 'x' END AS review
  FROM r_all)"""

B_REVIEWS = f"""b_reviews AS (
  SELECT CAST(doc_id AS VARCHAR) AS review_id, CAST(doc_id + 1 AS VARCHAR) AS user_id,
    CASE WHEN p_partkey IS NULL THEN {dirty_case("''", 'doc_id + rep')}
         ELSE {dirty_case(title(), 'doc_id + rep')} END AS movie_title,
    CASE WHEN quality = 1 THEN ' POSITIVE ' WHEN quality = 0 THEN 'negative'
         WHEN doc_id % 2 = 0 THEN 'Neutral' END AS sentiment,
    CASE WHEN rep = 1 THEN ' ' || text || ' ' ELSE text END AS body,
    {dirty_date(day('doc_id'), 'doc_id + rep')} AS created_date
  FROM v_all)"""

B_SCORES = f"""b_scores AS (
  SELECT CASE WHEN src = 3 THEN '' ELSE {dirty_case(title('p_name', 'p'), 'p + src')} END AS title,
    CASE (p + src) % 3 WHEN 0 THEN {tenths_text('p % 100')} WHEN 1 THEN '' ELSE 'N/A' END
      AS imdb_score,
    CASE p % 3 WHEN 0 THEN CAST(p_size + src AS VARCHAR) || '%'
               WHEN 1 THEN CAST(p_size * 3 AS VARCHAR) ELSE '' END AS rt_score,
    CASE src WHEN 0 THEN ' rotten_tomatoes ' WHEN 1 THEN 'IMDB' WHEN 2 THEN 'RT' ELSE 'imdb' END
      AS source,
    {dirty_date(day('p'), 'p + src')} AS collected_at
  FROM sc_all)"""

B_WATCHLIST = f"""b_watchlist AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
    {dirty_case("'user' || CAST(user_id AS VARCHAR)", 'event_id + rep')} AS "user",
    CASE WHEN p_partkey IS NULL THEN {dirty_case("''", 'event_id + rep')}
         ELSE {dirty_case(title(), 'event_id + rep')} END AS title,
    CASE event_type WHEN 'error' THEN ' remove ' WHEN 'view' THEN 'peek' WHEN 'click' THEN 'ADD'
         WHEN 'purchase' THEN 'Add' ELSE 'add' END AS action,
    {dirty_date('CAST(ts AS DATE)', 'event_id + rep')} AS event_time,
    CASE event_id % 4 WHEN 0 THEN 'ios' WHEN 1 THEN 'Android' WHEN 2 THEN 'WEB' ELSE '' END
      AS device
  FROM w_all)"""

B_AWARDS = f"""b_awards AS (
  SELECT CAST(o AS VARCHAR) AS award_id,
    CASE WHEN p_partkey IS NULL THEN {dirty_case("''", 'o + rep')}
         ELSE {dirty_case(title(), 'o + rep')} END AS title,
    {dirty_case('o_orderpriority', 'o + rep')} AS category,
    CASE WHEN o % 6 = 0 THEN '' WHEN o % 6 = 1 THEN 'Y' || CAST(year(o_orderdate) AS VARCHAR)
         ELSE CAST(year(o_orderdate) AS VARCHAR) END AS year,
    CASE o_orderstatus WHEN 'F' THEN CASE WHEN (o + rep) % 2 = 0 THEN 'WON' ELSE 'won' END
         WHEN 'O' THEN ' Nominated ' WHEN 'P' THEN 'pending' END AS result
  FROM a_all)"""

BRONZE_CTES = {
    "movies": (M_ALL, B_MOVIES),
    "users": (U_ALL, B_USERS),
    "ratings": (R_ALL, B_RATINGS),
    "reviews": (V_ALL, B_REVIEWS),
    "scores": (SC_ALL, B_SCORES),
    "watchlist": (W_ALL, B_WATCHLIST),
    "awards": (A_ALL, B_AWARDS),
}

BRONZE_COLS = {
    "movies": "id, title, type, genre, language, release_date, runtime, rating, votes, director",
    "scores": "title, imdb_score, rt_score, source, collected_at",
    "watchlist": 'event_id, "user", title, action, event_time, device',
    "awards": "award_id, title, category, year, result",
    "users": "user_id, username, email, country, signup_date, is_premium",
    "ratings": "rating_id, user_id, movie_title, score, watched_date, review",
    "reviews": "review_id, user_id, movie_title, sentiment, body, created_date",
}


def bronze_sql(ds: str) -> str:
    return with_(*BRONZE_CTES[ds]) + f"SELECT {BRONZE_COLS[ds]} FROM b_{ds}"


def silver_sql(ds: str) -> str:
    cols = {"movies": MOVIE_COLS, "users": USER_COLS, "ratings": RATING_COLS,
            "reviews": REVIEW_COLS, "scores": SCORE_COLS,
            "watchlist": ["username", "movie_key", "action", "event_date", "device"],
            "awards": ["movie_key", "category", "year", "result"]}[ds]
    return with_(*silver(ds)) + f"SELECT {', '.join(cols)} FROM s_{ds}"


# --------------------------------------------------------------------------
# Gold marts
# --------------------------------------------------------------------------

def exact_avg(total: str, n: str, scale: int, digits: int) -> str:
    """Half-up average from an integer sum of ``scale``-ths, without floating point."""
    half = f"(2 * {total} * {10 ** digits} + {n} * {scale}) // (2 * {n} * {scale})"
    return (f"CASE WHEN {n} > 0 THEN CAST({half} AS DOUBLE) / {10 ** digits} END")


def round_avg(c: str, digits: int) -> str:
    """Average of a column whose values have at most four decimals."""
    return exact_avg(f"SUM(CAST(ROUND({c} * 10000) AS HUGEINT))", f"COUNT({c})", 10000, digits)


def tally(src: str, key: str, value: str, total: str, counted: dict[str, str]) -> str:
    """Rows per key, in all and of some values, from a histogram of (key, value)."""
    cols = "".join(f", CAST(COALESCE(LIST_SUM(LIST_TRANSFORM(LIST_FILTER(h, lambda x: x.v = '{v}'), "
                   f"lambda x: x.n)), 0) AS BIGINT) AS {name}" for name, v in counted.items())
    every = f", CAST(LIST_SUM(LIST_TRANSFORM(h, lambda x: x.n)) AS BIGINT) AS {total}" if total else ""
    return (f"SELECT {key}{every}{cols} FROM (SELECT {key}, LIST(STRUCT_PACK(v := {value}, n := n)) AS h "
            f"FROM (SELECT {key}, {value}, COUNT(*) AS n FROM {src} GROUP BY ALL) GROUP BY {key})")


# Each mart is computed in another way than the engine does: from histograms, from sums
# of users' sums, from the first row of a sorted partition.
GOLD_BODY = {
    "genre_summary": f"""SELECT g AS genre, type, CAST(SUM(n) AS BIGINT) AS titles,
        {exact_avg('SUM(r)', 'SUM(nr)', 10000, 2)} AS avg_rating,
        {exact_avg('SUM(m)', 'SUM(nm)', 1, 0)} AS avg_runtime_min
        FROM (SELECT genre, type, COUNT(*) AS n, COALESCE(genre, 'Unknown') AS g,
              COALESCE(SUM(CAST(ROUND(rating * 10000) AS HUGEINT)), 0) AS r, COUNT(rating) AS nr,
              COALESCE(SUM(CAST(runtime_min AS HUGEINT)), 0) AS m, COUNT(runtime_min) AS nm
              FROM s_movies GROUP BY genre, type) GROUP BY ALL""",
    "fact_ratings": f"""SELECT movie_key, CAST(SUM(n) AS BIGINT) AS rating_count,
        {exact_avg('SUM(s)', 'SUM(n)', 10000, 2)} AS avg_score, COUNT(user_id) AS unique_raters
        FROM (SELECT movie_key, user_id, COUNT(*) AS n, SUM(CAST(ROUND(score * 10000) AS HUGEINT)) AS s
              FROM s_ratings WHERE score IS NOT NULL GROUP BY ALL) GROUP BY movie_key""",
    "review_summary": tally("(SELECT * FROM s_reviews WHERE movie_key IS NOT NULL)", "movie_key",
                            "sentiment", "review_count",
                            {"positive": "positive", "negative": "negative"}),
    "score_summary": """SELECT i.movie_key, i.imdb_score, r.rt_score
        FROM (SELECT * FROM s_scores QUALIFY ROW_NUMBER() OVER (
              PARTITION BY movie_key ORDER BY imdb_score DESC NULLS LAST) = 1) i
        JOIN (SELECT * FROM s_scores QUALIFY ROW_NUMBER() OVER (
              PARTITION BY movie_key ORDER BY rt_score DESC NULLS LAST) = 1) r
        ON i.movie_key = r.movie_key""",
    "title_popularity": tally("(SELECT * FROM s_watchlist WHERE movie_key IS NOT NULL)", "movie_key",
                              "action", "", {"adds": "add", "removes": "remove"}),
    "awards_won": tally("(SELECT * FROM s_awards WHERE movie_key IS NOT NULL)", "movie_key", "result",
                        "", {"wins": "won", "nominations": "nominated"}),
    "users_by_country": tally(
        """(SELECT COALESCE(country, 'Unknown') AS country,
            CASE WHEN is_premium THEN 'paid' ELSE 'free' END AS kind FROM s_users)""",
        "country", "kind", "users", {"premium_users": "paid"}),
}

GOLD_SOURCE = {"genre_summary": "movies", "fact_ratings": "ratings", "review_summary": "reviews",
               "score_summary": "scores", "title_popularity": "watchlist",
               "awards_won": "awards", "users_by_country": "users"}


def gold_sql(mart: str) -> str:
    return with_(*silver(GOLD_SOURCE[mart])) + GOLD_BODY[mart]


def gold_cte(mart: str) -> str:
    return f"g_{mart} AS ({GOLD_BODY[mart]})"


M360_CTES = [*silver("movies", "ratings", "scores", "watchlist", "awards", "reviews"),
             gold_cte("fact_ratings"), gold_cte("score_summary"), gold_cte("title_popularity"),
             gold_cte("awards_won"), gold_cte("review_summary"),
             # all measures as rows of one table, gathered by key, and one join
             """m_rows AS (
  SELECT movie_key AS mk, avg_score AS v1, rating_count AS n1, NULL::DOUBLE AS v2, NULL::INTEGER AS n2,
         NULL::BIGINT AS n3, NULL::BIGINT AS n4, NULL::BIGINT AS n5 FROM g_fact_ratings
  UNION ALL SELECT movie_key, NULL, NULL, imdb_score, rt_score, NULL, NULL, NULL FROM g_score_summary
  UNION ALL SELECT movie_key, NULL, NULL, NULL, NULL, adds, NULL, NULL FROM g_title_popularity
  UNION ALL SELECT movie_key, NULL, NULL, NULL, NULL, NULL, wins, NULL FROM g_awards_won
  UNION ALL SELECT movie_key, NULL, NULL, NULL, NULL, NULL, NULL, review_count FROM g_review_summary),
m_measures AS (SELECT mk, ANY_VALUE(v1) AS user_avg_score, ANY_VALUE(n1) AS rating_count,
         ANY_VALUE(v2) AS imdb_score, ANY_VALUE(n2) AS rt_score, ANY_VALUE(n3) AS watchlist_adds,
         ANY_VALUE(n4) AS award_wins, ANY_VALUE(n5) AS review_count FROM m_rows GROUP BY mk)""",
             """m360 AS (
  SELECT movie_key, title, type, genre, release_date, runtime_min, rating AS catalog_rating,
         user_avg_score, rating_count, imdb_score, rt_score, watchlist_adds, award_wins, review_count
  FROM s_movies LEFT JOIN m_measures ON mk = movie_key)"""]

MOVIE_360 = with_(*M360_CTES) + "SELECT * FROM m360"

TRENDING = with_(*M360_CTES) + """SELECT * EXCLUDE (place) FROM (
  SELECT movie_key, title, genre, watchlist_adds, user_avg_score, award_wins,
         ROW_NUMBER() OVER (ORDER BY COALESCE(watchlist_adds, 0) DESC, COALESCE(user_avg_score, 0) DESC,
                            movie_key NULLS FIRST) AS place FROM m360) WHERE place <= 20"""

LEFT_JOIN_RATINGS = with_(*silver("movies", "ratings"), gold_cte("fact_ratings")) + """
SELECT m.movie_key, m.title, fr.avg_score AS user_avg_score, fr.rating_count
FROM s_movies m LEFT JOIN g_fact_ratings fr ON fr.movie_key = m.movie_key"""

RUN_METRICS = with_(*silver("movies", "users", "ratings", "reviews")) + """
SELECT (SELECT COUNT(*) FROM s_movies) AS total_movies,
       (SELECT COUNT(*) FROM s_users) AS total_users,
       (SELECT COUNT(*) FROM s_ratings) AS total_ratings,
       (SELECT COUNT(*) FROM s_reviews) AS total_reviews"""
