
from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.operators import cleaners as cl
from marquee.operators import marts as mt
from marquee.operators.dedupe import first_per_key, first_per_key_by, first_per_key_keep_nulls
from marquee.sources.schemas import BRONZE


def bronze(spark, ds, rows):
    return spark.createDataFrame(rows, BRONZE[ds])


def test_first_per_key_null_keys_collapse_to_one(spark):
    df = spark.createDataFrame([(None, "b"), (None, "a"), (1, "z"), (1, "y")], "k int, v string")
    out = sorted(first_per_key(df, ["k"]).collect(), key=lambda r: (r.k is not None, r.k))
    assert [(r.k, r.v) for r in out] == [(None, "a"), (1, "y")]


def test_first_per_key_nulls_first_in_order(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "k int, v string")
    assert first_per_key(df, ["k"]).collect()[0].v is None


def test_keep_nulls_variant(spark):
    df = spark.createDataFrame([(None, 3), (None, 3), ("", 2), ("", 1), ("a", 5)],
                               "e string, id int")
    out = first_per_key_keep_nulls(df, "e", first=["id"])
    assert sorted(("-" if r.e is None else r.e, r.id) for r in out.collect()) == [("", 1), ("-", 3), ("-", 3),
                                                                                 ("a", 5)]


def test_aggregate_and_window_dedupe_agree(spark):
    rows = [(i % 11 if i % 5 else None, None if i % 7 == 0 else f"v{(i * 31) % 17}",
             None if i % 3 == 0 else float(i % 4), i % 2 == 0) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, a string, b double, c boolean")
    key = lambda r: tuple(str(x) for x in r)
    agg = sorted(first_per_key(df, ["k"], first=["b"]).collect(), key=key)
    win = sorted(first_per_key_by(df, ["k"], [F.col("b").asc_nulls_first(),
                                              F.col("a").asc_nulls_first(),
                                              F.col("c").asc_nulls_first()]).collect(), key=key)
    assert agg == win
    assert first_per_key(df, ["k"]).columns == df.columns


def test_dedupe_is_deterministic_across_partitionings(spark):
    rows = [(i % 37, f"v{(i * 7919) % 1000}") for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, v string")
    a = sorted(first_per_key(df.repartition(1), ["k"]).collect())
    b = sorted(first_per_key(df.repartition(13), ["k"]).collect())
    assert a == b


def test_clean_movies_merges_case_variants_and_drops_blank_titles(spark):
    rows = [("1", "the dawn", "MOVIE", "SCI-FI", "EN", "2021-03-04", "120 min", "8.5/10",
             "100", "  Lana W "),
            ("2", " THE DAWN ", "movie", "sci-fi", "en", "04/03/2021", "120", "999", None, None),
            ("3", "   ", "movie", None, None, None, None, None, None, None),
            ("4", None, "movie", None, None, None, None, None, None, None)]
    out = cl.clean_movies(bronze(spark, "movies", rows)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.movie_key, r.title, r.type, r.genre) == ("The Dawn|movie", "The Dawn", "movie",
                                                       "Sci-fi")
    # total order: rating null sorts first, so the second row survives
    assert r.rating is None and r.director is None and r.runtime_min == 120


def test_clean_users_email_dedupe_keeps_lowest_id_and_all_null_emails(spark):
    rows = [("5", " u5 ", "A@X.COM", "usa", "2021-03-04", "yes"),
            ("3", "u3", " a@x.com ", "UK", None, "0"),
            ("7", "u7", None, None, None, None),
            ("7", "u7", None, None, None, None),
            ("8", "u8", "", None, None, "maybe"),
            ("9", "u9", "", None, None, None)]
    out = cl.clean_users(bronze(spark, "users", rows))
    got = sorted((r.user_id, r.email) for r in out.collect())
    assert got == [(3, "a@x.com"), (7, None), (7, None), (8, "")]


def test_clean_scores_source_and_ranges(spark):
    rows = [("A", "9.5", "95%", " RT ", "2021-03-04"),
            ("a", "11", "120", None, None),
            ("", "1", "1", "imdb", None)]
    out = sorted(cl.clean_scores(bronze(spark, "scores", rows)).collect(), key=lambda r: r.source)
    assert [(r.movie_key, r.imdb_score, r.rt_score, r.source) for r in out] == [
        ("A|movie", None, None, "imdb"), ("A|movie", 9.5, 95, "rotten_tomatoes")]


def test_fact_ratings_keeps_null_key_group(spark):
    rows = [("1", "1", "x", "4.0", None, None), ("2", "2", "", "2.0", None, None),
            ("3", "2", None, "5", None, None), ("4", "1", "x", "four", None, None)]
    fr = mt.fact_ratings(cl.clean_ratings(bronze(spark, "ratings", rows)))
    got = sorted(((r.movie_key or "-"), r.rating_count, r.avg_score, r.unique_raters)
                 for r in fr.collect())
    assert got == [("-", 2, 3.5, 1), ("X|movie", 1, 4.0, 1)]


def test_counted_marts_count_only_named_values(spark):
    w = bronze(spark, "watchlist", [("1", "u", "t", "add", None, ""),
                                    ("2", "u", "t", " REMOVE ", None, ""),
                                    ("3", "u", "t", "peek", None, ""),
                                    ("4", "u", None, "add", None, "")])
    got = [(r.movie_key, r.adds, r.removes)
           for r in mt.title_popularity(cl.clean_watchlist(w)).collect()]
    assert got == [("T|movie", 1, 1)]


def test_users_by_country_null_premium_not_counted(spark):
    u = bronze(spark, "users", [("1", "a", "a", None, None, "yes"),
                                ("2", "b", "b", "", None, None),
                                ("3", "c", "c", "", None, "1")])
    got = sorted((r.country, r.users, r.premium_users)
                 for r in mt.users_by_country(cl.clean_users(u)).collect())
    assert got == [("", 2, 1), ("Unknown", 1, 1)]


def test_movie_360_and_trending(spark):
    movies = bronze(spark, "movies", [(str(i), f"t{i}", "movie", "g", None, None, None, None,
                                       None, None) for i in range(30)])
    silver_m = cl.clean_movies(movies)
    watch = bronze(spark, "watchlist", [(f"{i}-{j}", "u", f"t{i}", "add", None, "")
                                        for i in range(30) for j in range(i % 5)])
    ratings = bronze(spark, "ratings", [(str(i), "1", f"t{i}", "3.0", None, None)
                                        for i in range(30)])
    empty = lambda ds: bronze(spark, ds, [])
    m360 = mt.movie_360(silver_m, mt.fact_ratings(cl.clean_ratings(ratings)),
                        mt.score_summary(cl.clean_scores(empty("scores"))),
                        mt.title_popularity(cl.clean_watchlist(watch)),
                        mt.awards_won(cl.clean_awards(empty("awards"))),
                        mt.review_summary(cl.clean_reviews(empty("reviews"))))
    assert m360.count() == 30
    assert tuple(m360.columns) == mt.MOVIE_360_COLUMNS
    r = m360.where("movie_key = 'T0|movie'").first()
    assert r.watchlist_adds is None and r.imdb_score is None and r.user_avg_score == 3.0
    top = mt.trending_titles(m360).collect()
    assert len(top) == 20 and top[0].watchlist_adds == 4
    assert [r.movie_key for r in top[:2]] == ["T14|movie", "T19|movie"]


def test_table_counts_missing_is_zero(spark):
    df = spark.range(5)
    r = mt.table_counts({"a": df, "b": None, "c": df.limit(2)}).first()
    assert (r.total_a, r.total_b, r.total_c) == (5, 0, 2)


_text = st.one_of(st.none(), st.text(alphabet=" aBc-/0123456789.,%", max_size=12))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(_text, _text, _text, _text), min_size=1, max_size=25))
def test_properties_clean_ratings(spark, rows):
    """Keys unique after dedupe; scores within range; cleaning text twice is stable."""
    data = [(str(i % 7), t, a, b, c, None) for i, (t, a, b, c) in enumerate(rows)]
    df = bronze(spark, "ratings", data)
    out = cl.clean_ratings(df).collect()
    ids = [r.rating_id for r in out]
    assert len(ids) == len(set(ids))
    assert all(r.score is None or 0 <= r.score <= 10 for r in out)
    again = df.select(F.initcap(F.trim(F.initcap(F.trim("user_id")))).alias("x"),
                      F.initcap(F.trim("user_id")).alias("y")).collect()
    assert all(r.x == r.y for r in again)


_titles = st.one_of(st.none(), st.text(alphabet=" aZ-'", max_size=8))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(_titles, st.sampled_from(["add", " ADD ", "remove", "peek", None])),
                min_size=1, max_size=30))
def test_properties_marts(spark, events):
    """Cleaning text is idempotent; adds + removes never exceed the events of a
    title; movie_360 has exactly one row per silver movie."""
    w = bronze(spark, "watchlist", [(str(i), "u", t, a, None, "") for i, (t, a) in enumerate(events)])
    silver = cl.clean_watchlist(w)
    pop = mt.title_popularity(silver)
    per_key = {r.movie_key: r.n for r in
               silver.where("movie_key IS NOT NULL").groupBy("movie_key").count()
                     .withColumnRenamed("count", "n").collect()}
    for r in pop.collect():
        assert r.adds + r.removes <= per_key[r.movie_key]
    again = silver.select(F.initcap(F.trim(F.split("movie_key", r"\|").getItem(0))).alias("t"),
                          F.split("movie_key", r"\|").getItem(0).alias("k")).collect()
    assert all(r.t == r.k for r in again)
    movies = cl.clean_movies(bronze(spark, "movies", [(str(i), t, "movie", None, None, None, None,
                                                       None, None, None)
                                                      for i, (t, _) in enumerate(events)]))
    empty = lambda ds: bronze(spark, ds, [])
    m360 = mt.movie_360(movies, mt.fact_ratings(cl.clean_ratings(empty("ratings"))),
                        mt.score_summary(cl.clean_scores(empty("scores"))), pop,
                        mt.awards_won(cl.clean_awards(empty("awards"))),
                        mt.review_summary(cl.clean_reviews(empty("reviews"))))
    assert m360.count() == movies.count()
