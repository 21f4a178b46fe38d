
from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee import functions as fn


def _apply(spark, values, f, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


D = dt.date(2021, 3, 4)


def test_parse_date_accepts_all_layouts(spark):
    good = ["2021-03-04", "2021-3-4", "04/03/2021", "4/3/2021", "3-4-2021", "03-04-2021",
            "2021/3/4", "March 4, 2021", "March 04, 2021", "Mar 04 2021", " 2021-03-04 ",
            "march 4, 2021"]
    assert _apply(spark, good, fn.parse_date) == [D] * len(good)


def test_parse_date_rejects_bad_text(spark):
    bad = ["99-99-2021", "31/02/2021", "13-14-2021", "2/13/2021", "2021-03-040", "junk",
           "", None, "21-03-04", "12021-3-4", "+2021-3-4", "Mar 4, 2021", "March 4 2021"]
    assert _apply(spark, bad, fn.parse_date) == [None] * len(bad)


def test_parse_date_ignores_what_follows_the_date(spark):
    timed = ["2021-03-04T10:00:00Z", "2021-03-04 10:00:00", "4/3/2021 10:00", "3-4-2021T1", "2021/3/4 x",
             "March 4, 2021 at noon", "Mar 04 2021 10:00"]
    assert _apply(spark, timed, fn.parse_date) == [D] * len(timed)


def test_parse_date_first_layout_wins(spark):
    # day-first for "/", month-first for "-" with the year last
    assert _apply(spark, ["05/06/2021", "05-06-2021"], fn.parse_date) == [
        dt.date(2021, 6, 5), dt.date(2021, 5, 6)]


def test_parse_date_matches_unguarded_coalesce(spark):
    """The shape guards only skip layouts that cannot parse."""
    vals = ["2021-003-04", "2021-3-4", "4/3/2021", "1/1/0001", "0000-01-01", "9999-12-31",
            "May 1, 2020", "may 1 2020", "Sep 9 2019", "2021/12/31", "12-31-2021", "x-1-2021",
            "2021-02-29", "2020-02-29", "1-1-1", "Dec 31, 2021", "December 31 2021"]
    plain = lambda c: F.coalesce(*[F.try_to_date(F.trim(c), p) for p in fn.DATE_PATTERNS])
    iso = lambda f: (lambda c: F.date_format(f(c), "yyyy-MM-dd"))
    for got, want in zip(_apply(spark, vals, iso(fn.parse_date)), _apply(spark, vals, iso(plain))):
        assert want is None or got == want        # text after a date may add results, not change them


def test_date_iso(spark):
    assert _apply(spark, [D, None], fn.date_iso, "date") == ["2021-03-04", None]


def test_parse_int(spark):
    vals = ["120 min", "95%", "95.5", "-5", "N/A", "", "99999999999", None, " 7 "]
    assert _apply(spark, vals, fn.parse_int) == [120, 95, 955, 5, None, None, None, None, 7]


def test_parse_double_and_rating(spark):
    assert _apply(spark, ["8.5", "4.5x", "1.2.3", ".", "", None, "-2.5"], fn.parse_double) == [
        8.5, 4.5, None, None, None, None, 2.5]
    assert _apply(spark, ["8.5/10", "999", "four", "1.2.3", ".", "7/"], fn.parse_rating) == [
        8.5, 999.0, None, None, None, 7.0]


def test_range_or_null(spark):
    f = lambda c: fn.range_or_null(c, 0, 10)
    assert _apply(spark, [0.0, 10.0, 10.01, -0.1, None], f, "double") == [
        0.0, 10.0, None, None, None]


def test_text_functions(spark):
    assert _apply(spark, ["SCI-FI", " usa ", "o'neil", "two  words", "\tx "], fn.str_initcap) == [
        "Sci-fi", "Usa", "O'neil", "Two  Words", "\tx"]
    assert _apply(spark, ["  a b  ", "\ta\t"], fn.str_trim) == ["a b", "\ta\t"]
    assert _apply(spark, [" MiXed "], fn.str_lower_trim) == ["mixed"]


def test_movie_key(spark):
    assert _apply(spark, [" the LAST dawn ", "", "   ", None], fn.movie_key) == [
        "The Last Dawn|movie", None, None, None]


def test_bool_map(spark):
    vals = ["true", " YES ", "1", "y", "T", "false", "0", "No", "n", "F", "maybe", "", None]
    assert _apply(spark, vals, fn.bool_map) == [True] * 5 + [False] * 5 + [None] * 3


def test_source_canon(spark):
    assert _apply(spark, [None, "", "RT", " rotten_tomatoes ", "imdb", "other"],
                  fn.source_canon) == ["imdb", "imdb", "rotten_tomatoes", "rotten_tomatoes",
                                        "imdb", "imdb"]


def test_cast_ids(spark):
    assert _apply(spark, ["12", "x", "", None, "99999999999", "12.0", "-7.9", "1.2.3", "12.", ".5"],
                  fn.cast_ids) == [12, None, None, None, 99999999999, 12, -7, None, 12, None]


def test_nan_to_null(spark):
    assert _apply(spark, [float("nan"), 1.5, None], fn.nan_to_null, "double") == [
        None, 1.5, None]


@pytest.mark.parametrize("vals,expect", [([1.005, 1.005], 1.01), ([2.5, 2.0], 2.25),
                                         ([1.0, 2.0, 2.0], 1.67)])
def test_round_avg_half_up(spark, vals, expect):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert df.agg(fn.round_avg("x", 2)).first()[0] == expect


@pytest.mark.parametrize("n", [10_009, 200_009])
def test_round_avg_rounds_once(spark, n):
    """An average just below a tie: 2.3449995 rounds down at any partitioning."""
    df = spark.range(n).select(F.when(F.col("id") < n // 2, 2.34).when(
        F.col("id") < 2 * (n // 2), 2.35).otherwise(2.34).alias("x"))
    exact = (2.34 * (n - n // 2) + 2.35 * (n // 2)) / n
    assert 2.3449 < exact < 2.345
    for parts in (1, 13):
        assert df.repartition(parts).agg(fn.round_avg("x", 2)).first()[0] == 2.34


_date_like = st.text(alphabet="0123456789-/, MarchJnuyDec", min_size=0, max_size=14)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(_date_like,
                          st.builds(lambda y, m, d, sep: sep.join([y, m, d]),
                                    st.from_regex(r"[0-9]{1,5}", fullmatch=True),
                                    st.from_regex(r"[0-9]{1,3}", fullmatch=True),
                                    st.from_regex(r"[0-9]{1,4}", fullmatch=True),
                                    st.sampled_from(["-", "/"]))),
                min_size=1, max_size=40))
def test_property_shape_guards_do_not_change_results(spark, vals):
    plain = lambda c: F.coalesce(*[F.try_to_date(F.trim(c), p) for p in fn.DATE_PATTERNS])
    iso = lambda f: (lambda c: F.date_format(f(c), "yyyy-MM-dd"))
    for got, want in zip(_apply(spark, vals, iso(fn.parse_date)), _apply(spark, vals, iso(plain))):
        assert want is None or got == want        # text after a date may add results, not change them
