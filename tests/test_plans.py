"""Physical plan shapes the engine relies on for scale."""

from __future__ import annotations

from __spark_entry__ import queries
from conftest import SF_SMALL


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()     # materialise AQE's final plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_is_combined_before_the_shuffle(spark):
    p = _plan(queries()["clean_ratings"](spark, SF_SMALL))
    assert "partial_min" in p                         # map-side: one row per key per task
    assert p.count("Exchange hashpartitioning") == 1
    assert "Window" not in p


SOURCES = {"movies": 1, "users": 2, "ratings": 3, "reviews": 3, "scores": 1, "watchlist": 2, "awards": 2}


def test_each_table_is_read_once(spark, tmp):
    from marquee.operators.cleaners import clean_users
    from marquee.plans import fixtures as fx
    for ds, tables in SOURCES.items():
        p = queries()[f"clean_{ds}"](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
        assert p.count("FileScan") == tables, ds
    fx.bronze(spark, SF_SMALL, "users").write.parquet(f"{tmp}/users")
    p = clean_users(spark.read.parquet(f"{tmp}/users"))._jdf.queryExecution().sparkPlan().toString()
    assert p.count("FileScan") == 1


def test_trending_is_take_ordered(spark):
    p = _plan(queries()["trending_titles"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_no_python_udfs_anywhere(spark):
    for k in ("clean_movies", "clean_users", "movie_360", "fact_ratings", "users_by_country"):
        p = _plan(queries()[k](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, k


def test_scans_are_pruned(spark):
    df = queries()["fact_ratings"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    # lineitem is read with only the five columns the fixture needs
    assert "l_extendedprice" not in p and "l_comment" not in p


def test_distinct_count_has_no_expand(spark):
    p = _plan(queries()["fact_ratings"](spark, SF_SMALL))
    assert "Expand" not in p


def test_results_do_not_depend_on_partition_count(spark):
    q = queries()["movie_360"]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    key = lambda r: tuple(str(x) for x in r)
    a = sorted(q(spark, SF_SMALL).collect(), key=key)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    b = sorted(q(spark, SF_SMALL).collect(), key=key)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b


def test_bucketed_catalog_marts_join_without_shuffle(spark, tmp):
    """Catalog mode buckets silver movies and the per-title gold marts on
    movie_key, so movie_360 over the stored tables needs no exchange."""
    import re

    from marquee.operators.marts import movie_360
    from marquee.plans import fixtures as fx
    from marquee.plans.pipeline import run_pipeline, write_landing
    from marquee.plans.registry import DATASETS
    from marquee.sources.sinks import Store

    landing = write_landing(spark, {ds: fx.bronze(spark, SF_SMALL, ds) for ds in DATASETS},
                            f"{tmp}/landing")
    store = Store(f"{tmp}/lake", catalog=True, prefix="tb_", buckets=4)
    assert run_pipeline(spark, landing, store) == spark.table("tb_silver.movies").count()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        g = {ds: store.read(spark, "gold", DATASETS[ds].gold_table)
             for ds in ("ratings", "scores", "watchlist", "awards", "reviews")}
        m = movie_360(store.read(spark, "silver", "movies"), g["ratings"], g["scores"],
                      g["watchlist"], g["awards"], g["reviews"])
        p = _plan(m)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert p.count("SortMergeJoin") == 5
    assert not re.search(r"Exchange", p)


def test_movie_360_shares_the_aggregate_shuffles(spark, tmp):
    """From stored (unbucketed) silver tables with broadcast off, the five
    aggregates' hash partitioning on movie_key is reused by the five joins:
    one exchange per aggregate plus one for the base, nothing else."""
    import re

    from marquee.operators import cleaners as cl
    from marquee.operators import marts as mt
    from marquee.plans import fixtures as fx
    from marquee.sources.sinks import Store

    names = ("movies", "ratings", "scores", "watchlist", "awards", "reviews")
    store = Store(f"{tmp}/lake")
    for ds in names:
        store.write(cl.CLEANERS[ds](fx.bronze(spark, SF_SMALL, ds)), "silver", ds)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        s = {ds: store.read(spark, "silver", ds) for ds in names}
        m = mt.movie_360(s["movies"], mt.fact_ratings(s["ratings"]),
                         mt.score_summary(s["scores"]), mt.title_popularity(s["watchlist"]),
                         mt.awards_won(s["awards"]), mt.review_summary(s["reviews"]))
        p = _plan(m)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert p.count("SortMergeJoin") == 5
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 6
