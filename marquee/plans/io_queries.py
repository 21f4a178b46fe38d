"""Registered queries for readers, writers and pipeline steps, with oracles.

Each query writes under the session's shared folder and returns what it
reads back.  A full pipeline run over one ``sf_dir`` is shared by the
queries that only inspect its tables (same process, same session).
"""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from marquee.functions import parse_date
from marquee.operators import marts as mt
from marquee.operators.cleaners import CLEANERS
from marquee.plans import fixtures as fx
from marquee.plans import oracles as o
from marquee.plans.pipeline import (
    record_run_metrics, run_bronze, run_gold, run_pipeline, run_silver, write_landing,
)
from marquee.plans.registry import DATASETS
from marquee.sources import readers as rd
from marquee.sources.schemas import SILVER
from marquee.sources.sinks import (
    Store, read_audit, remove_path, write_feed, write_indented_json, write_wrapped_json,
)
from marquee.session import scratch_path, session_key, shuffles_freed

_RUNS: dict[tuple, Store] = {}
_LOCK = threading.Lock()


def _landing(spark: SparkSession, sf_dir: str, datasets=None) -> str:
    feeds = {ds: fx.bronze(spark, sf_dir, ds) for ds in (datasets or DATASETS)}
    return write_landing(spark, feeds, scratch_path(spark, "landing"))


def _landed_run(spark: SparkSession, sf_dir: str) -> Store:
    """Lands every feed and runs the pipeline over them.  A feed goes once its bronze table holds it, and
    shuffle files with the step that wrote them."""
    with shuffles_freed(spark):
        landing = _landing(spark, sf_dir)
        store = Store(scratch_path(spark, "lake"))
        run_pipeline(spark, landing, store, keep_landing=False)
        remove_path(spark, landing)
    return store


def _shared_run(spark: SparkSession, sf_dir: str) -> Store:
    """One full run per (application, sf_dir), reused by the inspecting queries."""
    key = (*session_key(spark), sf_dir)
    with _LOCK:
        if key in _RUNS and not _RUNS[key].exists(spark, "gold", "movie_360"):
            del _RUNS[key]                     # scratch output went away: run again
        if key not in _RUNS:
            with shuffles_freed(spark):
                store = _landed_run(spark, sf_dir)
                record_run_metrics(spark, store)          # a second snapshot: history appends
            _RUNS[key] = store
        return _RUNS[key]


# ---- scans (R1-R5) ---------------------------------------------------------

def q_scan_json_movies(spark, d):
    p = scratch_path(spark, "movies_json")
    write_feed(fx.bronze(spark, d, "movies"), p, "json")
    return rd.read_movies_json(spark, p, multiline=False)


def q_scan_csv_scores(spark, d):
    p = scratch_path(spark, "scores_csv")
    write_feed(fx.quoted_scores(spark, d), p, "csv")
    return rd.read_scores_csv(spark, p)


def q_scan_json_watchlist(spark, d):
    p = scratch_path(spark, "watchlist_json")
    write_wrapped_json(fx.bronze(spark, d, "watchlist"), p, "events", rows_per_doc=1000)
    return rd.read_watchlist_json(spark, p, wrapped=True, multiline=False)


def q_scan_xml_awards(spark, d):
    p = scratch_path(spark, "awards_xml")
    write_feed(fx.bronze(spark, d, "awards"), p, "xml", root_tag="awards", row_tag="award")
    return rd.read_awards_xml(spark, p)


def _scan_parquet(ds: str):
    def q(spark, d):
        p = scratch_path(spark, f"{ds}_parquet")
        write_feed(fx.parquet_feed(fx.bronze(spark, d, ds), ds), p, "parquet")
        return rd.read_parquet_feed(spark, p, ds)
    q.__name__ = f"q_scan_parquet_{ds}"
    return q


# ---- typed round trips of a silver table (W7) ------------------------------

def _roundtrip(fmt: str):
    def q(spark, d):
        from marquee.operators.cleaners import clean_movies
        p = scratch_path(spark, f"movies_{fmt}")
        silver = clean_movies(fx.bronze(spark, d, "movies"))
        if fmt == "csv":
            silver = silver.withColumn("director", fx.quoted(F.col("director"), F.length("title")))
        if fmt == "xml":
            write_feed(silver, p, "xml", root_tag="movies", row_tag="movie")
            return (spark.read.format("xml").option("rowTag", "movie")
                    .option("ignoreSurroundingSpaces", False).schema(SILVER["movies"]).load(p))
        write_feed(silver, p, fmt)
        r = spark.read.schema(SILVER["movies"])
        if fmt == "csv":
            r = r.option("header", True).option("escape", '"').option("multiLine", True)
        return getattr(r, fmt)(p)
    q.__name__ = f"q_roundtrip_{fmt}"
    return q


# ---- sinks and steps -------------------------------------------------------

def q_sink_bronze_roundtrip(spark, d):
    store = Store(scratch_path(spark, "lake"))
    store.write(fx.bronze(spark, d, "users"), "bronze", "users")
    return store.read(spark, "bronze", "users")


def _stored_silver_ratings(spark, d, store: Store):
    """Clean ratings as a silver table, so that several marts of them clean once."""
    store.write(CLEANERS["ratings"](fx.bronze(spark, d, "ratings")), "silver", "ratings")
    return store.read(spark, "silver", "ratings")


def q_sink_ctas_roundtrip(spark, d):
    """Gold replace: a first write of a partial mart is fully replaced."""
    store = Store(scratch_path(spark, "lake"))
    silver = _stored_silver_ratings(spark, d, store)
    store.write(mt.fact_ratings(silver.where(F.col("score") > 5)), "gold", "fact_ratings")
    store.write(mt.fact_ratings(silver), "gold", "fact_ratings")
    return store.read(spark, "gold", "fact_ratings")


def q_fact_ratings_merged(spark, d):
    """Two runs' ratings as stored states: the second merges with the first's, not its ratings."""
    store = Store(scratch_path(spark, "lake"))
    silver = _stored_silver_ratings(spark, d, store)
    first = F.coalesce(F.col("rating_id") % 3 != 0, F.lit(True))
    store.write(mt.rating_state(silver.where(first)), "gold", "rating_state")
    store.write(mt.merge_rating_states(store.read(spark, "gold", "rating_state"),
                                       mt.rating_state(silver.where(~first))), "gold", "rating_state")
    return mt.fact_ratings_of(store.read(spark, "gold", "rating_state"))


def q_observed_count(spark, d):
    """Rows written per silver table, as counted by the write's observation."""
    landing = _landing(spark, d)
    store = Store(scratch_path(spark, "lake"))
    rows = []
    for ds in DATASETS:
        run_bronze(spark, ds, landing, store)
        rows.append((ds, run_silver(spark, ds, store)))
    return spark.createDataFrame(rows, "dataset string, silver_rows bigint")


def q_bronze_step(spark, d):
    store = Store(scratch_path(spark, "lake"))
    run_bronze(spark, "ratings", _landing(spark, d, ["ratings"]), store)
    return store.read(spark, "bronze", "ratings")


def q_bronze_indented_watchlist(spark, d):
    """Indented documents, read with the defaults."""
    landing = scratch_path(spark, "landing")
    write_indented_json(fx.bronze(spark, d, "watchlist"), f"{landing}/{DATASETS['watchlist'].feed}",
                        "events", rows_per_doc=2000)
    store = Store(scratch_path(spark, "lake"))
    run_bronze(spark, "watchlist", landing, store)
    remove_path(spark, landing)
    return store.read(spark, "bronze", "watchlist")


def q_clean_typed_ratings(spark, d):
    """A Parquet export with floating-point ids and timestamps."""
    typed = fx.bronze(spark, d, "ratings").withColumns({
        "rating_id": F.col("rating_id").cast("double"), "user_id": F.col("user_id").cast("double"),
        "watched_date": parse_date("watched_date").cast("timestamp")})
    p = scratch_path(spark, "typed_ratings")
    typed.write.parquet(p)
    return CLEANERS["ratings"](rd.read_parquet_feed(spark, p, "ratings"))


def q_silver_step(spark, d):
    store = Store(scratch_path(spark, "lake"))
    run_bronze(spark, "ratings", _landing(spark, d, ["ratings"]), store)
    run_silver(spark, "ratings", store)
    return store.read(spark, "silver", "ratings")


def q_gold_step(spark, d):
    store = Store(scratch_path(spark, "lake"))
    run_bronze(spark, "ratings", _landing(spark, d, ["ratings"]), store)
    run_silver(spark, "ratings", store)
    run_gold(spark, "ratings", store)
    return store.read(spark, "gold", "fact_ratings")


def q_empty_guard(spark, d):
    """Silver is left as it was when a later bronze load is empty (F8): the
    whole ratings table from the first load is what remains."""
    store = Store(scratch_path(spark, "lake"))
    full = _landing(spark, d, ["ratings"])
    run_bronze(spark, "ratings", full, store)
    run_silver(spark, "ratings", store)
    empty = write_landing(spark, {"ratings": fx.bronze(spark, d, "ratings").limit(0)},
                          scratch_path(spark, "landing-empty"))
    if run_bronze(spark, "ratings", empty, store) != 0 or \
            run_silver(spark, "ratings", store) is not None:
        raise AssertionError("empty bronze load was not skipped")
    return store.read(spark, "silver", "ratings")


def q_audit_log(spark, d):
    store = _shared_run(spark, d)
    return read_audit(spark, store).drop("created_at")


def q_run_metrics(spark, d):
    store = _shared_run(spark, d)
    return store.read(spark, "gold", "run_metrics").drop("run_time")


def q_end_to_end_run(spark, d):
    """A run of its own, on every call."""
    return _landed_run(spark, d).read(spark, "gold", "movie_360")


def q_stored_trending_titles(spark, d):
    store = _shared_run(spark, d)
    return store.read(spark, "gold", "trending_titles")


def io_queries() -> dict:
    qs = {
        "scan_json_movies": q_scan_json_movies,
        "scan_csv_scores": q_scan_csv_scores,
        "scan_json_watchlist": q_scan_json_watchlist,
        "scan_xml_awards": q_scan_xml_awards,
    }
    for ds in ("users", "ratings", "reviews"):
        qs[f"scan_parquet_{ds}"] = _scan_parquet(ds)
    for fmt in ("csv", "json", "xml", "parquet"):
        qs[f"roundtrip_{fmt}"] = _roundtrip(fmt)
    qs.update({
        "sink_bronze_roundtrip": q_sink_bronze_roundtrip,
        "sink_ctas_roundtrip": q_sink_ctas_roundtrip,
        "fact_ratings_merged": q_fact_ratings_merged,
        "observed_count": q_observed_count,
        "bronze_step": q_bronze_step,
        "bronze_indented_watchlist": q_bronze_indented_watchlist,
        "clean_typed_ratings": q_clean_typed_ratings,
        "silver_step": q_silver_step,
        "gold_step": q_gold_step,
        "empty_guard": q_empty_guard,
        "audit_log": q_audit_log,
        "run_metrics": q_run_metrics,
        "end_to_end_run": q_end_to_end_run,
        "stored_trending_titles": q_stored_trending_titles,
    })
    return qs


# ---- oracles ---------------------------------------------------------------

def _count(name: str) -> str:
    return f"(SELECT COUNT(*) FROM {name})"


def _audit_sql() -> str:
    ctes = []
    for ds in DATASETS:
        for c in (*o.BRONZE_CTES[ds], *o.SILVER_CTES[ds]):
            if c not in ctes:
                ctes.append(c)
    marts = {name: ds.gold_table for name, ds in DATASETS.items()}
    for mart in marts.values():
        ctes.append(o.gold_cte(mart))
    ctes.extend(o.M360_CTES[-2:])
    rows = []
    for ds, mart in marts.items():
        rows.append(f"SELECT '{ds}' AS dataset, 'bronze' AS layer, '{ds}' AS table_name, "
                    f"CAST({_count('b_' + ds)} AS BIGINT) AS total_rows, 'OK' AS status")
        rows.append(f"SELECT '{ds}', 'silver', '{ds}', CAST({_count('s_' + ds)} AS BIGINT), 'OK'")
        rows.append(f"SELECT '{ds}', 'gold', '{mart}', CAST({_count('g_' + mart)} AS BIGINT), 'OK'")
    rows.append(f"SELECT 'marts', 'gold', 'movie_360', CAST({_count('m360')} AS BIGINT), 'OK'")
    rows.append("SELECT 'marts', 'gold', 'run_metrics', CAST(1 AS BIGINT), 'OK'")
    rows.append("SELECT 'marts', 'gold', 'run_metrics', CAST(1 AS BIGINT), 'OK'")
    return o.with_(*ctes) + "\nUNION ALL\n".join(rows)


def io_oracles() -> dict[str, str]:
    silver_movies = o.silver_sql("movies")
    out = {
        "scan_json_movies": o.bronze_sql("movies"),
        # CSV has no null: empty fields (null or '') read back as null
        "scan_csv_scores": "SELECT " + ", ".join(
            f"NULLIF({o.quoted('title', 'length(title)') if c == 'title' else c}, '') AS {c}"
            for c in o.BRONZE_COLS["scores"].split(", "))
        + f" FROM ({o.bronze_sql('scores')})",
        "scan_json_watchlist": o.bronze_sql("watchlist"),
        "scan_xml_awards": o.bronze_sql("awards"),
        "scan_parquet_users": o.bronze_sql("users"),
        "scan_parquet_ratings": o.bronze_sql("ratings"),
        "scan_parquet_reviews": o.bronze_sql("reviews"),
        "roundtrip_csv": f"SELECT * REPLACE ({o.quoted('director', 'length(title)')} AS director) "
                         f"FROM ({silver_movies})",
        "roundtrip_json": silver_movies,
        "roundtrip_xml": silver_movies,
        "roundtrip_parquet": silver_movies,
        "sink_bronze_roundtrip": o.bronze_sql("users"),
        "sink_ctas_roundtrip": o.gold_sql("fact_ratings"),
        "fact_ratings_merged": o.gold_sql("fact_ratings"),
        "observed_count": "\nUNION ALL\n".join(
            f"SELECT '{ds}' AS dataset, CAST(COUNT(*) AS BIGINT) AS silver_rows "
            f"FROM ({o.silver_sql(ds)})" for ds in DATASETS),
        "bronze_step": o.bronze_sql("ratings"),
        "bronze_indented_watchlist": o.bronze_sql("watchlist"),
        "clean_typed_ratings": o.silver_sql("ratings"),
        "silver_step": o.silver_sql("ratings"),
        "gold_step": o.gold_sql("fact_ratings"),
        "empty_guard": o.silver_sql("ratings"),
        "audit_log": _audit_sql(),
        # two snapshots were appended by the shared run
        "run_metrics": f"SELECT * FROM ({o.RUN_METRICS}) UNION ALL SELECT * FROM ({o.RUN_METRICS})",
        "end_to_end_run": o.MOVIE_360,
        "stored_trending_titles": o.TRENDING,
    }
    return out
