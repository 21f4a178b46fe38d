"""Replaces that are never half done, appends that are never doubled, feeds that lack a field."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from marquee.plans import fixtures as fx
from marquee.plans import pipeline as pl
from marquee.plans.registry import DATASETS
from marquee.sources import sinks
from marquee.sources.sinks import AuditLog, Store, read_audit

from conftest import SF_SMALL


class Killed(BaseException):
    pass


def kill(*_args, **_kw):
    raise Killed


def versions(store, table="t"):
    return sorted(x for x in os.listdir(store.path("gold", table)) if x.startswith("v-"))


@pytest.mark.parametrize("point", ["_replace_text", "_clean", "rename"])
def test_a_killed_replace_shows_old_or_new(spark, tmp, monkeypatch, point):
    store = Store(os.path.join(tmp, "lake"))
    store.write(spark.range(5), "gold", "t")
    with monkeypatch.context() as m:
        if point == "_clean":
            m.setattr(Store, "_clean", kill)
        elif point == "_replace_text":
            m.setattr(sinks, "_replace_text", kill)
        else:                                          # the new pointer is written, not yet in place
            def half(spark_, path, text):
                with open(f"{path}.half", "w") as f:
                    f.write(text)
                raise Killed
            m.setattr(sinks, "_replace_text", half)
        with pytest.raises(Killed):
            store.write(spark.range(9), "gold", "t")
    assert store.read(spark, "gold", "t").count() == (9 if point == "_clean" else 5)
    assert len(versions(store)) == 2                   # what the killed run left
    assert store.write(spark.range(3), "gold", "t") == 3
    assert store.read(spark, "gold", "t").count() == 3
    assert len(versions(store)) == 2                   # the table and the one before


@pytest.mark.parametrize("catalog", [False, True])
def test_readers_of_the_old_version_go_on(spark, tmp, catalog):
    store = Store(os.path.join(tmp, "lake"), catalog=catalog, prefix="rd_")
    store.prepare(spark)
    store.write(spark.range(5), "gold", "t")
    reader = store.read(spark, "gold", "t")
    files = reader.inputFiles()
    store.write(spark.range(7), "gold", "t")
    assert all(os.path.exists(f.removeprefix("file://").removeprefix("file:")) for f in files)
    if not catalog:
        assert reader.count() == 5
    assert store.read(spark, "gold", "t").count() == 7
    own = store.read(spark, "gold", "t").filter("id > 2")
    assert store.write(own, "gold", "t") == 4          # a table may be made from itself
    assert store.read(spark, "gold", "t").count() == 4


def test_catalog_replace_moves_the_location_only(spark, tmp, monkeypatch):
    store = Store(os.path.join(tmp, "lake"), catalog=True, prefix="mv_", buckets=3)
    store.prepare(spark)
    df = spark.range(30).select(F.col("id").cast("string").alias("movie_key"))
    store.write(df, "gold", "t", bucket_by="movie_key")
    with monkeypatch.context() as m:
        m.setattr(Store, "_adopt", kill)
        with pytest.raises(Killed):
            store.write(df.limit(4), "gold", "t", bucket_by="movie_key")
    assert store.read(spark, "gold", "t").count() == 30
    statements = []
    real = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: (statements.append(q), real(self, q, *a, **k))[1])
    store.write(df.limit(4), "gold", "t", bucket_by="movie_key")
    assert not any(q.startswith("DROP TABLE mv_gold.t") and q.endswith(".t") for q in statements)
    assert any("SET LOCATION" in q for q in statements)
    assert store.read(spark, "gold", "t").count() == 4
    desc = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED mv_gold.t").collect()}
    assert desc["Num Buckets"] == "3"
    store.write(df.withColumn("more", F.lit(1)), "gold", "t", bucket_by="movie_key")   # other columns
    assert store.read(spark, "gold", "t").columns == ["movie_key", "more"]


@pytest.mark.parametrize("catalog", [False, True])
def test_appends_once(spark, tmp, catalog):
    store = Store(os.path.join(tmp, "lake"), catalog=catalog, prefix="ap_")
    store.prepare(spark)
    df = spark.range(3)
    assert [store.append(df, "gold", "log", a) for a in ("run 1", "run 1", "run:2", None, None)] == [3] * 5
    got = store.read(spark, "gold", "log")
    assert got.columns == ["id"] and got.count() == 12


def test_a_log_appends_its_rows_once(spark, tmp):
    store = Store(os.path.join(tmp, "lake"))
    log = AuditLog(spark, store, "r1")
    assert log.flush() == 0
    log.add("movies", "bronze", "movies", 3)
    assert log.flush() == 1 and log.flush() == 0
    log.add("movies", "silver", "movies", 3)
    log.flush()
    assert read_audit(spark, store).count() == 2


def test_a_run_started_again_leaves_one_row_a_step(spark, tmp, monkeypatch):
    land = pl.write_landing(spark, {ds: fx.bronze(spark, SF_SMALL, ds) for ds in DATASETS}, os.path.join(tmp, "land"))
    store = Store(os.path.join(tmp, "lake"))
    with monkeypatch.context() as m:
        m.setattr(pl, "run_marts", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            pl.run_pipeline(spark, land, store, run_id="2024-01-01T00")
    assert read_audit(spark, store).count() == 3 * len(DATASETS)
    pl.run_pipeline(spark, land, store, run_id="2024-01-01T00")
    pl.run_pipeline(spark, land, store, run_id="2024-01-01T00")
    log = read_audit(spark, store)
    assert log.count() == log.select("dataset", "layer", "table_name").distinct().count() == 3 * len(DATASETS) + 2
    assert store.read(spark, "gold", "run_metrics").count() == 1
    pl.run_pipeline(spark, land, store, csv_multiline=False, run_id="2024-01-01T01")
    assert store.read(spark, "gold", "run_metrics").count() == 2


def test_a_feed_that_lacks_a_field_raises_and_the_old_table_stays(spark, tmp):
    land = os.path.join(tmp, "land")
    os.makedirs(land)
    store = Store(os.path.join(tmp, "lake"))
    names = [f for f in ("id", "title", "type", "genre", "language", "release_date", "runtime", "rating", "votes", "director")]

    def feed(**change):
        rec = {n: change.get(n, "x") for n in names if n not in change or change[n] is not ...}
        with open(os.path.join(land, "movies.json"), "w") as f:
            json.dump([rec, rec], f, indent=change.pop("indent", None))
        return pl.run_bronze(spark, "movies", land, store)
    assert feed() == 2
    assert feed(genre=None) == 2                        # named, without a value
    with pytest.raises(ValueError, match="genre"):
        feed(genre=...)
    with open(os.path.join(land, "movies.json"), "w") as f:
        json.dump([{"ident": 1, "name": "a"}], f)
    with pytest.raises(ValueError, match="title"):
        pl.run_bronze(spark, "movies", land, store)
    assert store.read(spark, "bronze", "movies").count() == 2
    with open(os.path.join(land, "movies.json"), "w") as f:
        f.write("[]")
    assert pl.run_bronze(spark, "movies", land, store) == 0


def test_awards_and_events_that_lack_a_field_raise(spark, tmp):
    land = os.path.join(tmp, "land")
    os.makedirs(land)
    store = Store(os.path.join(tmp, "lake"))
    with open(os.path.join(land, "awards.xml"), "w") as f:
        f.write("<awards><award><award_id>1</award_id><title>t</title><category/><year>1</year></award></awards>")
    with pytest.raises(ValueError, match="result"):
        pl.run_bronze(spark, "awards", land, store)
    event = {"event_id": "1", "username": "u", "title": "t", "action": "a", "event_time": "x", "device": ""}
    with open(os.path.join(land, "watchlist_events.json"), "w") as f:
        json.dump({"events": [event] * 3}, f, indent=2)
    with pytest.raises(ValueError, match="user"):
        pl.run_bronze(spark, "watchlist", land, store)
    assert not store.exists(spark, "bronze", "watchlist")
