"""Pipeline steps: empty guard, unknown dataset, missing metrics tables."""

from __future__ import annotations

import os

import pytest

from marquee.plans import fixtures as fx
from marquee.plans.pipeline import (
    metrics_snapshot, run_bronze, run_gold, run_silver, write_landing,
)
from marquee.plans.registry import dataset
from marquee.sources.sinks import Store, read_audit

from conftest import SF_SMALL


def test_unknown_dataset_raises():
    with pytest.raises(ValueError):
        dataset("nope")


def test_empty_bronze_skips_silver_and_keeps_old_table(spark, tmp):
    store = Store(os.path.join(tmp, "lake"))
    landing = write_landing(spark, {"ratings": fx.bronze(spark, SF_SMALL, "ratings")},
                            os.path.join(tmp, "landing"))
    run_bronze(spark, "ratings", landing, store)
    n = run_silver(spark, "ratings", store)
    assert n and n > 0
    empty = write_landing(spark, {"ratings": fx.bronze(spark, SF_SMALL, "ratings").limit(0)},
                          os.path.join(tmp, "landing2"))
    assert run_bronze(spark, "ratings", empty, store) == 0
    assert run_silver(spark, "ratings", store) is None
    assert store.read(spark, "silver", "ratings").count() == n
    assert run_gold(spark, "ratings", store) > 0
    statuses = [r.status for r in read_audit(spark, store).where("layer = 'silver'").collect()]
    assert sorted(statuses) == ["OK", "SKIPPED"]


def test_metrics_with_missing_tables(spark, tmp):
    store = Store(os.path.join(tmp, "lake"))
    r = metrics_snapshot(spark, store).first()
    assert (r.total_movies, r.total_users, r.total_ratings, r.total_reviews) == (0, 0, 0, 0)
    store.write(spark.range(4), "silver", "users")
    r = metrics_snapshot(spark, store).first()
    assert (r.total_movies, r.total_users) == (0, 4) and r.run_time is not None


def test_pretty_printed_feeds_in_reference_layout(spark, tmp):
    """Feeds laid out as the reference writes them: a one-line JSON array of
    movies with mixed-type values and an indented {"events": [...]} document."""
    import json

    land = os.path.join(tmp, "land")
    os.makedirs(land)
    movies = [{"id": 1000, "title": "the dawn", "type": "MOVIE", "genre": "Drama",
               "language": None, "release_date": "March 04, 2021", "runtime": 120,
               "rating": 8.5, "votes": None, "director": "  Lana W "},
              {"id": 1001, "title": "THE DAWN", "type": "movie", "genre": "drama",
               "language": "EN", "release_date": None, "runtime": "95 min",
               "rating": "8.5/10", "votes": 12, "director": None}]
    with open(os.path.join(land, "movies.json"), "w") as f:
        f.write(json.dumps(movies))
    events = {"events": [{"event_id": str(i), "user": "u", "title": " The Dawn ",
                          "action": "ADD" if i % 3 else " remove ", "event_time": "2021-03-04",
                          "device": ""} for i in range(7)]}
    with open(os.path.join(land, "watchlist_events.json"), "w") as f:
        f.write(json.dumps(events, indent=2))
    store = Store(os.path.join(tmp, "lake"))
    assert run_bronze(spark, "movies", land, store) == 2
    assert run_bronze(spark, "watchlist", land, store) == 7
    run_silver(spark, "movies", store)
    run_silver(spark, "watchlist", store)
    m = store.read(spark, "silver", "movies").collect()
    assert len(m) == 1 and m[0].movie_key == "The Dawn|movie"
    run_gold(spark, "watchlist", store)
    g = store.read(spark, "gold", "title_popularity").first()
    assert (g.adds, g.removes) == (4, 3)


def test_shuffle_sizing_from_landed_bytes(spark, tmp):
    from marquee.session import input_bytes, size_shuffle
    land = write_landing(spark, {"users": fx.bronze(spark, SF_SMALL, "users")},
                         os.path.join(tmp, "land"))
    n = input_bytes(spark, land)
    assert n > 0
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffle(spark, 100 * 2**40) == 409600
        assert size_shuffle(spark, n) == 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_silver_schema_is_enforced(spark, tmp, monkeypatch):
    from dataclasses import replace

    from marquee.plans import registry
    ds = registry.DATASETS["ratings"]
    store = Store(os.path.join(tmp, "lake"))
    store.write(fx.bronze(spark, SF_SMALL, "ratings"), "bronze", "ratings")
    monkeypatch.setitem(registry.DATASETS, "ratings",
                        replace(ds, cleaner=lambda df: ds.cleaner(df).drop("score")))
    with pytest.raises(TypeError, match="silver schema"):
        run_silver(spark, "ratings", store)
    assert not store.exists(spark, "silver", "ratings")


def test_cli_run_and_single_steps(spark, tmp, capsys):
    import json

    from marquee.__main__ import main
    from marquee.plans.registry import DATASETS

    land = write_landing(spark, {ds: fx.bronze(spark, SF_SMALL, ds) for ds in DATASETS},
                         os.path.join(tmp, "land"))
    lake = os.path.join(tmp, "lake")
    assert main(["run", "--landing", land, "--lake", lake]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    store = Store(lake)
    assert out["movie_360"] == store.read(spark, "gold", "movie_360").count() > 0
    assert main(["metrics", "--lake", lake]) == 0
    assert store.read(spark, "gold", "run_metrics").count() == 2
    assert main(["bronze", "--dataset", "scores", "--landing", land, "--lake", lake]) == 0


def test_metrics_mix_known_and_counted(spark, tmp):
    store = Store(os.path.join(tmp, "lake"))
    store.write(spark.range(4), "silver", "users")
    store.write(spark.range(9), "silver", "ratings")
    r = metrics_snapshot(spark, store, known={"movies": 7, "ratings": 9, "reviews": None}).first()
    assert (r.total_movies, r.total_users, r.total_ratings, r.total_reviews) == (7, 4, 9, 0)
    r = metrics_snapshot(spark, Store(os.path.join(tmp, "none")), known={"movies": 3}).first()
    assert (r.total_movies, r.total_users) == (3, 0)
