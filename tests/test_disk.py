"""What a run leaves on the disk while it goes on: no shuffle files of finished steps, no feed that
its bronze table already holds."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from marquee.plans import fixtures as fx
from marquee.plans import io_queries as io
from marquee.plans import pipeline as pl
from marquee.plans.registry import DATASETS
from marquee.session import FREE_SHUFFLES, shuffles_freed
from marquee.sources.sinks import Store

from conftest import SF_SMALL


def shuffles(spark) -> set[int]:
    """Numbers of the shuffles that have files on the disk."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = disk.getAllBlocks().mkString(",").split(",")
    return {int(n.split("_")[1]) for n in names if n.startswith("shuffle_")}


def left(spark, before: set[int]) -> set[int]:
    """Shuffles that came since; files are deleted in the background, so it waits for that."""
    for _ in range(50):
        if not (now := shuffles(spark) - before):
            break
        time.sleep(0.2)
    return now


def wide(spark):
    return spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.sum("id").alias("s"))


def test_shuffle_files_go_with_their_action(spark, tmp):
    before = shuffles(spark)
    wide(spark).write.parquet(f"{tmp}/kept")
    assert shuffles(spark) - before
    before = shuffles(spark)
    with shuffles_freed(spark):
        wide(spark).write.parquet(f"{tmp}/freed")
        wide(spark).write.json(f"{tmp}/freed_json")
        assert wide(spark).count() == 700
        assert not left(spark, before)
    assert spark.read.parquet(f"{tmp}/freed").exceptAll(spark.read.parquet(f"{tmp}/kept")).isEmpty()


@pytest.mark.parametrize("own", [None, "false", "true"])
def test_the_session_gets_its_setting_back_from_the_last(spark, own):
    if own:
        spark.conf.set(FREE_SHUFFLES, own)
    try:
        first, second = shuffles_freed(spark), shuffles_freed(spark)
        first.__enter__()
        second.__enter__()
        first.__exit__(None, None, None)
        assert spark.conf.get(FREE_SHUFFLES) == "true"
        with pytest.raises(ValueError), shuffles_freed(spark):
            raise ValueError
        assert spark.conf.get(FREE_SHUFFLES) == "true"
        second.__exit__(None, None, None)
        assert spark.conf.get(FREE_SHUFFLES, None) == own
    finally:
        spark.conf.unset(FREE_SHUFFLES)


def watch(monkeypatch) -> list[tuple[str, bool]]:
    """(dataset, whether its feed is still there) as each silver step begins."""
    seen, landings, silver, pipeline = [], [], pl.run_silver, pl.run_pipeline

    def run_silver(spark, name, *args, **kwargs):
        seen.append((name, os.path.exists(f"{landings[-1]}/{DATASETS[name].feed}")))
        return silver(spark, name, *args, **kwargs)

    def run_pipeline(spark, landing, *args, **kwargs):
        landings.append(landing.removeprefix("file:"))
        assert all(os.path.exists(f"{landings[-1]}/{ds.feed}") for ds in DATASETS.values())
        return pipeline(spark, landing, *args, **kwargs)
    monkeypatch.setattr(pl, "run_silver", run_silver)
    monkeypatch.setattr(io, "run_pipeline", run_pipeline)
    return seen


def test_end_to_end_run_holds_neither_landed_feeds_nor_shuffles(spark, monkeypatch):
    seen, before = watch(monkeypatch), shuffles(spark)
    out = io.q_end_to_end_run(spark, SF_SMALL)
    assert not left(spark, before)
    assert sorted(seen) == [(ds, False) for ds in sorted(DATASETS)]
    assert out.count() == fx.read_table(spark, SF_SMALL, "part").count()


def test_run_metrics_holds_neither_landed_feeds_nor_shuffles(spark, monkeypatch):
    monkeypatch.setattr(io, "_RUNS", {})                 # a run of its own
    seen, before = watch(monkeypatch), shuffles(spark)
    out = io.q_run_metrics(spark, SF_SMALL)
    assert not left(spark, before)
    assert sorted(seen) == [(ds, False) for ds in sorted(DATASETS)]
    assert out.count() == 2 and out.distinct().count() == 1
    assert io.q_run_metrics(spark, SF_SMALL).count() == 2
    assert len(seen) == len(DATASETS)                    # not run again


def test_a_landing_is_kept_unless_asked_otherwise(spark, tmp):
    land = pl.write_landing(spark, {ds: fx.bronze(spark, SF_SMALL, ds) for ds in DATASETS}, f"{tmp}/land")
    feeds = {ds.feed for ds in DATASETS.values()}
    n = pl.run_pipeline(spark, land, Store(f"{tmp}/kept"))
    assert feeds <= set(os.listdir(land))
    assert pl.run_pipeline(spark, land, Store(f"{tmp}/gone"), keep_landing=False) == n
    assert not feeds & set(os.listdir(land))
    for layer, table in [("bronze", ds) for ds in DATASETS] + [("gold", "movie_360")]:
        kept, gone = (Store(f"{tmp}/{s}").read(spark, layer, table) for s in ("kept", "gone"))
        assert kept.exceptAll(gone).isEmpty() and gone.exceptAll(kept).isEmpty()


def test_a_feed_stays_if_its_bronze_table_fails(spark, tmp):
    land = f"{tmp}/land"
    os.makedirs(f"{land}/movies.json")
    with open(f"{land}/movies.json/part", "w") as f:
        f.write('{"ident": 1}\n')
    with pytest.raises(ValueError, match="lacks"):
        pl.run_dataset(spark, "movies", land, Store(f"{tmp}/lake"), keep_landing=False)
    assert os.path.exists(f"{land}/movies.json/part")


def test_compressed_feeds_hold_every_row(spark, tmp):
    feeds = {ds: fx.bronze(spark, SF_SMALL, ds) for ds in ("watchlist", "awards")}
    land = pl.write_landing(spark, feeds, f"{tmp}/land", rows_per_doc=50)
    store = Store(f"{tmp}/lake")
    for ds, feed in feeds.items():
        files = [f for f in os.listdir(f"{land}/{DATASETS[ds].feed}") if f.startswith("part-")]
        assert files and all(f.endswith(".gz") for f in files)
        pl.run_bronze(spark, ds, land, store)
        got = store.read(spark, "bronze", ds)
        assert got.exceptAll(feed).isEmpty() and feed.exceptAll(got).isEmpty()
