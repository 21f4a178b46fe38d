"""Benchmark the headline operators; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

The dirty bronze feeds are landed as Parquet once, before timing, so the figures are the
engine's alone.  Each operator is fully executed (``noop`` sink) once as a warm-up and then
``BENCH_REPS`` (default 5) times; the reported time is the median.  The pipeline entry
times a whole run -- landing feeds -> bronze -> silver -> gold -> marts -> metrics --
into a fresh store each repetition.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from marquee.session import get_spark, scratch_path  # noqa: E402

def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "5"))
    spark = get_spark("marquee-bench", master=f"local[{cpus}]", shuffle_partitions=2 * cpus,
                      extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "7g")})
    from marquee.operators import marts as mt
    from marquee.operators.cleaners import CLEANERS
    from marquee.plans import fixtures as fx
    from marquee.plans.pipeline import run_pipeline, write_landing
    from marquee.plans.registry import DATASETS
    from marquee.sources.sinks import Store

    bronze = {}
    for ds in DATASETS:
        path = scratch_path(spark, f"bench-bronze-{ds}")
        fx.bronze(spark, sf_dir, ds).write.parquet(path)
        bronze[ds] = spark.read.parquet(path)

    def silver(ds: str):
        return CLEANERS[ds](bronze[ds])

    def movie_360():
        return mt.movie_360(silver("movies"), mt.fact_ratings(silver("ratings")),
                            mt.score_summary(silver("scores")),
                            mt.title_popularity(silver("watchlist")),
                            mt.awards_won(silver("awards")), mt.review_summary(silver("reviews")))

    builds = {
        "clean_ratings": lambda: silver("ratings"),
        "fact_ratings": lambda: mt.fact_ratings(silver("ratings")),
        "movie_360": movie_360,
        "trending_titles": lambda: mt.trending_titles(movie_360()),
        "clean_users": lambda: silver("users"),
        "clean_watchlist": lambda: silver("watchlist"),
        "users_by_country": lambda: mt.users_by_country(silver("users")),
    }
    out: dict[str, float] = {}
    for key, build in builds.items():
        _noop(build())
        times = []
        for _ in range(reps):
            t = time.perf_counter()
            _noop(build())
            times.append(time.perf_counter() - t)
        out[key] = round(statistics.median(times), 3)

    landing = write_landing(spark, {ds: fx.bronze(spark, sf_dir, ds) for ds in DATASETS},
                            scratch_path(spark, "bench-landing"))

    def pipeline() -> None:
        store = Store(scratch_path(spark, "bench-lake"))
        run_pipeline(spark, landing, store)
        store.read(spark, "gold", "movie_360").count()

    pipeline()
    times = []
    for _ in range(reps):
        t = time.perf_counter()
        pipeline()
        times.append(time.perf_counter() - t)
    out["end_to_end_run"] = round(statistics.median(times), 3)

    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": os.path.basename(sf_dir),
                      "cpus": cpus, "reps": reps}))
    spark.stop()


if __name__ == "__main__":
    main()
