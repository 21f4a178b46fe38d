"""Command line: one pipeline run, callable from any scheduler.

    spark-submit --py-files marquee.zip -m marquee run \\
        --landing s3a://bucket/landing --lake s3a://bucket/lake [--catalog --buckets 512]

Steps can also be run one at a time (``bronze``/``silver``/``gold`` with
``--dataset``), mirroring the reference's per-dataset tasks.
"""

from __future__ import annotations

import argparse
import json

from marquee.plans import pipeline as pl
from marquee.sources.sinks import Store
from marquee.session import get_spark, input_bytes, size_shuffle


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="marquee")
    ap.add_argument("step", choices=["run", "bronze", "silver", "gold", "marts", "metrics"])
    ap.add_argument("--landing", help="folder with the raw feeds")
    ap.add_argument("--lake", required=True, help="root of the bronze/silver/gold tables")
    ap.add_argument("--dataset", help="dataset for a single bronze/silver/gold step")
    ap.add_argument("--catalog", action="store_true", help="use catalog tables, not paths")
    ap.add_argument("--prefix", default="", help="database name prefix in catalog mode")
    ap.add_argument("--buckets", type=int, help="bucket count for per-title tables")
    ap.add_argument("--parallelism", type=int, help="concurrent dataset chains (default: all)")
    ap.add_argument("--size-shuffle", action="store_true",
                    help="size shuffle partitions from the landed bytes (~256 MB each)")
    ap.add_argument("--json-multiline", action="store_true",
                    help="JSON feeds are documents spread over lines (default: found from the files)")
    ap.add_argument("--csv-lines", action="store_true",
                    help="no CSV value holds a line break (default: cut at record ends)")
    ap.add_argument("--run-id", help="name of the run; started again, it does not append twice")
    a = ap.parse_args(argv)

    spark = get_spark("marquee")
    if a.size_shuffle and a.landing:
        size_shuffle(spark, input_bytes(spark, a.landing))
    store = Store(a.lake, catalog=a.catalog, prefix=a.prefix, buckets=a.buckets)
    store.prepare(spark)
    if a.step == "run":
        out = {"movie_360": pl.run_pipeline(spark, a.landing, store, a.parallelism,
                                                 a.json_multiline or None,
                                                 False if a.csv_lines else None, a.run_id)}
    elif a.step == "bronze":
        out = {"rows": pl.run_bronze(spark, a.dataset, a.landing, store,
                                          json_multiline=a.json_multiline or None,
                                          csv_multiline=False if a.csv_lines else None)}
    elif a.step == "silver":
        out = {"rows": pl.run_silver(spark, a.dataset, store)}
    elif a.step == "gold":
        out = {"rows": pl.run_gold(spark, a.dataset, store)}
    elif a.step == "marts":
        out = {"movie_360": pl.run_marts(spark, store)}
    else:
        out = {"rows": pl.record_run_metrics(spark, store, run_id=a.run_id)}
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
