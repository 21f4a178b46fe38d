"""The medallion run: landing feeds -> bronze -> silver -> gold -> marts -> metrics.

Each step is one Spark job that ends in a written table, so lineage is cut
at every layer and a lost executor only recomputes the current step.
Datasets are independent until the marts, so their bronze -> silver -> gold
chains run as concurrent jobs on one session.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.marts import movie_360, table_counts, trending_titles
from marquee.plans.registry import DATASETS, dataset
from marquee.session import input_bytes, shuffles_freed, size_shuffle
from marquee.sources.readers import absent_fields, read_feed
from marquee.sources.schemas import SILVER
from marquee.sources.sinks import (
    _APPEND_LOCK, AUDIT_TABLE, METRICS_TABLE, AuditLog, Store, remove_path, write_feed, write_wrapped_json,
)

log = logging.getLogger(__name__)

SPARK_DEFAULT_PARTITIONS = "200"
METRIC_TABLES = ("movies", "users", "ratings", "reviews")


class _StepLog:
    """The run's audit log, or a private one flushed when the step ends."""

    def __init__(self, spark: SparkSession, store: Store, audit_log: AuditLog | None):
        self.log = audit_log or AuditLog(spark, store)
        self.own = audit_log is None

    def __enter__(self) -> AuditLog:
        return self.log

    def __exit__(self, *exc) -> None:
        if self.own:
            self.log.flush()


def run_bronze(spark: SparkSession, name: str, landing: str, store: Store,
               audit_log: AuditLog | None = None, json_multiline: bool | None = None,
               csv_multiline: bool | None = None) -> int:
    """Read one landing feed as-is and replace its bronze table.

    A feed with rows that never names one of its fields raises, and the old table stays: a renamed
    field would else be nulls in every row.  What the write observes says which fields to look for,
    so that a usual feed is not read for it."""
    ds = dataset(name)

    def complete(seen: dict[str, int]) -> None:
        empty = [c for c in columns if not seen[f"in_{c}"]] if seen["rows"] else []
        if missing := absent_fields(spark, landing, name, empty):
            raise ValueError(f"{name} feed lacks the fields {', '.join(missing)}")

    with _StepLog(spark, store, audit_log) as a:
        feed = read_feed(spark, landing, name, json_multiline, csv_multiline)
        columns = feed.columns
        try:
            n = store.write(feed, "bronze", ds.bronze_table, columns=columns, check=complete)
        finally:
            if getattr(feed, "scratch", None):
                remove_path(spark, feed.scratch)
        a.add(name, "bronze", ds.bronze_table, n)
    log.info("bronze %s: %d rows", name, n)
    return n


def run_silver(spark: SparkSession, name: str, store: Store,
               audit_log: AuditLog | None = None, bronze_rows: int | None = None) -> int | None:
    """Clean bronze into silver.  An empty bronze table leaves silver as it is
    (audited as SKIPPED).  Emptiness comes from the bronze step's observed
    count when given, else from a probe that reads at most one row."""
    ds = dataset(name)
    with _StepLog(spark, store, audit_log) as a:
        bronze = store.read(spark, "bronze", ds.bronze_table)
        if (bronze_rows == 0) if bronze_rows is not None else bronze.isEmpty():
            a.add(name, "silver", ds.silver_table, 0, status="SKIPPED")
            return None
        clean = ds.cleaner(bronze)
        if [(f.name, f.dataType) for f in clean.schema] != [(f.name, f.dataType)
                                                            for f in SILVER[name]]:
            raise TypeError(f"{name}: {clean.schema.simpleString()} is not the silver schema")
        n = store.write(clean, "silver", ds.silver_table,
                        bucket_by="movie_key" if name == "movies" else None)
        a.add(name, "silver", ds.silver_table, n)
    return n


def run_gold(spark: SparkSession, name: str, store: Store,
             audit_log: AuditLog | None = None) -> int:
    """Aggregate one silver table into its gold mart."""
    ds = dataset(name)
    with _StepLog(spark, store, audit_log) as a:
        mart = ds.mart(store.read(spark, "silver", ds.silver_table))
        n = store.write(mart, "gold", ds.gold_table,
                        bucket_by="movie_key" if ds.per_title else None)
        a.add(name, "gold", ds.gold_table, n)
    return n


def run_marts(spark: SparkSession, store: Store, audit_log: AuditLog | None = None) -> int:
    """movie_360 from silver movies and the five per-title marts, then the
    top-20 from the stored movie_360."""
    g = {ds: store.read(spark, "gold", DATASETS[ds].gold_table)
         for ds in ("ratings", "scores", "watchlist", "awards", "reviews")}
    m360 = movie_360(store.read(spark, "silver", "movies"), g["ratings"], g["scores"],
                     g["watchlist"], g["awards"], g["reviews"])
    n = store.write(m360, "gold", "movie_360", bucket_by="movie_key")
    store.write(trending_titles(store.read(spark, "gold", "movie_360")), "gold", "trending_titles")
    with _StepLog(spark, store, audit_log) as a:
        a.add("marts", "gold", "movie_360", n)
    return n


def metrics_snapshot(spark: SparkSession, store: Store,
                     known: dict[str, int] | None = None) -> DataFrame:
    """Row counts of the silver tables (0 for a missing table) and the run time.
    ``known`` holds counts already observed when this run wrote those tables;
    only the others are counted."""
    known = {t: n for t, n in (known or {}).items() if t in METRIC_TABLES and n is not None}
    tables = {t: (store.read(spark, "silver", t) if store.exists(spark, "silver", t) else None)
              for t in METRIC_TABLES if t not in known}
    lits = {t: F.lit(n).cast("bigint") for t, n in known.items()}
    if all(v is None for v in tables.values()):
        cols = {t: lits.get(t, F.lit(0).cast("bigint")) for t in METRIC_TABLES}
        return spark.range(1).select(F.current_timestamp().alias("run_time"),
                                     *[c.alias(f"total_{t}") for t, c in cols.items()])
    counted = table_counts(tables)
    return counted.select(F.current_timestamp().alias("run_time"),
                          *[(lits[t] if t in lits else F.col(f"total_{t}")).alias(f"total_{t}")
                            for t in METRIC_TABLES])


def record_run_metrics(spark: SparkSession, store: Store,
                       audit_log: AuditLog | None = None,
                       known: dict[str, int] | None = None, run_id: str | None = None) -> int:
    """Append one snapshot row to gold.run_metrics (history; only a run that is started again
    under its ``run_id`` replaces its own row)."""
    with _APPEND_LOCK:
        n = store.append(metrics_snapshot(spark, store, known).coalesce(1), "gold",
                         METRICS_TABLE, run_id)
    with _StepLog(spark, store, audit_log) as a:
        a.add("marts", "gold", METRICS_TABLE, n)
    return n


def run_dataset(spark: SparkSession, name: str, landing: str, store: Store,
                audit_log: AuditLog | None = None, json_multiline: bool | None = None,
                csv_multiline: bool | None = None, keep_landing: bool = True) -> int | None:
    """bronze -> silver -> gold for one dataset; returns the silver rows written
    (None when silver was skipped).  Without ``keep_landing`` the feed is deleted once the bronze
    table holds it."""
    b = run_bronze(spark, name, landing, store, audit_log, json_multiline, csv_multiline)
    if not keep_landing:
        remove_path(spark, f"{landing.rstrip('/')}/{dataset(name).feed}")
    n = run_silver(spark, name, store, audit_log, bronze_rows=b)
    if n is not None or store.exists(spark, "silver", name):
        run_gold(spark, name, store, audit_log)
    return n


def run_pipeline(spark: SparkSession, landing: str, store: Store, parallelism: int | None = None,
                 json_multiline: bool | None = None, csv_multiline: bool | None = None,
                 run_id: str | None = None, keep_landing: bool = True) -> int:
    """The whole run; returns the movie_360 row count.  The first failure in
    any dataset chain is raised after the others finish; audit rows of the
    steps that did finish are written either way.

    A run that failed can be started again under the same ``run_id`` (a scheduler's name for
    it): it leaves one audit row a step and one row of metrics, as if it had run once.

    ``keep_landing=False`` deletes each feed once its bronze table holds it, so that the landing and
    the layers made of it are not on the disk together; feeds must be landed anew to start again.

    Shuffles are sized from the landed bytes, unless the session sets a number of
    partitions other than Spark's default.  A step's shuffle files go with the step."""
    sized = spark.conf.get("spark.sql.shuffle.partitions") == SPARK_DEFAULT_PARTITIONS
    if sized:
        size_shuffle(spark, input_bytes(spark, landing))
    store.prepare(spark)
    audit_log = AuditLog(spark, store, run_id)
    try:
        with shuffles_freed(spark):
            with ThreadPoolExecutor(max_workers=parallelism or len(DATASETS)) as pool:
                futures = {ds: pool.submit(run_dataset, spark, ds, landing, store, audit_log,
                                           json_multiline, csv_multiline, keep_landing) for ds in DATASETS}
                silver_rows = {ds: f.result() for ds, f in futures.items()}
            n = run_marts(spark, store, audit_log)
            record_run_metrics(spark, store, audit_log, known=silver_rows, run_id=run_id)
    finally:
        audit_log.flush()
        if sized:
            spark.conf.set("spark.sql.shuffle.partitions", SPARK_DEFAULT_PARTITIONS)
    return n


# ---- landing feeds ---------------------------------------------------------

def write_landing(spark: SparkSession, feeds: dict[str, DataFrame], landing: str,
                  rows_per_doc: int = 10_000) -> str:
    """Write bronze-shaped DataFrames as the raw feeds each source delivers:
    movies JSON lines, scores CSV, watchlist wrapped JSON, awards XML,
    users/ratings/reviews Parquet.  Watchlist and awards are compressed (their text is several times
    the tables it is made of); a file of theirs holds what one task wrote, and is read by one."""
    from marquee.plans.fixtures import parquet_feed
    root = landing.rstrip("/")
    for name, df in feeds.items():
        path = f"{root}/{dataset(name).feed}"
        if name == "movies":
            write_feed(df, path, "json")
        elif name == "scores":
            write_feed(df, path, "csv")
        elif name == "watchlist":
            write_wrapped_json(df, path, "events", rows_per_doc, compression="gzip")
        elif name == "awards":
            write_feed(df, path, "xml", root_tag="awards", row_tag="award", compression="gzip")
        else:
            write_feed(parquet_feed(df, name), path, "parquet")
    return root


__all__ = ["run_bronze", "run_silver", "run_gold", "run_marts", "record_run_metrics",
           "metrics_snapshot", "run_dataset", "run_pipeline", "write_landing", "AUDIT_TABLE"]
