"""Sinks: raw-feed writers, layer tables with observed row counts, audit log,
run-metrics history, JDBC.

Row counts come from an :class:`~pyspark.sql.Observation` attached to the
write itself, so a table is produced in one pass (the reference counts,
counts again, then writes).
"""

from __future__ import annotations

import re
import threading
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType

from marquee.sources.schemas import AUDIT

LAYERS = ("bronze", "silver", "gold")


# ---- raw feeds (W7) --------------------------------------------------------

def write_feed(df: DataFrame, path: str, fmt: str, mode: str = "overwrite",
               **options) -> None:
    """Write a raw feed as csv / json / xml / parquet, keeping values verbatim."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w = (w.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
              .option("ignoreTrailingWhiteSpace", False))
    elif fmt == "xml":
        w = w.format("xml").option("rootTag", options.pop("root_tag", "rows")) \
             .option("rowTag", options.pop("row_tag", "row"))
    for k, v in options.items():
        w = w.option(k, v)
    if fmt == "xml":
        w.save(path)
    else:
        getattr(w, fmt)(path)


def write_wrapped_json(df: DataFrame, path: str, field: str = "events", rows_per_doc: int = 10_000,
                       mode: str = "overwrite", bytes_per_doc: int = 64 << 20, **options) -> None:
    """JSON documents ``{"<field>": [row, ...]}``, one per line, each holding at
    most ``rows_per_doc`` rows, and no more than one row beyond ``bytes_per_doc`` -- the wrapped
    layout without ever gathering the whole feed into one document."""
    wrapped(df, field, rows_per_doc, bytes_per_doc).select(field).write.mode(mode).options(**options).json(path)


def write_indented_json(df: DataFrame, path: str, field: str = "events", rows_per_doc: int = 10_000,
                        mode: str = "overwrite", bytes_per_doc: int = 64 << 20) -> None:
    """The wrapped layout as indented documents, each in a file of its own."""
    docs = wrapped(df, field, rows_per_doc, bytes_per_doc)
    (docs.select(F.concat_ws("-", "__hash", "__doc").alias("doc"),
                 F.to_json(F.struct(field), {"pretty": "true"}).alias("value"))
         .repartition("doc").write.mode(mode).partitionBy("doc").text(path))


def wrapped(df: DataFrame, field: str, rows_per_doc: int, bytes_per_doc: int = 64 << 20) -> DataFrame:
    """Rows gathered into documents: by a hash of the row, which is the same whenever a
    task runs again, and then in order, cut by the number and by the JSON bytes of the rows before."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = F.struct(*df.columns)
    keyed = df.select(row.alias("__row"), F.pmod(F.xxhash64(row), F.lit(n)).alias("__hash"),
                      F.octet_length(F.to_json(row)).alias("__bytes"))
    before = Window.partitionBy("__hash").orderBy("__row").rowsBetween(Window.unboundedPreceding, -1)
    place = keyed.select("__row", "__hash", F.count("__bytes").over(before).alias("__rows"),
                         F.coalesce(F.sum("__bytes").over(before), F.lit(0)).alias("__size"))
    doc = F.concat_ws("-", F.expr(f"__size div {int(bytes_per_doc)}"), F.expr(f"__rows div {int(rows_per_doc)}"))
    return (place.groupBy("__hash", doc.alias("__doc")).agg(F.collect_list("__row").alias(field)))


# ---- layer tables (W1, W3, W8) ---------------------------------------------

def observed(df: DataFrame, write, columns: list[str] = ()) -> dict[str, int]:
    """Run ``write(df_with_observation)``; ``rows`` written, and how many hold a value, by column."""
    obs = Observation()
    write(df.observe(obs, F.count(F.lit(1)).alias("rows"),
                     *[F.count(F.col(f"`{c}`")).alias(f"in_{c}") for c in columns]))
    return obs.get


def write_observed(df: DataFrame, write) -> int:
    """Run ``write(df_with_observation)`` and return the number of rows written."""
    return int(observed(df, write)["rows"])


#: Names in a table's folder: the pointer to its version, and what versions and appends begin with.
POINTER, VERSION, APPEND = "_CURRENT", "v-", "append_id"


@dataclass(frozen=True)
class Store:
    """Where bronze / silver / gold tables live.

    Path mode (default): ``<root>/<layer>/<table>`` in ``fmt``.  Catalog mode
    (``catalog=True``): tables ``<prefix><layer>.<table>`` in the session
    catalog, database locations under ``root``; per-title gold marts can be
    bucketed on ``movie_key`` so joins between them need no shuffle.

    Each replace writes a version folder of its own; then one small step makes it the table: a
    pointer file that is replaced (path mode), or the table's location (catalog mode).  Readers
    see the old version or the new one, also when a run is killed at any point, and no data is
    moved.  The version before the current one stays for those who still read it; older ones and
    those of killed runs go with the next replace.  One writer a table at a time.

    An append is a partition named by its ``append_id``: repeated, it replaces itself.
    """

    root: str
    fmt: str = "parquet"
    catalog: bool = False
    prefix: str = ""
    buckets: int | None = None

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}{'.db' if self.catalog else ''}/{table}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def prepare(self, spark: SparkSession) -> list[str]:
        """Create the layer databases if absent (catalog mode); W6."""
        if not self.catalog:
            return [f"{self.root.rstrip('/')}/{layer}" for layer in LAYERS]
        out = []
        for layer in LAYERS:
            db = f"{self.prefix}{layer}"
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} "
                      f"LOCATION '{self.root.rstrip('/')}/{layer}.db'")
            out.append(db)
        return out

    def current(self, spark: SparkSession, layer: str, table: str) -> str | None:
        """The version folder that the table is now, if it was ever replaced (path mode)."""
        folder = self.path(layer, table)
        name = _read_text(spark, f"{folder}/{POINTER}")
        return name and f"{folder}/{name.strip()}"

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        if self.catalog:
            df = spark.table(self.name(layer, table))
        else:
            df = spark.read.format(self.fmt).load(self.current(spark, layer, table) or self.path(layer, table))
        return df.drop(APPEND)

    def exists(self, spark: SparkSession, layer: str, table: str) -> bool:
        if self.catalog:
            return spark.catalog.tableExists(self.name(layer, table))
        try:
            self.read(spark, layer, table)
            return True
        except AnalysisException as e:
            if (e.getCondition() or "").startswith(("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")):
                return False
            raise

    def write(self, df: DataFrame, layer: str, table: str, bucket_by: str | None = None,
              columns: list[str] = (), check=None) -> int:
        """Replace a table and return the observed row count.

        ``check`` gets what was observed (rows, and values of ``columns``) before the new version
        becomes the table.  A write or check that fails leaves the table as it was."""
        spark = df.sparkSession
        version = f"{VERSION}{uuid.uuid4().hex[:12]}"
        place = f"{self.path(layer, table)}/{version}"
        new = f"{table}__{version[len(VERSION):]}"
        bucketed = self.catalog and bucket_by and self.buckets
        if bucketed:
            # Same hash as the bucket id: each task writes exactly one bucket, so a
            # bucketed table has one file per bucket instead of tasks x buckets.
            df = df.repartition(self.buckets, bucket_by)

        def run(d: DataFrame) -> None:
            w = d.write.format(self.fmt)
            if not self.catalog:
                w.save(place)
                return
            if bucketed:
                w = w.bucketBy(self.buckets, bucket_by).sortBy(bucket_by)
            w.option("path", place).saveAsTable(self.name(layer, new))
        try:
            seen = observed(df, run, columns)
            if check:
                check(seen)
        except BaseException:
            if self.catalog:
                spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, new)}")
            remove_path(spark, place)
            raise
        if self.catalog:
            before = self._adopt(spark, layer, table, new)
        else:
            before = self.current(spark, layer, table)
            _replace_text(spark, f"{self.path(layer, table)}/{POINTER}", version)
        self._clean(spark, layer, table, {version, (before or "").rstrip("/").rsplit("/", 1)[-1]})
        return int(seen["rows"])

    def _adopt(self, spark: SparkSession, layer: str, table: str, new: str) -> str | None:
        """Make a new external table's files the table's, and return where they were before: by
        its location alone, if its columns and buckets stay."""
        name, fresh = self.name(layer, table), self.name(layer, new)

        def shape(t: str) -> dict:
            rows = [r for r in spark.sql(f"DESCRIBE TABLE EXTENDED {t}").collect()]
            details = {r.col_name: r.data_type for r in rows}
            kept = {k: details.get(k) for k in ("Provider", "Num Buckets", "Bucket Columns", "Sort Columns", "Type")}
            return {"location": details["Location"], "form": (spark.table(t).schema.jsonValue(), kept)}
        mine = shape(fresh)
        if not spark.catalog.tableExists(name):
            spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
            return None
        old = shape(name)
        if old["form"] == mine["form"]:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{mine['location']}'")
            spark.catalog.refreshTable(name)
            spark.sql(f"DROP TABLE {fresh}")
        else:                                    # other columns: the catalog has no one step for it
            spark.sql(f"DROP TABLE {name}")
            spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
        return old["location"]

    def _clean(self, spark: SparkSession, layer: str, table: str, keep: set[str]) -> None:
        """Delete the versions of a table but for these."""
        fs, folder = _file_system(spark, self.path(layer, table))
        for f in fs.listStatus(folder):
            name = f.getPath().getName()
            if name.startswith(VERSION) and name not in keep:
                fs.delete(f.getPath(), True)

    def append(self, df: DataFrame, layer: str, table: str, append_id: str | None = None) -> int:
        """Append rows and return their number.  Repeated with the same ``append_id`` (a run's name), the
        rows replace those of the first time."""
        spark = df.sparkSession
        batch = re.sub(r"[^A-Za-z0-9_.-]", "_", append_id or uuid.uuid4().hex)

        def run(d: DataFrame) -> None:
            if not self.catalog:
                d.write.format(self.fmt).mode("overwrite").save(f"{self.path(layer, table)}/{APPEND}={batch}")
                return
            if spark.catalog.tableExists(self.name(layer, table)):
                spark.sql(f"INSERT OVERWRITE TABLE {self.name(layer, table)} PARTITION ({APPEND} = '{batch}') "
                          "SELECT * FROM {rows}", rows=d)
            else:
                (d.withColumn(APPEND, F.lit(batch)).write.format(self.fmt).partitionBy(APPEND)
                  .saveAsTable(self.name(layer, table)))
        return write_observed(df, run)


def _read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None if there is no such file."""
    fs, p = _file_system(spark, path)
    try:
        stream = fs.open(p)
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileNotFoundException":
            return None
        raise
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one step, over an old one: a rename that replaces; in object stores,
    which have none but where a file appears whole, a single put."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs, p = _file_system(spark, path)
    put = fs.getScheme() in ("s3", "s3a", "s3n", "gs", "abfs", "abfss", "wasb", "wasbs", "oss", "cosn")
    first = p if put else _hadoop_path(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(first, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    if not put:
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(
            fs.makeQualified(first), fs.makeQualified(p), how)


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    p = _hadoop_path(spark, path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more (a landing of a finished run)."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


# ---- append-only logs (W4, W5) ---------------------------------------------

# ---- fixed values (must equal the reference's for equal results) ----
AUDIT_TABLE = "etl_audit_log"
METRICS_TABLE = "run_metrics"
# Appends into one table location are serialised: two concurrent file
# commits into the same folder would race on its staging directory.
_APPEND_LOCK = threading.Lock()
# created_at holds the UTC wall-clock time the step finished.
_AUDIT_ROW = StructType([*AUDIT.fields, StructField("created_at", TimestampNTZType(), True)])


class AuditLog:
    """Audit rows for gold.etl_audit_log, one per step, stamped when the step
    finishes and appended together by :meth:`flush` (one small write per
    phase instead of one per step).  Thread-safe for concurrent steps.

    ``run_id`` names the run: a run that is started again under its name leaves the rows of
    its last attempt, not those of both."""

    def __init__(self, spark: SparkSession, store: Store, run_id: str | None = None):
        self.spark, self.store, self.run_id = spark, store, run_id or uuid.uuid4().hex
        self._rows: list[tuple] = []
        self._new = False
        self._lock = threading.Lock()

    def add(self, dataset: str, layer: str, table: str, rows: int, status: str = "OK") -> None:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        with self._lock:
            self._rows.append((dataset, layer, table, int(rows), status, now))
            self._new = True

    def flush(self) -> int:
        """Append what was added, with all that this log appended before; the rows there are."""
        with self._lock:
            rows, new, self._new = list(self._rows), self._new, False
        if not new:
            return 0
        df = self.spark.createDataFrame(rows, _AUDIT_ROW)
        with _APPEND_LOCK:
            return self.store.append(df.coalesce(1), "gold", AUDIT_TABLE, self.run_id)


def audit(spark: SparkSession, store: Store, dataset: str, layer: str, table: str, rows: int,
          status: str = "OK") -> None:
    """Append one audit row now (``created_at`` = now, UTC)."""
    log = AuditLog(spark, store)
    log.add(dataset, layer, table, rows, status)
    log.flush()


def read_audit(spark: SparkSession, store: Store) -> DataFrame:
    return store.read(spark, "gold", AUDIT_TABLE)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str],
               mode: str = "overwrite", batchsize: int = 1000, truncate: bool = False) -> int:
    """Write to a database table (drop-and-recreate on overwrite unless
    ``truncate``); returns the observed row count.  W2."""
    props = {"batchsize": str(batchsize), "truncate": str(truncate).lower(), **properties}
    return write_observed(df, lambda d: d.write.mode(mode).jdbc(url, table, properties=props))
