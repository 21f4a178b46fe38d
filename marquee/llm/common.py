"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
import re
from contextvars import ContextVar
from functools import wraps

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.session import scratch_path

#: Rows per Arrow batch for Python stages; long texts make larger batches heavy.
ARROW_ROWS = 250


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows of an Arrow batch; a ``Scratch`` around it gives the session's number back."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the cluster's shared folder and read it back.  Within a
    ``Scratch`` the table is one of its tables."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path                      # for ``forget``
    scope = Scratch.current.get()
    return scope.adopt(out) if scope else out


def forget(*frames: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for df in frames:
        path = getattr(df, "scratch", None)
        if path:
            jvm = df.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def packed(df: DataFrame, **internal: Column) -> DataFrame:
    """``df`` with all its columns in one struct ``row``, beside internal columns: no
    column of the caller can clash with a name used here."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     *[c.alias(k) for k, c in internal.items()])


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    return isinstance(t, T.MapType) or isinstance(t, T.ArrayType) and _has_map(t.elementType)


def has_maps(df: DataFrame) -> bool:
    return _has_map(df.schema)


def orderable(df: DataFrame) -> Column:
    """The row as a struct that Spark can sort: columns that hold maps are their JSON."""
    return F.struct(*[F.to_json(F.struct(F.col(f"`{f.name}`"))) if _has_map(f.dataType)
                      else F.col(f"`{f.name}`") for f in df.schema])


def crc_mod(col: str, n: int) -> Column:
    """crc32 of the decimal text of an id, modulo ``n`` (null for a null id)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, everything else untouched."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: The same in Python, for use on str.
ASCII_LOWER = {ord("A") + i: ord("a") + i for i in range(26)}
LETTERS = re.compile(r"[^\W\d_]+")


def row_sums(x: np.ndarray) -> np.ndarray:
    """Each row's sum, correctly rounded: the same for equal rows wherever they stand in a batch
    (a matrix product rounds by the row's place)."""
    return np.array([math.fsum(row) for row in x.tolist()], dtype=float)


class Scratch:
    """Scope of a job: tables written in it are deleted at its end, but for those that are
    kept, and the session's Arrow batch size is the job's only while it runs.

    Whatever Python stage a job has must therefore run inside its scope: results leave it as
    kept tables, or as plans over them without Python.  What a scope inside another one keeps
    lives until the outer one ends."""

    current: ContextVar[Scratch | None] = ContextVar("scratch", default=None)

    def __init__(self, spark: SparkSession, rows: int = ARROW_ROWS):
        self.spark, self.rows, self.tables = spark, rows, []

    def __enter__(self) -> Scratch:
        self.before = self.spark.conf.get(_BATCH)
        self.batch(self.rows)
        self.around = Scratch.current.get()
        self.token = Scratch.current.set(self)
        return self

    def batch(self, rows: int) -> None:
        """Rows of an Arrow batch from here on."""
        self.spark.conf.set(_BATCH, str(rows))

    def write(self, df: DataFrame, name: str) -> DataFrame:
        return self.adopt(written(df, name))

    def adopt(self, table: DataFrame) -> DataFrame:
        """Delete a table that was written elsewhere, too."""
        if not any(t is table for t in self.tables):
            self.tables.append(table)
        return table

    def keep(self, df: DataFrame) -> DataFrame:
        self.tables = [t for t in self.tables if t is not df]
        if self.around is not None:
            self.around.adopt(df)
        return df

    def __exit__(self, *failure) -> None:
        Scratch.current.reset(self.token)
        self.spark.conf.set(_BATCH, self.before)
        forget(*self.tables)


def tidy(query):
    """A query ``(spark, sf_dir)`` that runs in a ``Scratch`` of its own: of all it wrote only its
    result stays, and the session's settings are what they were."""
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with Scratch(spark) as scratch:
            return scratch.keep(scratch.write(query(spark, sf_dir), query.__name__))
    return run


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
