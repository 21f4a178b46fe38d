"""Feed readers: raw files or JDBC tables -> bronze DataFrames (all strings).

Every reader takes an explicit schema, so nothing is inferred per run and
raw tokens survive as text: a JSON number ``95`` is read into a string
column as ``"95"``, an empty XML element as ``""``, padded CSV values keep
their spaces.

Broken input fails: malformed JSON or XML, CSV rows of another width than the header and
missing Parquet columns raise, and no reader returns fewer rows than the feed holds.

Scale notes: every feed is read by many tasks.  JSON lines, XML (split on the row tag) and Parquet
split as they are; JSON documents spread over lines and large CSV files, whose values may hold line
breaks, are cut at record ends (``sources.splitting``).  Which layout a JSON feed has is found from
the heads of its files.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructField, StructType

from marquee.functions.numbers import nan_to_null
from marquee.sources.schemas import BRONZE
from marquee.sources.splitting import NotSplittable, csv_records, json_records


def nan_to_null_columns(df: DataFrame) -> DataFrame:
    """NaN -> null in every float/double column (pandas-style missing values)."""
    return df.select(*[nan_to_null(F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema])


def as_bronze(df: DataFrame, dataset: str) -> DataFrame:
    """Cast to the dataset's all-string bronze schema.  Whole floating-point numbers
    (integer columns that once held nulls) become integer text; a missing column
    raises."""
    wanted = [f.name for f in BRONZE[dataset]]
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"{dataset} feed lacks the columns {', '.join(missing)}")

    def text(name: str) -> Column:
        c = F.col(name)
        if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
            whole = (c == F.floor(c)) & (F.abs(c) < 1e18)
            return F.when(whole, c.try_cast("bigint").cast("string")).otherwise(c.cast("string"))
        return c.cast("string")
    return df.select(*[text(c).alias(c) for c in wanted])


#: Bytes of a file's head by which its layout is found.
PROBE = 1 << 16


def _files(spark: SparkSession, path: str) -> list:
    """Data files under ``path``, as Hadoop file statuses."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    out, todo = [], list(fs.globStatus(p) or [])
    while todo:
        f = todo.pop()
        if f.isDirectory():
            todo += [c for c in fs.listStatus(f.getPath()) if c.getPath().getName()[0] not in "._"]
        else:
            out.append(f)
    return out


def _head(spark: SparkSession, file) -> tuple[str, bool]:
    """The first bytes of a file (decompressed), and whether there may be more."""
    jvm, path, conf = spark._jvm, file.getPath(), spark._jsc.hadoopConfiguration()
    raw = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        plain = raw if codec is None else codec.createInputStream(raw)
        got = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(
            jvm.org.apache.commons.io.input.BoundedInputStream(plain, PROBE)))
    finally:
        raw.close()
    return got.decode("utf-8", "replace").lstrip("\ufeff"), len(got) >= PROBE


def spread_over_lines(spark: SparkSession, path: str, multiline: bool | None = None) -> bool:
    """Whether the JSON documents under ``path`` are spread over lines (else every line
    holds a whole one), from the heads of the files.  Raises for files of both layouts, and for
    JSON lines when ``multiline=True`` is asked for; ``multiline=False`` is taken as given.

    A file of another layout than its head shows fails the read: a line that is no document, or a
    second document after one that is spread over lines."""
    if multiline is False:
        return False
    with ThreadPoolExecutor(16) as pool:
        heads = list(pool.map(lambda f: _head(spark, f), _files(spark, path)))
    spread = by_line = False
    for text, more in heads:
        first, _, rest = text.lstrip().partition("\n")
        first = first.strip()
        if not first:
            continue
        if more and not rest or (first[0], first[-1]) in (("{", "}"), ("[", "]")):
            by_line |= more or bool(rest.strip())
        else:
            spread = True
    if by_line and (spread or multiline):
        raise ValueError(f"{path}: JSON lines where documents spread over lines are expected")
    return spread


def _read_json(spark: SparkSession, path: str, schema: StructType, multiline: bool | None,
               field: str | None = None) -> DataFrame:
    """Records of JSON files, or the elements of their ``field``; those of documents spread over
    lines by many tasks, if the files have the usual form, else by one task a file."""
    spread = spread_over_lines(spark, path, multiline)
    if spread:
        try:
            return json_records(spark, path, schema, field)
        except NotSplittable:
            pass
    docs = spark.read.option("mode", "FAILFAST").option("multiLine", spread)
    if field is None:
        return docs.schema(schema).json(path)
    docs = docs.schema(StructType([StructField(field, ArrayType(schema))])).json(path)
    elements = F.when(F.col(field).isNotNull(), F.col(field)).otherwise(
        F.raise_error(F.lit(f"a document has no {field}")).cast(docs.schema[field].dataType))
    return docs.select(F.inline(elements))


def read_movies_json(spark: SparkSession, path: str, multiline: bool | None = None) -> DataFrame:
    """Movie catalogue: a JSON array of objects, on one or many lines, or JSON lines."""
    return _read_json(spark, path, BRONZE["movies"], multiline)


def read_scores_csv(spark: SparkSession, path: str, multiline: bool | None = None) -> DataFrame:
    """External scores: CSV with a header row; header names must match the schema.
    Quotes inside values are doubled.  Rows with more or fewer values than the header raise.

    ``multiline=False``: no value holds a line break, every line is a record.  ``True``: a file is
    read by one task.  By default files larger than a scan's split are cut at record ends, for
    many tasks; all three give the same rows."""
    limit = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    if multiline is None and any(f.getLen() > limit for f in _files(spark, path)):
        return csv_records(spark, path, BRONZE["scores"])
    return (spark.read.schema(BRONZE["scores"]).option("header", True).option("escape", '"')
                 .option("mode", "FAILFAST").option("multiLine", multiline is not False)
                 .option("enforceSchema", False).csv(path))


def read_watchlist_json(spark: SparkSession, path: str, wrapped: bool = True,
                        multiline: bool | None = None) -> DataFrame:
    """Watchlist events: ``{"events": [...]}`` documents flattened to one row per
    event (``wrapped=False`` for plain event records).  A document without events
    raises."""
    return _read_json(spark, path, BRONZE["watchlist"], multiline, "events" if wrapped else None)


def read_awards_xml(spark: SparkSession, path: str, row_tag: str = "award") -> DataFrame:
    """Awards: one row per ``<award>`` element; child text kept with its spaces."""
    return (spark.read.format("xml").option("rowTag", row_tag)
                 .option("ignoreSurroundingSpaces", False).option("mode", "FAILFAST")
                 .schema(BRONZE["awards"]).load(path))


def read_parquet_feed(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Operational Parquet export -> bronze strings (NaN -> null first)."""
    return as_bronze(nan_to_null_columns(spark.read.parquet(path)), dataset)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str],
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetchsize: int = 10_000) -> DataFrame:
    """A database table.  With ``partition_column`` (an integer id) and bounds the
    read is split into ``num_partitions`` range queries; without, it is a single
    partition.  Filters and column pruning are pushed into the SQL Spark sends."""
    props = {"fetchsize": str(fetchsize), **properties}
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC read needs lower_bound, upper_bound, num_partitions")
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions,
                               properties=props)
    return spark.read.jdbc(url, table, properties=props)


# dataset -> (landing file name, reader(spark, path, multiline) -> bronze DataFrame)
FEEDS = {
    "movies": ("movies.json", lambda s, p, ml: read_movies_json(s, p, multiline=ml)),
    "scores": ("external_scores.csv", lambda s, p, ml: read_scores_csv(s, p, multiline=ml)),
    "watchlist": ("watchlist_events.json",
                  lambda s, p, ml: read_watchlist_json(s, p, wrapped=True, multiline=ml)),
    "awards": ("awards.xml", lambda s, p, ml: read_awards_xml(s, p)),
    "users": ("users.parquet", lambda s, p, ml: read_parquet_feed(s, p, "users")),
    "ratings": ("ratings.parquet", lambda s, p, ml: read_parquet_feed(s, p, "ratings")),
    "reviews": ("reviews.parquet", lambda s, p, ml: read_parquet_feed(s, p, "reviews")),
}
#: Formats whose readers give nulls for a field that a feed does not have.
FREE_FORMS = ("movies", "watchlist", "awards")


def read_feed(spark: SparkSession, landing: str, dataset: str, json_multiline: bool | None = None,
              csv_multiline: bool | None = None) -> DataFrame:
    """Bronze rows of one landing feed.  The layout of JSON and CSV feeds is found from the
    files, unless ``json_multiline`` or ``csv_multiline`` states it."""
    name, reader = FEEDS[dataset]
    return reader(spark, f"{landing.rstrip('/')}/{name}",
                  csv_multiline if dataset == "scores" else json_multiline)


def absent_fields(spark: SparkSession, landing: str, dataset: str, empty: list[str]) -> list[str]:
    """Of the columns that held no value in any row, those that the feed never names."""
    if not empty or dataset not in FREE_FORMS:
        return []
    text = spark.read.text(f"{landing.rstrip('/')}/{FEEDS[dataset][0]}")
    named = {c: F.col("value").contains(f"<{c}") if dataset == "awards"
             else F.col("value").rlike(f'"{c}"\\s*:') for c in empty}
    r = text.agg(*[F.max(has).alias(c) for c, has in named.items()]).first()
    return [c for c in empty if not r[c]]
