"""Sharding by a two-pass external shuffle, in DataFrame functions only.

Pass 1 scatters rows over memory-sized buckets by seeded hashes (one exchange of the
rows); pass 2 shuffles every bucket with Spark's ``shuffle`` (a Fisher-Yates shuffle of an
array) and writes it.  A row's shard is the rendezvous winner of its key: the shard
whose seeded hash with the key is largest.  One more shard therefore takes rows only
into itself.

Each shard has buckets by its own bytes, so that a shard with a hot key (or very long texts)
has more of them, not larger ones.

Defined cases: a null text counts no bytes and has crc32 0; a null key is a key like any
other; repeated rows each keep a slot; an empty table gives an empty result; columns
of the input may have any names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import Scratch, has_maps, orderable, packed

#: Text bytes one bucket holds on average; a bucket is shuffled in one task's memory.
BUCKET_BYTES = 8 << 20
#: Bucket counts are joined by broadcast up to here (a row is 24 bytes), else by shuffle.
BROADCAST_BUCKETS = 100_000
ROW_BYTES = 16


def rendezvous(key: Column, n_shards: int, seed: int) -> Column:
    """The shard in [0, n_shards) whose seeded hash with ``key`` is largest."""
    scored = F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)),
                         lambda s: F.struct(F.xxhash64(F.lit(seed), key, s).alias("h"),
                                            s.alias("s")))
    return F.array_max(scored)["s"]


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus a fixed cost of a row."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def shard_documents(df: DataFrame, n_shards: int, key: str = "doc_id", text: str = "text",
                    seed: int = 17, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Columns ``row`` (the whole input row as a struct), ``shard``, ``bucket`` and
    ``slot`` (0, 1, ... in each shard, in shuffled order), read from the written shards.

    ``spark_partition_id`` salts the bucket, so that many repeats of one row do not meet
    in one bucket; it is fixed for a task, retried or not, and the shard does not
    depend on it.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    with Scratch(df.sparkSession) as scratch:
        return _sharded(scratch, df, n_shards, F.col(f"`{key}`"), F.col(f"`{text}`"), seed,
                        bucket_bytes)


def _sharded(scratch: Scratch, df: DataFrame, n_shards: int, k: Column, t: Column, seed: int,
             bucket_bytes: int) -> DataFrame:
    spark = df.sparkSession
    shard = rendezvous(k, n_shards, seed)
    plan = scratch.write(
        df.groupBy(shard.alias("shard")).agg(F.sum(text_bytes(t)).alias("bytes"))
        .withColumn("buckets", F.ceil(F.col("bytes") / bucket_bytes)), "shard-sizes")
    total, n_buckets = plan.agg(F.coalesce(F.sum("bytes"), F.lit(0)),
                                F.coalesce(F.sum("buckets"), F.lit(0))).first()
    small = F.broadcast if n_buckets <= BROADCAST_BUCKETS else (lambda x: x)
    scatter = F.xxhash64(F.lit(seed + 2), k, t, F.spark_partition_id())
    maps = has_maps(df)
    place = {"place": orderable(df)} if maps else {}
    rows = (packed(df, shard=shard, h=F.xxhash64(F.lit(seed + 1), k, t), scatter=scatter, **place)
            .join(small(plan.select("shard", "buckets")), "shard")
            .select("row", "shard", "h", *place,
                    F.pmod("scatter", F.col("buckets")).cast("int").alias("bucket")))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                math.ceil(total / (4 * bucket_bytes)))
    dealt = F.collect_list(F.struct("h", *place, "row"))
    buckets = (rows.repartition(parts, "shard", "bucket")
               .groupBy("shard", "bucket")
               .agg((F.array_sort(dealt, _by_place) if maps else F.sort_array(dealt)).alias("rows"))
               .sortWithinPartitions("shard", "bucket"))
    shuffled = scratch.keep(scratch.write(
        buckets.select("shard", "bucket", F.posexplode(F.shuffle("rows", seed)).alias("pos", "r"))
               .select("shard", "bucket", "pos", F.col("r.row").alias("row")), "shards"))
    sizes = shuffled.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = scratch.keep(scratch.write(
        sizes.select("shard", "bucket", F.sum("n").over(_earlier()).alias("before")),
        "bucket-offsets"))
    return (shuffled.join(small(before), ["shard", "bucket"])
            .select("row", "shard", "bucket",
                    (F.coalesce("before", F.lit(0)) + F.col("pos")).cast("long").alias("slot")))


def _by_place(a: Column, b: Column) -> Column:
    x, y = (F.struct(r["h"], r["place"]) for r in (a, b))
    return F.when(x < y, -1).when(x > y, 1).otherwise(0)


def _earlier():
    from pyspark.sql import Window
    return Window.partitionBy("shard").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)


def op3_sharding(spark, sf_dir: str, n_shards: int = 40, seed: int = 17) -> DataFrame:
    """All documents over 40 shards by the ``key`` law (doc_id and shard count decide)."""
    from marquee.llm.common import table
    docs = table(spark, sf_dir, "documents")
    out = shard_documents(docs, n_shards, seed=seed)
    key, text = F.col("row.doc_id"), F.col("row.text")
    return out.select(
        key.alias("doc_id"), text_bytes(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        rendezvous(key, n_shards + 1, seed).cast("int").alias("grown_shard"))
