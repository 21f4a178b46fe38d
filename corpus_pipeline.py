"""The corpus pipeline: toxicity, near-duplicates, decontamination, mixture, shards.

Each stage reads all that its predecessor kept, and its result is written and read again
before the next; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import Scratch, packed, table
from marquee.llm.decontaminate import decontaminate
from marquee.llm.mixing import production_mix
from marquee.llm.sharding import shard_documents
from marquee.llm.simhash import keep_one
from marquee.llm.toxicity import THRESHOLD, held_out, toxicity_score
from marquee.llm.toxicity import train as train_toxicity

N_SHARDS, SHARD_SEED = 40, 17


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    labels = table(spark, sf_dir, "labels")
    model = train_toxicity(docs, labels, F.col("toxic"), ~held_out())
    scored = packed(docs, score=toxicity_score(docs, F.col("text"), model))
    return scored.filter(F.col("score") < THRESHOLD).select("row.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of the smallest id."""
    return keep_one(docs, "doc_id", "text")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages; documents that are mostly benchmark go."""
    out = decontaminate(docs, "text", table(spark, sf_dir, "benchmark"), F.col("item_id"),
                        F.col("text")).filter(~F.coalesce("reject", F.lit(False)))
    fresh = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.when(F.col("clean").eqNullSafe(F.col("row.text")),
                                  F.col("row.n_chars")).otherwise(
            F.length("clean").cast(docs.schema["n_chars"].dataType))
    return out.select(*[fresh.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The production mixture of what is left; a second epoch repeats its documents."""
    return production_mix(docs).select("row.*")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in shuffled shards: the columns of documents, ``shard`` and ``slot``.  A column
    that documents have under such a name keeps it; the new one gets underscores before its own."""
    out = shard_documents(docs, N_SHARDS, seed=SHARD_SEED)
    return out.select(*[F.col(f"row.`{c}`") for c in docs.columns],
                      F.col("shard").cast("int").alias(_free("shard", docs)),
                      F.col("slot").alias(_free("slot", docs)))


def _free(name: str, docs: DataFrame) -> str:
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity), ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]

#: Trained models, components and seeded hashes: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with Scratch(spark) as scratch:
            scratch.adopt(docs)
            docs = scratch.keep(scratch.write(stage(spark, docs, sf_dir), f"stage-{name}"))
    return docs
