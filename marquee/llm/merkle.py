"""Merkle manifest of a dataset: a content-addressed DAG, and proofs by descent through it.

A leaf is the digest of a row's fields.  The leaves of a tree (here: of a source), in the order
of their keys, are cut into runs of ``FANOUT``, and a run's digest is that of its nodes' digests;
so on upwards until one node is left, the subroot.  The subroots, in the order of their
trees, make the root in the same way.  Every run is stored as a record, digest to children,
and equal runs share one.

A proof is found without any index of positions: leaf requests descend from the root.  A level's
requests stand at the node that they go through, once a node however many they are; the node's
digest fetches its record, the next digit of their rank (base ``FANOUT``) selects the child they
go on to, and the children that are not selected are collected as the level's path segment.  The
segments of the whole descent, reversed, are the proof from the leaf up.

Places are found by a range shuffle on (tree, key), numbering within each partition and adding
up what partitions before it hold, so that a tree with a third of all rows is spread like any
other.  Requests meet the nodes of the level above the leaves, of which there are a sixteenth,
and the paths are copied to the leaves where they are folded, never shuffled for each leaf.

Defined cases: nulls are fields like any other; a null tree or key comes first; rows of one
key are ordered by their digests, and repeated rows each have their leaf; a tree of one leaf is
its own subroot, and a single subroot the root; an empty table has no root and no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.llm.common import Scratch, crc_mod, lower_ascii, table

FANOUT = 16
#: Nodes of a level up to which their requests are broadcast to its records (a few kB each).
FEW_NODES = 1024
#: Tree number of the nodes above the subroots.
TOP = -1


def field(c: Column) -> Column:
    """A value as bytes that no other value has: its UTF-8 length, a colon, the value; ``-`` for null."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def row_digest(*fields: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def levels_above(n: Column) -> Column:
    """How many times ``n`` nodes are cut into runs until one is left."""
    return sum((F.when(n > F.lit(FANOUT ** k), 1).otherwise(0) for k in range(15)), F.lit(0))


@dataclass
class Manifest:
    """``leaves``: tree (its number), pos, key, leaf, row.  ``trees``: tree, group, n, depth, subroot.
    ``records``/``top``: by level from 1 up, digest and children of each run, distinct;
    ``sizes``/``top_sizes``: an upper bound on the nodes of each.  ``root``: hex, None if empty."""

    leaves: DataFrame
    trees: DataFrame
    records: list[DataFrame]
    top: list[DataFrame]
    sizes: list[int]
    top_sizes: list[int]
    root: str | None


def _placed(scratch: Scratch, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leaves, trees): rows with the number of their tree, its depth and their place in it."""
    order = ["group", "key", "leaf", "salt"]
    at = scratch.write(rows.withColumn("salt", F.monotonically_increasing_id())
                       .repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
                       .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
                       .drop("salt").withColumn("at", F.monotonically_increasing_id()),
                       "manifest-order")
    part = F.shiftright("at", 33)            # the partition's number; below it, the row's
    runs = scratch.write(at.groupBy("group", part.alias("part"))
                         .agg(F.min("at").alias("first"), F.count("*").alias("n")), "manifest-runs")
    runs = runs.withColumn("before", F.sum("n").over(
        W.partitionBy("group").orderBy("part").rowsBetween(W.unboundedPreceding, -1)))
    trees = runs.groupBy("group").agg(F.min("first").alias("start"), F.sum("n").alias("n"))
    begun = trees.groupBy(F.shiftright("start", 33).alias("part")).agg(F.count("*").alias("trees"))
    begun = begun.select(F.col("part").alias("in_part"), F.coalesce(F.sum("trees").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    own = F.row_number().over(W.partitionBy("in_part").orderBy("start")) - 1
    trees = scratch.write(
        trees.withColumn("in_part", F.shiftright("start", 33)).join(begun, "in_part")
        .select("group", "n", (F.col("earlier") + own).alias("tree"),
                levels_above(F.col("n")).alias("depth")), "manifest-trees")
    spots = (runs.join(trees.withColumnRenamed("group", "g"), F.col("group").eqNullSafe(F.col("g")))
             .select("part", "g", "tree", "depth", "first", F.coalesce("before", F.lit(0)).alias("before")))
    leaves = scratch.write(
        at.join(spots, (part == F.col("part")) & F.col("group").eqNullSafe(F.col("g")))
        .select("tree", "depth", (F.col("at") - F.col("first") + F.col("before")).alias("pos"),
                "key", "leaf", "row"), "manifest-leaves")
    return leaves, trees


def _lifted(nodes: DataFrame) -> DataFrame:
    """The runs of a level's nodes: tree, depth, pos, digest, children (at most FANOUT)."""
    runs = (nodes.groupBy("tree", "depth", F.expr(f"pos div {FANOUT}").alias("run"))
            .agg(F.sort_array(F.collect_list(F.struct("pos", "digest"))).alias("nodes")))
    return runs.select("tree", "depth", F.col("run").alias("pos"),
                       F.sha2(F.array_join("nodes.digest", ""), 256).alias("digest"),
                       F.col("nodes.digest").alias("children"))


def _records(runs: DataFrame) -> DataFrame:
    return runs.select("digest", "children").dropDuplicates(["digest"])


def build(scratch: Scratch, rows: DataFrame) -> Manifest:
    """The manifest of ``rows``: group (of which tree), key (place in it), leaf, row (anything
    that is to come back with the leaf)."""
    leaves, trees = _placed(scratch, rows)
    depth, count = trees.agg(F.max("depth"), F.count("*")).first()
    per_level = [F.sum(F.expr(f"(n + {FANOUT ** k - 1}) div {FANOUT ** k}")) for k in range(depth or 0)]
    sizes = list(trees.agg(*per_level).first()) if per_level else []
    nodes = leaves.select("tree", "depth", "pos", F.col("leaf").alias("digest"))
    subroots = nodes.filter("depth = 0")
    records = []
    for level in range(1, (depth or 0) + 1):
        nodes = scratch.write(_lifted(nodes.filter(f"depth >= {level}")), f"manifest-level{level}")
        records.append(_records(nodes))
        subroots = subroots.unionByName(nodes.filter(f"depth = {level}").drop("children"))
    trees = scratch.write(trees.join(subroots.select("tree", F.col("digest").alias("subroot")), "tree"),
                          "manifest-subroots")
    nodes = trees.select(F.lit(TOP).alias("tree"), F.lit(0).alias("depth"),
                         F.col("tree").alias("pos"), F.col("subroot").alias("digest"))
    top, top_sizes, n = [], [], count
    while n > 1:
        top_sizes.append(n)
        nodes = scratch.write(_lifted(nodes), f"manifest-top{len(top) + 1}")
        top.append(_records(nodes))
        n = -(-n // FANOUT)
    first = nodes.select("digest").first()
    return Manifest(leaves, trees, records, top, [*sizes[1:], count], [*top_sizes[1:], 1],
                    first[0] if first else None)


def _wanted(below: DataFrame) -> DataFrame:
    """Digits that requests select at each node, from the nodes that they go to one level below."""
    return (below.groupBy("tree", F.expr(f"pos div {FANOUT}").alias("up"))
            .agg(F.collect_set((F.col("pos") % FANOUT).cast("int")).alias("digits"))
            .withColumnRenamed("up", "pos"))


#: The children of a record that stand before and after the selected one, joined.
def _segment(digit: Column) -> Column:
    kids = F.col("children")
    return F.struct(F.array_join(F.slice(kids, 1, digit), "").alias("before"),
                    F.array_join(F.slice(kids, digit + 2, F.lit(FANOUT)), "").alias("after"))


def _descend(at: DataFrame, records: DataFrame, wanted: DataFrame, nodes: int) -> DataFrame:
    """One level down: requests at a node (tree, pos, digest, path, carried columns) go to the
    children that they select."""
    at = F.broadcast(at) if nodes <= FEW_NODES else at
    rest = [c for c in at.columns if c not in ("tree", "pos", "digest", "path")]
    on = at.join(records, "digest").join(wanted, ["tree", "pos"])
    step = on.select("tree", "pos", "path", "children", *rest, F.explode("digits").alias("digit"))
    return step.select("tree", (F.col("pos") * FANOUT + F.col("digit")).alias("pos"),
                       F.col("children")[F.col("digit")].alias("digest"),
                       F.concat("path", F.array(_segment(F.col("digit")))).alias("path"), *rest)


def prove(m: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """One row a requested leaf: key, leaf, row, subroot, root and ``proof``, the segments from
    the leaf's run up to the root: digests before and after the node that is proved.

    ``requests``: rows of ``m.leaves`` (all of them if not given)."""
    ask = m.leaves if requests is None else requests
    # the requests of a run travel as one row, of FANOUT leaves at most
    runs = (ask.groupBy("tree", "depth", F.expr(f"pos div {FANOUT}").alias("run"))
            .agg(F.collect_list(F.struct((F.col("pos") % FANOUT).cast("int").alias("digit"),
                                         "key", "leaf", "row")).alias("asked")))
    runs = runs.withColumnRenamed("run", "pos")
    here, below = [], runs.filter("depth > 0").select("tree", "depth", "pos")
    for level in range(2, len(m.records) + 1):
        above = _wanted(below.filter(f"depth >= {level}"))
        here.append(above)
        below = above.select("tree", "pos").join(m.trees.select("tree", "depth"), "tree")
    goals = runs.select("tree").distinct().select(F.lit(TOP).alias("tree"), F.col("tree").alias("pos"))
    up = []
    for _ in m.top:
        up.append(_wanted(goals))
        goals = up[-1].select("tree", "pos")
    spark = m.leaves.sparkSession
    at = spark.range(1 if m.root is not None else 0).select(
        F.lit(TOP).alias("tree"), F.lit(0).cast("long").alias("pos"), F.lit(m.root).alias("digest"),
        F.array().cast("array<struct<before:string,after:string>>").alias("path"))
    for k in reversed(range(len(m.top))):
        at = _descend(at, m.top[k], up[k], m.top_sizes[k])
    subroots = (at.select(F.col("pos").alias("tree"), "digest", "path")
                .join(m.trees.select("tree", "depth"), "tree")
                .select("tree", F.lit(0).cast("long").alias("pos"), "digest", "path", "depth",
                        F.col("digest").alias("subroot")))
    at = None
    for level in range(len(m.records), 0, -1):
        begin = subroots.filter(f"depth = {level}").drop("depth")
        at = begin if at is None else at.unionByName(begin)
        if level > 1:
            at = _descend(at, m.records[level - 1], here[level - 2], m.sizes[level - 1])
    out = []
    asked = F.explode("asked").alias("r")
    none = F.array().cast("array<struct<before:string,after:string>>")
    alone = subroots.filter("depth = 0").join(runs.select("tree", "asked"), "tree")
    out.append(alone.select("subroot", F.col("path").alias("upper"), none.alias("own"), asked))
    if at is not None:
        last = at.join(m.records[0], "digest").join(runs.filter("depth > 0").drop("depth"), ["tree", "pos"])
        last = last.select("subroot", F.col("path").alias("upper"), "children", asked)
        out.append(last.select("subroot", "upper", F.array(_segment(F.col("r.digit"))).alias("own"), "r"))
    both = out[0] if len(out) == 1 else out[0].unionByName(out[1])
    return both.select("r.key", "r.leaf", "r.row", "subroot", F.lit(m.root).alias("root"),
                       F.concat("own", F.reverse("upper")).alias("proof"))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, level by level upwards, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def op11_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """All documents, a tree for each source; every leaf proved, also after tampering with texts."""
    rest = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text")
    tampered = F.when(crc_mod("doc_id", 5) == 0, row_digest(*rest, lower_ascii(text)))
    docs = table(spark, sf_dir, "documents")
    with Scratch(spark) as scratch:
        rows = scratch.write(docs.select(
            F.col("source").alias("group"), F.col("doc_id").alias("key"),
            row_digest(*rest, text).alias("leaf"), F.struct(tampered.alias("tampered")).alias("row")),
            "manifest-rows")
        got = prove(build(scratch, rows))
        now = F.coalesce("row.tampered", "leaf")
        out = got.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root",
                         proof_digest(F.col("proof")).alias("proof_sha256"),
                         folded(now, F.col("proof")).alias("folded_root"))
        return scratch.keep(scratch.write(
            out.withColumn("verified", F.col("folded_root") == F.col("root")), "manifest-proved"))
