"""Jaccard join of word-shingle sets by rare-first prefixes.

All shingles have one order, rare ones first.  Two sets that are similar enough share a shingle in
their prefixes, the first n - ceil(t n) + 1 shingles, so that sets meet only by the prefix shingles.
The order is by a count sketch of all shingles (a fixed number of counters, summed over all
documents) and by hash among equals: any one order gives the same links, and a rare one
fewer candidates.

Candidates are held against these bounds before they are verified: the lengths; the positions of
a shared prefix shingle, from which enough must be left in both; and the suffix filter, a lower
bound of the symmetric difference by counts of the shingles in 64 classes.  Verification intersects whole sets, once a pair.

Documents need components, not pairs.  So in a first round every document is verified with one
other: of all groups by a prefix shingle that it is in, the member of smallest position leads (it
has the fewest rare shingles of its own), and the leader that it meets most often is taken.  In
the second round groups whose members are all in one component are done; in the others, the
pairs across components, and only these, go through the filters.  No link between two components
is lost, and a group of near copies costs one link a member.

Texts are told apart by a 64-bit hash, and so are shingles.  Copies of a text are one set.

Defined cases: nulls, empty texts and texts of blanks have no shingles and link with nothing, their
component is their own id; fewer words than a shingle make one shingle; rows that share an id each
count; a component without ids has none; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import Scratch, table
from marquee.llm.rolling import scrambled, word_ngrams, word_values, words_between
from marquee.llm.simhash import components

SHINGLE, PERCENT = 4, 85
#: Counters of the sketch (4 bytes each when broadcast), and the slices in which they are summed.
SKETCH_BITS, SLICES = 20, 64
#: Classes of the suffix filter.
CLASSES = 64
#: Bits of the filter by which texts of candidates are read again; its 64-bit words are broadcast.
FILTER_BITS = 23
_GAP = np.isin(np.arange(256), [32, *range(9, 14)])


def shingle_sets(texts: list[str], size: int = SHINGLE) -> list[np.ndarray]:
    """The distinct shingles of each text, as ascending 64-bit fingerprints."""
    raws = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    raw = np.frombuffer(b"\n".join(raws), np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raws])
    starts, stops = words_between(_GAP[raw])
    values = word_values(raw, starts, stops)
    last = np.searchsorted(starts, ends)                  # one past each text's last word
    out, first = [], 0
    for z in last.tolist():
        if z == first:
            out.append(np.empty(0, np.uint64))
            continue
        n = max(1, z - first - size + 1)
        at = np.arange(n)
        prints = word_ngrams(values[first:z], at, np.minimum(at + size, z - first))
        out.append(np.unique(scrambled(prints)))
        first = z
    return out


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def in_parts(b: pd.DataFrame, seen: set[int], size: int) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Keys and sets of a batch's texts, about a megabyte at a time, without texts seen before."""
    keys, texts, room = [], [], 1 << 20
    for k, t in zip(b["cid"].tolist(), b["text"]):
        if k in seen:
            continue
        seen.add(k)
        keys.append(k)
        texts.append(t)
        room -= len(t)
        if room <= 0:
            yield keys, shingle_sets(texts, size)
            keys, texts, room = [], [], 1 << 20
    if keys:
        yield keys, shingle_sets(texts, size)


# -- stages ------------------------------------------------------------------------------

def _sketch(scratch: Scratch, texts: DataFrame, size: int) -> np.ndarray:
    """How often the shingles of each of 2^SKETCH_BITS counters occur, in sets of all texts."""
    width = (1 << SKETCH_BITS) // SLICES

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen = np.zeros(1 << SKETCH_BITS, np.int64), set()
        for b in batches:
            for _, sets in in_parts(b, seen, size):
                at = np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)
                total += np.bincount(at.astype(np.int64), minlength=1 << SKETCH_BITS)
        for k, part in enumerate(total.reshape(SLICES, -1)):
            if part.any():
                yield pd.DataFrame({"slice": [k], "counts": [part.astype("<u4").tobytes()]})

    def add(b: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, "<u4").astype(np.int64) for c in b["counts"])
        return pd.DataFrame({"slice": b["slice"][:1],
                             "counts": [np.minimum(total, 0xFFFFFFFF).astype("<u4").tobytes()]})

    parts = (texts.mapInPandas(count, "slice int, counts binary")
             .groupBy("slice").applyInPandas(add, "slice int, counts binary"))
    out = np.zeros(1 << SKETCH_BITS, np.uint32)
    for r in parts.collect():                     # at most SLICES rows, 4 MB together
        out[r["slice"] * width:(r["slice"] + 1) * width] = np.frombuffer(r["counts"], "<u4")
    return out


PREFIXES = "cid long, n int, classes array<int>, prefix array<long>"


def _prefixes(texts: DataFrame, sketch: np.ndarray, size: int, percent: int) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(sketch)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for b in batches:
            for keys, sets in in_parts(b, seen, size):
                rows = []
                for k, s in zip(keys, sets):
                    if len(s):
                        often = shared.value[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                        order = np.argsort(often, kind="stable")[:prefix_length(len(s), percent)]
                        classes = np.bincount((s & np.uint64(CLASSES - 1)).astype(np.int64), minlength=CLASSES)
                        rows.append((k, len(s), classes.astype(np.int32), s[order].view(np.int64)))
                yield pd.DataFrame(rows, columns=["cid", "n", "classes", "prefix"])
    return texts.mapInPandas(cut, PREFIXES)


def _long_enough(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _overlap(a: Column, b: Column, percent: int) -> Column:
    """Smallest intersection with which sets of these sizes are linked."""
    return F.ceil(percent * (a + b).cast("long") / F.lit(100 + percent))


def _near(na: Column, pa: Column, nb: Column, pb: Column, percent: int) -> Column:
    """Whether what stands from these positions on is enough.  Linked sets pass it at the first
    shingle that they share, whatever they do at later ones."""
    return F.least(na - pa, nb - pb) >= _overlap(na, nb, percent)


def _low(c: str) -> Column:
    return F.col(c).bitwiseAND(F.lit((1 << 40) - 1))


def _groups(scratch: Scratch, prefixes: DataFrame) -> DataFrame:
    """Members of the groups by a prefix shingle that hold two texts or more, each with the group's
    leader: h, cid, n, pos, lead, lead_n, lead_pos."""
    entries = prefixes.select("cid", "n", F.posexplode("prefix").alias("pos", "h"))
    rank = F.shiftleft(F.col("pos").cast("long"), 40).bitwiseOR(_low("cid")).alias("rank")
    leaders = (entries.select("*", rank).groupBy("h")
               .agg(F.min("cid").alias("lo"), F.max("cid").alias("hi"), F.min_by("cid", "rank").alias("lead"),
                    F.min_by("n", "rank").alias("lead_n"), F.min("pos").alias("lead_pos"))
               .filter("lo < hi").drop("lo", "hi"))
    return scratch.write(entries.join(scratch.write(leaders, "jaccard-leaders"), "h"), "jaccard-groups")


def _first_round(groups: DataFrame, percent: int) -> DataFrame:
    """For each text the leader that it meets most often: a, b, na, nb."""
    near = _near(F.col("n"), F.col("pos"), F.col("lead_n"), F.col("lead_pos"), percent)
    met = (groups.filter((F.col("cid") != F.col("lead")) & _long_enough(F.col("n"), F.col("lead_n"), percent) & near)
           .groupBy("cid", "lead").agg(F.count("*").alias("met"), F.min("n").alias("n"), F.min("lead_n").alias("lead_n")))
    rank = F.shiftleft("met", 40).bitwiseOR(_low("lead")).alias("rank")
    return (met.select("*", rank).groupBy("cid")
            .agg(F.max_by("lead", "rank").alias("b"), F.min("n").alias("na"), F.max_by("lead_n", "rank").alias("nb"))
            .withColumnRenamed("cid", "a"))


def _second_round(scratch: Scratch, groups: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """All pairs that share a prefix shingle, pass the filters by length and position and are in two
    components so far: a, b, na, nb."""
    named = (groups.select("h", "cid", "n", "pos")
             .join(labels.select(F.col("fp").alias("cid"), "label"), "cid", "left")
             .withColumn("label", F.coalesce("label", "cid")))
    named = scratch.write(named, "jaccard-labelled")
    mixed = named.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi")
    open_ = scratch.write(named.join(mixed.select("h"), "h"), "jaccard-open")
    a = open_.select("h", *[F.col(c).alias(f"{c}_a") for c in ("cid", "label", "n", "pos")])
    b = open_.select("h", *[F.col(c).alias(f"{c}_b") for c in ("cid", "label", "n", "pos")])
    pairs = a.join(b, "h").filter(
        (F.col("cid_a") < F.col("cid_b")) & (F.col("label_a") != F.col("label_b"))
        & _long_enough(F.col("n_a"), F.col("n_b"), percent)
        & _near(F.col("n_a"), F.col("pos_a"), F.col("n_b"), F.col("pos_b"), percent))
    return (pairs.select(F.col("cid_a").alias("a"), F.col("cid_b").alias("b"),
                         F.col("n_a").alias("na"), F.col("n_b").alias("nb")).distinct())


def _candidate_texts(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """Texts of the keys, and a few others: read by a bit for each key's low bits, so that the texts
    are not shuffled to meet them.  The bits are a table of 2^FILTER_BITS / 64 rows at most."""
    def spot(c: str) -> Column:
        return F.col(c).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))

    def bit(c: str) -> Column:
        return F.expr(f"shiftleft(1L, cast({c} & 63 as int))")
    words = keys.groupBy(F.shiftright(spot("cid"), 6).alias("word")).agg(F.bit_or(bit("cid")).alias("mask"))
    return (texts.join(F.broadcast(words), F.shiftright(spot("cid"), 6) == F.col("word"))
            .filter(F.col("mask").bitwiseAND(bit("cid")) != 0).select("cid", "text"))


def _verified(scratch: Scratch, texts: DataFrame, classes: DataFrame, pairs: DataFrame, size: int,
              percent: int) -> DataFrame:
    """Edges (fp, root) of the pairs that are linked."""
    both = (pairs.join(classes.toDF("a", "classes_a"), "a").join(classes.toDF("b", "classes_b"), "b"))
    apart = F.aggregate(F.zip_with("classes_a", "classes_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    left = scratch.write(both.filter((100 + percent) * apart <= (100 - percent) * (F.col("na") + F.col("nb")))
                         .select("a", "b"), "jaccard-candidates")
    keys = left.select(F.col("a").alias("cid")).union(left.select(F.col("b").alias("cid"))).distinct()

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for b in batches:
            for k, s in in_parts(b, seen, size):
                yield pd.DataFrame({"cid": k, "s": [x.view(np.int64) for x in s]})
    wanted = scratch.write(_candidate_texts(texts, keys).mapInPandas(sets, "cid long, s array<long>")
                           .dropDuplicates(["cid"]), "jaccard-sets")
    both = left.join(wanted.toDF("a", "sa"), "a").join(wanted.toDF("b", "sb"), "b")
    both = both.select("a", "b", (F.size("sa") + F.size("sb")).alias("total"),
                       F.size(F.array_intersect("sa", "sb")).alias("same"))
    return scratch.write(both.filter(100 * F.col("same") >= percent * (F.col("total") - F.col("same")))
                         .select(F.col("a").alias("fp"), F.col("b").alias("root")), "jaccard-links")


def jaccard_components(scratch: Scratch, df: DataFrame, id_: Column, text: Column, size: int = SHINGLE,
                       percent: int = PERCENT) -> DataFrame:
    """One row a document: id, n_shingles, component_id."""
    ids = scratch.write(df.select(id_.alias("id"), F.xxhash64(text).alias("cid")), "jaccard-ids")
    texts = df.select(F.xxhash64(text).alias("cid"), text.alias("text")).filter("text <> ''")
    sketch = _sketch(scratch, texts, size)
    prefixes = scratch.write(_prefixes(texts, sketch, size, percent), "jaccard-prefixes")
    nodes = scratch.write(prefixes.dropDuplicates(["cid"]).select("cid", "n", "classes"), "jaccard-nodes")
    classes = nodes.select("cid", "classes")
    groups = _groups(scratch, prefixes)
    links = _verified(scratch, texts, classes, _first_round(groups, percent), size, percent)
    labels = scratch.adopt(components(links))
    more = _verified(scratch, texts, classes, _second_round(scratch, groups, labels, percent), size, percent)
    if not more.isEmpty():
        labels = scratch.adopt(components(links.union(more)))
    known = (nodes.select("cid", "n").join(labels.withColumnRenamed("fp", "cid"), "cid", "left")
             .withColumn("label", F.coalesce("label", "cid")))
    of = scratch.write(ids.join(known, "cid", "left"), "jaccard-documents")
    least = of.filter("label is not null").groupBy("label").agg(F.min("id").alias("least"))
    return of.join(least, "label", "left").select(
        "id", F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"),
        F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"))


def op13_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """All documents, four-word shingles, similarity of 0.85 or more."""
    with Scratch(spark) as scratch:
        out = jaccard_components(scratch, table(spark, sf_dir, "documents"), F.col("doc_id"), F.col("text"))
        return scratch.keep(scratch.write(out.withColumnRenamed("id", "doc_id"), "jaccard"))
