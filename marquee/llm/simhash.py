"""SimHash near-duplicates through vantage-point trees.

Fingerprints: a text's words (lower-cased A-Z, divided by blanks) give word shingles, each
hashed by XXH64; a fingerprint bit is 1 if it is set in over half of the hashes.

Search: a vantage-point tree over a bounded sample of the distinct fingerprints cuts the
64-bit space into shards: at each node a fingerprint goes to the inner side if its
Hamming distance d to the vantage point is at most the node's radius, else to the outer
one.  By the triangle inequality all partners within k bits lie on the inner side if
d + k <= radius, on the outer one if d - k > radius, and else on both: a fingerprint has one home
shard and visits every shard that its ball overlaps.  Inside a shard the same search
goes on down a local tree, so all pairs within k bits are found, exactly.  A shard
returns a spanning forest of its links, not the pairs; components are joined over shards by
smallest-label propagation with pointer jumping over written tables.

Defined cases: a text without words (null, empty) has fingerprint zero, which links like
any other; fewer words than a shingle make one shingle; repeated rows share a
fingerprint and so a component; the component id is the smallest non-null id in it (null
if all ids are null); an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import Scratch, forget, orderable, packed, table, written

SHINGLE, MAX_BITS, HASH_SEED = 3, 2, 42
#: Home fingerprints of a shard, on average; and of a leaf of its local tree.
SHARD, LEAF = 2048, 192
#: Sampled fingerprints for each shard of the tree, and the most there may be (8 bytes each).
SAMPLE_PER_SHARD, MAX_SAMPLE = 16, 1 << 18
#: Shingle hashes counted at once.
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = HASH_SEED) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    n = max(1, len(words) - shingle + 1)
    starts = [0, *ends[:n - 1]]
    stops = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        h = np.array([digest(flat[a:b - 1], seed)
                      for a, b in zip(starts[at:at + CHUNK], stops[at:at + CHUNK])], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint_udf(shingle: int, seed: int):
    @F.pandas_udf(T.LongType())
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle, seed) for t in texts],
                                  dtype=np.uint64).view(np.int64))
    return simhash


# -- the tree: nested tuples (vantage, radius, inner, outer), leaves are shard numbers -----

def grow(points: np.ndarray, depth: int, rng: np.random.Generator, shards: list[int]):
    """Split ``points`` by the median distance to the vantage point that, of a few tried,
    spreads the distances most (fewest points near its boundary)."""
    if depth == 0 or len(points) < 4:
        shards.append(len(shards))
        return shards[-1]
    best = None
    for v in rng.choice(points, size=min(8, len(points)), replace=False):
        d = np.bitwise_count(points ^ v)
        radius = int(np.median(d))
        inner = d <= radius
        near = np.count_nonzero(np.abs(d.astype(int) - radius) <= 2) / len(points)
        uneven = abs(inner.mean() - 0.5)
        if not inner.all() and (best is None or near + uneven < best[0]):
            best = (near + uneven, v, radius, inner)
    if best is None:                                  # all alike: nothing to split
        shards.append(len(shards))
        return shards[-1]
    _, v, radius, inner = best
    return (v, radius, grow(points[inner], depth - 1, rng, shards),
            grow(points[~inner], depth - 1, rng, shards))


def visits(tree, points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shards that each point's ball overlaps: index of the point, shard, is it home."""
    out: list[tuple[np.ndarray, int, np.ndarray]] = []
    todo = [(tree, np.arange(len(points)), np.ones(len(points), bool))]
    while todo:
        node, idx, home = todo.pop()
        if not len(idx):
            continue
        if isinstance(node, int):
            out.append((idx, node, home))
            continue
        v, radius, inner, outer = node
        d = np.bitwise_count(points[idx] ^ v).astype(np.int16)
        a, b = d - k <= radius, d + k > radius
        todo.append((inner, idx[a], (home & (d <= radius))[a]))
        todo.append((outer, idx[b], (home & (d > radius))[b]))
    if not out:
        e = np.empty(0, np.int64)
        return e, e, e.astype(bool)
    return (np.concatenate([o[0] for o in out]),
            np.concatenate([np.full(len(o[0]), o[1]) for o in out]),
            np.concatenate([o[2] for o in out]))


def near_pairs(home: np.ndarray, seen: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into home, into seen) within k bits, by a local vantage-point tree."""
    todo = [(np.arange(len(home)), np.arange(len(seen)), 0)]
    while todo:
        h, s, stuck = todo.pop()
        if not len(h) or not len(s):
            continue
        if len(h) <= LEAF or stuck > 2:
            step = max(1, (1 << 20) // len(h))
            for at in range(0, len(s), step):
                part = s[at:at + step]
                i, j = np.nonzero(np.bitwise_count(home[h][:, None] ^ seen[part][None, :]) <= k)
                yield h[i], part[j]
            continue
        v = home[h[len(h) // 2]]
        dh, ds = (np.bitwise_count(x ^ v).astype(np.int16) for x in (home[h], seen[s]))
        radius = int(np.median(dh))
        inner = dh <= radius
        if inner.all():
            radius -= 1
            inner = dh <= radius
        stuck = stuck + 1 if inner.all() or not inner.any() else 0
        todo.append((h[inner], s[ds - k <= radius], stuck))
        todo.append((h[~inner], s[ds + k > radius], stuck))


def forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index in the component of each of n nodes."""
    root = np.arange(n)

    def top(x: np.ndarray) -> np.ndarray:
        while True:
            up = root[x]
            if (up == x).all():
                return x
            x = up

    for a, b in links:
        while True:
            ra, rb = top(a), top(b)
            open_ = ra != rb
            if not open_.any():
                break
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
    return top(np.arange(n))


# -- on Spark ---------------------------------------------------------------------------

def near_links(prints: DataFrame, max_bits: int = MAX_BITS, seed: int = 7) -> DataFrame:
    """``prints``: distinct ``fp``.  Edges (fp, root) that join all fingerprints within
    ``max_bits`` bits of each other, directly or by way of others of a shard.

    A fingerprint visits only shards numbered above its home: of two near ones with different
    homes each one's ball holds the other, so the one of the lower home meets the other there."""
    spark = prints.sparkSession
    n = prints.count()
    n_shards = max(1, math.ceil(n / SHARD))
    sample = [r[0] for r in prints.orderBy(F.xxhash64("fp")).limit(
        min(MAX_SAMPLE, SAMPLE_PER_SHARD * n_shards)).collect()]
    shards: list[int] = []
    tree = grow(np.array(sample, dtype=np.int64).view(np.uint64),
                math.ceil(math.log2(n_shards)), np.random.default_rng(seed), shards)
    shared = spark.sparkContext.broadcast(tree)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fps = b["fp"].to_numpy(np.int64)
            i, shard, home = visits(shared.value, fps.view(np.uint64), max_bits)
            own = np.empty(len(fps), np.int64)
            own[i[home]] = shard[home]
            go = shard >= own[i]
            yield pd.DataFrame({"shard": shard[go], "fp": fps[i[go]], "home": home[go]})

    def search(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("fp")
        fps, home = b["fp"].to_numpy(np.int64), np.flatnonzero(b["home"].to_numpy())
        u = fps.view(np.uint64)
        links = ((home[i], j) for i, j in near_pairs(u[home], u, max_bits))
        root = forest(len(fps), links)
        at = np.flatnonzero(root != np.arange(len(fps)))
        return pd.DataFrame({"fp": fps[at], "root": fps[root[at]]})

    spots = prints.select("fp").mapInPandas(spread, "shard long, fp long, home boolean")
    return spots.groupBy("shard").applyInPandas(search, "fp long, root long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(fp, label): the smallest fp in the connected component, for all nodes of edges."""
    both = written(edges.select("fp", "root")
                   .union(edges.select(F.col("root").alias("fp"), F.col("fp").alias("root")))
                   .distinct(), "links")
    label = written(both.groupBy("fp").agg(F.least("fp", F.min("root")).alias("label")),
                    "labels")
    while True:
        seen = (both.join(label.select(F.col("fp").alias("root"), "label"), "root")
                .groupBy("fp").agg(F.min("label").alias("near")))
        near = label.join(seen, "fp").select("fp", F.least("label", "near").alias("new"),
                                             F.col("label").alias("old"))
        up = label.select(F.col("fp").alias("new"), F.col("label").alias("upper"))
        step = written(near.join(up, "new").select(
            "fp", F.least("new", "upper").alias("label"), "old"), "labels")
        moved = step.filter("label <> old").limit(1).count()
        forget(label)
        label = step.select("fp", "label")
        label.scratch = step.scratch
        if not moved:
            forget(both)
            return label


def near_duplicates(df: DataFrame, id_: Column, text: Column, shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, seed: int = HASH_SEED) -> DataFrame:
    """One row a document: ``id``, ``fp`` (signed 64 bits), ``component_id``; and ``group``, which
    tells components apart even without ids, and ``th``, a hash of the text.  A join of two
    written tables, which stay; all others are deleted."""
    with Scratch(df.sparkSession) as scratch:
        prints, of = _near(scratch, df, id_, text, shingle, max_bits, seed)
        return _joined(scratch.keep(prints), scratch.keep(of))


def _near(scratch: Scratch, df: DataFrame, id_: Column, text: Column, shingle: int = SHINGLE,
          max_bits: int = MAX_BITS, seed: int = HASH_SEED) -> tuple[DataFrame, DataFrame]:
    """Documents with their fingerprints, and fingerprints with their components."""
    prints = scratch.write(df.select(
        id_.alias("id"), fingerprint_udf(shingle, seed)(text).alias("fp"),
        F.xxhash64(text).alias("th")), "fingerprints")
    classes = scratch.write(prints.groupBy("fp").agg(F.min("id").alias("least")), "print-classes")
    links = scratch.write(near_links(classes, max_bits), "print-links")
    label = scratch.adopt(components(links))
    small = (classes.join(label, "fp", "left")
             .withColumn("label", F.coalesce("label", "fp")))
    least = small.groupBy("label").agg(F.min("least").alias("component_id"))
    of = scratch.write(small.join(least, "label").select(
        "fp", "component_id", F.col("label").alias("group")), "print-components")
    return prints, of


def _joined(prints: DataFrame, of: DataFrame) -> DataFrame:
    return prints.join(of, "fp").select("id", "fp", "component_id", "group", "th")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """``df`` with one document of each group: the one of the smallest id (a group without ids
    keeps one as well), and of several texts under that id the one of the smallest hash.
    Of rows of one id and text, the first in row order stands for all (map columns: by
    their JSON)."""
    with Scratch(df.sparkSession) as scratch:
        dup = _joined(*_near(scratch, df, F.col(f"`{key}`"), F.col(f"`{text}`"), **params))
        first = F.struct(F.col("id").isNull().alias("none"), "id", "th", "n")
        stay = scratch.keep(scratch.write(
            dup.groupBy("group", "id", "th").agg(F.count("*").alias("n"))
            .groupBy("group").agg(F.min(first).alias("m")).select("m.id", "m.th", "m.n"),
            "near-kept"))
        repeated = stay.filter("n > 1").limit(1).count() > 0
    same = F.col("id").eqNullSafe(F.col("stay")) & (F.col("th") == F.col("stay_th"))
    # one plan at every size: texts meet the ids that stay by a shuffle, never by broadcast
    ids = stay.select(F.col("id").alias("stay"), F.col("th").alias("stay_th")).hint("merge")
    place = {"place": orderable(df)} if repeated else {}
    rows = packed(df, id=F.col(f"`{key}`"), th=F.xxhash64(F.col(f"`{text}`")), **place)
    kept = rows.join(ids, same, "left_semi")
    if repeated:
        kept = kept.groupBy("id", "th").agg(F.min_by("row", "place").alias("row"))
    return kept.select("row.*")


def op8_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"), F.col("doc_id"), F.col("text"))
    return out.select(F.col("id").alias("doc_id"),
                      F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
