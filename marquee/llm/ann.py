"""Approximate nearest neighbours (largest inner product) on an NN-descent graph.

Build: every vector starts with random neighbours; in each round Spark joins a sample of
each node's neighbours, and of the nodes that it is a neighbour of, with their vectors,
compares them with each other (neighbours of neighbours), and keeps the best ``degree``
for each node, until few lists change.  Pairs that were compared before are not compared again.

Query: greedy search by rounds for all queries at once.  A query's pool holds the best ``pool``
nodes found; each round expands its best ``width`` unexpanded ones: a join gives their
neighbours, which go to the blocks of the vectors' table to be scored there, in blocks of
queries, and come back.  It ends when all nodes of all pools are expanded.  The best of
the pool are scored anew on the original vectors, in double precision.

Each vector is kept as its direction, in half precision (2 bytes a component), beside its own
norm in double precision, so that no vector sets the precision of the others.  The search ranks by
norm times cosine.  For the graph, vectors are scaled by a high norm (``norm_cap``) and given one
more component, which makes all of equal length: then the nearest by angle are those of the
largest inner product.  Of longer vectors only the direction counts there, which are found by
the search's entries of large norm.  Equal vectors are one node, which stands for the smallest
``k + 1`` of their ids.

Defined cases: rows with null ids, and vectors that are null, empty, zero, of another length
than most, or hold null or non-finite components take no part; repeated rows count once, and of
several vectors under one id the smallest counts; with fewer than ``k`` candidates all
come back; ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import forget, small_batches, table, written

DEGREE, SAMPLED, ROUNDS, STOP, CANDIDATES = 32, 12, 10, 0.04, 6
POOL, WIDTH, RESCORED, ENTRIES = 320, 64, 48, 128
#: Nearest drawn entries, and nearest of the entries of largest norm, that a query starts from.
NEAR_DRAWN, NEAR_LONG = 8, 32
#: The graph's norms end at this share of the nodes, or at so many medians, and start at so much of that.
CAP_SHARE, CAP_MEDIANS, CAP_LEAST = 0.99, 4, 1 / 64
#: Vectors of one block, and queries of one block: both are bounded groups of a join.
BLOCK, QUERY_BLOCK = 2048, 64
MAX_SEARCH_ROUNDS = 200


# -- vectors ----------------------------------------------------------------------------

def clean_vectors(df: DataFrame, id_: Column, vector: Column) -> DataFrame:
    """(id, vec array<double>): the rows that take part, one for each id."""
    v = vector.cast("array<double>")
    rows = (df.select(id_.cast("long").alias("id"), v.alias("vec"))
            .filter(F.col("id").isNotNull() & (F.size("vec") > 0)))
    rows = rows.filter(finite_of("vec") & F.exists("vec", lambda x: x != 0))
    dims = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n"))
    dim = dims.orderBy(F.desc("n"), "d").first()
    rows = rows.filter(F.size("vec") == (dim.d if dim else 0))
    return rows.groupBy("id").agg(F.min("vec").alias("vec"))


def finite_of(col: str) -> Column:
    return F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def nodes_of(vectors: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors as nodes (node = smallest id, vec), and members (node, id) of the
    smallest ``k + 1`` ids of each."""
    nodes = vectors.groupBy("vec").agg(F.min("id").alias("node"))
    nodes = written(nodes.select("node", "vec"), "ann-nodes")
    ids = vectors.join(nodes.withColumnRenamed("vec", "v"), F.col("vec") == F.col("v"))
    members = (ids.select("node", "id")
               .withColumn("r", F.row_number().over(Window.partitionBy("node").orderBy("id")))
               .filter(F.col("r") <= k + 1).drop("r"))
    return nodes, written(members, "ann-members")


def size_of(vec: Column) -> Column:
    """The largest absolute component."""
    return F.array_max(F.transform(vec, lambda x: F.abs(x)))


def halves(vec: Column, most: float) -> Column:
    """``half``: the norm over ``most`` (the largest component of the table) in 8 bytes and the
    direction in half precision; ``norm``: the same norm."""
    @F.pandas_udf("half binary, norm double")
    def pack(vs: pd.Series) -> pd.DataFrame:
        if not len(vs):
            return pd.DataFrame({"half": pd.Series([], dtype=object), "norm": np.empty(0)})
        x = np.stack(vs.to_numpy()).astype(np.float64)
        size = np.abs(x).max(axis=1)
        x /= size[:, None]                              # squares neither overflow nor vanish
        length = np.sqrt((x * x).sum(axis=1))
        norm = np.maximum(size / most * length, np.finfo(np.float64).tiny)
        h = (x / length[:, None]).astype(np.float16)
        return pd.DataFrame({"half": [n.tobytes() + r.tobytes() for n, r in zip(norm, h)],
                             "norm": norm})
    return pack(vec)


def unpacked(col: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Norms and directions."""
    if not len(col):
        return np.empty(0), np.empty((0, 0), np.float32)
    rows = np.frombuffer(b"".join(col), np.uint8).reshape(len(col), -1)
    return (np.ascontiguousarray(rows[:, :8]).view(np.float64)[:, 0],
            np.ascontiguousarray(rows[:, 8:]).view(np.float16).astype(np.float32))


def lifted(col: pd.Series, cap: float) -> np.ndarray:
    """Vectors over ``cap`` with the component that makes their length 1."""
    norm, x = unpacked(col)
    norm = np.clip(norm / cap, CAP_LEAST, 1.0)
    return np.column_stack([x * norm[:, None], np.sqrt(1 - norm * norm)]).astype(np.float32)


def norm_cap(halves: DataFrame, n: int) -> float:
    """The norm that ``CAP_SHARE`` of the nodes do not exceed, ``CAP_MEDIANS`` medians at most (by
    a histogram of 32 steps an octave)."""
    steps = (halves.groupBy(F.floor(F.log2("norm") * 32).alias("step"))
             .agg(F.count("*").alias("n"), F.max("norm").alias("norm")).orderBy("step").collect())
    upto = np.cumsum([r.n for r in steps])

    def at(share: float) -> float:
        return steps[int(np.searchsorted(upto, share * n))].norm
    return min(at(CAP_SHARE), CAP_MEDIANS * at(0.5)) if steps else 1.0


# -- NN-descent -------------------------------------------------------------------------

def _local_join(batches: Iterator[pd.DataFrame], cap: float) -> Iterator[pd.DataFrame]:
    """Rows (u, v, fresh, worst, vec) sorted by u: compare the v of one u with each other and
    return, for each, the best that would improve its list (worst: its last similarity)."""
    def compare(b: pd.DataFrame) -> pd.DataFrame:
        u, v = b["u"].to_numpy(), b["v"].to_numpy()
        fresh, worst = b["fresh"].to_numpy(bool), b["worst"].to_numpy(np.float32)
        vec = lifted(b["vec"], cap)
        starts = np.flatnonzero(np.concatenate(([True], u[1:] != u[:-1])))
        sizes = np.diff(np.append(starts, len(u)))
        out = []
        step = 512
        for a in range(0, len(starts), step):
            size, first = sizes[a:a + step], starts[a:a + step]
            w = int(size.max())
            if w < 2:
                continue
            cell = np.full((len(size), w), -1)
            rows = np.repeat(np.arange(len(size)), size)
            cols = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            cell[rows, cols] = first[0] + np.arange(size.sum())
            there = cell >= 0
            x = vec[cell] * there[:, :, None]
            sim = x @ x.transpose(0, 2, 1)
            f = fresh[cell] & there
            ok = (there[:, :, None] & there[:, None, :] & (f[:, :, None] | f[:, None, :])
                  & ~np.eye(w, dtype=bool)[None] & (sim > worst[cell][:, :, None]))
            sim = np.where(ok, sim, -2.0)
            top = min(CANDIDATES, w - 1)
            best = np.argpartition(-sim, top - 1, axis=2)[:, :, :top]
            s = np.take_along_axis(sim, best, 2)
            hit = s > -2.0
            g, i, j = np.nonzero(hit)
            out.append(pd.DataFrame({"u": v[cell[g, i]], "v": v[cell[g, best[g, i, j]]],
                                     "sim": s[hit].astype(np.float32)}))
        return pd.concat(out) if out else pd.DataFrame(
            {"u": np.empty(0, np.int64), "v": np.empty(0, np.int64),
             "sim": np.empty(0, np.float32)})

    rest = None
    for b in batches:
        b = b if rest is None else pd.concat([rest, b], ignore_index=True)
        last = b["u"].iloc[-1] if len(b) else None
        done = b["u"] != last
        rest = b[~done].reset_index(drop=True)          # the last group may go on
        if done.any():
            yield compare(b[done].reset_index(drop=True))
    if rest is not None and len(rest):
        yield compare(rest)


def _first_edges(nodes: DataFrame, n: int, degree: int, seed: int) -> DataFrame:
    """Random neighbours: nodes are numbered within hash buckets, and each draws (bucket,
    place) pairs; edges to places that are not there fall out of the join."""
    per = 64
    buckets = max(1, n // per)
    placed = nodes.select("node", F.pmod(F.xxhash64(F.lit(seed), "node"), F.lit(buckets)).alias("b"))
    placed = placed.withColumn("place", F.row_number().over(
        Window.partitionBy("b").orderBy("node")) - 1)
    draw = F.explode(F.sequence(F.lit(0), F.lit(2 * degree - 1)))
    wish = nodes.select(F.col("node").alias("u"), draw.alias("i")).select(
        "u", F.pmod(F.xxhash64(F.lit(seed + 1), "u", "i"), F.lit(buckets)).alias("b"),
        F.pmod(F.xxhash64(F.lit(seed + 2), "u", "i"), F.lit(min(n, per))).alias("place"))
    return (wish.join(placed, ["b", "place"]).filter("u <> node")
            .select("u", F.col("node").alias("v")).distinct())


def nn_descent(nodes: DataFrame, n: int, degree: int = DEGREE, sampled: int = SAMPLED,
               rounds: int = ROUNDS, seed: int = 3) -> DataFrame:
    """``nodes``: node, half (bytes), norm.  Edges (u, v, sim): the best ``degree`` found for each u."""
    sim0, cap = F.lit(-2.0).cast("float"), norm_cap(nodes, n)
    edges = written(_best(_first_edges(nodes, n, degree, seed).select(
        "u", "v", sim0.alias("sim"), F.lit(True).alias("fresh")), degree, sampled, seed), "ann-edges")
    for r in range(rounds):
        small_batches(nodes.sparkSession, 4000)
        back = (edges.withColumn("r", F.row_number().over(
            Window.partitionBy("v", "fresh").orderBy(F.xxhash64(F.lit(seed + r), "u", "v"))))
            .filter(F.col("r") <= sampled)
            .select(F.col("v").alias("u"), F.col("u").alias("v"), "fresh"))
        pairs = (edges.filter("drawn").select("u", "v", "fresh").union(back)
                 .groupBy("u", "v").agg(F.max("fresh").alias("fresh")))
        worst = edges.groupBy(F.col("u").alias("node")).agg(
            F.when(F.count("*") >= degree, F.min("sim")).otherwise(sim0).alias("worst"))
        known = nodes.join(worst, "node", "left").select(
            F.col("node").alias("v"), "half", F.coalesce("worst", sim0).alias("worst"))
        found = (pairs.join(known, "v")
                 .select("u", "v", "fresh", "worst", F.col("half").alias("vec"))
                 .repartition("u").sortWithinPartitions("u", "v")
                 .mapInPandas(lambda b: _local_join(b, cap), "u long, v long, sim float"))
        old = edges.select("u", "v", "sim", (F.col("fresh") & ~F.col("drawn")).alias("fresh"))
        step = written(_best(old.union(found.withColumn("fresh", F.lit(True))), degree, sampled,
                             seed + r), "ann-edges")
        forget(edges)
        edges = step
        changed = edges.filter("fresh").count()
        if changed <= STOP * degree * n:
            break
    return edges.select("u", "v", "sim")


def _best(edges: DataFrame, degree: int, sampled: int, seed: int) -> DataFrame:
    """The best ``degree`` edges of each u; ``drawn``: in the sample of the next round.
    An edge that was there before keeps its (older) freshness."""
    by = Window.partitionBy("u")
    return (edges.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
            .withColumn("r", F.row_number().over(by.orderBy(F.desc("sim"), "v")))
            .filter(F.col("r") <= degree)
            .withColumn("d", F.row_number().over(Window.partitionBy("u", "fresh").orderBy(
                F.xxhash64(F.lit(seed), "u", "v"))))
            .select("u", "v", "sim", "fresh", (F.col("d") <= sampled).alias("drawn")))


# -- greedy search ----------------------------------------------------------------------

STATE = "qb long, q long, vec binary, ids binary, sims binary, done binary, open int"
_I, _F, _B = np.int64, np.float64, np.bool_


def _top(ids: np.ndarray, sims: np.ndarray, done: np.ndarray, pool: int, width: int):
    """The best ``pool`` (ties to smaller ids) and which are expanded next."""
    order = np.lexsort((ids, -sims))[:pool]
    ids, sims, done = ids[order], sims[order], done[order]
    return ids, sims, done, np.flatnonzero(~done)[:width]


def block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    """The block of the vectors' table that holds each node."""
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(33)) % np.uint64(blocks)).astype(_I)


def _block(blocks: int):
    @F.pandas_udf("long")
    def of(ids: pd.Series) -> pd.Series:
        return pd.Series(block_of(ids.to_numpy(_I), blocks))
    return of


def greedy_search(queries: DataFrame, nodes: DataFrame, edges: DataFrame, n: int,
                  pool: int = POOL, width: int = WIDTH, entries: int = ENTRIES) -> DataFrame:
    """``queries``: q, half (bytes of the query), start (a node or null).  Returns (q, ids
    binary): the node ids of each query's pool, best first."""
    spark = queries.sparkSession
    blocks = max(1, -(-n // BLOCK))
    n_queries = queries.count()
    q_blocks = max(1, -(-n_queries // QUERY_BLOCK))
    near = (edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            .distinct()
            .withColumn("r", F.row_number().over(Window.partitionBy("u").orderBy(
                F.xxhash64("u", "v")))).filter(F.col("r") <= 3 * DEGREE)   # hubs keep a sample
            .groupBy("u").agg(F.collect_list("v").alias("near")))
    near = written(near.withColumnRenamed("u", "node"), "ann-graph")
    placed = written(nodes.select(_block(blocks)("node").alias("block"), "node", "half"),
                     "ann-blocks")
    marks = nodes.orderBy(F.xxhash64(F.lit(8), "node")).limit(entries).collect()
    longest = nodes.orderBy(F.desc("norm"), "node").limit(entries).collect()
    first = spark.sparkContext.broadcast([
        (np.array([m.node for m in of], _I), *unpacked(pd.Series([m.half for m in of])), near_)
        for of, near_ in ((marks, NEAR_DRAWN), (longest, NEAR_LONG)) if of])

    def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            x = unpacked(b["half"])[1]
            for qb, q, half, start, v in zip(b["qb"], b["q"], b["half"], b["start"], x):
                # the start and the nearest entries of each kind
                best = {} if pd.isna(start) else {int(start): np.inf}
                for ids0, norm0, x0, near_ in first.value:
                    sims = norm0 * (x0 @ v)
                    for i in np.lexsort((ids0, -sims))[:near_].tolist():
                        best.setdefault(int(ids0[i]), sims[i])
                ids, sims = np.array(list(best), _I), np.array(list(best.values()), _F)
                order = np.lexsort((ids, -sims))
                rows.append((qb, q, half, ids[order].tobytes(), sims[order].tobytes(),
                             np.zeros(len(ids), _B).tobytes(), len(ids)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in STATE.split(", ")])

    small_batches(spark, 1000)
    state = written(queries.select(
        F.pmod(F.xxhash64(F.lit(7), "q"), F.lit(q_blocks)).alias("qb"), "q", "half", "start")
        .mapInPandas(begin, STATE), "ann-state")

    def frontier(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for qb, q, ids, done in zip(b["qb"], b["q"], b["ids"], b["done"]):
                ids, done = np.frombuffer(ids, _I), np.frombuffer(done, _B)
                nxt = ids[np.flatnonzero(~done)[:width]]
                out.append(pd.DataFrame({"qb": qb, "q": q, "node": nxt}))
            yield pd.concat(out) if out else pd.DataFrame(
                {"qb": np.empty(0, _I), "q": np.empty(0, _I), "node": np.empty(0, _I)})

    def gather(s: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        """The unknown neighbours of each query of a block, by block of the vectors."""
        rows = []
        by_q = {q: g for q, g in new.groupby("q")["near"]}
        for q, vec, ids, sims in zip(s["q"], s["vec"], s["ids"], s["sims"]):
            if q not in by_q:
                continue
            cand = np.setdiff1d(np.concatenate(list(by_q[q])), np.frombuffer(ids, _I))
            worst = np.frombuffer(sims, _F)
            limit = float(worst[-1]) if len(worst) >= pool else -np.inf
            if not len(cand):
                continue
            of = block_of(cand, blocks)
            order = np.argsort(of, kind="stable")
            cand, of = cand[order].astype(_I), of[order]
            first_of = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            for a, b in zip(first_of, np.append(first_of[1:], len(of))):
                rows.append((s["qb"].iloc[0], q, vec, limit, cand[a:b].tobytes(), of[a]))
        return pd.DataFrame(rows, columns=["qb", "q", "vec", "least", "cand", "block"])

    def score(asked: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        rows = []
        vectors = vectors.sort_values("node")
        node, (norm, x) = vectors["node"].to_numpy(_I), unpacked(vectors["half"])
        for qb, q, v, limit, cand in zip(asked["qb"], asked["q"], unpacked(asked["vec"])[1],
                                         asked["least"], asked["cand"]):
            ids = np.frombuffer(cand, _I)
            at = np.searchsorted(node, ids)
            at = at[(at < len(node)) & (node[np.minimum(at, len(node) - 1)] == ids)]
            sims = norm[at] * (x[at] @ v)
            good = sims > limit
            if good.any():
                rows.append((qb, q, node[at][good].tobytes(), sims[good].astype(_F).tobytes()))
        return pd.DataFrame(rows, columns=["qb", "q", "ids", "sims"])

    def merge(s: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        rows = []
        by_q: dict[int, list] = {}
        for q, ids, sims in zip(got["q"], got["ids"], got["sims"]):
            by_q.setdefault(q, []).append((np.frombuffer(ids, _I), np.frombuffer(sims, _F)))
        for qb, q, vec, ids, sims, done in zip(s["qb"], s["q"], s["vec"], s["ids"], s["sims"],
                                               s["done"]):
            ids, sims = np.frombuffer(ids, _I), np.frombuffer(sims, _F)
            done = np.frombuffer(done, _B).copy()
            done[np.flatnonzero(~done)[:width]] = True
            new = by_q.get(q, [])
            ids = np.concatenate([ids, *(g[0] for g in new)])
            sims = np.concatenate([sims, *(g[1] for g in new)])
            done = np.concatenate([done, np.zeros(len(ids) - len(done), _B)])
            ids, sims, done, nxt = _top(ids, sims, done, pool, width)
            rows.append((qb, q, vec, ids.tobytes(), sims.tobytes(), done.tobytes(), len(nxt)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in STATE.split(", ")])

    for _ in range(MAX_SEARCH_ROUNDS):
        busy = state.filter("open > 0")
        asked = (busy.mapInPandas(frontier, "qb long, q long, node long")
                 .join(near, "node").select("qb", "q", "near"))
        wanted = busy.groupBy("qb").cogroup(asked.groupBy("qb")).applyInPandas(
            gather, "qb long, q long, vec binary, least double, cand binary, block long")
        got = wanted.groupBy("block").cogroup(placed.groupBy("block")).applyInPandas(
            score, "qb long, q long, ids binary, sims binary")
        step = written(busy.groupBy("qb").cogroup(got.groupBy("qb")).applyInPandas(merge, STATE)
                       .union(state.filter("open <= 0")), "ann-state")
        forget(state)
        state = step
        if not state.filter("open > 0").limit(1).count():
            break
    forget(near, placed)
    return state.select("q", "ids")


# -- the operator -----------------------------------------------------------------------

def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def scores(q: Column, vec: Column, most: float) -> tuple[Column, Column]:
    """``by``: the inner product with both sides over powers of two, which neither overflows nor
    changes the order; ``score``: as it is (infinite where it exceeds double precision)."""
    up = math.ldexp(1.0, max(-1000, min(1000, math.frexp(most)[1])))
    own = F.pow(F.lit(2.0), F.greatest(F.lit(-1000.0), F.least(F.lit(1000.0), F.ceil(
        F.log2(size_of(q))).cast("double"))))
    by = dot(F.transform(q, lambda x: x / own), F.transform(vec, lambda x: x / F.lit(up)))
    plain = dot(q, vec)
    return by.alias("by"), F.when(F.abs(plain) < float("inf"), plain).otherwise(
        by * own * F.lit(up)).alias("score")


def nearest(df: DataFrame, id_: Column, vector: Column, is_query: Column, k: int = 20,
            **params) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest rows other than the query itself.

    ``is_query`` is a condition on ``id``."""
    vectors = written(clean_vectors(df, id_, vector), "ann-vectors")
    nodes, members = nodes_of(vectors, k)
    most, n = nodes.agg(F.max(size_of(F.col("vec"))), F.count("*")).first()
    most = most or 1.0
    half = written(nodes.select("node", halves(F.col("vec"), most).alias("h"))
                   .select("node", "h.half", "h.norm"), "ann-half")
    edges = nn_descent(half, n, **params)
    asked = vectors.filter(is_query).select(F.col("id").alias("q"), F.col("vec").alias("qvec"))
    queries = asked.join(nodes, F.col("qvec") == F.col("vec"), "left").select(
        "q", halves(F.col("qvec"), most).getField("half").alias("half"), F.col("node").alias("start"))
    found = greedy_search(written(queries, "ann-queries"), half, edges, n)

    @F.pandas_udf("array<long>")
    def best(ids: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(i, _I)[:max(RESCORED, 2 * k)] for i in ids], dtype=object)

    pairs = found.select("q", F.explode(best("ids")).alias("node"))
    scored = (pairs.join(nodes, "node").join(asked, "q")
              .select("q", "node", *scores(F.col("qvec"), F.col("vec"), most)))
    rows = scored.join(members, "node").filter("id <> q")
    w = Window.partitionBy("q").orderBy(F.desc("by"), "id")
    return (rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select(F.col("q").alias("query_id"), F.col("rank").cast("int").alias("rank"),
                    F.col("id").alias("vec_id"), "score"))


def op1_nearest_neighbours(spark, sf_dir: str, k: int = 20) -> DataFrame:
    """Rows of ``embeddings`` whose vec_id is divisible by 20, against every other row."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id"), F.col("embedding"),
                   F.col("id") % 20 == 0, k)
