"""Mixing sources to target weights by hierarchical budgeting.

Leaves of a domain > language > source tree hold documents.  A token budget flows down
from the root: at each level a node's budget is split over its children by weight, a child
never gets more than its subtree can give (its tokens times ``max_epochs``), and what it
cannot give goes to its siblings first.  Only when all siblings are full does a
shortage show as a full subtree one level up, where it is shared among the parent's
siblings.  Each leaf then reads its documents in whole seeded epochs and a last, partial
one: the prefix, in seeded order, that covers the rest of its budget.

The tree has one row a leaf; documents are never gathered by leaf.  The order in an epoch
is a seeded hash, cut into ranges whose token sums are pre-aggregated; only the
range in which a leaf's budget ends is ordered row by row.

Defined cases: null or empty texts have no tokens and are taken where their place in the
order is before the cut; a leaf without any tokens costs nothing and is taken once; null levels form a node of their own; a weight that is
missing is 1 and a weight of 0 takes nothing; repeated rows are taken or left together;
a budget above the supply takes all epochs of all leaves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import packed, table, tidy, written

#: Hash ranges that an epoch's order is cut into (a power of two).
RANGES = 1 << 12
#: A tree of up to so many leaves is joined by broadcast (about 100 bytes a leaf).
BROADCAST_LEAVES = 50_000
LEVELS = ("domain", "lang", "source")


def n_tokens(text: Column) -> Column:
    """Words divided by blanks."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _fill(df: DataFrame, parent: list[str], budget: Column) -> DataFrame:
    """Split ``budget`` of each parent over its rows by ``weight``, none above ``cap``.

    Children are taken in order of cap/weight: while the next one's cap is below its share
    of what is left, it is full and leaves the rest to its siblings.
    """
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    key = F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(0.0))
    upto = by.orderBy(key, "node").rowsBetween(Window.unboundedPreceding, -1)
    cap = F.when(F.col("weight") > 0, F.col("cap")).otherwise(F.lit(0.0))
    df = (df.withColumn("budget", budget).withColumn("cap", cap)
            .withColumn("left", F.col("budget") - F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
            .withColumn("w_left", F.sum("weight").over(by)
                        - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
            .withColumn("full", (F.col("weight") <= 0)
                        | (F.col("cap") * F.col("w_left") <= F.col("weight") * F.col("left"))))
    # the first child that is not full fixes the level for all after it
    first = by.orderBy(key, "node").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    level = F.min(F.when(~F.col("full"), F.struct(key.alias("k"), F.col("node"),
                                                   F.try_divide("left", "w_left").alias("l")))
                  ).over(first)["l"]
    return (df.withColumn("level", level)
              .withColumn("budget", F.when(F.col("level").isNull(), F.col("cap"))
                          .otherwise(F.least("cap", F.col("weight") * F.col("level"))))
              .drop("left", "w_left", "full", "level"))


def leaf_budgets(leaves: DataFrame, total: float, weights: dict[tuple, float],
                 max_epochs: int) -> DataFrame:
    """``leaves``: domain, lang, source, tokens.  Adds ``budget`` (tokens of the leaf).

    ``weights`` maps a path, (domain,), (domain, lang) or (domain, lang, source), to its
    weight among its siblings; other nodes weigh 1.
    """
    paths = {len(p): {} for p in weights}
    for p, w in weights.items():
        if not w >= 0:
            raise ValueError(f"weight of {p} must be 0 or more")
        paths[len(p)][p] = float(w)

    def weight(depth: int) -> Column:
        own = [(reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v))
                                            for c, v in zip(LEVELS, p)]), w)
               for p, w in paths.get(depth, {}).items()]
        out = F.lit(1.0)
        for cond, w in own:
            out = F.when(cond, F.lit(w)).otherwise(out)
        return out

    # what a node can take is what its leaves can reach: none below a weight of 0
    open_ = reduce(lambda a, b: a & b, [weight(d) > 0 for d in range(1, len(LEVELS) + 1)])
    tree = leaves.withColumn("cap", F.when(open_, F.col("tokens").cast("double") * max_epochs)
                             .otherwise(F.lit(0.0)))
    got, budget = None, F.lit(float(total))
    for depth in range(1, len(LEVELS) + 1):
        keys, parent = list(LEVELS[:depth]), list(LEVELS[:depth - 1])
        nodes = (tree.groupBy(*keys).agg(F.sum("cap").alias("cap"))
                     .withColumn("weight", weight(depth))
                     .withColumn("node", F.to_json(F.struct(*keys))))
        # a parent of weight 0 must not be filled by its children's caps
        if got is not None:
            up = got.select(*[F.col(c).alias(f"up_{c}") for c in parent],
                            F.col("budget").alias("up_budget"))
            on = reduce(lambda a, b: a & b,
                        [F.col(c).eqNullSafe(F.col(f"up_{c}")) for c in parent])
            nodes = nodes.join(up, on).drop(*[f"up_{c}" for c in parent])
            budget = F.col("up_budget")
        got = _fill(nodes, parent, budget)
    return got.select(*LEVELS, "budget")


def mix(df: DataFrame, total: float, weights: dict[tuple, float], domain: Column,
        lang: Column, source: Column, key: Column, text: Column, max_epochs: int = 1,
        seed: int = 29) -> DataFrame:
    """Columns ``row`` (input row as a struct), the leaf, ``tokens``, ``epoch`` (from 0),
    ``budget`` of the leaf and ``supply`` (tokens of one epoch of it)."""
    rows = packed(df, domain=domain, lang=lang, source=source, key=key, tokens=n_tokens(text),
                  th=F.xxhash64(text))
    light = rows.select("domain", "lang", "source", "key", "tokens", "th")
    light = written(light, "mix-tokens")          # ids and counts only, never texts
    leaves = light.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    tree = written(leaves, "mix-leaves")
    n_leaves = tree.count()
    hint = F.broadcast if n_leaves <= BROADCAST_LEAVES else (lambda x: x)
    plan = written(
        leaf_budgets(tree, total, weights, max_epochs).alias("b")
        .join(tree.alias("t"), reduce(lambda a, b: a & b, [
            F.col(f"b.{c}").eqNullSafe(F.col(f"t.{c}")) for c in LEVELS]))
        .select(*[F.col(f"b.{c}").alias(c) for c in LEVELS], "budget",
                F.col("tokens").alias("supply"))
        .withColumn("whole", F.when(F.col("supply") > 0, F.least(
            F.floor(F.col("budget") / F.col("supply")), F.lit(max_epochs))).otherwise(1)
            .cast("int"))
        .withColumn("rest", F.when((F.col("whole") >= max_epochs) | (F.col("supply") == 0),
                                   F.lit(0.0)).otherwise(
            F.col("budget") - F.col("whole") * F.col("supply"))), "mix-plan")

    def order(epoch: Column) -> Column:
        return F.xxhash64(F.lit(seed), epoch, F.col("key"), F.col("th"))

    leaf = [F.col(c) for c in LEVELS]
    same = reduce(lambda a, b: a & b, [F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}"))
                                       for c in LEVELS])
    # the epoch in which the budget ends: sums by hash range, then the one range that is cut
    last = (light.alias("r").join(hint(plan.filter("rest > 0")).alias("p"), same)
            .select(*[F.col(f"r.{c}").alias(c) for c in LEVELS], "key", "th", "r.tokens", "whole",
                    "rest", order(F.col("whole")).alias("h"))
            .withColumn("range", F.shiftrightunsigned("h", 64 - (RANGES.bit_length() - 1))))
    by_leaf = Window.partitionBy(*LEVELS)
    ranges = (last.groupBy(*LEVELS, "rest", "range").agg(F.sum("tokens").alias("n"))
              .withColumn("upto", F.sum("n").over(by_leaf.orderBy("range")))
              .filter((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("n") < F.col("rest")))
              .groupBy(*LEVELS, "rest").agg(F.min(F.struct("range", "upto", "n")).alias("m"))
              .select(*LEVELS, "m.range", (F.col("m.upto") - F.col("m.n")).alias("before")))
    ranges = written(ranges, "mix-ranges")
    same_range = reduce(lambda a, b: a & b, [F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}"))
                                             for c in LEVELS]) & (F.col("r.range") == F.col("p.range"))
    edge = (last.alias("r").join(hint(ranges).alias("p"), same_range)
            .select(*[F.col(f"r.{c}").alias(c) for c in LEVELS], "r.h", "r.tokens", "r.rest",
                    "p.before")
            .groupBy(*LEVELS, "rest", "before", "h").agg(F.sum("tokens").alias("n"))
            .withColumn("upto", F.col("before") + F.sum("n").over(by_leaf.orderBy("h")))
            .filter(F.col("upto") - F.col("n") < F.col("rest"))
            .groupBy(*LEVELS).agg(F.max(F.struct(F.shiftrightunsigned("h", 1), "h")).alias("c"))
            .select(*LEVELS, F.col("c.h").alias("cut")))
    cut = written(
        plan.alias("p").join(edge.alias("r"), same, "left")
            .select(*[F.col(f"p.{c}").alias(c) for c in LEVELS], "budget", "supply", "whole",
                    "rest", "cut"), "mix-cuts")
    # unsigned order of the hash is the order of the ranges
    less = (F.shiftrightunsigned("h", 1) < F.shiftrightunsigned("cut", 1)) | (
        (F.shiftrightunsigned("h", 1) == F.shiftrightunsigned("cut", 1))
        & (F.pmod("h", F.lit(2)) <= F.pmod("cut", F.lit(2))))
    taken = (rows.alias("r").join(hint(cut).alias("p"), same)
             .select("r.row", *[F.col(f"r.{c}").alias(c) for c in LEVELS], "r.tokens", "budget",
                     "supply", "whole", "rest", "cut", order(F.col("whole")).alias("h"))
             .withColumn("copies", F.col("whole") + F.when(
                 (F.col("rest") > 0) & F.col("cut").isNotNull() & less, 1).otherwise(0))
             .filter("copies > 0"))
    return taken.select("row", *LEVELS, "tokens", "budget", "supply", F.explode(
        F.sequence(F.lit(0), F.col("copies") - 1)).alias("epoch"))


#: Production mixture: domains are the source families ``source number mod 4``.
DOMAIN_WEIGHTS = {("f0",): 4.0, ("f1",): 3.0, ("f2",): 2.0, ("f3",): 1.0}
LANG_WEIGHTS = {"en": 6.0, "de": 2.0, "fr": 2.0, "es": 1.0}
#: Share of all tokens that the mixture takes, and how often a document may be repeated.
SHARE, MAX_EPOCHS = 0.6, 2


def family(source: Column) -> Column:
    number = F.regexp_extract(source, r"(\d+)$", 1)
    return F.concat(F.lit("f"), F.when(number != "", F.crc32(number.cast("binary")) % 4)
                    .otherwise(F.lit(0)).cast("string"))


def production_mix(docs: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    weights = dict(DOMAIN_WEIGHTS)
    weights |= {(d, lang): w for (d,) in DOMAIN_WEIGHTS for lang, w in LANG_WEIGHTS.items()}
    total = docs.agg(F.sum(n_tokens(F.col("text")))).first()[0] or 0
    return mix(docs, share * total, weights, domain=F.coalesce(family(F.col("source")), F.lit("f0")),
               lang=F.col("lang"), source=F.col("source"), key=F.col("doc_id"), text=F.col("text"),
               max_epochs=max_epochs)


@tidy
def op5_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents mixed to the production weights: one row a taken document and epoch."""
    out = production_mix(table(spark, sf_dir, "documents"))
    return out.select(F.col("row.doc_id").alias("doc_id"), *LEVELS, "tokens", "budget", "supply",
                      "epoch")
