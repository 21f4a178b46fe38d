"""Deterministic first-per-key deduplication.

``dropDuplicates`` keeps an arbitrary survivor; here the survivor is the
first row by a total order -- the ``first`` columns, then every other
non-key column, ascending, nulls first -- so reruns and different partition
counts give the same rows.

Plan shape: the survivor is ``min(struct(order columns...))`` per key, a
partial aggregate on the map side and a final one after the shuffle (both
sort-based on the key only).  Each map task therefore sends at most one row
per key: a key that holds a third of the input (for example null, which
collapses to one row like ``dropDuplicates``) costs one row per map task in
the shuffle, not a third of the data in one reducer.  Struct ordering is
field by field, ascending, nulls first -- exactly the window order
``row_number() OVER (PARTITION BY keys ORDER BY ...)``, which
:func:`first_per_key_by` keeps for arbitrary orders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__marquee_rn"
_MIN = "__marquee_first"
# Equal rows that one step of the expansion makes.
_COPIES = 1 << 16


def total_order(df: DataFrame, keys: Sequence[str], first: Sequence[str] = ()) -> list[Column]:
    """``first`` columns, then every other non-key column, ascending, nulls first."""
    rest = [c for c in df.columns if c not in keys and c not in first]
    return [F.col(c).asc_nulls_first() for c in [*first, *rest]]


def first_per_key(df: DataFrame, keys: Sequence[str], first: Sequence[str] = ()) -> DataFrame:
    """One row per distinct ``keys`` value (null keys count as one value): the
    row that is smallest by ``first`` columns, then all other columns.  The
    non-key columns must be orderable (no map columns)."""
    keys = list(keys)
    order = [*first, *[c for c in df.columns if c not in keys and c not in first]]
    if not order:
        return df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias(_MIN))
    return picked.select(*[F.col(c) if c in keys else F.col(_MIN)[c].alias(c)
                           for c in df.columns])


def first_per_key_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key by any ``order`` (e.g. descending), via
    ``row_number() == 1``; Spark inserts a partial ``WindowGroupLimit`` before
    the shuffle, so this is skew-safe as well."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def first_per_key_keep_nulls(df: DataFrame, key: str, first: Sequence[str] = ()) -> DataFrame:
    """Like :func:`first_per_key` on one key, but rows whose key is null are all kept.

    One pass: rows without a key are grouped by all their columns and counted, so they
    are spread over the shuffle, and the count is expanded again (in two steps, so that
    no array grows with the table)."""
    null = F.col(key).isNull()
    order = [*first, *[c for c in df.columns if c != key and c not in first]]
    if not order:
        return df.select(key).filter(~null).distinct().unionByName(df.select(key).filter(null))
    own = [F.when(null, F.col(c)).alias(f"{_MIN}_{i}") for i, c in enumerate(order)]
    groups = df.groupBy(F.col(key), *own).agg(
        F.min(F.struct(*order)).alias(_MIN),
        F.count(F.when(null, F.lit(1))).alias(_RN))
    last = F.greatest(F.col(_RN) - 1, F.lit(0))
    step = F.lit(_COPIES)
    chunks = groups.select(key, _MIN, F.explode(F.sequence(F.lit(0), last, step)).alias("from"),
                           last.alias("last"))
    rows = chunks.select(key, _MIN, F.explode(F.sequence(
        "from", F.least(F.col("from") + step - 1, F.col("last")))).alias(_RN))
    return rows.select(*[F.col(c) if c == key else F.col(_MIN)[c].alias(c) for c in df.columns])
