"""Sharding, mixing, nearest neighbours, the pipeline and its registration."""

from __future__ import annotations

import importlib
import random
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as cp
from conftest import ROOT
from marquee.llm import ann, mixing, sharding
from marquee.llm.common import packed

SF = "/root/testdata/sf0.01"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


# -- sharding -------------------------------------------------------------------------------

def odd_docs(spark, n=60):
    rows = [(i, f"text {i} " * (i % 7), "en", "src1", i) for i in range(n)]
    rows += [(5, "text 5 " * 5, "en", "src1", 5)] * 40 + [(None, None, None, None, None)] * 3
    rows += [(77, "x" * 100_000, "de", "src2", 1), (78, "", "de", "src2", 1)]
    df = spark.createDataFrame(rows, DOC)
    for c in ("shard", "bucket", "slot", "h", "pos", "row", "epoch", "budget"):
        df = df.withColumn(c, F.lit("mine"))
    return df, rows


def test_shards_hold_every_row_once(spark):
    df, rows = odd_docs(spark)
    out = sharding.shard_documents(df, 4, bucket_bytes=2000)
    got = out.collect()
    assert Counter((r.row.doc_id, r.row.text) for r in got) == Counter((r[0], r[1]) for r in rows)
    assert all(r.row.shard == "mine" for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.bucket for r in got}) > 5
    again = sharding.shard_documents(df, 4, bucket_bytes=2000).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))          # seeded
    assert sharding.shard_documents(df.limit(0), 4).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_documents(df, 0)


def test_rows_with_maps_are_sharded(spark):
    rows = [(k % 5, f"t{k % 5}", {"a": k % 3}, [{"b": k}]) for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>, l array<map<string,int>>")
    got = [sharding.shard_documents(df, 3, bucket_bytes=1000).collect() for _ in range(2)]
    assert sorted(map(str, got[0])) == sorted(map(str, got[1]))
    assert sorted(str(tuple(r.row)) for r in got[0]) == sorted(map(str, rows))


def test_columns_named_like_the_stage_s_stay(spark):
    df = odd_docs(spark, 10)[0]
    out = cp.sharding(spark, df, SF)
    assert out.columns == [*df.columns, "_shard", "_slot"]
    assert {(r.shard, r.slot) for r in out.collect()} == {("mine", "mine")}


def test_shuffled_order_differs_from_the_hash_order(spark):
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    rows = sharding.shard_documents(df, 1).orderBy("slot").collect()
    ids = [r.row.doc_id for r in rows]
    assert ids != sorted(ids)
    assert 0.3 < np.mean([a < b for a, b in zip(ids, ids[1:])]) < 0.7


def test_a_hot_key_has_more_buckets_not_larger_ones(spark):
    rows = [(None if i % 3 else i, f"text {i} " + "w" * 80) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sharding.shard_documents(df, 8, bucket_bytes=5000).collect()
    assert Counter((r.row.doc_id, r.row.text) for r in got) == Counter(rows)
    sizes = Counter()
    for r in got:
        sizes[r.shard, r.bucket] += len(r.row.text) + sharding.ROW_BYTES
    hot = max(sizes, key=sizes.get)[0]
    assert sum(r.shard == hot for r in got) > 2000
    assert max(sizes.values()) < 3 * 5000


def test_sharding_query(spark):
    rows = sharding.op3_sharding(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    assert {r.law for r in rows} == {"key"} and {r.shard for r in rows} <= set(range(40))
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert r.size == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw)
        assert r.grown_shard in (r.shard, 40)
    moved = sum(r.grown_shard == 40 for r in rows)
    assert 0 < moved < 3 * len(rows) / 41
    assert max(Counter(r.shard for r in rows).values()) < 3 * len(rows) / 40


# -- mixing ---------------------------------------------------------------------------------

def slow_fill(children, budget):
    """children: name -> (weight, cap); raise the level until the budget or caps are used up."""
    got = {k: 0.0 for k in children}
    open_ = {k for k, (w, c) in children.items() if w > 0 and c > 0}
    left = budget
    while open_ and left > 1e-9:
        total = sum(children[k][0] for k in open_)
        step = min([left / total] + [(children[k][1] - got[k]) / children[k][0] for k in open_])
        for k in open_:
            got[k] += step * children[k][0]
            left -= step * children[k][0]
        open_ = {k for k in open_ if children[k][1] - got[k] > 1e-9}
    return got


def slow_budgets(leaves, total, weights, epochs):
    out = {}

    def reached(leaf):
        return all(weights.get(leaf[:k], 1.0) > 0 for k in (1, 2, 3))

    def down(prefix, budget):
        depth = len(prefix)
        if depth == 3:
            out[prefix] = budget
            return
        kids = defaultdict(float)
        for leaf, tokens in leaves.items():
            if leaf[:depth] == prefix:
                kids[leaf[:depth + 1]] += tokens * epochs * reached(leaf)
        share = slow_fill({k: (weights.get(k, 1.0), c) for k, c in kids.items()}, budget)
        for k in kids:
            down(k, share[k])
    down((), total)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_budgets_match_water_filling(spark, seed):
    rng = random.Random(seed)
    leaves = {(d, la, s): rng.choice([0, 5, 50, 500, 3000]) for d in ("d1", "d2", None)
              for la in ("en", None) for s in ("a", "b", "c") if rng.random() < 0.8}
    weights = {("d1",): rng.choice([0.0, 1.0, 5.0]), ("d2",): 2.0, ("d1", "en"): 3.0,
               ("d2", None, "a"): 0.0, (None, "en", "b"): 9.0}
    total = rng.choice([0, 100, 2000, 10_000, 10 ** 6])
    df = spark.createDataFrame([(*k, v) for k, v in leaves.items()],
                               "domain string, lang string, source string, tokens long")
    got = {(r.domain, r.lang, r.source): r.budget
           for r in mixing.leaf_budgets(df, total, weights, 2).collect()}
    want = slow_budgets(leaves, total, weights, 2)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-5), (k, seed)


def test_budget_of_a_closed_branch_reaches_the_ancestors(spark):
    leaves = {("A", "en", "x"): 1000, ("A", "de", "x"): 10, ("B", "en", "x"): 5000}
    df = spark.createDataFrame([(*k, v) for k, v in leaves.items()],
                               "domain string, lang string, source string, tokens long")
    got = {(r.domain, r.lang): r.budget
           for r in mixing.leaf_budgets(df, 1000, {("A", "en"): 0.0}, 1).collect()}
    assert got == {("A", "en"): 0, ("A", "de"): 10, ("B", "en"): 990}


@pytest.mark.parametrize("seed", range(4))
def test_budgets_with_zeros_at_every_level(spark, seed):
    rng = random.Random(100 + seed)
    leaves = {(d, la, s): rng.choice([5, 50, 500, 3000]) for d in ("d1", "d2", "d3", None)
              for la in ("en", "de", None) for s in ("a", "b", None)}
    nodes = sorted({k[:n] for k in leaves for n in (1, 2, 3)}, key=str)
    weights = {k: rng.choice([0.0, 0.0, 1.0, 4.0]) for k in rng.sample(nodes, len(nodes) // 2)}
    df = spark.createDataFrame([(*k, v) for k, v in leaves.items()],
                               "domain string, lang string, source string, tokens long")
    got = {(r.domain, r.lang, r.source): r.budget
           for r in mixing.leaf_budgets(df, 9000, weights, 2).collect()}
    want = slow_budgets(leaves, 9000, weights, 2)
    assert got == {k: pytest.approx(v, abs=1e-5) for k, v in want.items()}


def run_mix(df, total, weights, epochs):
    return mixing.mix(df, total, weights, F.lit("d"), F.col("lang"), F.col("source"),
                      F.col("doc_id"), F.col("text"), max_epochs=epochs)


def test_mix_takes_the_prefix_of_seeded_epochs(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randrange(1, 40), rng.choice(["en", "de", None]), rng.choice(["a", "b"]), 1)
            for i in range(300)]
    df = spark.createDataFrame(rows, DOC).withColumn("budget", F.lit("mine"))
    weights = {("d", "en"): 3.0, ("d", "de"): 1.0, ("d", "en", "a"): 5.0}
    supply = defaultdict(int)
    for _, t, la, s, _ in rows:
        supply[("d", la, s)] += len(t.split())
    for total in (200, 3000, 8000, 10 ** 7):
        got = run_mix(df, total, weights, 2).collect()
        taken, seen = defaultdict(int), Counter()
        for r in got:
            taken[(r.domain, r.lang, r.source)] += r.tokens
            seen[(r.row.doc_id, r.epoch)] += 1
        assert max(seen.values(), default=1) == 1
        assert all((i, 0) in seen for i, e in seen if e == 1)
        budgets = slow_budgets(dict(supply), total, weights, 2)
        for leaf, b in budgets.items():
            assert b - 1e-6 <= taken[leaf] < b + 40 + 1e-6, (leaf, total)    # ends with a whole text
    a = sorted((r.row.doc_id, r.epoch) for r in run_mix(df, 3000, weights, 2).collect())
    b = sorted((r.row.doc_id, r.epoch) for r in run_mix(df.repartition(7), 3000, weights, 2).collect())
    assert a == b                                                    # the seed decides, not the layout
    less = {x[0] for x in sorted((r.row.doc_id, r.epoch) for r in run_mix(df, 1500, weights, 2).collect())}
    assert less <= {x[0] for x in a}                                 # a smaller budget takes a prefix


def test_mix_odd_rows(spark):
    df, rows = odd_docs(spark)
    out = run_mix(df, 10 ** 6, {}, 1)
    assert out.count() == len(rows)                                  # all fit: every row once
    assert run_mix(df, 0, {}, 1).filter("tokens > 0").count() == 0
    assert run_mix(df.limit(0), 100, {}, 1).count() == 0
    with pytest.raises(ValueError):
        run_mix(df, 10, {("d",): -1.0}, 1)


def test_mixing_query(spark):
    out = mixing.op5_mixing(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    total = sum(len(t.split()) for t in docs.text)
    assert not out.duplicated(["doc_id", "epoch"]).any()
    by = out.groupby(["domain", "lang", "source"]).agg(n=("tokens", "sum"), b=("budget", "first"))
    assert by.b.sum() == pytest.approx(mixing.SHARE * total, rel=1e-6)
    longest = max(len(t.split()) for t in docs.text)
    assert (by.n >= by.b - 1e-6).all() and (by.n < by.b + longest).all()


# -- nearest neighbours -------------------------------------------------------------------------

VEC = "vec_id long, embedding array<float>"


def slow_nearest(rows, is_query, k):
    ok = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        ok[i] = min(ok.get(i, v), v)
    dims = Counter(len(v) for v in ok.values())
    d = min(dims, key=lambda n: (-dims[n], n)) if dims else 0
    ok = {i: np.array(v, np.float32).astype(float) for i, v in ok.items() if len(v) == d}
    out = []
    for q in ok:
        if is_query(q):
            top = sorted(((-float(ok[q] @ ok[c]), c) for c in ok if c != q))[:k]
            out += [(q, r, c, -s) for r, (s, c) in enumerate(top, 1)]
    return sorted(out)


def search(spark, rows, k=5):
    df = spark.createDataFrame(rows, VEC).withColumn("id", F.lit("mine")).withColumn("vec", F.lit(0))
    out = ann.nearest(df, F.col("vec_id"), F.col("embedding"), F.col("id") % 3 == 0, k)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out.collect())


def same(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-12)


def test_neighbours_odd_rows(spark):
    rng = np.random.default_rng(3)
    v = lambda: rng.integers(-8, 8, 6).astype(float).tolist()
    rows = [(i, v()) for i in range(40)]
    rows += [(50, None), (51, []), (52, [0.0] * 6), (53, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (None, v()),
             (54, [float("nan")] * 6), (55, [float("inf")] * 6), (56, [1.0, 2.0]), rows[3], rows[3]]
    rows += [(60 + i, rows[9][1]) for i in range(25)]                 # ties beyond k
    same(search(spark, rows), slow_nearest(rows, lambda i: i % 3 == 0, 5))
    few = [(0, [1.0, 0.0]), (3, [0.0, 2.0]), (4, [1.0, 1.0])]
    same(search(spark, few), slow_nearest(few, lambda i: i % 3 == 0, 5))
    assert search(spark, []) == [] and search(spark, [(0, [1.0])]) == []


def test_inner_product_recall_with_unequal_lengths(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 16)) * rng.uniform(0.2, 3, (1500, 1))
    rows = [(i, r.tolist()) for i, r in enumerate(x)]
    got, want = search(spark, rows, 10), slow_nearest(rows, lambda i: i % 3 == 0, 10)
    hits = len({(g[0], g[2]) for g in got} & {(w[0], w[2]) for w in want})
    assert len(got) == len(want) and hits / len(want) > 0.95


def recall(spark, x, every, k=20):
    """Of ``nearest`` against inner products with each side over its own power of two."""
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    out = ann.nearest(df, F.col("vec_id"), F.col("embedding"), F.col("id") % every == 0, k).collect()
    small = x / 2.0 ** np.ceil(np.log2(np.abs(x).max()))
    got = defaultdict(set)
    for r in out:
        got[r.query_id].add(r.vec_id)
    hits = 0
    for q in range(0, len(x), every):
        s = small @ (x[q] / np.abs(x[q]).max())
        s[q] = -np.inf
        assert len(got[q]) == k
        hits += len(got[q] & set(np.argsort(-s)[:k].tolist()))
    return hits / (k * len(got))


@pytest.mark.parametrize("longest", [1e4, 1e200])
def test_recall_with_one_very_long_vector(spark, longest):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 24))
    x *= (rng.uniform(0.5, 1.5, 3000) / np.linalg.norm(x, axis=1))[:, None]
    x[7] *= longest
    assert recall(spark, x, 30) > 0.95


def test_recall_with_lognormal_norms_and_an_outlier(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 24))
    x *= (rng.lognormal(0, 0.7, 3000) / np.linalg.norm(x, axis=1))[:, None]
    x[7] *= 1e8
    assert recall(spark, x, 30) > 0.95


def test_neighbour_query_recall(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = [tuple(r) for r in ann.op1_nearest_neighbours(spark, SF).collect()]
    want = slow_nearest(rows, lambda i: i % 20 == 0, 20)
    hits = len({(g[0], g[2]) for g in got} & {(w[0], w[2]) for w in want})
    assert len(got) == len(want) and hits / len(want) > 0.95


# -- the pipeline -----------------------------------------------------------------------------

def test_pipeline_stages_against_their_inputs(spark):
    from marquee.llm.common import written
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("fp", F.lit("mine"))
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    seen = {}
    for name, stage in cp.STAGES:
        docs = written(stage(spark, docs, SF), "t")
        seen[name] = docs
        if name != cp.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "fp"]
    ids = {k: [r.doc_id for r in v.select("doc_id").collect()] for k, v in seen.items()}
    clean = [i for i, t in labels.items() if t == 0]
    assert len(set(clean) - set(ids["toxicity"])) < 0.02 * len(clean)
    assert len(ids["simhash_near_dedup"]) == len(set(ids["simhash_near_dedup"]))
    from test_llm_dedup import slow_components, slow_hits
    kept = [(r.doc_id, r.text) for r in seen["toxicity"].collect()]
    assert sorted(ids["simhash_near_dedup"]) == sorted({c[3] for c in slow_components(kept)})
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = slow_hits([(r.doc_id, r.text) for r in seen["simhash_near_dedup"].collect()], items)
    gone = {d for d, n, h, _ in before if h > 0.5 * n}
    assert sorted(ids["decontamination"]) == sorted({b[0] for b in before} - gone)
    after = slow_hits([(r.doc_id, r.text) for r in seen["decontamination"].collect()], items)
    assert sum(a[2] for a in after) == 0 < sum(b[2] for b in before)
    assert Counter(ids["mixing"]) == Counter(ids["sharding"])
    assert set(ids["mixing"]) <= set(ids["decontamination"])
    slots = defaultdict(list)
    for r in seen["sharding"].collect():
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_stages_take_empty_and_odd_documents(spark):
    df, rows = odd_docs(spark, 20)
    for part in (df, df.limit(0)):
        for name, stage in cp.STAGES:
            out = stage(spark, part, SF)
            n = out.count()
            assert n <= 2 * part.count(), name
            if part is df and name == "simhash_near_dedup":
                assert n < len(rows)


def test_run_is_registered(spark):
    names = entry.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert names["pipeline"] is cp.run and cp.ORACLE_SQL is None
    assert [k for k, _ in cp.STAGES] == ["toxicity", "simhash_near_dedup", "decontamination",
                                         "mixing", "sharding"]


def test_library_stands_without_the_subpackage(tmp_path):
    code = ("import sys\nclass Gone:\n    def find_spec(self, name, path=None, target=None):\n"
            "        if name == 'corpus_pipeline' or name.startswith('marquee.llm'):\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Gone())\nimport __spark_entry__ as e\n"
            "q = e.queries()\nassert 'movie_360' in q and not any(k.startswith('op') for k in q)\n"
            "assert set(e.oracle_sql()) == set(q)\n")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_packed_keeps_any_names(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` long, row long")
    assert packed(df, row2=F.lit(3)).select("row.*").columns == ["a.b", "row"]


def test_queries_with_sql():
    assert {k.split("_")[0] for k in importlib.import_module("marquee.llm.queries").llm_oracles()} == {
        "op2", "op7", "op11", "op12", "op13"}
