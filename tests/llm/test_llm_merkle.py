"""The Merkle manifest against a brute-force tree."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from marquee.llm import merkle
from marquee.llm.common import Scratch

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def digest(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row) -> str:
    doc_id, text, lang, source, n = row

    def one(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    return digest("".join(map(one, (doc_id, source, lang, n, text))))


def layers(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def steps(tree: list[list[str]], i: int):
    for layer in tree[:-1]:
        run = layer[i - i % 16:i - i % 16 + 16]
        yield run[:i % 16], run[i % 16 + 1:]
        i //= 16


def lower(s):
    return s and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute(rows):
    """Sorted (doc_id, leaf, subroot, root, proof, folded, verified) of all rows."""
    first = (lambda v: (v is not None, v if v is not None else 0))
    trees = defaultdict(list)
    for r in rows:
        trees[r[3]].append(r)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for s in order:
        trees[s].sort(key=lambda r: (first(r[0]), leaf_of(r)))
        built[s] = layers([leaf_of(r) for r in trees[s]])
    top = layers([built[s][-1][0] for s in order])
    root = top[-1][0]
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(trees[s]):
            path = [*steps(built[s], i), *steps(top, k)]
            node = leaf_of(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                node = leaf_of((r[0], lower(r[1]), *r[2:]))
            for a, b in path:
                node = digest("".join(a) + node + "".join(b))
            proof = digest("".join("".join(a) + "".join(b) for a, b in path))
            out.append((r[0], leaf_of(r), built[s][-1][0], root, proof, node, node == root))
    return sorted(out, key=str)


def via_spark(spark, tmp, rows, extra=False):
    df = spark.createDataFrame(rows, DOC)
    if extra:
        for c in ("group", "key", "leaf", "at", "pos", "tree", "digest", "m"):
            df = df.withColumn(c, F.create_map(F.lit("a"), F.lit(1)))
    df.write.parquet(f"{tmp}/documents.parquet")
    got = merkle.op11_merkle_manifest(spark, tmp)
    return sorted((tuple(r) for r in got.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


@pytest.mark.parametrize("extra", [False, True])
def test_manifest_is_that_of_the_definition(spark, tmp, extra):
    rows = [(i, f"Text {i} Ünï" * (i % 4), "en", "hot", i) for i in range(300)]          # three levels
    rows += [(1000 + i, f"A{i}", None, f"s{i % 23:02d}é", None) for i in range(40)]      # two at the top
    rows += [(2000 + i, "Null Source", "de", None, 1) for i in range(17)]                # a last run of one
    rows += [(5000, "lone LEAF", "en", "", 3)]
    rows += [(None, None, None, None, None)] * 2 + [(None, "Q", "en", "hot", 1)] + [(7, "Same", "x", "hot", 1)] * 20
    assert via_spark(spark, tmp, rows, extra) == brute(rows)


def test_one_leaf_and_none(spark, tmp):
    one = [(5, "Solo", "en", "only", 4)]
    got = via_spark(spark, f"{tmp}/one", one)
    assert got == brute(one)
    assert got[0][2] == got[0][3] == got[0][1] and got[0][4] == digest("")
    assert via_spark(spark, f"{tmp}/none", []) == []


def test_requests_for_some_leaves(spark, tmp):
    rows = [(i, f"t{i}", "en", f"s{i % 3}", i) for i in range(400)]
    want = {r[0]: r for r in brute(rows)}
    df = spark.createDataFrame(rows, DOC)
    with Scratch(spark) as scratch:
        leaf = merkle.row_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
        m = merkle.build(scratch, df.select(F.col("source").alias("group"), F.col("doc_id").alias("key"),
                                            leaf.alias("leaf"), F.struct("lang").alias("row")))
        ask = m.leaves.filter("key in (0, 1, 2, 399, 200)")
        got = {r.key: r for r in merkle.prove(m, ask).select(
            "key", "root", merkle.proof_digest(F.col("proof")).alias("p"),
            merkle.folded(F.col("leaf"), F.col("proof")).alias("f")).collect()}
    assert set(got) == {0, 1, 2, 399, 200}
    assert all(got[k].p == want[k][4] and got[k].f == got[k].root == want[k][3] for k in got)
    assert digest("x") not in {r.f for r in got.values()}
