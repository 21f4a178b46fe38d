"""The Jaccard join against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import jaccard as jc

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text, size=4):
    w = (text or "").encode().lower().split()
    if not w:
        return set()
    return {b" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))}


def brute(rows, percent=85):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            k = top(i)
            least[k] = min(least.get(k, r[0]), r[0])
    return sorted(((r[0], len(s), least.get(top(i)) if s else r[0])
                   for i, (r, s) in enumerate(zip(rows, sets))), key=str)


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            at = rng.randrange(len(w))
            kind = rng.random()
            if kind < 0.4:
                w[at] = f"new{rng.randrange(10**6)}"
            elif kind < 0.7:
                w.insert(at, rng.choice(base))
            elif len(w) > 5:
                del w[at]
        out.append(" ".join(w))
    return out


def sample(seed):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(300)]
    texts = []
    for _ in range(12):
        base = rng.choices(vocab, k=rng.choice([5, 12, 40, 120]))
        texts += family(rng, base, 14, 1 + len(base) // 12)
    shared = rng.choices(vocab, k=60)                      # a passage in unlike texts, and ever longer ones
    texts += [" ".join(rng.choices(vocab, k=30) + shared) for _ in range(25)]
    texts += [" ".join(shared + rng.choices(vocab, k=k)) for k in range(0, 25)]
    chain = rng.choices(vocab, k=100)                      # each like the next, the ends unlike
    texts += [" ".join(chain[k:k + 60]) for k in range(0, 40, 2)]
    texts += ["a b c", "A  b\tC", "a b", "a", "", " \n", None, "x " * 5000, "x y " * 2000, "ÄÖ ß", "äö ß"]
    texts += [texts[0]] * 20 + [texts[0].upper(), texts[0].replace(" ", "\n")]
    rng.shuffle(texts)
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    return rows + [(None, texts[3], "en", "s", 1), (None, "only without an id here", None, None, None), (4, texts[9], "e", "s", 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_all_pairs(spark, tmp, seed, monkeypatch):
    rows = sample(seed)
    if seed == 2:                                          # any order of shingles, few bits: same links
        monkeypatch.setattr(jc, "SKETCH_BITS", 7)
        monkeypatch.setattr(jc, "FILTER_BITS", 8)
    df = spark.createDataFrame(rows, DOC).repartition(6)
    for c in ("cid", "n", "h", "label", "a", "id"):
        df = df.withColumn(c, F.create_map(F.lit(1), F.lit(2)))
    df.write.parquet(f"{tmp}/documents.parquet")
    got = sorted((tuple(r) for r in jc.op13_jaccard_join(spark, tmp).collect()), key=str)
    assert got == brute(rows)
    assert len({r[2] for r in got}) < len(got) - 60


def test_sets_are_those_of_the_words():
    texts = ["a b c d e a b c d", "", "one", "Two words", "x " * 9, "é É e"]
    got = jc.shingle_sets(texts)
    assert [len(s) for s in got] == [len(shingles(t)) for t in texts]
    again = jc.shingle_sets(["e a b c d e"])[0]
    assert len(np.intersect1d(got[0], again)) == len(shingles(texts[0]) & shingles("e a b c d e"))


def test_prefixes_of_linked_sets_meet():
    for n in range(1, 400):
        assert jc.prefix_length(n, 85) == n - -(-85 * n // 100) + 1 >= 1
    assert jc.prefix_length(20, 85) == 4


def test_no_rows(spark, tmp):
    spark.createDataFrame([], DOC).write.parquet(f"{tmp}/documents.parquet")
    out = jc.op13_jaccard_join(spark, tmp)
    assert out.columns == ["doc_id", "n_shingles", "component_id"] and out.collect() == []
