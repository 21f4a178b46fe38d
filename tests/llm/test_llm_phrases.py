"""Phrase mining against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import phrases as ph
from marquee.llm.common import Scratch

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def counts(rows):
    words, f = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for n in range(1, 5):
                for i in range(len(w) - n + 1):
                    f[lang, tuple(w[i:i + n])] += 1
    return words, f


def brute(rows, least=30, top=2000):
    words, f = counts(rows)
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    best = {}
    for (lang, w), a in cand.items():
        cuts = []
        for k in range(1, len(w)):
            x, y = f[lang, w[:k]], f[lang, w[k:]]
            cuts.append((2000000 * a // (x + y), k, x, y))
        best[lang, w] = min(cuts)
    out = []
    for lang in words:
        mine = []
        for (g, w), a in cand.items():
            if g != lang:
                continue
            inside = any(g2 == g and len(v) > len(w) and 100 * b >= 80 * a
                         and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))
                         for (g2, v), b in cand.items())
            if not inside:
                s, _, x, y = best[lang, w]
                mine.append((-s, -a, " ".join(w).encode(), x, y))
        for rank, (s, a, p, x, y) in enumerate(sorted(mine)[:top], 1):
            out.append((lang, rank, p.decode(), -a, x, y, words[lang], -s))
    return sorted(out)


def sample():
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(14)] + ["Ünï", "don't", "x\x07y", "　", "A-B"]
    rows = []
    for i in range(1500):
        n = rng.choice([0, 1, 3, 12, 40])
        words = [vocab[min(int(rng.expovariate(0.35)), len(vocab) - 1)] for _ in range(n)]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "!"]) for w in words)
        rows.append((i, text, rng.choice(["en", "de", None, "und", ""]), "s", n))
    rows += [(900, "New York City Hall " * 3000, "en", "s", 1), (901, None, "en", "s", None),
             (902, "", None, "s", 0)] + [(903, "to be or not to be", "fr", "s", 1)] * 31
    return rows


@pytest.mark.parametrize("chunk", [1 << 11, 8 << 20])
def test_phrases_are_those_of_the_definition(spark, tmp, monkeypatch, chunk):
    rows = sample()
    monkeypatch.setattr(ph, "CHUNK", chunk)
    monkeypatch.setattr(ph, "OPEN", 3 * chunk)
    monkeypatch.setattr(ph, "BUCKET", 3000)
    monkeypatch.setattr(ph, "HELD", 20 if chunk < 1 << 20 else 500_000)
    df = spark.createDataFrame(rows, DOC).repartition(7)
    for c in ("f", "n", "phrase", "chunk", "raw"):
        df = df.withColumn(c, F.create_map(F.lit(1), F.lit(2)))
    df.write.parquet(f"{tmp}/documents.parquet")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = sorted(tuple(r) for r in ph.op12_phrase_collocations(spark, tmp).collect())
    assert got == brute(rows) and len(got) > 50
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_the_first_of_each_language(spark):
    rows = sample()
    with Scratch(spark) as scratch:
        found = ph.frequent_phrases(scratch, spark.createDataFrame(rows, DOC), F.col("text"), F.col("lang"))
        got = sorted(tuple(r) for r in ph.collocations(*found, top=5).collect())
    assert got == brute(rows, top=5)


def test_colliding_fingerprints_are_parted():
    words = np.array([0, 1, 2, 0, 1, 2, 0, 1])
    places, sizes = np.array([0, 1, 3, 4, 6, 0, 3]), np.array([2, 2, 2, 2, 2, 1, 1])   # 01 12 01 12 01 0 0

    def parted(group):
        group = np.array(group)
        order = np.argsort(group, kind="stable")
        lead = np.searchsorted(group[order], np.unique(group))
        got = ph._parted(words, places[order], sizes[order], group[order], lead)
        return sorted((tuple(words[p:p + n].tolist()), c) for p, n, c in zip(*(x.tolist() for x in got)))
    want = [((0,), 2), ((0, 1), 3), ((1, 2), 2)]
    assert parted([0, 1, 0, 1, 0, 2, 2]) == want
    assert parted([0, 0, 0, 0, 0, 0, 0]) == want
    assert parted([0, 1, 0, 1, 0, 1, 1]) == want


def test_shared_fingerprints_change_nothing(spark, tmp, monkeypatch):
    monkeypatch.setattr(ph, "dealt", lambda p, buckets: p % np.uint64(61))    # everything collides
    rows = [(i, f"alpha beta gamma{i % 9} delta", "en", "s", 1) for i in range(300)]
    raw = b"\n".join(r[1].encode() for r in rows)
    bits = {0: np.packbits(np.ones(61, bool)).tobytes()}
    got = Counter()
    for p, c in ph.phrases_of(raw, "en", bits, 1, 4):
        got[p.decode()] += c
    _, f = counts(rows)
    assert got == Counter({" ".join(w): c for (_, w), c in f.items()})


def test_scores_past_64_bits(spark):
    big = 9 * 10**17
    phrases = spark.createDataFrame([("en", 2, "a b", big), ("en", 1, "a", big + 7), ("en", 1, "b", big + 1)],
                                    "lang string, n int, phrase string, f long")
    totals = spark.createDataFrame([("en", 3 * big)], "lang string, words long")
    (r,) = ph.collocations(phrases, totals).collect()
    assert r.score == 2000000 * big // (2 * big + 8) and r.n == 3 * big and r.rank == 1


def test_no_rows(spark, tmp):
    spark.createDataFrame([], DOC).write.parquet(f"{tmp}/documents.parquet")
    out = ph.op12_phrase_collocations(spark, tmp)
    assert out.collect() == []
    assert dict(out.dtypes)["rank"] == "bigint"
