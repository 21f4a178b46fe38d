"""Near-duplicates, repeated substrings and decontamination against brute force."""

from __future__ import annotations

import hashlib
import os
import random
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.llm import decontaminate as dc
from marquee.llm import simhash as sh
from marquee.llm import substrings as ss
from marquee.llm.mixing import op5_mixing
from marquee.llm.quality import op9_quality_classifier
from marquee.session import shared_dir

SF = "/root/testdata/sf0.01"
DOC = "doc_id long, text string"
CLASH = ("fp", "id", "label", "row", "d", "base", "raw", "spans", "items", "hit", "n_words")


def clashing(df):
    for c in CLASH:
        df = df.withColumn(c, F.lit("mine"))
    return df


# -- SimHash ------------------------------------------------------------------------------

def slow_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hs = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def slow_components(rows):
    prints = [(i, slow_print(t)) for i, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 2:
                parent[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(prints):
        if i is not None:
            least[find(k)].append(i)
    return sorted((i is None, i or 0, p, min(least[find(k)], default=None))
                  for k, (i, p) in enumerate(prints))


def near(spark, rows):
    df = clashing(spark.createDataFrame(rows, DOC))
    out = sh.near_duplicates(df, F.col("doc_id"), F.col("text")).collect()
    return sorted((r.id is None, r.id or 0, r.fp % (1 << 64), r.component_id) for r in out)


def test_simhash_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one"), (5, "ONE"), (5, "ONE"), (None, "one"),
            (6, "one two"), (7, "é É"), (8, "x y z " * 20_000), (9, "x y z " * 20_000 + "w")]
    assert near(spark, rows) == slow_components(rows)
    assert near(spark, []) == []


def test_simhash_matches_brute_force(spark):
    rng = random.Random(4)
    base = [[rng.choice("the a of to in red dog cat ran on".split()) + str(rng.randrange(9))
             for _ in range(300)] for _ in range(25)]
    rows = []
    for k, words in enumerate(base):
        for c in range(8):
            w = list(words)
            for _ in range(c):
                w[rng.randrange(len(w))] = "new"
            rows.append((1000 - 10 * k - c, " ".join(w)))
    assert near(spark, rows) == slow_components(rows)


def test_simhash_query_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((False, r.doc_id, int(r.fingerprint, 16), r.component_id)
                 for r in sh.op8_simhash_near_dedup(spark, SF).collect())
    assert got == slow_components(rows)


def test_tree_finds_all_links_of_a_dense_space(spark, monkeypatch):
    """Many shards and deep local trees over prints that differ in few bits."""
    monkeypatch.setattr(sh, "SHARD", 16)
    rng = np.random.default_rng(1)
    centers = rng.integers(0, 1 << 62, 30)
    flips = (1 << rng.integers(0, 62, (400, 3))).sum(axis=1)
    fps = sorted({int(centers[i % 30]) ^ int(f) for i, f in enumerate(flips)} | set(map(int, centers)))
    edges = sh.near_links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    label = {r.fp: r.label for r in sh.components(edges).collect()}
    want = {f: f for f in fps}
    for _ in range(len(fps)):
        before = dict(want)
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= 2:
                    want[a] = want[b] = min(want[a], want[b])
        if before == want:
            break
    assert {f: label.get(f, f) for f in fps} == want


def test_local_tree_matches_all_pairs():
    rng = np.random.default_rng(2)
    home = np.unique(rng.integers(0, 1 << 14, 900).astype(np.uint64))
    seen = np.unique(rng.integers(0, 1 << 14, 1200).astype(np.uint64))
    got = {(int(i), int(j)) for a, b in sh.near_pairs(home, seen, 2) for i, j in zip(a, b)}
    want = set(zip(*map(lambda x: x.tolist(),
                        np.nonzero(np.bitwise_count(home[:, None] ^ seen[None, :]) <= 2))))
    assert got == want


def test_one_of_each_group_stays(spark):
    rows = [(3, "a b c d"), (1, "a b c d"), (2, "something else here"), (2, "something else here"),
            (None, "quite another text")]
    out = sh.keep_one(clashing(spark.createDataFrame(rows, DOC)))
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == [
        (0, "quite another text"), (1, "a b c d"), (2, "something else here")]
    assert set(CLASH) <= set(out.columns)


def test_repeats_of_a_row_with_a_map_column(spark):
    rows = [(1, "a b c d", {"k": 2}), (1, "a b c d", {"k": 1}), (2, "something else here", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, extra map<string,int>")
    assert sorted((r.doc_id, r.extra) for r in sh.keep_one(df).collect()) == [(1, {"k": 1}), (2, None)]


def test_scratch_is_deleted_and_settings_come_back(spark):
    folder, conf = f"{shared_dir(spark)}/marquee".removeprefix("file:"), "spark.sql.execution.arrow.maxRecordsPerBatch"
    os.makedirs(folder, exist_ok=True)
    before, batch = set(os.listdir(folder)), spark.conf.get(conf)
    out = sh.keep_one(spark.createDataFrame([(k, f"a b c d{k}") for k in range(60)], DOC))
    assert out.count() == 60 and spark.conf.get(conf) == batch
    left = set(os.listdir(folder)) - before
    assert len(left) == 1 and next(iter(left)).startswith("llm-near-kept")


def test_queries_leave_only_their_result(spark):
    folder, conf = f"{shared_dir(spark)}/marquee".removeprefix("file:"), "spark.sql.execution.arrow.maxRecordsPerBatch"
    os.makedirs(folder, exist_ok=True)
    for query in (op5_mixing, op9_quality_classifier):
        before, batch = set(os.listdir(folder)), spark.conf.get(conf)
        assert query(spark, "/root/testdata/sf0.001").count() and spark.conf.get(conf) == batch
        left = set(os.listdir(folder)) - before
        assert len(left) == 1 and next(iter(left)).startswith(f"llm-{query.__name__}")


def test_one_of_each_group_stays_without_ids_or_with_ids_of_several_texts(spark):
    rows = [(None, "first text of its own"), (None, "a second one, not alike"), (None, None),
            (None, ""), (7, "x y z w"), (7, "words that no other row has"), (8, "x y z w"),
            (None, "x y z w")]
    out = sh.keep_one(clashing(spark.createDataFrame(rows, DOC))).collect()
    got = sorted((r.doc_id or 0, r.text or "") for r in out)
    assert got == [(0, ""), (0, "a second one, not alike"), (0, "first text of its own"),
                   (7, "words that no other row has"), (7, "x y z w")]
    assert not sh.keep_one(spark.createDataFrame([], DOC)).collect()


# -- substrings ---------------------------------------------------------------------------

def slow_cut(rows, size):
    """By (id, text) order; rows of one id never match across their border."""
    seen, out = set(), []
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    for d, t in order:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - size + 1):
            w = raw[s:s + size]
            if w in seen:
                gone[s:s + size] = b"\1" * size
            seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((d, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def cut(spark, rows, size, gram=ss.GRAM):
    df = clashing(spark.createDataFrame(rows, DOC))
    out = ss.remove_repeats(df, F.col("doc_id"), F.col("text"), size, gram)
    return sorted(((None if r.d == ss.NO_ID else r.d, r.n_bytes, r.n_removed, r.n_spans,
                    hashlib.sha256(bytes(r.kept)).hexdigest()) for r in out.collect()), key=str)


def texts(seed, n, alphabet, longest):
    rng = random.Random(seed)
    pool = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))) for _ in range(n)]
    rows = []
    for i in range(n):
        a, b = rng.choice(pool), rng.choice(pool)
        x, y = sorted(rng.randrange(len(a) + 1) for _ in range(2))
        rows.append((rng.randrange(n), pool[i] + a[x:y] + b[: rng.randrange(len(b) + 1)]))
    return rows


@pytest.mark.parametrize("seed,alphabet,size,gram", [(1, "abcdefgh é", 100, 20), (2, "ab", 30, 8),
                                                     (3, "a", 25, 5)])
def test_substrings_match_brute_force(spark, seed, alphabet, size, gram):
    rows = texts(seed, 60, alphabet, 500)
    assert cut(spark, rows, size, gram) == slow_cut(rows, size)


def test_substrings_odd_rows(spark):
    long = "".join(random.Random(7).choice("abcdefghij ") for _ in range(1_300_000))
    rows = [(None, None), (1, ""), (1, None), (2, "x" * 99), (3, "x" * 100), (4, "x" * 101),
            (5, "é" * 80), (5, "é" * 80), (6, long), (7, "q" + long[600_000:700_000] + "q"),
            (None, "é" * 80)]
    assert cut(spark, rows, 100) == slow_cut(rows, 100)
    assert cut(spark, [], 100) == []


def test_hot_passages_are_split_and_still_exact(spark, monkeypatch):
    monkeypatch.setattr(ss, "HOT_SAMPLE", 50)
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    line = word(180)
    rows = [(i, word(150) + (line if i % 3 else "") + word(150)) for i in range(90)]
    rows += [(100 + i, rows[0][1]) for i in range(30)]
    df = spark.createDataFrame(rows, DOC)
    raw = df.select(F.col("doc_id").alias("d"), F.lit(0).alias("base"),
                    F.col("text").cast("binary").alias("raw"))
    assert len(ss.hot_grams(raw, len(rows), 100, 20))
    assert cut(spark, rows, 100) == slow_cut(rows, 100)


def test_hot_sample_grows_with_the_corpus(spark, monkeypatch):
    """A passage that too few of a fixed sample hold is found as the documents it may hold fall."""
    monkeypatch.setattr(ss, "HOT_SAMPLE", 40)
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    line = word(180)
    rows = [(i, word(150) + (line if i % 20 == 0 else "") + word(150)) for i in range(400)]
    df = spark.createDataFrame(rows, DOC)
    raw = df.select(F.col("doc_id").alias("d"), F.lit(0).alias("base"),
                    F.col("text").cast("binary").alias("raw"))
    assert not len(ss.hot_grams(raw, len(rows), 100, 20))
    monkeypatch.setattr(ss, "HOT_DOCS", 10)
    found = ss.hot_grams(raw, len(rows), 100, 20)
    assert len(found)
    monkeypatch.setattr(ss, "MAX_HOT", 2)
    assert len(ss.hot_grams(raw, len(rows), 100, 20)) == 2
    assert cut(spark, rows, 100) == slow_cut(rows, 100)


def test_tasks_settle_any_number_at_once():
    """The earliest of equal strings stays, whatever the order and the limits of a task."""
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    line = word(300)
    docs = [(d, 0, (word(120) + line).encode()) for d in rng.sample(range(90), 90)]
    frame = pd.DataFrame(docs, columns=["d", "base", "raw"])
    parts = [frame.iloc[a:a + 7] for a in range(0, len(frame), 7)]

    def spans(anchors, most):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(ss, "TASK_ANCHORS", anchors)
            m.setattr(ss, "TASK_DOCS", most)
            got = list(ss._emit(iter(parts), 100, 20, np.empty(0, np.uint64), 1))
        out = ss._settle(pd.concat(got, ignore_index=True), 100)
        return len(got), sorted(map(str, out.to_numpy().tolist()))

    one, two = spans(1 << 20, 60_000), spans(40, 5)
    assert one[0] == 1 and two[0] > 10 and one[1] == two[1]
    sure = [s for s in one[1] if "<NA>" in s]
    assert len(sure) > 80 and not any(s.startswith("[0, ") for s in sure)


def test_a_run_of_one_byte_or_period_is_one_record_a_task(spark):
    """No bucket of a hash gets the records that a task has settled, however many."""
    long = [("a" * 1_500_000), "ab " * 300_000, "- " * 200_000 + "end"]
    blank = [f"{i} begins" + " " * 400 + f"and ends {i}" for i in range(300)]
    frame = pd.DataFrame([(i, 0, t.encode()) for i, t in enumerate(long + blank)],
                         columns=["d", "base", "raw"])
    got = pd.concat(ss._emit(iter([frame]), 100, 20, np.empty(0, np.uint64), 8))
    records = sum(len(b) - 16 * n for k, n, b in zip(got["kind"], got["n"], got["blob"]) if k == 0) // 24
    assert records < 20 * len(frame)
    assert got["blob"].map(len).max() < 1 << 20 and got["blob"].map(len).sum() < 1 << 20
    rows = [(1, "a" * 3000), (2, "ab " * 900), (3, "x" + "a" * 2000 + "y"), (4, "- " * 700 + "end")]
    rows += [(10 + i, t) for i, t in enumerate(blank[:40])]
    assert cut(spark, rows, 100) == slow_cut(rows, 100)
    out = {r.d: (r.n_bytes, r.n_removed) for r in ss.remove_repeats(
        spark.createDataFrame(list(enumerate(long)), DOC), F.col("doc_id"), F.col("text")).collect()}
    assert out[0] == (1_500_000, 1_499_999) and out[1] == (900_000, 899_997)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=30), max_size=6), st.integers(2, 6))
def test_maximal_repeats_are_complete(pieces, size):
    """Every window that occurs twice lies in a reported repeat, with all occurrences."""
    raw = [p.encode() for p in pieces if p]
    joined, at = b"", []
    for p in raw:
        at.append(len(joined))
        joined += p + b"\0"
    groups = [(d, set(map(int, w))) for d, w in ss.maximal_repeats(raw, size)] if raw else []
    for d, where in groups:
        assert len({joined[i:i + d] for i in where}) == 1 and len(where) > 1
        first = joined[min(where):min(where) + d]
        every = {i for i in range(len(joined) - d + 1) if joined[i:i + d] == first}
        assert where == every and b"\0" not in first
    windows = defaultdict(set)
    for i in range(len(joined) - size + 1):
        if b"\0" not in joined[i:i + size]:
            windows[joined[i:i + size]].add(i)
    for where in windows.values():
        if len(where) > 1:
            for i in where:
                assert any(j <= i and i + size <= j + d for d, js in groups for j in js)


# -- decontamination ------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def slow_hits(docs, items, window=10):
    grams = defaultdict(set)
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            grams[tuple(w[k:k + n])].add(str(i) if i is not None else "")
    sizes = {len(g) for g in grams}
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                g = grams.get(tuple(w[k:k + n]))
                if g:
                    hit.update(range(k, k + n))
                    found |= g
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def hits(spark, docs, items, **params):
    df = clashing(spark.createDataFrame(docs, DOC))
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = dc.find_windows(df, F.col("text"), bench, F.col("item_id"), F.col("text"), **params)
    rows = out.select(F.col("row.doc_id").alias("d"), "n_words", dc.hit_words().alias("n"),
                      "items").collect()
    return sorted(((r.d, r.n_words, r.n, list(r["items"])) for r in rows), key=str)


def cases(seed):
    rng = random.Random(seed)
    vocab = ["a", "B", "c", "Über", "x1", "東京"]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, say(rng.choice([1, 3, 5, 9, 10, 11, 25]))) for i in range(12) if i != 3]
    items += [(30, ""), (31, None), (None, say(12)), (5, items[5][1])]
    docs = [(i, ", ".join([say(rng.randrange(30)), rng.choice(items)[1] or "", say(5)]))
            for i in range(40)] + [(1, None), (None, ""), (7, "..."), (8, say(30_000))]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_match_brute_force(spark, seed):
    docs, items = cases(seed)
    assert hits(spark, docs, items) == slow_hits(docs, items)


def test_long_items_only(spark):
    rng = random.Random(3)
    say = lambda n: " ".join(rng.choice("abcdefgh") for _ in range(n))
    items = [(i, say(25)) for i in range(20)]
    docs = [(i, say(8) + " " + items[i % 20][1][2 * (i % 5):30] + " " + say(40)) for i in range(60)]
    assert hits(spark, docs, items) == slow_hits(docs, items)


def test_blocks_of_items_give_the_same(spark):
    docs, items = cases(4)
    assert hits(spark, docs[:-1], items, block_words=20) == slow_hits(docs[:-1], items)


def test_items_longer_than_a_block_are_cut_into_pieces(spark):
    rng = random.Random(8)
    words = [f"w{rng.randrange(400)}" for _ in range(300)]
    items = [(1, " ".join(words)), (2, "two words"), (3, "  ".join(words[250:]).upper())]
    docs = [(k, f"two words before {' '.join(words[k:k + 14])} and after") for k in range(0, 295, 3)]
    for block in (7, 40):
        assert hits(spark, docs, items, block_words=block) == slow_hits(docs, items)
    pieces = dc._pieces(spark.createDataFrame(items, "i long, text string"), F.col("i"), F.col("text"),
                        20, 40).collect()
    assert len(pieces) > 8 and all(p.n <= 59 for p in pieces)


def test_many_blocks_read_the_documents_once(spark, monkeypatch):
    """Documents are read by one job whatever the number of blocks; blocks read stretches only."""
    calls = []
    write = dc.Scratch.write
    monkeypatch.setattr(dc.Scratch, "write", lambda self, df, name: (
        calls.append((name, df._jdf.queryExecution().toString())), write(self, df, name))[1])
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    args = docs, F.col("text"), bench, F.col("item_id"), F.col("text")
    few = dc.find_windows(*args)
    many = dc.find_windows(*args, block_words=80)
    assert sum(name == "decontaminate-hits" for name, _ in calls) >= 20
    assert [name for name, plan in calls if "documents.parquet" in plan] == ["decontaminate"]
    row = lambda df: sorted((r.d, r.n_words, str(r.spans), str(r["items"])) for r in df.select(
        F.col("row.doc_id").alias("d"), "n_words", "spans", "items").collect())
    assert row(many) == row(few)
    assert 0 < many.filter(F.size("spans") > 0).count() < docs.count()


def test_empty_tables(spark):
    assert hits(spark, [], [(1, "a")]) == []
    assert hits(spark, [(1, "a b")], []) == [(1, 2, 0, [])]


def test_query_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = [(d, n, h, len(f), hashlib.sha256(",".join(f).encode()).hexdigest(), h > 0)
            for d, n, h, f in slow_hits(docs, items)]
    got = [tuple(r) for r in dc.op2_decontamination(spark, SF).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and any(w[5] for w in want)


def test_spans_are_cut_and_covered_documents_marked(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [(1, f"Before it: {item.upper()}! after " + "w " * 30), (2, item), (3, "clean")]
    out = dc.decontaminate(clashing(spark.createDataFrame(docs, DOC)), "text",
                           spark.createDataFrame([(1, item)], "item_id long, text string"),
                           F.col("item_id"), F.col("text")).collect()
    got = {r.row.doc_id: (r.clean, r.n_hit, r.reject) for r in out}
    assert got[1] == ("Before it: ! after " + "w " * 30, 11, False)
    assert got[2] == ("", 11, True) and got[3] == ("clean", 0, False)


@pytest.mark.parametrize("block_words", [dc.BLOCK_WORDS, 6])
def test_whole_short_items_are_cut(spark, block_words):
    items = [(1, "who wrote the old book"), (2, "alpha beta gamma delta"), (3, "Yes"),
             (4, " ".join(f"long{i}" for i in range(12)))]
    rest = " ".join(f"w{i}" for i in range(40))
    docs = [(1, f"{rest} Who wrote the old book? {rest}"), (2, f"alpha beta gamma, {rest}"),
            (3, f"{rest}; yes. {rest} alpha beta gamma delta"), (4, f"{rest} {items[3][1]} {rest}")]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def clean(**params):
        out = dc.decontaminate(clashing(spark.createDataFrame(docs, DOC)), "text", bench,
                               F.col("item_id"), F.col("text"), block_words=block_words, **params)
        got = out.select("row.doc_id", "clean", "reject").collect()
        assert not any(r.reject for r in got)
        return sorted((r.doc_id, r.clean) for r in got)

    want = [(1, f"{rest} ? {rest}"), docs[1], (3, f"{rest}; . {rest} "), (4, f"{rest}  {rest}")]
    assert clean() == want and clean(max_span=20) == want
    assert all(h[2] == 0 for h in slow_hits(clean(), items))
