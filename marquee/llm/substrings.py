"""Exact substring de-duplication with suffix arrays.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts earlier: in a
document of smaller id, or in the same one at a smaller offset.

Equal strings are brought together by anchors: of the ``GRAM``-byte hashes in a string of
``LENGTH`` bytes, the smallest (leftmost of equal ones) depends on the string alone.  An anchor
stands for the run of strings (windows) that it is the smallest of, and carries the hash of their
bytes.  About one anchor in 40 bytes is shuffled (24 bytes each), dealt by its hash:

* an anchor whose hash occurs once stands for strings that occur once;
* of anchors that agree in hash and bytes, all but the earliest stand for repeats;
* where anchors agree in hash but not in bytes (the borders of repeats), the earliest of
  each kind fetch their bytes, and an enhanced suffix array is built over them: a stack
  scan of its common prefixes yields the intervals of the prefix tree of at least ``LENGTH``,
  those whose occurrences differ to the left are maximal repeats, and all their
  occurrences but the earliest are repeats.

Hashes that are common in a sample of documents are hot: their anchors are split into their single
windows, dealt by the window's own hash, so that a passage in a third of all documents does not meet
in one task.  The sample only routes; results do not depend on it.  It grows with the corpus, so
that a hash of more than about ``HOT_DOCS`` documents is found at any size (of a small corpus, one
of more than ``HOT_SHARE``); should there be over ``MAX_HOT`` of them, the most frequent are taken,
and any other holds at most a ``MAX_HOT``-th of all anchors.
Repeats inside one task are settled there, before any shuffle: of records that agree only the
earliest is dealt by its hash, the others travel as merged spans to any bucket.  So a run of one
byte or of a short period, which has an anchor a byte, is one record a task.

Defined cases: null text is empty; null ids come before all others; rows of one id come
in order of their text, as parts of one document between which nothing matches; of equal
rows the first stays; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from marquee.llm.common import small_batches, table, written
from marquee.session import scratch_path

LENGTH, GRAM = 100, 20
#: Documents looked at for hot hashes (or more, see HOT_DOCS), and the share that makes one hot.
HOT_SAMPLE, HOT_SHARE = 2000, 0.01
#: Documents that may share a hash that is not hot, and the most hot hashes (8 bytes each, broadcast).
HOT_DOCS, MAX_HOT = 50_000, 1 << 20
#: Anchors, and documents, that a task settles at once.
TASK_ANCHORS, TASK_DOCS = 1 << 20, 60_000
#: Merged spans of one blob (24 bytes each).
BLOB_SPANS = 1 << 15
#: Bytes of anchors, and of border strings, that one group of a shuffle holds on average.
ANCHOR_BUCKET, BORDER_BUCKET = 8 << 20, 1 << 20
#: Bytes hashed at once.
CHUNK = 1 << 19
NO_ID = -(1 << 63)

_U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=_U) | _U(1)
_BASE = 0x9E3779B97F4A7C15
_RECORD = np.dtype([("gram", "<u8"), ("ctx", "<u8"), ("pos", "<u4"), ("doc", "<u2"),
                    ("lo", "u1"), ("n", "u1")])


def _powers(base: int, n: int) -> np.ndarray:
    p = np.ones(n, _U)
    k = 1
    while k < n:
        m = min(k, n - k)
        p[k:k + m] = p[:m] * _U(pow(base, k, 1 << 64))
        k += m
    return p


_POWER = _powers(_BASE, CHUNK + 1)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), CHUNK + 1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(29))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(32))


class Hashes:
    """Hashes of all substrings of a buffer of at most ``CHUNK`` bytes."""

    def __init__(self, buf: np.ndarray) -> None:
        self.sums = np.zeros(len(buf) + 1, _U)
        np.cumsum(_BYTE[buf] * _POWER[:len(buf)], out=self.sums[1:])

    def of(self, start, stop) -> np.ndarray:
        return _mix((self.sums[stop] - self.sums[start]) * _INVERSE[start])

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mix((self.sums[size:] - self.sums[:n]) * _INVERSE[:n])


def _smallest(keys: np.ndarray, w: int) -> np.ndarray:
    """The smallest of each w consecutive keys."""
    n = len(keys)
    padded = np.full(-(-n // w) * w, np.iinfo(_U).max, _U)
    padded[:n] = keys
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def anchors(buf: np.ndarray, part: np.ndarray, length: int, gram: int,
            hot: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """Of a buffer of several texts (``part``: the text of each byte): hash, hash of the bytes,
    first window, anchor's distance from it and further windows of each anchor."""
    none = (np.empty(0, _U), np.empty(0, _U), *(np.empty(0, np.int64) for _ in range(3)))
    if len(buf) < length:
        return none
    hashes = Hashes(buf)
    grams = hashes.all(gram)
    at = np.arange(len(grams), dtype=_U)
    low = _U((1 << 20) - 1)
    place = (_smallest((grams & ~low) | at, length - gram + 1) & low).astype(np.int64)
    whole = np.flatnonzero(part[:len(place)] == part[length - 1:length - 1 + len(place)])
    if not len(whole):
        return none
    place = place[whole]
    first = np.flatnonzero(np.concatenate(
        ([True], (place[1:] != place[:-1]) | (whole[1:] != whole[:-1] + 1))))
    start, p = whole[first], place[first]
    more = np.diff(np.append(first, len(whole))) - 1
    g = grams[p]
    lo = p - start
    if hot is not None and len(hot):
        k = np.minimum(np.searchsorted(hot, g), len(hot) - 1)
        split = hot[k] == g
        if split.any():                       # one record for each window of a hot hash
            n = more[split] + 1
            s = np.repeat(start[split], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            zero = np.zeros(len(s), np.int64)
            keep = ~split
            start, lo, more = (np.concatenate(x) for x in (
                (start[keep], s), (lo[keep], zero), (more[keep], zero)))
            window = hashes.of(s, s + length)
            g = np.concatenate((g[keep], _mix(window ^ _U(0xA5A5A5A55A5A5A5A))))
    ctx = _mix(hashes.of(start, start + more + length) + (lo.astype(_U) << _U(8)) + more.astype(_U))
    return g, ctx, start, lo, more


def _chunks(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Buffers of at most ``CHUNK`` bytes, with the text of each byte and, by text, what to add
    to a buffer's offset for the text's; longer texts in pieces that overlap by length - 1."""
    held, ids, shift, size = [], [], np.zeros(len(texts), np.int64), 0

    def flush():
        lens = [len(h) for h in held]
        return (np.frombuffer(b"".join(held), np.uint8), np.repeat(ids, lens), shift.copy())

    for i, t in enumerate(texts):
        for a in range(0, max(1, len(t) - length + 1), CHUNK - length):
            piece = t[a:a + CHUNK - 1] if len(t) > CHUNK - 1 else t
            if size + len(piece) > CHUNK or (held and ids[-1] == i):
                yield flush()
                held, ids, size = [], [], 0
            shift[i] = a - size
            held.append(piece)
            ids.append(i)
            size += len(piece)
            if len(t) <= CHUNK - 1:
                break
    if held:
        yield flush()


def _again(*keys: np.ndarray) -> np.ndarray:
    """Which rows, sorted by the keys, equal the one before."""
    out = np.zeros(len(keys[0]), bool)
    if len(out):
        out[1:] = np.logical_and.reduce([k[1:] == k[:-1] for k in keys])
    return out


def _merged(d: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Rows (d, start, stop) in which spans of one d that meet or overlap are one."""
    if not len(d):
        return np.empty((0, 3), np.int64)
    o = np.lexsort((s, d))
    d, s, e = d[o], s[o], e[o]
    new = ~_again(d)
    reach = pd.Series(e).groupby(np.cumsum(new)).cummax().to_numpy()
    first = np.flatnonzero(new | np.concatenate(([True], s[1:] > reach[:-1])))
    return np.column_stack([d[first], s[first], reach[np.append(first[1:], len(d)) - 1]])


def text_anchors(texts: list[bytes], length: int, gram: int, hot: np.ndarray | None,
                 settled: list[np.ndarray] | None = None) -> np.ndarray:
    """Anchor records of the texts; ``pos`` is the first window's offset in its text.  With
    ``settled``, records that agree with an earlier one of their text and buffer go there, as
    merged rows (text, start, stop)."""
    out = []
    for buf, part, shift in _chunks(texts, length):
        g, ctx, start, lo, more = anchors(buf, part, length, gram, hot)
        r = np.empty(len(g), _RECORD)
        r["gram"], r["ctx"], r["lo"], r["n"] = g, ctx, lo, more
        if len(g):
            r["doc"] = part[start]
            r["pos"] = start + shift[part[start]]
        if settled is not None:
            r = r[np.lexsort((r["pos"], r["ctx"], r["gram"], r["doc"]))]
            again = _again(r["gram"], r["ctx"], r["doc"])
            if again.any():
                done, r = r[again], r[~again]
                at = done["pos"].astype(np.int64)
                settled.append(_merged(done["doc"].astype(np.int64), at, at + done["n"] + length))
        out.append(r)
    return np.concatenate(out) if out else np.empty(0, _RECORD)


# -- the enhanced suffix array ------------------------------------------------------------

def suffix_array(pieces: list[bytes], length: int):
    """Suffixes of at least ``length`` bytes of the pieces, sorted; the common prefix of each
    with the one before; their offsets in the pieces joined by an end mark."""
    n = sum(map(len, pieces)) + len(pieces)
    text = np.zeros(n + 256, np.int64)
    left = np.zeros(n, np.int64)                       # bytes to the end of the piece
    at = 0
    for p in pieces:
        text[at:at + len(p)] = np.frombuffer(p, np.uint8).astype(np.int64) + 1
        left[at:at + len(p)] = np.arange(len(p), 0, -1)
        at += len(p) + 1
    longest = max(map(len, pieces)) + 1
    key = np.zeros(n, np.int64)
    for k in range(7):
        key = (key << 9) | text[k:k + n]
    ranks: list[tuple[int, np.ndarray]] = []
    size = 7
    while True:
        order = np.argsort(key)                       # equal keys are equal strings so far
        s = key[order]
        rank = np.empty(n + 256, np.int64)
        rank[n:] = 0
        rank[order] = np.cumsum(np.concatenate(([1], (s[1:] != s[:-1]).astype(np.int64))))
        ranks.append((size, rank))
        if size >= longest:
            break
        ahead = np.zeros(n, np.int64)
        if size < n:
            ahead[:n - size] = rank[size:n]
        key = rank[:n] * (n + 2) + ahead
        size *= 2
    sa = order[left[order] >= length]
    a, b = sa[:-1], sa[1:]
    lcp = np.zeros(len(a), np.int64)
    for size, rank in reversed(ranks):
        same = rank[np.minimum(a + lcp, n)] == rank[np.minimum(b + lcp, n)]
        lcp += np.where(same & (a + lcp < n) & (b + lcp < n), size, 0)
    for _ in range(6):
        lcp += (text[a + lcp] == text[b + lcp]) & (text[a + lcp] > 0)
    lcp = np.minimum(lcp, np.minimum(left[a], left[b]))
    return sa, np.concatenate(([0], lcp)), text


def repeat_intervals(lcp: list[int], length: int) -> list[tuple[int, int, int]]:
    """(first, last, depth) of the intervals of the common-prefix tree of at least ``length``."""
    out, stack = [], []                                # open intervals: depth, first suffix
    for i in range(1, len(lcp) + 1):
        depth = lcp[i] if i < len(lcp) else 0
        first = i - 1
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            out.append((first, i - 1, d))
        if depth >= length and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))
    return out


def maximal_repeats(pieces: list[bytes], length: int) -> Iterator[tuple[int, np.ndarray]]:
    """Maximal repeats of at least ``length`` bytes: their size and all occurrences, as offsets
    in the pieces joined by an end mark."""
    if not pieces:
        return
    sa, lcp, text = suffix_array(pieces, length)
    if not len(sa):
        return
    before = np.where(sa > 0, text[sa - 1], 0)
    # occurrences that differ in the byte before them; a piece's start differs from all
    change = np.concatenate(([0], np.cumsum((before[1:] != before[:-1])
                                            | (before[1:] == 0) | (before[:-1] == 0))))
    # only neighbours that share enough take part in the scan
    shares = lcp >= length
    part = np.flatnonzero(shares | np.append(shares[1:], False))
    for a, b, depth in repeat_intervals(np.where(shares, lcp, 0)[part].tolist(), length):
        a, b = part[a], part[b]
        if change[a] != change[b]:
            yield depth, sa[a:b + 1]


# -- on Spark -----------------------------------------------------------------------------

def _bucketed(df: DataFrame, buckets: int, by: str) -> DataFrame:
    """Write a table bucketed by a column in the shared folder; later joins on that column
    do not move its rows again."""
    spark = df.sparkSession
    name = f"llm_{uuid.uuid4().hex[:12]}"
    (df.write.bucketBy(buckets, by).sortBy(by).option("path", scratch_path(spark, "llm-texts"))
       .option("compression", "zstd").saveAsTable(name))
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")               # resolved; the files of its path stay
    return out


def hot_grams(texts: DataFrame, n: int, length: int, gram: int) -> np.ndarray:
    """Sorted anchor hashes that are common in a sample of the ``n`` documents."""
    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            r = text_anchors([bytes(t) for t in b["raw"]], length, gram, None)
            once = np.unique(r[["gram", "doc"]])["gram"]
            yield pd.DataFrame({"gram": once.view(np.int64)})
    least = max(8, int(HOT_SHARE * HOT_SAMPLE))
    size = max(HOT_SAMPLE, math.ceil(least * n / HOT_DOCS))
    fine = 1 << 40
    draw = F.pmod(F.xxhash64(F.lit(13), "d", "base"), F.lit(fine))
    sample = texts.filter(draw < min(fine, math.ceil(size / max(1, n) * fine))).select("raw")
    rows = (sample.mapInPandas(grams, "gram long").groupBy("gram").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= least).orderBy(F.desc("n"), "gram").limit(MAX_HOT)
            .select("gram").collect())
    return np.sort(np.array([r.gram for r in rows], np.int64).view(_U))


SPANS = "d long, start long, stop long, gram long, lo int"


def _spans(d, start, stop, gram=None, lo=None) -> pd.DataFrame:
    n = len(d)
    return pd.DataFrame({
        "d": d, "start": start, "stop": stop,
        "gram": pd.array(gram, dtype="Int64") if gram is not None else pd.array([pd.NA] * n, dtype="Int64"),
        "lo": np.zeros(n, np.int32) if lo is None else lo.astype(np.int32)})


def _emit(batches: Iterator[pd.DataFrame], length: int, gram: int, hot: np.ndarray,
          buckets: int) -> Iterator[pd.DataFrame]:
    """Anchors of a task's documents, packed by bucket, with the task's own repeats settled."""
    found, docs, n_found, n_docs = [], [], 0, 0
    for b in batches:
        for at in range(0, len(b), TASK_DOCS):
            part = b.iloc[at:at + TASK_DOCS]
            own: list[np.ndarray] = []
            r = text_anchors([bytes(t) for t in part["raw"]], length, gram, hot, own)
            of = np.column_stack([part["d"].to_numpy(np.int64), part["base"].to_numpy(np.int64)])
            if own:
                t, start, stop = np.concatenate(own).T
                yield _blobs(_span_blobs(of[t, 0], of[t, 1] + start, of[t, 1] + stop, buckets))
            if n_docs and (n_found + len(r) > TASK_ANCHORS or n_docs + len(part) > TASK_DOCS):
                yield _packed(np.concatenate(found), np.concatenate(docs), buckets, length)
                found, docs, n_found, n_docs = [], [], 0, 0
            r["doc"] += np.uint16(n_docs)
            found.append(r)
            docs.append(of)
            n_found, n_docs = n_found + len(r), n_docs + len(part)
    if n_docs:
        yield _packed(np.concatenate(found), np.concatenate(docs), buckets, length)


def _blobs(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["bucket", "kind", "n", "blob"])


def _span_blobs(d: np.ndarray, s: np.ndarray, e: np.ndarray, buckets: int) -> list[tuple]:
    """Blobs of merged spans, for buckets that depend on where they are and not on their hash."""
    spans = _merged(d, s, e)
    rows = []
    for i in range(0, len(spans), BLOB_SPANS):
        part = spans[i:i + BLOB_SPANS]
        salt = _mix(part[0, :2].astype(_U))
        rows.append((int((salt[0] ^ (salt[1] >> _U(1))) % _U(buckets)), 1, len(part), part.tobytes()))
    return rows


def _packed(r: np.ndarray, docs: np.ndarray, buckets: int, length: int) -> pd.DataFrame:
    """Blobs of anchors by bucket: ``n`` (id, base) pairs of documents, then records (``kind`` 0).
    Of records that agree the earliest is among them; the others are repeats already and only
    pass through to the spans, as ``n`` triples of id, start and stop (``kind`` 1)."""
    by_id = np.lexsort((docs[:, 1], docs[:, 0]))
    place = np.empty(len(docs), np.uint16)
    place[by_id] = np.arange(len(docs), dtype=np.uint16)
    docs, r["doc"] = docs[by_id], place[r["doc"]]
    r = r[np.lexsort((r["pos"], r["doc"], r["ctx"], r["gram"]))]
    again = _again(r["gram"], r["ctx"])
    done, r = r[again], r[~again]
    start = docs[done["doc"], 1] + done["pos"]
    rows = _span_blobs(docs[done["doc"], 0], start, start + done["n"] + length, buckets)
    where = (r["gram"] >> _U(40)) % _U(buckets)
    o = np.argsort(where, kind="stable")
    r, where = r[o], where[o]
    cut = np.flatnonzero(~_again(where))
    for i, j in zip(cut, np.append(cut[1:], len(where))):
        sub = r[i:j].copy()
        used, sub["doc"] = np.unique(sub["doc"], return_inverse=True)
        rows.append((int(where[i]), 0, len(used), docs[used].tobytes() + sub.tobytes()))
    return _blobs(rows)


def _settle(b: pd.DataFrame, length: int) -> pd.DataFrame:
    """All anchors of a bucket: repeats as spans, and the borders' first ones as requests."""
    recs, ids, bases = [np.empty(0, _RECORD)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    done = [np.empty((0, 3), np.int64)]
    for kind, n, blob in zip(b["kind"], b["n"], b["blob"]):
        if kind == 1:
            done.append(np.frombuffer(blob, np.int64).reshape(n, 3))
            continue
        docs = np.frombuffer(blob, np.int64, 2 * n).reshape(n, 2)
        r = np.frombuffer(blob, _RECORD, offset=16 * n)
        recs.append(r)
        ids.append(docs[r["doc"], 0])
        bases.append(docs[r["doc"], 1] + r["pos"])
    r, d, s = np.concatenate(recs), np.concatenate(ids), np.concatenate(bases)
    e = s + r["n"] + length
    out = []
    o = np.lexsort((s, d, r["ctx"], r["gram"]))
    r, d, s, e = r[o], d[o], s[o], e[o]
    if len(r):
        new_gram = np.concatenate(([True], r["gram"][1:] != r["gram"][:-1]))
        new_ctx = new_gram | np.concatenate(([True], r["ctx"][1:] != r["ctx"][:-1]))
        done.append(np.column_stack([d[~new_ctx], s[~new_ctx], e[~new_ctx]]))
        group = np.cumsum(new_gram) - 1
        border = new_ctx & (np.bincount(group, new_ctx)[group] > 1)
        out.append(_spans(d[border], s[border], e[border],
                          r["gram"][border].view(np.int64), r["lo"][border]))
    return pd.concat([_spans(*_merged(*np.concatenate(done).T).T), *out], ignore_index=True)


def _border(b: pd.DataFrame, length: int) -> pd.DataFrame:
    """Repeats among border strings: all occurrences of a maximal repeat but the earliest."""
    pieces = [bytes(p) for p in b["piece"]]
    d, s = b["d"].to_numpy(np.int64), b["start"].to_numpy(np.int64)
    ends = np.cumsum([len(p) + 1 for p in pieces])
    begin = ends - [len(p) + 1 for p in pieces]
    out_d, out_s, out_e = [], [], []
    for depth, where in maximal_repeats(pieces, length):
        k = np.searchsorted(ends, where, side="right")
        at = s[k] + where - begin[k]
        if len(k) == 2:
            i, j = k
            late = 1 if (d[i], at[0]) < (d[j], at[1]) else 0
            out_d.append(d[k[late]:k[late] + 1])
            out_s.append(at[late:late + 1])
        else:
            first = np.lexsort((at, d[k]))[0]
            rest = np.arange(len(k)) != first
            out_d.append(d[k][rest])
            out_s.append(at[rest])
        out_e.append(out_s[-1] + depth)
    cat = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
    spans = pd.DataFrame({"d": cat(out_d), "start": cat(out_s), "stop": cat(out_e)})
    return spans


def repeats(df: DataFrame, id_: Column, text: Column, length: int = LENGTH,
            gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): a table of ``d`` (id; null as the smallest long), ``base`` (offset of the
    row's text among the rows of its id) and ``raw`` bytes, bucketed by ``d``; and rows (d,
    start, stop) of repeated bytes, which may overlap."""
    if not 0 < gram <= length <= 256:
        raise ValueError("0 < gram <= length <= 256")
    spark = df.sparkSession
    small_batches(spark)
    rows = df.select(F.coalesce(id_.cast("long"), F.lit(NO_ID)).alias("d"),
                     F.coalesce(text, F.lit("")).cast("binary").alias("raw"))
    earlier = Window.partitionBy("d").orderBy("raw").rowsBetween(Window.unboundedPreceding, -1)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = _bucketed(rows.repartition(parts, "d").withColumn("base", F.coalesce(
        F.sum(F.octet_length("raw").cast("long") + 1).over(earlier), F.lit(0))), parts, "d")
    total, n = texts.agg(F.sum(F.octet_length("raw").cast("long")), F.count("*")).first()
    total = total or 0
    hot = spark.sparkContext.broadcast(hot_grams(texts, n, length, gram))
    stride = (length - gram + 2) / 2
    buckets = max(1, parts, math.ceil(total / stride * _RECORD.itemsize / ANCHOR_BUCKET))

    def emit(batches):
        return _emit(batches, length, gram, hot.value, buckets)

    found = written(
        texts.mapInPandas(emit, "bucket int, kind int, n int, blob binary")
        .groupBy("bucket").applyInPandas(lambda b: _settle(b, length), SPANS), "repeat-spans")
    asked = found.filter(F.col("gram").isNotNull())
    size = asked.agg(F.sum(F.col("stop") - F.col("start"))).first()[0] or 0
    groups = max(1, parts, math.ceil(size / BORDER_BUCKET))

    # the bytes of border strings, fetched where their document lies
    wanted = asked.groupBy("d").agg(F.collect_list(F.struct("start", "stop", "gram")).alias("want"))
    pieces = (texts.join(wanted, "d")
              .select("d", "base", "raw", F.explode("want").alias("w"))
              .filter((F.col("w.start") >= F.col("base"))
                      & (F.col("w.stop") <= F.col("base") + F.octet_length("raw")))
              .select(F.pmod(F.xxhash64("w.gram"), F.lit(groups)).alias("group"), "d",
                      F.col("w.start").alias("start"),
                      F.substring(F.col("raw"), (F.col("w.start") - F.col("base") + 1).cast("int"),
                                  (F.col("w.stop") - F.col("w.start")).cast("int")).alias("piece")))
    borders = pieces.groupBy("group").applyInPandas(
        lambda b: _border(b, length), "d long, start long, stop long")
    spans = found.filter(F.col("gram").isNull()).select("d", "start", "stop").union(borders)
    return texts, spans


CLEANED = "d long, n_bytes long, n_removed long, n_spans long, kept binary"


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for d, base, raw, spans in zip(b["d"], b["base"], b["raw"], b["spans"]):
            raw, removed, runs = bytes(raw), 0, 0
            if spans is not None and len(spans):
                at = np.frombuffer(spans, np.int64).reshape(-1, 2) if isinstance(spans, bytes) \
                    else np.array([(s["start"], s["stop"]) for s in spans], np.int64)
                at = at[(at[:, 0] >= base) & (at[:, 0] < base + len(raw))] - base
                kept, last = [], 0
                at = at[np.argsort(at[:, 0], kind="stable")]
                stop = np.maximum.accumulate(at[:, 1]) if len(at) else at[:, 1]
                first = np.flatnonzero(np.concatenate(([True], at[1:, 0] > stop[:-1]))) \
                    if len(at) else []
                for k, i in enumerate(first):
                    a = int(at[i, 0])
                    z = int(stop[first[k + 1] - 1]) if k + 1 < len(first) else int(stop[-1])
                    kept.append(raw[last:a])
                    removed += z - a
                    runs += 1
                    last = z
                kept.append(raw[last:])
                out = b"".join(kept)
            else:
                out = raw
            rows.append((d, len(raw), removed, runs, out))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in CLEANED.split(", ")])


def remove_repeats(df: DataFrame, id_: Column, text: Column, length: int = LENGTH,
                   gram: int = GRAM) -> DataFrame:
    """One row a document: ``d``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (bytes)."""
    texts, spans = repeats(df, id_, text, length, gram)
    by_doc = spans.groupBy("d").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return (texts.join(by_doc, "d", "left").select("d", "base", "raw", "spans")
            .mapInPandas(_cut, CLEANED))


def op4_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents, strings of 100 bytes."""
    out = remove_repeats(table(spark, sf_dir, "documents"), F.col("doc_id"), F.col("text"))
    return out.select(F.when(F.col("d") != NO_ID, F.col("d")).alias("doc_id"), "n_bytes",
                      "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
