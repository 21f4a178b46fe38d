"""Benchmark decontamination with a generalised suffix automaton.

The words of all benchmark items build one suffix automaton.  The words of a document stream
through it, and at each word the automaton holds the longest run of words, ending there,
that occurs in an item.  Where that run is a window or longer (``window`` consecutive
item words; an item of fewer words is one window), its words are hit.  Runs of hit words
of at least ``max_span`` words, or that hold a whole item, are cut out of the text, and documents
in which more than ``max_coverage`` of the words are hit are marked for removal.

Only words within stretches of item n-grams are streamed: a window needs all its n-grams
to occur in items, so nothing is lost (an exact, vectorised filter).

Items are dealt to blocks of bounded size, longer ones in overlapping pieces, so that an automaton
does not grow with the benchmark.  One block's automaton streams over the documents.  With several
blocks the documents are read once, too: a filter of the hashes of all windows (bounded,
``FILTER_BITS``) leaves the few stretches of text that may hold one, and each block's automaton
streams over those.  The filter loses nothing; a benchmark of far over 20 million words fills
it, and more stretches pass.

Defined cases: null and empty texts have no words and no hits; an item without words has
no window; items of one id are reported once (null ids as empty text); a
document of fewer words than a window can still hold a short item; an empty benchmark
leaves all documents as they are.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import Scratch, forget, packed, small_batches, table, written
from marquee.llm.rolling import scrambled, word_ngrams, word_values, words_between

WINDOW = 10
#: Item words in one automaton (about 0.5 KB a word in a Python worker).
BLOCK_WORDS = 100_000
#: Length of the n-grams of an automaton's own filter, at most.
GRAM = 4
#: Bits of the windows' filter (32 MB), and bits that a window sets in it.
FILTER_BITS, PROBES = 28, 4
#: Production limits: any run of a whole window or item is cut; above this share the document goes.
MAX_SPAN, MAX_COVERAGE = 10, 0.5

#: Bytes to lower case, and every byte that is not part of a word to a blank.
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128
                  else 32 for c in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: The same for Spark, over characters.
_WORDS = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split() if text else []


class SuffixAutomaton:
    """Of several word sequences: states with transitions, suffix links and lengths."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, nxt: dict[int, int]) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """The part of q that extends p by w, as a state of its own."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[int]) -> list[int]:
        """Insert a sequence; returns the state of each of its prefixes."""
        last, states = 0, []
        for w in words:
            known = self.next[last].get(w)
            if known is not None:
                last = known if self.length[known] == self.length[last] + 1 \
                    else self._split(last, w, known)
            else:
                cur, p = self._state(self.length[last] + 1, 0, {}), last
                while p >= 0 and w not in self.next[p]:
                    self.next[p][w] = cur
                    p = self.link[p]
                if p >= 0:
                    q = self.next[p][w]
                    self.link[cur] = q if self.length[q] == self.length[p] + 1 \
                        else self._split(p, w, q)
                last = cur
            states.append(last)
        return states


class Benchmark:
    """The automaton of one block of items, and what it reports."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW,
                 whole: int = 0) -> None:
        """Items of fewer than ``whole`` words (all under ``window``) mark the spans that hold them."""
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.items = [i for i, _ in items]
        texts = [[self.vocab.setdefault(w, len(self.vocab)) for w in words_of(t)] for _, t in items]
        self.sam = SuffixAutomaton()
        for t in texts:
            self.sam.add(t)
        n = len(self.sam.next)
        self.of: list[set[int]] = [set() for _ in range(n)]      # items that hold the state's words
        short: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for k, t in enumerate(texts):
            v = 0
            for w in t:
                v = self.sam.next[v][w]
                u = v
                while u > 0 and k not in self.of[u]:
                    self.of[u].add(k)
                    u = self.sam.link[u]
            if 0 < len(t) < max(window, whole):
                short[v].append((len(t), k))
        # short items that end where a state does: its own and those of its suffixes
        self.short = short
        for v in sorted(range(1, n), key=self.sam.length.__getitem__):
            up = self.sam.link[v]
            if up > 0 and short[up]:
                short[v] = short[v] + short[up]
        sizes = [min(len(t), window) for t in texts if t]
        self.least = min(sizes, default=0)
        self.gram = min(GRAM, self.least)
        rng = np.random.default_rng(5)
        self.mult = rng.integers(1, 1 << 62, GRAM, dtype=np.uint64) | np.uint64(1)
        grams = [self._grams(np.array(t, np.int64)) for t in texts if len(t) >= self.gram] \
            if self.gram else []
        self.table = np.zeros(1 << 22, bool)
        if grams:
            self.table[np.concatenate(grams)] = True

    def _grams(self, ids: np.ndarray) -> np.ndarray:
        n = len(ids) - self.gram + 1
        h = np.zeros(n, np.uint64)
        for k in range(self.gram):
            h = (h + ids[k:k + n].astype(np.uint64)) * self.mult[k]
        return (h >> np.uint64(42)).astype(np.int64)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int, bool]], set[int]]:
        """Merged spans [start, end) of hit words, with whether they hold a whole short item, and
        the items whose windows occur."""
        if not self.least or len(words) < self.least:
            return [], set()
        ids = np.array(list(map(self.vocab.get, words, repeat(-1))), np.int64)
        known = ids >= 0
        if self.gram > 1:
            n = len(ids) - self.gram + 1
            open_ = self.table[self._grams(ids)]
            for k in range(self.gram):
                open_ &= known[k:k + n]
        else:
            open_ = known
        if not open_.any():
            return [], set()
        edge = np.flatnonzero(np.diff(np.concatenate(([0], open_.view(np.int8), [0]))))
        spans: list[tuple[int, int, bool]] = []
        found: set[int] = set()
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b - a + self.gram - 1 >= self.least:
                self._stream(ids[a:b + self.gram - 1].tolist(), a, spans, found)
        merged: list[tuple[int, int, bool]] = []
        for a, b, whole in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]), whole or merged[-1][2])
            else:
                merged.append((a, b, whole))
        return merged, found

    def _stream(self, ids: list[int], at: int, spans: list, found: set[int]) -> None:
        nxt, link, length, window = self.sam.next, self.sam.link, self.sam.length, self.window
        v = run = 0
        for end, w in enumerate(ids, at + 1):
            while v and w not in nxt[v]:
                v = link[v]
                run = length[v]
            if w in nxt[v]:
                v = nxt[v][w]
                run += 1
            if run >= window:
                u = v
                while length[link[u]] >= window:
                    u = link[u]
                found |= self.of[u]
                spans.append((end - run, end, False))
            for size, k in self.short[v]:
                if size <= run:
                    found.add(k)
                    spans.append((end - size, end, True))


_SPANS = "array<struct<start:int,stop:int,whole:boolean>>"
_RESULT = f"n_words long, spans {_SPANS}, items array<string>, clean string"


def _cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the bytes from the first to the last word of each span."""
    raw = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in _WORD.finditer(raw)]
    out, last = [], 0
    for a, b in spans:
        out.append(raw[last:at[a][0]])
        last = at[b - 1][1]
    return b"".join([*out, raw[last:]]).decode("utf-8", "surrogatepass")


#: The automaton built last in this Python process, by its token.
_BUILT: dict[str, Benchmark] = {}


def _built(token: str, shared, window: int, whole: int) -> Benchmark:
    """The automaton of a block, built once for all tasks of a Python process in a row."""
    if token not in _BUILT:
        _BUILT.clear()
        _BUILT[token] = Benchmark(shared.value, window, whole)
    return _BUILT[token]


def _scanner(shared, window: int, whole: int):
    """Scan texts with one block's automaton."""
    token = uuid.uuid4().hex

    @F.pandas_udf(_RESULT)
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bench = _built(token, shared, window, whole)
        for batch in texts:
            rows = []
            for t in batch:
                words = words_of(t)
                spans, found = bench.scan(words)
                rows.append((len(words), [{"start": a, "stop": b, "whole": c} for a, b, c in spans],
                             sorted({bench.items[k] for k in found}), None))
            yield pd.DataFrame(rows, columns=["n_words", "spans", "items", "clean"])
    return scan


def _count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORDS)), F.lit(0))


def _cleaned(text: str, starts: Column, stops: Column) -> Column:
    @F.pandas_udf("string")
    def cut(texts: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.Series:
        return pd.Series([_cut(t, list(zip(a, b))) if t is not None and len(a) else t
                          for t, a, b in zip(texts, starts, stops)], dtype=object)
    return cut(text, starts, stops)


def _merge(spans: Column) -> Column:
    """Sorted spans of several blocks as maximal runs (DataFrame functions)."""
    def step(acc, s):
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"),
            (last["whole"] | s["whole"]).alias("whole"))))
        return (F.when(F.size(acc) == 0, F.array(s))
                 .when(s["start"] <= last["stop"], joined).otherwise(F.concat(acc, F.array(s))))
    empty = F.array().cast(_SPANS)
    return F.aggregate(F.array_sort(spans), empty, step)


def _word_values(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the text (words in lower case, blanks between), starts, stops and values of words."""
    flat = (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS)
    raw = np.frombuffer(flat, np.uint8)
    starts, stops = words_between(raw == 32)
    return raw, starts, stops, word_values(raw, starts, stops)


def _slots(values: np.ndarray, size: int) -> np.ndarray:
    """Bits of the filter that each run of ``size`` words sets: one row a probe."""
    at = np.arange(len(values) - size + 1)
    h = scrambled(word_ngrams(values, at, at + size) + np.uint64(size))
    step = scrambled(h) | np.uint64(1)
    return np.stack([(h + np.uint64(k) * step) >> np.uint64(64 - FILTER_BITS)
                     for k in range(PROBES)]).astype(np.int64)


def window_filter(items: DataFrame, window: int) -> tuple[list[int], np.ndarray]:
    """Sizes of the windows of ``text``, and the bytes of a filter of all of them: bits are put
    together by Spark's bitmaps, 2^FILTER_BITS at most whatever the benchmark."""
    def slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for text in b["text"]:
                values = _word_values(text)[3]
                size = min(window, len(values))
                if size:
                    yield pd.DataFrame({"slot": np.unique(_slots(values, size)), "size": size})

    found = items.select("text").mapInPandas(slots, "slot long, size int")
    no = F.col("slot") + 1                       # Spark's first bucket holds bits 1 to 32768
    marks = found.groupBy(F.bitmap_bucket_number(no).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(no)).alias("bits"),
        F.collect_set("size").alias("sizes"))
    bits, sizes = np.zeros(1 << FILTER_BITS - 3, np.uint8), set()
    for r in marks.toLocalIterator():
        part = np.frombuffer(bytes(r.bits), np.uint8)
        at = (r.bucket - 1) * len(part)
        bits[at:at + len(part)] = part
        sizes.update(r.sizes)
    return sorted(sizes), bits


def _stretches(shared):
    """Words of a text, and its maximal runs of words that may lie in windows."""
    @F.pandas_udf("n_words long, stretches array<struct<start:int,text:string>>")
    def find(texts: pd.Series) -> pd.DataFrame:
        sizes, bits = shared.value
        rows = []
        for t in texts:
            raw, starts, stops, values = _word_values(t)
            n = len(values)
            turns = np.zeros(n + 1, np.int64)
            for size in sizes:
                if n >= size:
                    slots = _slots(values, size)
                    at = np.flatnonzero((bits[slots >> 3] >> (slots & 7) & 1).all(axis=0))
                    turns[at] += 1
                    turns[at + size] -= 1
            edge = np.flatnonzero(np.diff(np.cumsum(turns) > 0, prepend=False, append=False))
            rows.append((n, [{"start": int(a), "text": raw[starts[a]:stops[b - 1]].tobytes().decode(
                "utf-8", "surrogatepass")} for a, b in zip(edge[::2], edge[1::2])]))
        return pd.DataFrame(rows, columns=["n_words", "stretches"])
    return find


def _pieces(items: DataFrame, item_id: Column, item_text: Column, least: int,
            block_words: int) -> DataFrame:
    """Items with words, ``id``, ``text`` and number of words ``n``; those of more than a block's
    words in pieces that overlap, of ``least`` words or more each."""
    step = max(block_words, least)
    words = F.regexp_extract_all("text", F.lit(f"({_WORDS})"))
    at = F.explode(F.sequence(F.lit(0), F.greatest(F.col("n") - least, F.lit(0)), F.lit(step)))
    every = (items.select(F.coalesce(item_id.cast("string"), F.lit("")).alias("id"),
                          item_text.alias("text")).distinct()
             .withColumn("n", _count_words(F.col("text"))).filter("n > 0"))
    piece = F.array_join(F.slice(words, F.col("at") + 1, F.lit(step + least - 1)), " ")
    return (every.select("id", "text", "n", at.alias("at"))
            .select("id", F.when(F.col("n") <= step, F.col("text")).otherwise(piece).alias("text"))
            .withColumn("n", _count_words(F.col("text"))))


def find_windows(df: DataFrame, text: Column, items: DataFrame, item_id: Column,
                 item_text: Column, window: int = WINDOW,
                 block_words: int = BLOCK_WORDS, whole: int = 0) -> DataFrame:
    """Columns ``row`` (input row as a struct), ``text``, ``n_words``, ``spans`` of hit words
    (``whole``: they hold an item that has fewer words than a window, or than ``whole``) and
    ``items`` (ids as text, sorted, of the items with windows in the text)."""
    spark = df.sparkSession
    docs = packed(df, text=text)
    bench = written(_pieces(items, item_id, item_text, max(window, whole), block_words), "items")
    total = bench.agg(F.sum("n")).first()[0] or 0
    n_blocks = max(1, -(-total // block_words))

    def scanner(k: int):
        block = bench.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == k)
        shared = spark.sparkContext.broadcast([(r[0], r[1]) for r in block.select(
            "id", "text").collect()])
        return _scanner(shared, window, whole)

    if n_blocks > 1:
        with Scratch(spark) as scratch:
            scratch.adopt(bench)
            return _by_blocks(scratch, docs, bench, window, scanner, n_blocks)
    small_batches(spark)
    out = docs.select("row", "text", scanner(0)("text").alias("hit")).select(
        "row", "text", "hit.n_words", "hit.spans", "hit.items")
    forget(bench)
    return out


def _by_blocks(scratch: Scratch, docs: DataFrame, bench: DataFrame, window: int, scanner,
               n_blocks: int) -> DataFrame:
    """One pass over the documents for their stretches, then each block over the stretches."""
    shared = docs.sparkSession.sparkContext.broadcast(window_filter(bench, window))
    docs = scratch.keep(scratch.write(
        docs.withColumn("found", _stretches(shared)("text")).select(
            "row", "text", "found.*", F.monotonically_increasing_id().alias("key")),
        "decontaminate"))
    parts = scratch.write(docs.filter(F.size("stretches") > 0).select(
        "key", F.explode("stretches").alias("s")).select("key", "s.*"), "decontaminate-stretches")
    at = F.col("start")
    shifted = F.transform("hit.spans", lambda s: F.struct(
        (s["start"] + at).alias("start"), (s["stop"] + at).alias("stop"), s["whole"].alias("whole")))
    hits = []
    for k in range(n_blocks):
        hit = parts.select("key", "start", scanner(k)("text").alias("hit"))
        hits.append(scratch.write(hit.filter(F.size("hit.spans") > 0).select(
            "key", shifted.alias("spans"), "hit.items"), "decontaminate-hits"))
    found = scratch.keep(scratch.write(reduce(DataFrame.union, hits).groupBy("key").agg(
        _merge(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")),
        "decontaminate-found"))
    return docs.join(found, "key", "left").select(
        "row", "text", "n_words", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def decontaminate(df: DataFrame, text: str, items: DataFrame, item_id: Column, item_text: Column,
                  window: int = WINDOW, max_span: int = MAX_SPAN,
                  max_coverage: float = MAX_COVERAGE, **params) -> DataFrame:
    """``row`` with ``clean`` (the text without spans of ``max_span`` words or more, or that hold a
    whole item), ``n_hit``, ``items`` and ``reject`` (over ``max_coverage`` of the words are hit)."""
    found = find_windows(df, F.col(f"`{text}`"), items, item_id, item_text, window,
                         whole=max_span, **params)
    long = F.filter("spans", lambda s: (s["stop"] - s["start"] >= max_span) | s["whole"])
    return (found.withColumn("n_hit", hit_words())
            .withColumn("cut", long)
            .select("row", "n_words", "n_hit", "items",
                    F.when(F.size("cut") > 0, _cleaned("text", F.col("cut.start"),
                                                       F.col("cut.stop")))
                    .otherwise(F.col("text")).alias("clean"),
                    (F.col("n_hit") > max_coverage * F.col("n_words")).alias("reject")))


def hit_words() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"),
                       lambda n, s: n + (s["stop"] - s["start"]).cast("long"))


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    found = find_windows(table(spark, sf_dir, "documents"), F.col("text"),
                         table(spark, sf_dir, "benchmark"), F.col("item_id"), F.col("text"))
    items = F.array_join("items", ",")
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(items.cast("binary"), 256).alias("items_sha256"),
        (hit_words() > 0).alias("contaminated"))
