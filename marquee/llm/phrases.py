"""Frequent phrases by Rabin-Karp fingerprints, ranked by how much they hang together.

1. Texts are packed into chunks of one language: lower-cased, a newline where a piece ends.
2. Fingerprints: the words of a chunk get a polynomial hash of their bytes, and prefix sums of a
   polynomial over the words give every n-gram's fingerprint by one subtraction.  A chunk sends each
   distinct fingerprint once, with its count: the bucket by the upper half, 4 bytes of the lower.
3. A bucket adds up the counts.  Fingerprints that reach the minimum go back to the chunks that sent
   them, as a bit for each one sent: the pointer to their occurrences.  Different phrases may share
   a fingerprint, so that this is a superset of the frequent phrases, never less.
4. A chunk finds the occurrences of the marked fingerprints again, holds all occurrences of a
   fingerprint against the words of its first one, parts those that differ, and only then writes
   phrases as text.  Counts are added by text, so they are exact.
5. The frequent phrases alone are joined with their parts, and with what contains them.

A phrase sends one number a chunk however frequent it is, and buckets grow in number with the
corpus, not in size.  Nothing is broadcast.

Defined cases: a null text is empty; a null language is ``und``, as is that name itself;
repeated rows count each time; texts of any length are whole (one longer than a chunk is a
chunk); an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.llm.common import Scratch, table
from marquee.llm.rolling import scrambled, word_ngrams, word_values, words_between

MAX_WORDS, MIN_COUNT, TOP, ABSORBED = 4, 30, 2000, 80
#: Bytes of a chunk; of all chunks that a task fills; fingerprints of a bucket, on average.
CHUNK, OPEN, BUCKET = 1 << 20, 32 << 20, 1 << 22
#: Phrases whose counts a task adds up before it hands them on.
HELD = 300_000
#: Parts in which a language's phrases are ranked before they meet.
RANK_PARTS = 64
#: Byte classes: A-Z lower-cased; ends of pieces become newlines, tabs blanks.
_TABLE = bytes(10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c
               for c in range(256))
NEWLINE, BLANK = 10, 32

# -- fingerprints ------------------------------------------------------------------------

def words_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and stop of every word of a chunk, and the number of its piece."""
    end = raw == NEWLINE
    starts, stops = words_between(end | (raw == BLANK))
    return starts, stops, np.searchsorted(np.flatnonzero(end), starts)


def ngrams(raw: np.ndarray, lang: str, longest: int = MAX_WORDS):
    """(starts, stops, [(places, fingerprints) of 1-grams, of 2-grams, ...]) of a chunk; a place is
    the number of the first word."""
    starts, stops, piece = words_of(raw)
    values = word_values(raw, starts, stops)
    salt = int.from_bytes(lang.encode("utf-8", "surrogatepass"), "little") % ((1 << 61) - 1)
    out, at = [], np.arange(len(starts))
    for n in range(1, longest + 1):
        places = at[:max(0, len(at) - n + 1)]
        places = places[piece[places] == piece[places + n - 1]]
        prints = word_ngrams(values, places, places + n)
        out.append((places, scrambled(prints ^ np.uint64(salt * 8 + n))))
    return starts, stops, out


def dealt(prints: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket in the upper 32 bits, the lower 32 bits of the fingerprint below."""
    return ((prints >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (prints & np.uint64(0xFFFFFFFF))


def sent(grams, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct dealt fingerprints of a chunk, ascending, and their counts."""
    keys = np.concatenate([dealt(p, buckets) for _, p in grams])
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, int)
    return keys[first], np.diff(np.append(first, len(keys)))


# -- stages ------------------------------------------------------------------------------

CHUNKS = "lang string, raw binary, words long"
SENT = "bucket long, chunk long, codes binary, many binary"
MARKED = "chunk long, bucket long, bits binary"
READ = "lang string, part long, phrases binary, counts binary"
COUNTED = "lang string, n int, phrase string, f long"


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parts: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}

    def flush(lang: str) -> pd.DataFrame:
        raw = b"\n".join(parts.pop(lang))
        del size[lang]
        words = len(words_of(np.frombuffer(raw, np.uint8))[0])
        return pd.DataFrame({"lang": [lang], "raw": [raw], "words": [words]})

    for b in batches:
        for lang, text in zip(b["lang"], b["text"]):
            if not text:
                continue
            raw = text.encode("utf-8", "surrogatepass").translate(_TABLE)
            parts.setdefault(lang, []).append(raw)
            size[lang] = size.get(lang, 0) + len(raw) + 1
            if size[lang] >= CHUNK:
                yield flush(lang)
            elif sum(size.values()) >= OPEN:
                yield flush(max(size, key=size.get))
    for lang in list(parts):
        yield flush(lang)


def _sender(buckets: int, longest: int):
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for chunk, lang, raw in zip(b["chunk"], b["lang"], b["raw"]):
                keys, counts = sent(ngrams(np.frombuffer(raw, np.uint8), lang, longest)[2], buckets)
                bucket = keys >> np.uint64(32)
                cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(keys) else []
                rows = []
                for a, z in zip(cuts, np.append(cuts[1:], len(keys))):
                    c = counts[a:z]
                    more = np.flatnonzero(c > 1)          # most counts are 1: only others are sent
                    many = np.stack([more, c[more]]).astype("<u4")
                    rows.append((int(bucket[a]), chunk, keys[a:z].astype("<u4").tobytes(), many.tobytes()))
                yield pd.DataFrame(rows, columns=["bucket", "chunk", "codes", "many"])
    return send


def _marker(least: int):
    def mark(b: pd.DataFrame) -> pd.DataFrame:
        codes = [np.frombuffer(c, "<u4") for c in b["codes"]]
        both = []
        for c, m in zip(codes, b["many"]):
            at, many = np.frombuffer(m, "<u4").reshape(2, -1)
            one = (c.astype(np.uint64) << np.uint64(32)) + np.uint64(1)
            one[at] += many.astype(np.uint64) - np.uint64(1)
            both.append(one)
        both = np.concatenate(both)
        both.sort()
        code = both >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        total = np.add.reduceat(both & np.uint64(0xFFFFFFFF), first)
        often = code[first[total >= least]].astype("<u4")
        rows = []
        for chunk, c in zip(b["chunk"], codes):
            at = np.searchsorted(often, c)
            hit = np.zeros(len(c), bool)
            inside = at < len(often)
            hit[inside] = often[at[inside]] == c[inside]
            if hit.any():
                rows.append((chunk, int(b["bucket"].iloc[0]), np.packbits(hit).tobytes()))
        return pd.DataFrame(rows, columns=["chunk", "bucket", "bits"])
    return mark


def _parted(words: np.ndarray, places: np.ndarray, sizes: np.ndarray, group: np.ndarray, lead: np.ndarray):
    """(place, size, count) of each distinct n-gram among occurrences that are grouped by fingerprint:
    each is held word by word against its group's ``lead``, and groups that hold several phrases
    are parted by their words."""
    padded = np.append(words, np.full(int(sizes.max()), -1))
    top = lead[group]
    same = sizes == sizes[top]
    for k in range(int(sizes.max())):
        same &= (sizes <= k) | (padded[places + k] == padded[places[top] + k])
    count = np.bincount(group, minlength=len(lead))
    if same.all():
        return places[lead], sizes[lead], count
    mixed = np.zeros(len(lead), bool)
    mixed[group[~same]] = True
    odd = np.flatnonzero(mixed[group])
    rows = np.stack([np.where(sizes[odd] > k, padded[places[odd] + k], -1) for k in range(int(sizes.max()))], axis=1)
    _, at, times = np.unique(rows, axis=0, return_index=True, return_counts=True)
    first = np.concatenate([lead[~mixed], odd[at]])
    return places[first], sizes[first], np.concatenate([count[~mixed], times])


def phrases_of(raw: bytes, lang: str, bits: dict[int, bytes], buckets: int, longest: int) -> Iterator[tuple]:
    """(phrase, count) of the n-grams of a chunk whose fingerprints are marked."""
    _, _, grams = ngrams(np.frombuffer(raw, np.uint8), lang, longest)
    keys = np.concatenate([dealt(prints, buckets) for _, prints in grams])
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, int)
    count, bucket = np.diff(np.append(first, len(keys))), keys[first] >> np.uint64(32)
    marked = np.zeros(len(first), bool)
    edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    for b, m in bits.items():
        a, z = edges[b], edges[b + 1]
        marked[a:z] = np.unpackbits(np.frombuffer(m, np.uint8), count=z - a).astype(bool)
    if not marked.any():
        return
    hit, often = order[np.repeat(marked, count)], count[marked]
    places = np.concatenate([at for at, _ in grams])[hit]
    sizes = np.repeat(np.arange(1, longest + 1), [len(at) for at, _ in grams])[hit]
    group, lead = np.repeat(np.arange(len(often)), often), np.append(0, np.cumsum(often)[:-1])
    text = raw.split()
    words = pd.factorize(np.array(text, dtype=object))[0]
    for p, n, c in zip(*(x.tolist() for x in _parted(words, places, sizes, group, lead))):
        yield b" ".join(text[p:p + n]), c


def _reader(buckets: int, longest: int):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, dict[bytes, int]] = {}

        def flush() -> Iterator[pd.DataFrame]:
            for lang, f in held.items():
                parts: dict[int, list[bytes]] = {}
                for phrase in f:
                    parts.setdefault(crc32(phrase) % buckets, []).append(phrase)
                yield pd.DataFrame(
                    [(lang, part, b"\n".join(some), np.array([f[p] for p in some], "<i8").tobytes())
                     for part, some in parts.items()], columns=["lang", "part", "phrases", "counts"])
            held.clear()

        for b in batches:
            for lang, raw, marks in zip(b["lang"], b["raw"], b["marks"]):
                f = held.setdefault(lang, {})
                for phrase, count in phrases_of(raw, lang, {m["bucket"]: m["bits"] for m in marks}, buckets, longest):
                    f[phrase] = f.get(phrase, 0) + count
                if sum(map(len, held.values())) >= HELD:
                    yield from flush()
        yield from flush()
    return read


def _adder(least: int):
    def add(b: pd.DataFrame) -> pd.DataFrame:
        f: dict[bytes, int] = {}
        for phrases, counts in zip(b["phrases"], b["counts"]):
            for phrase, count in zip(phrases.split(b"\n"), np.frombuffer(counts, "<i8").tolist()):
                f[phrase] = f.get(phrase, 0) + count
        rows = [(b["lang"].iloc[0], p.count(b" ") + 1, p.decode("utf-8", "surrogatepass"), c)
                for p, c in f.items() if c >= least]
        return pd.DataFrame(rows, columns=["lang", "n", "phrase", "f"])
    return add


def frequent_phrases(scratch: Scratch, df: DataFrame, text: Column, lang: Column, longest: int = MAX_WORDS,
                     least: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): lang, n, phrase and f, its exact count, of all phrases of 1 to ``longest``
    words with f >= ``least``; and lang, words: the words of each language in all."""
    scratch.batch(250)
    chunks = (df.select(F.coalesce(lang.cast("string"), F.lit("und")).alias("lang"), text.alias("text"))
              .mapInPandas(_pack, CHUNKS).withColumn("chunk", F.monotonically_increasing_id()))
    chunks = scratch.write(chunks, "phrase-chunks")
    totals = scratch.write(chunks.groupBy("lang").agg(F.sum("words").alias("words")), "phrase-words")
    total = totals.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    buckets = max(1, math.ceil(total * longest / BUCKET))
    scratch.batch(4)                                     # rows are chunks from here on
    prints = chunks.select("chunk", "lang", "raw").mapInPandas(_sender(buckets, longest), SENT)
    marks = scratch.write(prints.groupBy("bucket").applyInPandas(_marker(least), MARKED), "phrase-marks")
    back = marks.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias("marks"))
    counted = (chunks.join(back, "chunk").select("lang", "raw", "marks")
               .mapInPandas(_reader(buckets, longest), READ))
    phrases = counted.groupBy("lang", "part").applyInPandas(_adder(least), COUNTED)
    return scratch.write(phrases, "phrases"), totals


def _part(words: Column, start: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, start, n), " ")


def collocations(phrases: DataFrame, totals: DataFrame, top: int = TOP, absorbed: int = ABSORBED) -> DataFrame:
    """The best phrases of two words or more of each language: lang, rank, phrase, a, l, r, n, score.

    ``a``: the phrase's count; ``l`` and ``r``: those of its parts at the cut with the lowest score,
    floor(2000000 a / (l + r)); ``n``: words of the language.  A phrase goes if one that contains it
    has at least ``absorbed`` percent of its count."""
    some = phrases.select("lang", "n", "phrase", "f", F.split("phrase", " ").alias("w"))
    cuts = (some.filter("n > 1")
            .select("lang", "phrase", F.col("f").alias("a"), "w", "n",
                    F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", _part(F.col("w"), F.lit(1), F.col("k")).alias("lp"),
                    _part(F.col("w"), F.col("k") + 1, F.col("n") - F.col("k")).alias("rp")))
    f = phrases.select("lang", F.col("phrase").alias("lp"), F.col("f").alias("l"))
    cuts = cuts.join(f, ["lang", "lp"]).join(f.toDF("lang", "rp", "r"), ["lang", "rp"])
    exact = F.expr("(cast(a as decimal(19, 0)) * 2000000) div (cast(l as decimal(19, 0)) + r)")
    best = F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("cut")
    scored = (cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), best)
              .select("lang", "phrase", "a", "cut.l", "cut.r", F.col("cut.score").cast("long").alias("score")))
    sub = (some.filter("n > 2")
           .select("lang", "f", "w", "n", F.explode(F.expr("sequence(2, n - 1)")).alias("m"))
           .select("lang", "f", "w", "m", F.explode(F.expr("sequence(1, n - m + 1)")).alias("i"))
           .select("lang", "f", _part(F.col("w"), F.col("i"), F.col("m")).alias("phrase"))
           .groupBy("lang", "phrase").agg(F.max("f").alias("inside")))
    kept = (scored.join(sub, ["lang", "phrase"], "left")
            .filter(F.coalesce(100 * F.col("inside") < absorbed * F.col("a"), F.lit(True))))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = (F.xxhash64("phrase") % RANK_PARTS).alias("part")
    near = (kept.select("*", part).withColumn("place", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order)))
            .filter(F.col("place") <= top))
    ranked = (near.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)))
              .filter(F.col("rank") <= top))
    return (ranked.join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                    F.col("words").alias("n"), "score"))


def op12_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    """All documents: the first 2,000 phrases of each language."""
    with Scratch(spark) as scratch:
        found = frequent_phrases(scratch, table(spark, sf_dir, "documents"), F.col("text"), F.col("lang"))
        return scratch.keep(scratch.write(collocations(*found), "collocations"))
