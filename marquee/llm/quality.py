"""Quality scores by Bradley-Terry pairwise ranking.

A text is described by features of the whole of it: hashed n-grams (the shares of its words and pairs
of words, and of its four-byte strings, that fall in each bin, by their root) and counts of its
surface.  From labelled texts come preference pairs (a text of label 1 over a text of label 0); the chance that one wins is the logistic function
of the difference of their scores, scores are linear in the features, and the weights
minimise the logistic loss on feature differences.  The decision threshold is the quantile of the
labelled scores that leaves the labelled share of label 0 below it; the reported score is
the logistic function of the distance to it.

The weights are fitted on at most ``SAMPLE`` labelled texts (drawn by seeded hash) and
``PAIRS`` pairs; every text is scored.

Defined cases: null text is empty text, and has features and a score like any other;
labels are read per id (an id of several labels takes the largest, null labels none);
with labels of one kind only, or none, all scores are 0.5; repeated rows get equal scores.
"""

from __future__ import annotations

import zlib
from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import crc_mod, row_sums, small_batches, table, tidy

SAMPLE, PAIRS, SEED, RIDGE = 8000, 60_000, 11, 1e-3
#: Bins of words and their pairs, and of four-byte strings; pairs of texts, and bytes, taken at once.
WORD_BINS, BYTE_BINS, AT_ONCE, CHUNK = 256, 128, 4000, 1 << 16
#: Kinds of features.
SURFACE, GRAMS = "surface", "grams"
_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=_U)
_LOWER[65:91] += _U(32)
_SYMBOLS = np.frombuffer(b"*#%&$@~^<>{}[]\\/=+_", np.uint8)


def features(text: str | None) -> list[float]:
    """Of the whole text; each in about [0, 1] but for the logarithms."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    words = raw.split()
    n, nw = max(1, len(raw)), max(1, len(words))
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = hist[65:91].sum(), hist[97:123].sum()
    counts = Counter(words)
    top = max(counts.values(), default=0)
    same = sum(map(eq, words, words[1:]))
    lines = raw.split(b"\n")
    symbols = hist[_SYMBOLS].sum()
    distinct = len(counts)
    caps = upper / max(1, upper + lower)
    bang, bar = hist[33] / nw, hist[124] / nw
    stops = (hist[46] + hist[63]) / nw
    return [
        np.log1p(len(words)), caps, np.sqrt(caps), min(bang, 2), np.sqrt(min(bang, 2)), min(bar, 2),
        np.sqrt(min(bar, 2)), symbols / n, np.sqrt(symbols / n), hist[48:58].sum() / n,
        distinct / nw, np.log1p(distinct) / np.log1p(nw + 1), top / nw, np.sqrt(top / nw),
        same / nw, np.sqrt(same / nw), (n - hist[32]) / nw / 10, min(stops, 1.0),
        np.sqrt(min(stops, 1.0)), len(lines) / nw, 1 - len(set(lines)) / len(lines), hist[44] / nw,
        hist[128:].sum() / n, float(len(words) < 20),
    ]


def _bins(h: np.ndarray, n: int) -> np.ndarray:
    """How many of the hashes fall in each of ``n`` bins (a power of two)."""
    h = (h ^ (h >> _U(31))) * _ODD
    return np.bincount((h >> _U(65 - n.bit_length())).astype(np.int64), minlength=n)


def grams(text: str | None) -> np.ndarray:
    """Roots of the shares of hashed words (by checksum and length) and pairs of words, and of
    four-byte strings, A-Z in lower case."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    out = np.zeros(WORD_BINS + BYTE_BINS)
    words = np.array([zlib.crc32(w) | len(w) << 32 for w in raw.lower().split()], dtype=_U)
    out[:WORD_BINS] = _bins(words, WORD_BINS) + _bins(words[:-1] * _ODD + words[1:], WORD_BINS)
    for at in range(0, len(raw) - 3, CHUNK):         # bounded pieces, each string in one of them
        b = _LOWER[np.frombuffer(raw, np.uint8, min(CHUNK + 3, len(raw) - at), at)]
        out[WORD_BINS:] += _bins(((b[:-3] << _U(24)) | (b[1:-2] << _U(16)) | (b[2:-1] << _U(8))
                                  | b[3:]) * _ODD, BYTE_BINS)
    for part in (out[:WORD_BINS], out[WORD_BINS:]):
        part /= max(1.0, part.sum())
    return np.sqrt(out)


def described(text: str | None, kinds: tuple[str, ...]) -> np.ndarray:
    return np.concatenate([np.array(features(text)) if k == SURFACE else grams(text) for k in kinds])


def _described_udf(kinds: tuple[str, ...]):
    @F.pandas_udf("binary")
    def describe(texts: pd.Series) -> pd.Series:
        return pd.Series([described(t, kinds).astype(np.float32).tobytes() for t in texts],
                         dtype=object)
    return describe


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, seed: int = SEED,
        ridge: float = RIDGE) -> dict | None:
    """Weights by Newton's method on the pairs' logistic loss; None without both labels."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return None
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    z = (x - mean) / scale
    rng = np.random.default_rng(seed)
    better, worse = rng.choice(good, pairs), rng.choice(bad, pairs)
    w = np.zeros(x.shape[1])
    for _ in range(25):
        grad, hess = ridge * w, ridge * np.eye(len(w))
        for at in range(0, pairs, AT_ONCE):          # differences of bounded size
            d = z[better[at:at + AT_ONCE]] - z[worse[at:at + AT_ONCE]]
            p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
            grad += d.T @ (p - 1) / pairs
            hess += (d * (p * (1 - p))[:, None]).T @ d / pairs
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    scores = z @ w
    return {"mean": mean, "scale": scale, "w": w,
            "cut": float(np.quantile(scores, len(bad) / len(y)))}


def scores(model: dict | None, x: np.ndarray) -> np.ndarray:
    if model is None:
        return np.full(len(x), 0.5)
    s = row_sums((x - model["mean"]) / model["scale"] * model["w"]) - model["cut"]
    return 1 / (1 + np.exp(-np.clip(s, -30, 30)))


def labelled(docs: DataFrame, id_: str, text: str, labels: DataFrame, label: Column,
             keep: Column, sample: int) -> DataFrame:
    """(text, y, id) of at most ``sample`` labelled documents, in the order of a seeded hash;
    the sample's ids (16 bytes each) are broadcast."""
    picked = (labels.filter(label.isNotNull() & F.col(id_).isNotNull() & keep)
              .groupBy(F.col(id_).alias("label_id")).agg(F.max(label).cast("double").alias("y"))
              .orderBy(F.xxhash64("label_id")).limit(sample))
    return (docs.select(F.col(f"`{id_}`").alias("id"), F.col(f"`{text}`").alias("text"))
            .join(F.broadcast(picked), F.col("id") == F.col("label_id"))
            .select("id", "text", "y"))


def train(docs: DataFrame, labels: DataFrame, label: Column, keep: Column, id_: str = "doc_id",
          text: str = "text", sample: int = SAMPLE,
          kinds: tuple[str, ...] = (SURFACE, GRAMS)) -> dict | None:
    """``kinds``: the kinds of features that the scores are made of."""
    small_batches(docs.sparkSession)
    rows = (labelled(docs, id_, text, labels, label, keep, sample)
            .select("y", _described_udf(kinds)("text").alias("x"), F.xxhash64("id").alias("h"))
            .orderBy("h", "y").limit(sample).collect())    # at most ``sample`` short vectors
    if not rows:
        return None
    model = fit(np.array([np.frombuffer(r.x, np.float32) for r in rows], dtype=float),
                np.array([r.y for r in rows]))
    return model and model | {"kinds": kinds}


def quality_score(text: Column, model: dict | None) -> Column:
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        if model is None:
            return pd.Series(np.full(len(texts), 0.5))
        return pd.Series(scores(model, np.array([described(t, model["kinds"]) for t in texts])))
    return score(text)


@tidy
def op9_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """All documents; labels of ids with crc32 mod 3 = 1 are held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels, F.col("quality"), crc_mod("doc_id", 3) != 1)
    return docs.select(
        "doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        quality_score(F.col("text"), model).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
