"""Language identification with string kernels.

Texts are compared by the blended-spectrum presence kernel: the number of character
n-grams (of one to ``LONGEST`` characters) that both hold, over the root of the product of
how many each holds.  A few hundred landmark texts give Nystroem features, on which one
kernel ridge regression per language is fitted against the rest.  Scoring is one product
of a batch's presence matrix with the landmarks', and one with the solved weights.

n-grams are hashed to ``BITS`` bits.  Landmarks and training rows are bounded samples, drawn by
hash within each language; every document is scored on its whole text.

Defined cases: null texts and texts without letters are ``und`` with score 0; without any
labelled text every document is ``und``; labels are taken as they are; repeated rows get
equal predictions.
"""

from __future__ import annotations

import math
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import LETTERS, crc_mod, small_batches, table, written

LONGEST, BITS, LANDMARKS, SAMPLE, RIDGE = 4, 14, 240, 4000, 1e-3
#: Training rows of a language, at least.
LEAST_ROWS = 8
#: Languages that a model holds (a landmark of each is 64 KB); more are refused.
MAX_LANGS = 1000
_MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
#: Texts of one matrix product.
ROWS = 128


def presence(text: str, out: np.ndarray) -> None:
    """Mark the n-grams of a text in the row ``out``."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where((c < 97) | ((c > 122) & (c < 128)), np.uint32(32), c)
    # runs of anything that is no letter count as one blank
    c = c[np.concatenate(([True], (c[1:] != 32) | (c[:-1] != 32)))]
    h = np.zeros(len(c), np.uint32)
    for n in range(1, min(LONGEST, len(c)) + 1):
        h = (h[:len(c) - n + 1] if n == 1 else h[:-1]) * np.uint32(31) + c[n - 1:] * _MULT[0]
        out[((h ^ (h >> np.uint32(15))) * _MULT[n - 1]) >> np.uint32(32 - BITS)] = 1


def has_letters(text: str | None) -> bool:
    return bool(text) and any(any(map(str.isalpha, m.group())) for m in LETTERS.finditer(text))


def matrix(texts: list[str]) -> np.ndarray:
    x = np.zeros((len(texts), 1 << BITS), np.float32)
    for row, t in zip(x, texts):
        presence(t, row)
    return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))


def unpack(rows: list[bytes]) -> np.ndarray:
    """The matrix of texts given as packed presence bits."""
    x = np.unpackbits(np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1),
                      axis=1).astype(np.float32)
    return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))


def kernel(x: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    return x @ landmarks.T


def outputs(x: np.ndarray, marks: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Each language's output for texts (rows of ``matrix``).  Shared n-grams are whole numbers and
    so exact in any order; the rest is summed landmark by landmark, so that equal texts get
    equal outputs wherever they stand in a batch."""
    x, marks = x > 0, marks > 0
    same = (x.astype(np.float32) @ marks.T.astype(np.float32)).astype(np.float64)
    k = same / np.sqrt(np.outer(np.maximum(x.sum(axis=1), 1), np.maximum(marks.sum(axis=1), 1)))
    return (k[:, :, None] * w).sum(axis=1)


def solve(k_mm: np.ndarray, k_nm: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights over landmarks: Nystroem features of the kernel, then ridge regression."""
    values, vectors = np.linalg.eigh(k_mm.astype(np.float64))
    good = values > 1e-6 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])
    z = k_nm @ root
    a = np.linalg.solve(z.T @ z + ridge * len(z) * np.eye(z.shape[1]), z.T @ y)
    return root @ a


def train(docs: DataFrame, text: Column, lang: Column, keep: Column, order: Column,
          landmarks: int = LANDMARKS, sample: int = SAMPLE) -> dict | None:
    """``order`` draws the sample within each language (a seeded hash of the row).  Every value of
    ``lang`` is learned; a ``ValueError`` says if there are more than ``MAX_LANGS``."""
    small_batches(docs.sparkSession)
    rows = docs.select(text.alias("text"), lang.alias("lang"), order.alias("o")).filter(
        keep & lang.isNotNull() & F.coalesce(text, F.lit("")).rlike(r"\p{L}"))
    counts = (rows.groupBy("lang").agg(F.count("*").alias("n"))
              .limit(MAX_LANGS + 1).collect())
    langs = sorted(r.lang for r in counts)
    if not langs:
        return None
    if len(langs) > MAX_LANGS:
        raise ValueError(f"over {MAX_LANGS} languages: more than the model can hold")
    each, few = max(LEAST_ROWS, -(-sample // len(langs))), -(-landmarks // len(langs))
    # of a frequent language only the share of hashes that gives about twice the rows needed
    # is looked at, so no language is gathered; then a bounded number of each is ranked
    share = F.create_map(*[F.lit(v) for r in counts for v in (
        r.lang, min(1 << 20, math.ceil((2 * each + 20) / r.n * (1 << 20))))])
    part = Window.partitionBy("lang").orderBy("o", "text")
    drawn = (rows.filter(F.pmod(F.xxhash64("o"), F.lit(1 << 20)) < share[F.col("lang")])
             .withColumn("k", F.row_number().over(part)).filter(F.col("k") <= each))
    drawn = written(drawn, "language-sample")

    @F.pandas_udf("binary")
    def pack(texts: pd.Series) -> pd.Series:
        return pd.Series([np.packbits(matrix([t]) > 0).tobytes() for t in texts], dtype=object)

    marks = drawn.filter(F.col("k") <= few).select("lang", "k", pack("text").alias("bits"))
    x = unpack([r.bits for r in sorted(marks.collect(), key=lambda r: (r.lang, r.k))])
    at = {v: i for i, v in enumerate(langs)}

    @F.pandas_udf("array<float>")
    def compare(texts: pd.Series) -> pd.Series:
        return pd.Series([k for i in range(0, len(texts), ROWS) for k in kernel(matrix(
            list(texts.iloc[i:i + ROWS])), x)])

    got = drawn.filter(F.col("k") <= each).select("lang", compare("text").alias("k")).collect()
    y = np.zeros((len(got), len(langs)))
    for i, r in enumerate(got):
        y[i, at[r.lang]] = 1.0
    return {"langs": langs, "marks": x, "w": solve(kernel(x, x), np.array([r.k for r in got]), y)}


def predict(docs: DataFrame, text: Column, model: dict | None) -> Column:
    """A struct of ``lang`` and ``score`` (the winner's share of the positive outputs)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def classify(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        lang, score = ["und"] * len(texts), [0.0] * len(texts)
        rows = [i for i, t in enumerate(texts) if m is not None and has_letters(t)]
        for a in range(0, len(rows), ROWS):
            part = rows[a:a + ROWS]
            out = outputs(matrix([texts.iloc[i] for i in part]), m["marks"], m["w"])
            best, pos = out.argmax(axis=1), np.maximum(out, 0)
            share = pos.max(axis=1) / np.maximum(pos.sum(axis=1), 1e-9)
            for i, b, s in zip(part, best, share):
                lang[i], score[i] = m["langs"][b], float(s)
        return pd.DataFrame({"lang": lang, "score": score})
    return classify(text)


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    """All documents; the lang of ids with crc32 mod 4 = 2 is held out."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    model = train(docs, F.col("text"), F.col("lang"),
                  F.coalesce(crc_mod("doc_id", 4) != 2, F.lit(True)), F.xxhash64("doc_id"))
    out = docs.select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                      predict(docs, F.col("text"), model).alias("p"))
    return out.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"),
                      F.col("p.score").alias("score"))
