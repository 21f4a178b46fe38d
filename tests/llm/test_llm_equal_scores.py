"""Equal texts get equal scores, wherever they stand in a batch and in whichever batch."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import langid, quality, toxicity
from marquee.llm.common import row_sums

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def thrice(spark):
    """Each of 300 texts three times, in unlike places."""
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(300).collect()]
    rows = [(i, t) for i, t in enumerate(texts)] + [(i, t) for i, t in reversed(list(enumerate(texts)))]
    rows += [(i, texts[i]) for i in range(0, 300, 2)] + [(i, texts[i]) for i in range(1, 300, 2)]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)


@pytest.mark.parametrize("batch", [1000, 61])
def test_equal_texts_score_alike(spark, thrice, batch):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    good = quality.train(docs, labels, F.col("quality"), F.lit(True), sample=400)
    bad = toxicity.train(docs, labels, F.col("toxic"), F.lit(True))
    lang = langid.train(docs, F.col("text"), F.col("lang"), F.lit(True), F.xxhash64("doc_id"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = thrice.select("doc_id", quality.quality_score(F.col("text"), good).alias("q"),
                            toxicity.toxicity_score(thrice, F.col("text"), bad).alias("t"),
                            langid.predict(thrice, F.col("text"), lang).alias("l")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    seen = {}
    for r in got:
        assert seen.setdefault(r.doc_id, r) == r
    assert len(got) == 900 and len({r.q for r in got}) > 100


def test_row_sums_do_not_depend_on_the_place():
    x = np.random.default_rng(3).normal(size=(50, 24)) * 10.0 ** np.arange(-12, 12)
    assert (row_sums(np.vstack([x[:7], x]))[7:] == row_sums(x)).all()
    assert row_sums(np.empty((0, 4))).shape == (0,)
