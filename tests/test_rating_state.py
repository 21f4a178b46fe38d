"""Rating states that merge, dates by one pattern, documents bounded in bytes."""

from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from marquee.functions.dates import DATE_PATTERNS, parse_date
from marquee.operators import marts as mt
from marquee.sources.sinks import write_indented_json, write_wrapped_json

SILVER = "rating_id long, user_id long, movie_key string, score double, watched_date date"


def ratings(spark, seed, n):
    rng = random.Random(seed)
    users = [None, 0, 1, -1, -40000, 32768, 32769, 2**40, 2**62, *range(100, 160)]
    rows = [(i, rng.choice(users), rng.choice([None, "a", "b", "c"]), rng.choice([None, 7.5, 0.05, 9.95, 3.3333]), None)
            for i in range(n)]
    return spark.createDataFrame(rows, SILVER)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_states_give_the_mart(spark):
    a, b, c = (ratings(spark, k, 300) for k in range(3))
    want = mt.fact_ratings(a.unionByName(b).unionByName(c))
    one = mt.rating_state(a.unionByName(b).unionByName(c))
    assert rows(mt.fact_ratings_of(one)) == rows(want)
    step = mt.merge_rating_states(mt.merge_rating_states(mt.rating_state(a), mt.rating_state(b)), mt.rating_state(c))
    assert rows(mt.fact_ratings_of(step)) == rows(want)
    got = mt.fact_ratings_of(step)
    assert [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    empty = mt.rating_state(a.limit(0))
    assert rows(mt.fact_ratings_of(mt.merge_rating_states(empty, mt.rating_state(a)))) == rows(mt.fact_ratings(a))
    assert mt.fact_ratings_of(empty).count() == 0


def test_a_merge_reads_no_ratings_again(spark, tmp):
    mt.rating_state(ratings(spark, 1, 50)).write.parquet(f"{tmp}/state")
    merged = mt.merge_rating_states(spark.read.parquet(f"{tmp}/state"), mt.rating_state(ratings(spark, 2, 50)))
    assert all("state" in f for f in merged.inputFiles())


def one_by_one(c):
    """The layouts, each attempted on the text before a time."""
    t = F.regexp_extract(F.trim(c), r"^([A-Za-z]+ [0-9]+,? [0-9]{4}(?![0-9])|[0-9]+[-/][0-9]+[-/][0-9]+)", 1)
    return F.coalesce(*[F.try_to_date(t, p) for p in DATE_PATTERNS])


def test_dates_are_those_of_the_layouts(spark):
    rng = random.Random(5)
    texts = ["", " ", None, "N/A", "2021", "2021-05", "2021-05-", "20210304", "2021-3-4", "03/4/2021", "3-04-2021",
             "2021/3/4", "March 4, 2021", "mar 4 2021", "Mar 4, 2021", "March 4 2021", "2021-02-30", "31/04/2021",
             "13-01-2021", "2021-03-04T10:00", "2021-03-04 10:00:00", "04/03/2021 x", "1-2-3", "-1-2-2021",
             "2021--03-04", "2021-3/4", "٢٠٢١-٠٣-٠٤", "2021-003-0004", "2021-03-04\nmore", "0001-01-01", "12/2021"]
    sep = ["-", "/", " ", ".", "--"]
    for _ in range(3000):
        a, b, c = (rng.choice([str(rng.randrange(40)), f"{rng.randrange(14):02d}", str(rng.randrange(1900, 2100)), "0"])
                   for _ in range(3))
        s = rng.choice(sep)
        texts.append(rng.choice(["", " "]) + a + s + b + rng.choice([s, s, s, rng.choice(sep)]) + c + rng.choice(["", "T1", " 3"]))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    bad = df.select("t", parse_date("t").alias("a"), one_by_one(F.col("t")).alias("b")).where("NOT a <=> b").collect()
    assert bad == []


@pytest.mark.parametrize("indented", [False, True])
def test_documents_are_bounded_in_bytes(spark, tmp, indented):
    rng = random.Random(2)
    df = spark.createDataFrame([(str(i), "x" * rng.choice([1, 50, 400])) for i in range(600)], "event_id string, title string")
    p = os.path.join(tmp, "w")
    (write_indented_json if indented else write_wrapped_json)(df, p, "events", 10_000, bytes_per_doc=3000)
    docs = spark.read.option("multiLine", indented).json(p).select("events").collect()
    sizes = [[len(json.dumps(e.asDict(), separators=(",", ":"))) for e in d.events] for d in docs]
    assert sum(map(len, sizes)) == 600
    assert all(sum(s) - max(s) < 3000 for s in sizes)
    assert max(sum(s) for s in sizes) > 2000
