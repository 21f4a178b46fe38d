"""Readers keep raw tokens; writers round-trip; the table store and logs work."""

from __future__ import annotations

import csv
import json
import os

import pytest
from pyspark.sql import functions as F

from marquee.sources import readers as rd
from marquee.sources.schemas import BRONZE
from marquee.sources.sinks import Store, audit, read_audit, write_feed, write_wrapped_json


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_json_array_mixed_types_read_as_raw_text(spark, tmp):
    recs = [{"id": 1000, "title": "A", "runtime": 120, "rating": 8.5, "votes": None},
            {"id": 1001, "title": "B", "runtime": "120 min", "rating": "8.5/10", "votes": 12}]
    p = _write(os.path.join(tmp, "movies.json"), json.dumps(recs, indent=2))
    rows = rd.read_movies_json(spark, p).orderBy("id").collect()
    assert [(r.id, r.runtime, r.rating, r.votes) for r in rows] == [
        ("1000", "120", "8.5", None), ("1001", "120 min", "8.5/10", "12")]
    assert rows[0].genre is None          # missing field -> null


def test_wrapped_json_document_is_flattened(spark, tmp):
    doc = {"events": [{"event_id": "e1", "user": "U1", "title": " t ", "action": "add",
                       "event_time": "2021-03-04", "device": ""},
                      {"event_id": "e2", "user": "u2", "title": "t", "action": " remove ",
                       "event_time": None, "device": "WEB"}]}
    p = _write(os.path.join(tmp, "w.json"), json.dumps(doc, indent=2))
    rows = rd.read_watchlist_json(spark, p).orderBy("event_id").collect()
    assert [(r.title, r.device, r.action) for r in rows] == [(" t ", "", "add"),
                                                             ("t", "WEB", " remove ")]


def test_pretty_xml_keeps_spaces_and_empty_elements(spark, tmp):
    xml = """<?xml version="1.0" ?>
<awards>
  <award>
    <award_id>a1</award_id>
    <title> The Dawn </title>
    <category> Best Actor </category>
    <year></year>
    <result>WON</result>
  </award>
  <award>
    <award_id>a2</award_id>
    <title>x</title>
    <category>best director</category>
    <year>2019</year>
    <result> Nominated </result>
  </award>
</awards>
"""
    p = _write(os.path.join(tmp, "awards.xml"), xml)
    rows = rd.read_awards_xml(spark, p).orderBy("award_id").collect()
    assert [(r.title, r.category, r.year, r.result) for r in rows] == [
        (" The Dawn ", " Best Actor ", "", "WON"), ("x", "best director", "2019", " Nominated ")]


def test_csv_header_and_padding(spark, tmp):
    p = _write(os.path.join(tmp, "s.csv"),
               "title,imdb_score,rt_score,source,collected_at\n"
               "A, 9.5,95%, rotten_tomatoes ,2021-03-04\nB,,N/A,IMDB,\n")
    rows = rd.read_scores_csv(spark, p).orderBy("title").collect()
    assert rows[0].source == " rotten_tomatoes " and rows[0].imdb_score == " 9.5"
    assert rows[1].imdb_score is None and rows[1].collected_at is None


def test_parquet_feed_to_bronze_strings(spark, tmp):
    df = spark.createDataFrame([(1.0, "a", float("nan")), (2e7, None, 1.5)],
                               "user_id double, username string, x double")
    for c in ("email", "country", "signup_date", "is_premium"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    p = os.path.join(tmp, "u.parquet")
    df.write.parquet(p)
    out = rd.read_parquet_feed(spark, p, "users")
    assert out.schema == BRONZE["users"]
    assert sorted((r.user_id, r.username) for r in out.collect()) == [("1", "a"), ("20000000", None)]
    assert rd.nan_to_null_columns(spark.read.parquet(p)).where("x IS NULL").count() == 1


def test_missing_column_raises(spark, tmp):
    p = os.path.join(tmp, "r.parquet")
    spark.createDataFrame([(1, 2)], "ratingid long, user_id long").write.parquet(p)
    with pytest.raises(ValueError, match="rating_id"):
        rd.read_parquet_feed(spark, p, "ratings")


EVENT = {"event_id": "e1", "user": "u", "title": "t", "action": "add", "event_time": None, "device": ""}


def test_json_layouts(spark, tmp):
    doc = {"events": [EVENT] * 3}
    line, pretty = json.dumps(doc), json.dumps(doc, indent=2)
    read = lambda name, text, **k: rd.read_watchlist_json(
        spark, _write(os.path.join(tmp, name), text), **k).count()
    assert read("a.json", line) == read("b.json", pretty) == 3
    assert read("c.json", line + "\n" + line + "\n") == 6
    with pytest.raises(ValueError):                      # JSON lines asked for as one document
        read("d.json", line + "\n" + line, multiline=True)
    with pytest.raises(Exception, match="(?i)malformed"):    # one document read as lines
        read("e.json", pretty, multiline=False)
    with pytest.raises(Exception, match="(?i)malformed"):    # a broken line
        read("f.json", line + "\n" + line[:40])
    with pytest.raises(Exception, match="(?i)malformed"):    # a broken document
        read("g.json", pretty[:-30])
    with pytest.raises(ValueError):                      # a second document would be lost
        read("h.json", pretty + "\n" + pretty)
    with pytest.raises(Exception, match="no events"):
        read("i.json", json.dumps({"event": []}))


def test_bare_ampersand_in_xml_raises(spark, tmp):
    p = _write(os.path.join(tmp, "a.xml"), "<awards><award><award_id>1</award_id><title>A & B</title>"
                                           "<category>c</category><year>1</year><result>won</result>"
                                           "</award></awards>")
    with pytest.raises(Exception, match="(?i)malformed"):
        rd.read_awards_xml(spark, p).collect()


TITLES = ['Good, "Bad" and Ugly', 'say "hi", bye', "two\nlines", "ends in \\", " padded "]


def test_csv_as_the_csv_module_writes_it(spark, tmp):
    path = os.path.join(tmp, "s.csv")
    with open(path, "w", newline="") as f:
        w = csv.DictWriter(f, BRONZE["scores"].names)
        w.writeheader()
        for t in TITLES:
            w.writerow({"title": t, "imdb_score": "9.5", "rt_score": "95%", "source": "RT"})
    rows = rd.read_scores_csv(spark, path).collect()
    assert [r.title for r in rows] == TITLES and {r.source for r in rows} == {"RT"}


def test_csv_writer_is_read_by_the_csv_module(spark, tmp):
    p = os.path.join(tmp, "out")
    write_feed(spark.createDataFrame([(t, "x") for t in TITLES], "title string, v string").coalesce(1),
               p, "csv")
    part = next(x for x in os.listdir(p) if x.startswith("part-"))
    with open(os.path.join(p, part), newline="") as f:
        assert [r["title"] for r in csv.DictReader(f)] == TITLES


@pytest.mark.parametrize("catalog", [False, True])
def test_failed_overwrite_keeps_the_old_table(spark, tmp, catalog):
    store = Store(os.path.join(tmp, "lake"), catalog=catalog, prefix="fo_")
    store.prepare(spark)
    store.write(spark.range(5), "gold", "kept")
    broken = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(
        F.raise_error(F.lit("broken")).cast("bigint")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        store.write(broken, "gold", "kept")
    assert store.exists(spark, "gold", "kept") and store.read(spark, "gold", "kept").count() == 5
    with pytest.raises(Exception, match="broken"):
        store.write(broken, "gold", "never")
    assert not store.exists(spark, "gold", "never")
    assert store.write(spark.range(2), "gold", "kept") == 2
    assert store.read(spark, "gold", "kept").count() == 2
    if not catalog:
        os.makedirs(store.path("gold", "hollow"))
        assert not store.exists(spark, "gold", "hollow")


def test_feed_writers_round_trip(spark, tmp):
    df = spark.createDataFrame([("a", " pad ", ""), ("b", None, "x")], "k string, v string, w string")
    for fmt in ("json", "parquet", "xml"):
        p = os.path.join(tmp, fmt)
        write_feed(df, p, fmt, root_tag="rows", row_tag="row")
        r = spark.read.schema(df.schema)
        back = (r.format("xml").option("rowTag", "row").option("ignoreSurroundingSpaces", False)
                .load(p) if fmt == "xml" else getattr(r, fmt)(p))
        assert sorted(back.collect(), key=lambda x: x.k) == sorted(df.collect(), key=lambda x: x.k), fmt
    p = os.path.join(tmp, "csv")
    write_feed(df, p, "csv")
    back = spark.read.schema(df.schema).option("header", True).csv(p)
    assert sorted(back.collect(), key=lambda x: x.k)[0].v == " pad "


def test_wrapped_json_writer_bounds_documents(spark, tmp):
    df = spark.range(2500).select(F.col("id").cast("string").alias("event_id"))
    p = os.path.join(tmp, "wrapped")
    write_wrapped_json(df, p, "events", rows_per_doc=1000)
    docs = spark.read.json(p)
    sizes = [r[0] for r in docs.select(F.size("events")).collect()]
    assert max(sizes) <= 1000 and sum(sizes) == 2500


def test_store_write_counts_and_exists(spark, tmp):
    store = Store(os.path.join(tmp, "lake"))
    assert not store.exists(spark, "silver", "movies")
    assert store.write(spark.range(7), "silver", "movies") == 7
    assert store.exists(spark, "silver", "movies")
    assert store.write(spark.range(3), "silver", "movies") == 3          # replace
    assert store.read(spark, "silver", "movies").count() == 3
    audit(spark, store, "movies", "silver", "movies", 3)
    audit(spark, store, "movies", "gold", "genre_summary", 1, status="SKIPPED")
    log = read_audit(spark, store)
    assert log.count() == 2 and "created_at" in log.columns


def test_catalog_store_buckets_gold(spark, tmp):
    store = Store(os.path.join(tmp, "cat"), catalog=True, prefix="t_", buckets=4)
    assert store.prepare(spark) == ["t_bronze", "t_silver", "t_gold"]
    df = spark.range(0, 200, 1, 8).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("movie_key"))
    assert store.write(df, "gold", "m", bucket_by="movie_key") == 200
    assert spark.catalog.tableExists("t_gold.m")
    desc = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED t_gold.m").collect()}
    assert desc.get("Num Buckets") == "4"
    files = spark.table("t_gold.m").inputFiles()
    assert 0 < len(files) <= 4                       # one file per bucket, not tasks x buckets


def test_partitioned_jdbc_read_needs_bounds(spark):
    import pytest
    with pytest.raises(ValueError):
        rd.read_jdbc(spark, "jdbc:none://x", "t", {}, partition_column="id", num_partitions=4)
