"""Records that run over lines, read by many tasks: the same rows as a reader of whole files."""

from __future__ import annotations

import csv
import json
import os
import random

import pytest

from marquee.sources import readers as rd
from marquee.sources import splitting
from marquee.sources.schemas import BRONZE

COLS = BRONZE["scores"].names


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0",
            "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def scores_file(path, n, seed, end="\r\n"):
    rng = random.Random(seed)
    titles = ['Good, "Bad"', "two\nlines", "a\n\nb\n", '"', '""\n""', "ends in \\", " padded ", "é\n" * 30, "x" * 3000 + "\n", "plain"]
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(COLS)
        for i in range(n):
            w.writerow([f"{i} {rng.choice(titles)}", rng.choice(["9.5", ""]), "95%", "RT", rng.choice(["2020-01-02", ""])])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_with_line_breaks_is_split(spark, tmp, small_splits, end):
    folder = os.path.join(tmp, "feed")
    os.makedirs(folder)
    for k in range(3):
        scores_file(os.path.join(folder, f"{k}.csv"), 200, k, end)
    want = rows(rd.read_scores_csv(spark, folder, multiline=True))
    assert len(want) == 600
    with open(os.path.join(folder, "1.csv"), newline="") as f:
        titles = {r["title"] for r in csv.DictReader(f)}
    assert titles <= {r[0] for r in want}
    assert splitting.lines(spark, folder).rdd.getNumPartitions() > 20
    assert rows(rd.read_scores_csv(spark, folder)) == want


def test_csv_beyond_the_broadcast_of_blocks(spark, tmp, small_splits, monkeypatch):
    p = os.path.join(tmp, "s.csv")
    scores_file(p, 300, 5)
    want = rows(rd.read_scores_csv(spark, p))
    monkeypatch.setattr(splitting, "BROADCAST_BLOCKS", 0)
    assert rows(rd.read_scores_csv(spark, p)) == want and len(want) == 300


def _csv(tmp, name, body, header=",".join(COLS)):
    p = os.path.join(tmp, name)
    with open(p, "w", newline="") as f:
        f.write(header + "\n" + body)
    return p


@pytest.mark.parametrize("multiline", [None, True, False])
def test_csv_rows_of_the_wrong_width_raise(spark, tmp, multiline):
    for name, body in (("a", "B, with comma,3,4,imdb,2020-01-02\n"), ("b", "B,3,4\n")):
        with pytest.raises(Exception, match="(?i)malformed|width|columns"):
            rd.read_scores_csv(spark, _csv(tmp, name + ".csv", "A,1,2,imdb,\n" + body), multiline).collect()


def test_split_csv_raises_as_well(spark, tmp, small_splits):
    filler = "".join(f"T{i},1,2,imdb,2020-01-02\n" for i in range(300))
    read = lambda p: rd.read_scores_csv(spark, p).collect()
    assert len(read(_csv(tmp, "ok.csv", filler + "\n"))) == 300
    for name, body in (("wide", "B, c,3,4,imdb,2020\n"), ("short", "B,3\n")):
        with pytest.raises(Exception, match="(?i)malformed"):
            read(_csv(tmp, f"{name}.csv", filler + body + filler))
    with pytest.raises(ValueError, match="not closed"):
        read(_csv(tmp, "open.csv", filler + '"B,3,4,imdb,2020\n' + filler))
    with pytest.raises(Exception, match="header"):
        read(_csv(tmp, "names.csv", filler, header="name,imdb_score,rt_score,source,collected_at"))


def events(n, seed):
    rng = random.Random(seed)
    odd = ['br{ack}et[s]', 'quo"te', "back\\slash", "", None, "\\\"", "tab\t,", "é" * 40, "line\nbreak", "}{"]
    return [{"event_id": f"e{seed}-{i}", "user": rng.choice(odd), "title": rng.choice(odd), "action": "add",
             "event_time": None, "device": rng.choice(odd)} for i in range(n)]


@pytest.mark.parametrize("indent,compact", [(2, False), (0, False), (None, True)])
def test_indented_documents_are_split(spark, tmp, small_splits, indent, compact):
    folder = os.path.join(tmp, "w")
    os.makedirs(folder)
    want = []
    for k in range(3):
        e = events([150, 1, 0][k], k)
        want += [tuple(x[c] for c in BRONZE["watchlist"].names) for x in e]
        text = json.dumps({"events": e}, indent=indent)
        if compact:                                    # several elements a line, elements over lines
            text = text.replace('[{', '[\n{').replace('"title"', '\n"title"')
        with open(os.path.join(folder, f"{k}.json"), "w") as f:
            f.write(text)
    got = rd.read_watchlist_json(spark, folder, multiline=None if not compact else True)
    assert rows(got) == sorted(want, key=str)
    assert getattr(got, "scratch", None)               # cut, not read whole


def test_indented_array_is_split(spark, tmp, small_splits):
    p = os.path.join(tmp, "m.json")
    movies = [{"id": 1000 + i, "title": f"T {i} " * 9, "runtime": i, "rating": 8.5, "votes": None, "x": {"y": [1, {}]}}
              for i in range(120)]
    with open(p, "w") as f:
        json.dump(movies, f, indent=1)
    got = rd.read_movies_json(spark, p)
    assert got.scratch and sorted(int(r.id) for r in got.collect()) == list(range(1000, 1120))
    assert got.first().rating == "8.5"


def test_other_documents_are_read_whole(spark, tmp):
    p = os.path.join(tmp, "w.json")
    with open(p, "w") as f:
        json.dump({"meta": {"n": [1, 2]}, "events": events(5, 1), "end": True}, f, indent=2)
    got = rd.read_watchlist_json(spark, p)
    assert got.count() == 5 and not hasattr(got, "scratch")
    with open(p, "a") as f:
        json.dump({"meta": {}, "events": []}, f, indent=2)
    with pytest.raises(ValueError, match="several"):
        rd.read_watchlist_json(spark, p).collect()


def test_broken_documents_raise(spark, tmp, small_splits):
    text = json.dumps({"events": events(100, 3)}, indent=2)
    for k, broken in enumerate((text[:-40], text.replace("},", "}", 1), text.replace(": null", ": nul", 1))):
        p = os.path.join(tmp, f"b{k}.json")
        with open(p, "w") as f:
            f.write(broken)
        with pytest.raises(Exception, match="(?i)malformed"):
            rd.read_watchlist_json(spark, p).collect()


def test_layout_is_found_without_reading_the_feed(spark, tmp):
    p = os.path.join(tmp, "big.json")
    line = json.dumps({"events": events(3, 0)})
    with open(p, "w") as f:
        f.write("\n \n" + (line + "\n") * 2000)
    group = "probe-test"
    spark.sparkContext.setJobGroup(group, group)
    try:
        assert rd.spread_over_lines(spark, p) is False
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []   # no job ran
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rd.read_watchlist_json(spark, p).count() == 6000
