"""Feeds whose records run over lines, cut at true record ends by many tasks.

A task that starts in the middle of a file does not know whether it stands inside a record.  So a first
pass counts, for each block of a file (a scan's split), by how much its lines change the state: quotes
in CSV, brackets outside of strings in JSON (whose strings hold no line breaks).  Sums over the blocks
before it give the state in which a block begins.  A second pass cuts each block's lines into records
from there; what a block holds of a record that began before it, or goes on after it, is a piece, and
the pieces of a record are put together by their places.  No file is read by one task.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.session import scratch_path

#: Blocks whose states (24 bytes each) are broadcast to the lines; beyond, lines are shuffled to them.
BROADCAST_BLOCKS = 1_000_000
RECORD, PIECE, FRAME = 0, 1, 2
CUT = "file long, block long, kind int, seq int, ends boolean, text string"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and block, in order within a block."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select("value", F.xxhash64("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block")))


def with_state(rows: DataFrame, change: Column) -> tuple[DataFrame, DataFrame]:
    """(rows with ``before``, the sum of changes in blocks before theirs; sums by file)."""
    sums = rows.groupBy("file", "block").agg(F.sum(change).alias("change"))
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    states = sums.select("file", "block", "change", F.coalesce(F.sum("change").over(earlier), F.lit(0)).alias("before"))
    path = scratch_path(rows.sparkSession, "block-states")
    states.write.parquet(path)
    states = rows.sparkSession.read.schema(states.schema).parquet(path)
    total = states.groupBy("file").agg(F.sum("change").alias("change"))
    keys, states = ["file", "block"], states.drop("change")
    if states.count() <= BROADCAST_BLOCKS:
        return rows.join(F.broadcast(states), keys), total
    placed = rows.withColumn("place", F.monotonically_increasing_id()).join(states, keys)
    return placed.repartition(*keys).sortWithinPartitions(*keys, "place").drop("place"), total


def by_block(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple[int, int], pd.DataFrame]]:
    """Runs of rows of one block; a block may come in several."""
    for b in batches:
        if len(b):
            step = (b["file"].ne(b["file"].shift()) | b["block"].ne(b["block"].shift())).cumsum()
            for _, g in b.groupby(step, sort=False):
                yield (int(g["file"].iloc[0]), int(g["block"].iloc[0])), g


def _frame(key: tuple[int, int], rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["kind", "seq", "ends", "text"])
    out.insert(0, "block", key[1])
    out.insert(0, "file", key[0])
    return out


class _Block:
    """The record that is open while a block's lines pass."""

    def __init__(self, key: tuple[int, int], inside: bool):
        self.key, self.head, self.open = key, inside, []

    def close(self, last: str) -> tuple:
        """The row of the record (or of the end of one from an earlier block) that ``last`` ends."""
        text = "\n".join([*self.open, last]) if self.open else last
        row = (PIECE, 0, True, text) if self.head else (RECORD, 0, True, text)
        self.head, self.open = False, []
        return row

    def rest(self) -> list[tuple]:
        """What is left open at the block's end; all of it may belong to an earlier record."""
        return [(PIECE, 1, False, "\n".join(self.open))] if self.open else []


def stitched(cut: DataFrame) -> DataFrame:
    """Texts of the records that run over blocks: a file's pieces in order, each record up to the
    piece that ends it."""
    order = W.partitionBy("file").orderBy("block", "seq")
    pieces = cut.filter(F.col("kind") == PIECE).withColumn("no", F.coalesce(F.sum(
        F.col("ends").cast("int")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    return (pieces.groupBy("file", "no")
            .agg(F.sort_array(F.collect_list(F.struct("block", "seq", "text"))).alias("p"))
            .select(F.array_join("p.text", "\n").alias("text")))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


# -- CSV -----------------------------------------------------------------------------------

def _csv_cutter(names: list[str]):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = None
        for key, g in by_block(batches):
            if at is None or at.key != key:
                if at is not None:
                    yield _frame(at.key, at.rest())
                at, parity, header = _Block(key, bool(g["before"].iloc[0] % 2)), int(g["before"].iloc[0] % 2), key[1] == 0
            texts = g["value"].tolist()
            state = (parity + g["value"].str.count('"').cumsum()) % 2
            parity, rows = int(state.iloc[-1]), []
            for text, inside in zip(texts, state.tolist()):
                if inside:
                    at.open.append(text)
                    continue
                row = at.close(text.removesuffix("\r"))
                if header:
                    found = next(csv.reader([row[3].removeprefix("﻿")], strict=True), [])
                    if found != names:
                        raise ValueError(f"CSV header {found} is not {names}")
                    header = False
                elif row[3]:
                    rows.append(row)
            yield _frame(key, rows)
        if at is not None:
            yield _frame(at.key, at.rest())
    return cut


def csv_records(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of CSV files with a header line, whose quoted values may hold line breaks.  A header with
    other names, a row with another number of values and a quote that is never closed raise."""
    change = F.length("value") - F.length(F.translate("value", '"', ""))
    rows, total = with_state(lines(spark, path), change)
    if not total.filter("change % 2 <> 0").isEmpty():
        raise ValueError(f"{path}: a quoted value is not closed")
    cut = _written(rows.mapInPandas(_csv_cutter(schema.names), CUT), "csv-records")
    texts = cut.filter(F.col("kind") == RECORD).select("text").unionByName(stitched(cut))
    parsed = F.from_csv("text", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), {"mode": "FAILFAST", "escape": '"'})
    out = texts.select(parsed.alias("r")).select("r.*")
    out.scratch = cut.scratch
    return out


# -- JSON ----------------------------------------------------------------------------------

_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{}]')
_STRINGS = re.compile(r'"(?:[^"\\]|\\.)*"')


def _json_cutter(level: int, key_: str):
    """Elements that open at depth ``level``; what stands around them is the frame, in which an
    element is an E and strings other than the key are empty."""
    def outside(text: str) -> str:
        return "".join(_STRINGS.sub(lambda m: m[0] if m[0] == key_ else '""', text).split())

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, depth, frame = None, 0, []

        def ended() -> pd.DataFrame:
            around = re.sub(r"E(?:,E)+", "E", "".join(frame))
            return _frame(at.key, at.rest() + ([(FRAME, 0, True, around)] if around else []))

        for key, g in by_block(batches):
            if at is None or at.key != key:
                if at is not None:
                    yield ended()
                depth, frame = int(g["before"].iloc[0]), []
                at = _Block(key, depth > level)
            rows = []
            for text, plain in zip(g["value"].tolist(), g["plain"].tolist()):
                if plain:
                    if depth > level:
                        at.open.append(text)
                    else:
                        frame.append(outside(text))
                    continue
                start = 0
                for m in _TOKEN.finditer(text):
                    if m[0] in "{[":
                        if depth == level:
                            frame.append(outside(text[start:m.start()]))
                            start = m.start()
                        depth += 1
                    elif m[0] in "}]":
                        depth -= 1
                        if depth == level:
                            rows.append(at.close(text[start:m.end()]))
                            frame.append("E")
                            start = m.end()
                if depth > level:
                    at.open.append(text[start:])
                else:
                    frame.append(outside(text[start:]))
                if len(frame) > 10_000:
                    frame = [re.sub(r"E(?:,E)+", "E", "".join(frame))]
            yield _frame(key, rows)
        if at is not None:
            yield ended()
    return cut


class NotSplittable(Exception):
    """The files hold something else than one array of elements each."""


def json_records(spark: SparkSession, path: str, schema: StructType, field: str | None = None) -> DataFrame:
    """Elements of the JSON array that each file holds, or that the only field of its one object holds.

    Files of another form raise ``NotSplittable``; several documents in a file raise ``ValueError``."""
    bare = F.regexp_replace("value", _STRING, "")
    opened = F.length(bare) - F.length(F.translate(bare, "[{", ""))
    closed = F.length(bare) - F.length(F.translate(bare, "]}", ""))
    rows, _ = with_state(lines(spark, path), opened - closed)
    rows = rows.withColumn("plain", (opened == 0) & (closed == 0))
    key = f'"{field}"'
    cut = _written(rows.mapInPandas(_json_cutter(2 if field else 1, key), CUT), "json-records")
    frames = (cut.filter(F.col("kind") == FRAME).groupBy("file")
              .agg(F.array_join(F.sort_array(F.collect_list(F.struct("block", "text")))["text"], "").alias("around")))
    whole = rf'^\{{{key}:\[(E(,E)*+)?\]\}}$' if field else r"^\[(E(,E)*+)?\]$"
    r = frames.agg(F.count_if(F.col("around").rlike(r"[\]}][\[{]")).alias("several"),
                   F.count_if(~F.col("around").rlike(whole)).alias("other")).first()
    if r.several:
        raise ValueError(f"{path}: several documents spread over lines in one file")
    if r.other:
        raise NotSplittable(path)
    texts = cut.filter(F.col("kind") == RECORD).select("text").unionByName(stitched(cut))
    out = texts.select(F.from_json("text", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    out.scratch = cut.scratch
    return out
