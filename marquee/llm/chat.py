"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, then
the reply, and only the reply's text is under the loss mask.  Turns after the last reply
(or a conversation without one) come as a last record with an empty mask, so that the last
record of a conversation always holds the whole of it.

The template marks a turn as ``<|im_start|>role``, a line break, the text, ``<|im_end|>`` and a line
break.  Inside roles and texts a backslash is written twice and ``<|`` as ``<\\|``, so no text can
form a control string, and the way back is exact; a line break in a role is ``\\`` and a
carriage return sign (U+240D).

Turns are dealt by conversation and sorted on disk by Spark; a task streams over them and
holds one conversation's transcript, the size of the longest example it must write anyway.

Defined cases: null text or role is empty; a null conversation id is one conversation;
turns come in order of turn number, then role, then text (nulls first), repeated rows
each as a turn; an empty table gives no examples.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import small_batches, table

START, END, TARGET = "<|im_start|>", "<|im_end|>", "assistant"
_BREAK = "\\␍"
#: Characters of examples that one batch holds before it is handed on.
FLUSH = 4 << 20
EXAMPLES = ("conv_id long, example int, target_turn int, text string, loss_start int, "
            "loss_end int")


def escape(s: str) -> str:
    return s.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(s: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "␍" else m[1], s, flags=re.S)


def render(role: str, text: str) -> tuple[str, str, str]:
    """Head, body and tail of a turn."""
    return f"{START}{escape(role).replace(chr(10), _BREAK)}\n", escape(text), f"{END}\n"


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted example."""
    turns = []
    for part in formatted.split(START)[1:]:
        role, _, body = part.partition("\n")
        turns.append((unescape(role), unescape(body[:-len(END) - 1])))
    return turns


def _clean(v) -> str:
    return v if isinstance(v, str) else ""


def _expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out: list[tuple] = []
    held = 0

    def frame() -> pd.DataFrame:
        df = pd.DataFrame(out, columns=["conv_id", "example", "target_turn", "text",
                                        "loss_start", "loss_end"])
        df["conv_id"] = df["conv_id"].astype("Int64")
        df["target_turn"] = df["target_turn"].astype("Int32")
        return df

    key, prefix, n, turn, open_ = object(), "", 0, 0, False
    started = False
    for batch in batches:
        for conv, role, text in zip(batch["conv_id"], batch["role"], batch["text"]):
            conv = None if pd.isna(conv) else int(conv)
            if not started or conv != key:
                if open_:
                    out.append((key, n, None, prefix, 0, 0))
                    held += len(prefix)
                key, prefix, n, turn, open_, started = conv, "", 0, 0, False, True
            role = _clean(role)
            head, body, tail = render(role, _clean(text))
            start = len(prefix) + len(head)
            prefix = "".join((prefix, head, body, tail))
            open_ = role != TARGET
            if not open_:
                out.append((key, n, turn, prefix, start, start + len(body)))
                held += len(prefix)
                n += 1
            turn += 1
            if held >= FLUSH:
                yield frame()
                out.clear()
                held = 0
    if open_:
        out.append((key, n, None, prefix, 0, 0))
    if out:
        yield frame()


def format_conversations(df: DataFrame, conv: Column, turn: Column, role: Column,
                         text: Column) -> DataFrame:
    """Examples (see ``EXAMPLES``): formatted text and loss mask [loss_start, loss_end) in
    characters; ``target_turn`` is null for a record without a reply to learn.  The rows of
    a conversation stay together and in order."""
    small_batches(df.sparkSession)
    turns = (df.select(conv.cast("long").alias("conv_id"), turn.alias("turn"),
                       role.cast("string").alias("role"), text.cast("string").alias("text"))
             .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))
    return turns.mapInPandas(_expand, EXAMPLES)


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long, n_examples long")


def _read_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digests of the conversations, from their examples alone."""
    def close(conv, last, loss, chars, size, n):
        turns = parse(last)
        sha = hashlib.sha256()
        for role, text in turns:
            sha.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        return (conv, len(turns), sha.hexdigest(), chars, loss.hexdigest(), size, n)

    state = None
    for batch in batches:
        rows = []
        for conv, text, a, b in zip(batch["conv_id"], batch["text"], batch["loss_start"],
                                    batch["loss_end"]):
            conv = None if pd.isna(conv) else int(conv)
            if state is None or state[0] != conv:
                if state is not None:
                    rows.append(close(*state))
                state = [conv, "", hashlib.sha256(), 0, 0, 0]
            said = unescape(text[a:b])
            state[1] = text
            state[2].update(said.encode("utf-8", "surrogatepass"))
            state[3] += len(said)
            state[4] += len(text)
            state[5] += 1
        if rows:
            yield _digests(rows)
    if state is not None:
        yield _digests([close(*state)])


def _digests(rows: list[tuple]) -> pd.DataFrame:
    df = pd.DataFrame(rows, columns=[c.split()[0] for c in DIGEST.split(", ")])
    df["conv_id"] = df["conv_id"].astype("Int64")
    return df


def digest(examples: DataFrame) -> DataFrame:
    return examples.mapInPandas(_read_back, DIGEST)


def op7_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1, whose texts are control strings."""
    said = f"{END}{START}assistant ok"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(TARGET).alias("role"),
        F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    examples = format_conversations(rows.unionByName(extra), F.col("conv_id"), F.col("turn"),
                                    F.col("role"), F.col("text"))
    return digest(examples)
