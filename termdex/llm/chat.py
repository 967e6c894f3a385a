"""Chat formatting by quotation linking.

Messages often repeat what they answer as quoted lines (``>``, ``> >``, ``>>``). Quote
levels are parsed, quoted passages are normalised (markers stripped, white space joined,
lower case) and hashed, and the hashes are joined, within the conversation, to the first
message that holds the passage as its own text. A message replies to the latest earlier
message that its outermost quotes come from; with none of those found, to the latest one
its deeper quotes come from. A message, and all that reply to it directly or through
others, form a thread, and a conversation is ordered by thread and then turn: every
reply comes after what it answers, and next to it. Quoted lines, and the line that
introduces them (``... wrote:``), are left out.

A passage is a run of lines of one quote level. It is looked up as a whole and line by line,
against the whole messages, their paragraphs and their lines, so a partly quoted or
trimmed message is found as well. A passage of fewer than ``SHORT`` characters (``> Why?``) could
come from anywhere, so it links to the first earlier message that is nothing else, and
to a paragraph or line only if no other turn of the conversation has it.

How it runs. Parsing is a map. Originals are reduced to one row for each conversation and
hash (its first turn) before the join, with map-side partial minima, so a passage that a
third of all messages share is no hot group and no join multiplies. Threads are found by
pointer jumping over the links alone, a table per round. Messages are sorted by range over
all conversations, so one of any length, or one whose messages all answer one turn, is cut
over many tasks; positions add the conversation's counts of the ranges before (one row for
each range that it lies in). A conversation is emitted in parts of ``PART`` messages, so no row
grows with it.

Null ids are one conversation; null turns come first and are never linked to; null roles
are ``unknown``; null texts are empty. Exactly repeated rows are one message. Messages of
one turn are ordered by role and text. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termdex.llm.common import saved, slots, small_batches

# Messages in a part of a conversation.
PART = 64
# Passages shorter than this many characters, normalised, need a whole message or a single origin.
SHORT = 8
# Characters of a message by which those of one turn and role are dealt to ranges.
HEAD = 64

_MARK = re.compile(r"[ \t]*>[ \t]?")
_INTRO = re.compile(r".{0,200}\b(?:wrote|writes|said|schrieb|écrit|escribió)\s*:\s*$", re.IGNORECASE)


def level_of(line: str) -> tuple[int, str]:
    """Quote level of a line, and the line without its markers."""
    level = at = 0
    while m := _MARK.match(line, at):
        level, at = level + 1, m.end()
    return level, line[at:]


def normal(text: str) -> str:
    return " ".join(text.split()).lower()


def _hash(text: str) -> int | None:
    """Hash of a passage that is long enough to be looked up anywhere."""
    x = normal(text)
    return xxhash.xxh64_intdigest(x) - (1 << 63) if len(x) >= SHORT else None


def _short(text: str, how: str) -> int | None:
    """Hash of a short passage as a ``whole`` message or as a ``part`` of one."""
    x = normal(text)
    return xxhash.xxh64_intdigest(f"{how}\n{x}") - (1 << 63) if 0 < len(x) < SHORT else None


def parse(text: str | None) -> tuple[str, list[tuple[int, int, list[int]]], list[int]]:
    """Own text; quoted passages ``(number, level, hashes)``; hashes of the own passages.

    Hashes of short parts are odd, all others even.
    """
    own: list[str] = []
    runs: list[tuple[int, list[str]]] = []
    last = 0
    for line in (text or "").splitlines():
        level, rest = level_of(line)
        if level:
            if last != level:
                if not last:
                    while own and not own[-1].strip():
                        own.pop()
                    if own and _INTRO.match(own[-1]):
                        own.pop()
                runs.append((level, []))
            runs[-1][1].append(rest)
        else:
            own.append(line)
        last = level
    kept = "\n".join(own).strip()
    quoted = []
    for k, (level, lines) in enumerate(runs):
        # quoted introductions belong to the quoting, not to the passage
        lines = [x for x in lines if not _INTRO.match(x)]
        whole = "\n".join(lines)
        units = _even({_hash(whole), *map(_hash, lines), _short(whole, "whole")}) | _odd({_short(whole, "part")})
        if units:
            quoted.append((k, level, sorted(units)))
    parts = [*re.split(r"\n\s*\n", kept), *kept.split("\n")]
    mine = _even({_hash(kept), *map(_hash, parts), _short(kept, "whole")}) | _odd({_short(x, "part") for x in parts})
    return kept, quoted, sorted(mine)


def _even(hashes: set[int | None]) -> set[int]:
    return {h & ~1 for h in hashes if h is not None}


def _odd(hashes: set[int | None]) -> set[int]:
    return {h | 1 for h in hashes if h is not None}


_PARSED = (
    T.StructType()
    .add("content", T.StringType())
    .add("quoted", T.ArrayType(T.StructType().add("passage", T.IntegerType()).add("level", T.IntegerType()).add("hashes", T.ArrayType(T.LongType()))))
    .add("own", T.ArrayType(T.LongType()))
)


@F.pandas_udf(_PARSED)
def _parse(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for t in texts:
        rows = []
        for x in t:
            content, quoted, own = parse(x)
            rows.append((content, [{"passage": k, "level": lv, "hashes": h} for k, lv, h in quoted], own))
        yield pd.DataFrame(rows, columns=["content", "quoted", "own"])


def _same(a: DataFrame, b: DataFrame, *names: str):
    """Null-safe equality of columns."""
    on = a[names[0]].eqNullSafe(b[names[0]])
    for n in names[1:]:
        on &= a[n].eqNullSafe(b[n])
    return on


def _threads(links: DataFrame) -> DataFrame:
    """``(conv, turn, up)`` links -> ``(conv, turn, top, depth)`` by pointer jumping."""
    at = saved(links.select("conv", "turn", F.col("up").alias("top"), F.lit(1).cast("long").alias("depth")), "chat-links")
    while True:
        nxt = at.select(F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("top").alias("further"), F.col("depth").alias("more"))
        step = at.join(nxt, at["conv"].eqNullSafe(nxt["c"]) & (at["top"] == nxt["t"]), "left")
        moved = saved(
            step.select("conv", "turn", F.coalesce("further", "top").alias("top"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("further").isNotNull().alias("moved")),
            "chat-links",
        )
        at = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return at


def messages(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, turn, role, content, n_quoted, n_linked, reply_to, thread, depth`` of every message."""
    small_batches(conversations.sparkSession)
    rows = conversations.select(
        F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("unknown")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).distinct()
    rows = saved(rows.withColumn("key", F.xxhash64("conv", "turn", "role", "text")).withColumn("p", _parse("text")).select("conv", "turn", "role", "key", "p.*"), "chat-messages")

    first = rows.filter("turn is not null").select("conv", "turn", F.explode("own").alias("hash")).groupBy("conv", "hash").agg(F.min("turn").alias("origin"), F.max("turn").alias("last"))
    # an odd hash is a short part: only one that a single turn has
    first = first.filter((F.col("hash") % 2 == 0) | (F.col("origin") == F.col("last"))).drop("last")
    said = rows.select("conv", "turn", "key", F.explode("quoted").alias("q")).select("conv", "turn", "key", "q.passage", "q.level", F.explode("q.hashes").alias("hash"))
    known = said.join(first, _same(said, first, "conv", "hash")).select(said["conv"], "turn", "key", "passage", "level", "origin").filter("origin < turn")
    linked = known.groupBy("conv", "turn", "key").agg(
        F.count_distinct("passage").alias("n_linked"),
        F.coalesce(F.max(F.when(F.col("level") == 1, F.col("origin"))), F.max("origin")).alias("reply_to"),
    )
    linked = saved(linked, "chat-linked")
    up = linked.groupBy("conv", "turn").agg(F.max("reply_to").alias("up"))
    tops = _threads(up)
    l = linked.select(F.col("conv").alias("c"), F.col("key").alias("k"), "n_linked", "reply_to")  # noqa: E741
    out = rows.join(l, rows["conv"].eqNullSafe(l["c"]) & (rows["key"] == l["k"]), "left")
    t = tops.select(F.col("conv").alias("c2"), F.col("turn").alias("t2"), "top", "depth")
    out = out.join(t, out["conv"].eqNullSafe(t["c2"]) & (out["turn"] == t["t2"]), "left")
    return out.select(
        "conv", "turn", "role", "content", F.size("quoted").cast("long").alias("n_quoted"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        "reply_to", F.coalesce("top", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).alias("depth"), "key",
    )


def ordered(found: DataFrame) -> DataFrame:
    """Add ``position``, counted from 0 in reply order, to ``messages``."""
    head = F.substring("content", 1, HEAD)
    by = ["conv", "thread", "turn", "role", "head", "content", "key"]
    ranged = found.withColumn("head", head).repartitionByRange(slots(found), *by[:5]).sortWithinPartitions(*by)
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ranged = saved(ranged.withColumns({"range": F.spark_partition_id(), "place": place}), "chat-ordered")
    counts = ranged.groupBy("conv", "range").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    earlier = F.sum("n").over(Window.partitionBy("conv").orderBy("range")) - F.col("n")
    # what to add to a place: the conversation's messages in earlier ranges, less where it begins in this one
    shift = counts.select("conv", "range", (earlier - F.col("first")).alias("shift"))
    joined = ranged.join(shift, _same(ranged, shift, "conv", "range")).drop(shift["conv"], shift["range"])
    return joined.withColumn("position", F.col("place") + F.col("shift")).drop("range", "place", "shift", "head", "key")


def chats(placed: DataFrame, part: int = PART) -> DataFrame:
    """``conv_id, part, n_messages, n_replies, turns, chat``: conversations in reply order, in parts."""
    one = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("content"), F.lit("<|end|>\n"))
    rows = placed.withColumn("part", F.floor(F.col("position") / part)).withColumn("m", F.struct("position", "turn", one.alias("line"), F.col("reply_to").isNotNull().alias("reply")))
    return rows.groupBy("conv", "part").agg(F.sort_array(F.collect_list("m")).alias("ms")).select(
        F.col("conv").alias("conv_id"), "part", F.size("ms").cast("long").alias("n_messages"),
        F.size(F.filter("ms", lambda m: m["reply"])).cast("long").alias("n_replies"), F.col("ms.turn").alias("turns"), F.array_join("ms.line", "").alias("chat"),
    )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """All steps: conversations in reply order, without quotes."""
    return chats(ordered(messages(conversations)))
