"""Chat formatting (operator 9): quotation linking.

Messages are parsed into their own text and quoted passages with nested levels
(``>`` marks; attribution lines such as "On ... wrote:" go with their quote). A
passage is hashed after normalising white space and case, and joined to the first
earlier message of the same conversation that says it in its own text: as a whole
message, a paragraph or a line. A quoted passage found nowhere as a whole is tried
by its longest line.

The first linked passage of the outermost level names the message replied to.
Messages that reply to their predecessor (the message with the greatest smaller turn
that exists in the conversation) continue its thread, a reply to an earlier message
opens a thread below that message's, and messages without a link are threads by
themselves. Sorting by (conv_id, thread, turn) gives every
conversation in reply order, without quotes.

A conversation is never gathered: passages are reduced to their first speaker
before the join, so quotes meet one row each, and threads are found by pointer
jumping over the links alone. A thread's path has one number for each level of
sub-threads, so a chain of d sub-threads, each opened below the one before, writes
d * d / 2 numbers; replies to the predecessor add no level.

Defined cases: a null text is empty; a null conv_id is a conversation like others;
rows that repeat a (conv_id, turn) keep their own row and share the place;
a quote of a later, unknown or own message gives no link; an empty table gives an
empty result; extra columns pass through unless named like an output column.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from strata.llm.common import Scratch

MARK = re.compile(r"^\s{0,3}((?:>\s?)+)(.*)$")
ATTRIBUTION = re.compile(r"^(?:on\b.{1,200}\bwrote|.{1,120}\b(?:wrote|writes|said)|am\b.{1,200}\bschrieb.{0,120}|le\b.{1,200}\ba écrit)\s*:\s*$", re.I)
SEPARATOR = re.compile(r"^\s*-{2,}\s*(?:original message|forwarded message|ursprüngliche nachricht)\s*-{2,}\s*$", re.I)


def normal(lines: list[str]) -> str:
    return " ".join(" ".join(lines).casefold().split())


def named(text: str) -> str | None:
    return xxhash.xxh3_128_hexdigest(text.encode()) if text else None


def parse_message(text: str) -> tuple[str, list[tuple[int, list[str]]]]:
    """Own text, and quoted passages (level, lines) in their order."""
    lines: list[tuple[int, str]] = []
    for line in text.split("\n"):
        m = MARK.match(line)
        lines.append((m[1].count(">"), m[2]) if m else (0, line))
    ahead, level = [0] * len(lines), 0  # the level of the next line that is quoted or not blank
    for k in range(len(lines) - 1, -1, -1):
        ahead[k] = level
        if lines[k][0] or lines[k][1].strip():
            level = lines[k][0]
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    for k, (level, body) in enumerate(lines):
        if ahead[k] > level and (ATTRIBUTION.match(body.strip()) or SEPARATOR.match(body)):
            continue
        if not level:
            own.append(body)
        elif passages and k and lines[k - 1][0] == level and passages[-1][0] == level and body.strip():
            passages[-1][1].append(body)
        elif body.strip():
            passages.append((level, [body]))
    return re.sub(r"\n{3,}", "\n\n", "\n".join(own)).strip(), passages


def own_names(own: str) -> list[str]:
    """Hashes under which a message's own text can be quoted: all of it, its paragraphs, its lines."""
    out = {named(normal([own]))}
    for part in re.split(r"\n\s*\n", own):
        out.add(named(normal([part])))
        for line in part.split("\n"):
            out.add(named(normal([line])))
    return sorted(x for x in out if x)


def parsed(messages: DataFrame, text: str) -> DataFrame:
    """All columns but the text, the own text, the hashes of own passages and the quotes."""
    rest = [c for c in messages.columns if c not in (text, "own", "says", "quotes")]
    quote = StructType().add("level", "integer").add("pos", "integer").add("hash", "string").add("line", "string")
    schema = StructType([messages.schema[c] for c in rest])
    schema = schema.add("own", "string").add("says", ArrayType(StringType())).add("quotes", ArrayType(quote))
    arrow_quote = pa.list_(pa.struct([("level", pa.int32()), ("pos", pa.int32()), ("hash", pa.string()), ("line", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, says, quotes = [], [], []
            for t in b.column(b.num_columns - 1).to_pylist():
                body, passages = parse_message(t or "")
                own.append(body)
                says.append(own_names(body))
                quotes.append([
                    {"level": level, "pos": k, "hash": named(normal(lines)), "line": named(max((normal([x]) for x in lines), key=len))}
                    for k, (level, lines) in enumerate(passages)])
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(b.num_columns - 1)] + [pa.array(own, pa.string()), pa.array(says, pa.list_(pa.string())), pa.array(quotes, arrow_quote)],
                names=[*rest, "own", "says", "quotes"])

    return messages.select(*rest, text).mapInArrow(run, schema)


def jump(pointers: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, to) pointers followed to their ends; the rounds are the logarithm of the longest chain."""
    state = scratch.save(pointers)
    while True:
        a, b = state.alias("a"), state.alias("b")
        step = a.join(b, F.col("a.to") == F.col("b.node"), "left").select(F.col("a.node").alias("node"), F.coalesce("b.to", "a.to").alias("to"), F.col("b.to").isNotNull().alias("moved"))
        after = scratch.save(step)
        scratch.drop(state)
        state = after.select("node", "to")
        state._scratch_path = after._scratch_path
        if after.where("moved").isEmpty():
            return state


def link(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """All rows with ``text`` (own text), ``reply_to`` (turn or null) and ``thread`` (turns from the outermost thread down)."""
    scratch = Scratch(messages.sparkSession, "quotes")
    added = ("reply_to", "thread")
    numbered = messages.drop(*added, "__row", "__conv").withColumn("__row", F.monotonically_increasing_id())
    numbered = numbered.withColumn("__conv", F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit("")))
    columns = [*[c for c in numbered.columns if c != text], text]
    rows = scratch.save(parsed(numbered.select(*columns), text))
    said = rows.select("__conv", F.col(turn).alias("at"), F.explode("says").alias("hash"))
    first = said.groupBy("__conv", "hash").agg(F.min("at").alias("at"))
    quotes = rows.select("__conv", "__row", F.col(turn).alias("now"), F.explode("quotes").alias("q"))
    quotes = quotes.select("__conv", "__row", "now", "q.level", "q.pos", "q.hash", "q.line")
    whole = quotes.join(first, ["__conv", "hash"], "left").where("at < now").select("__row", "level", "pos", F.lit(0).alias("by"), "at")
    by_line = quotes.drop("hash").withColumnRenamed("line", "hash").join(first, ["__conv", "hash"]).where("at < now")
    by_line = by_line.select("__row", "level", "pos", F.lit(1).alias("by"), "at")
    best = whole.unionByName(by_line).groupBy("__row").agg(F.min(F.struct("level", "by", "pos", "at")).alias("b"))
    replies = scratch.save(best.select("__row", F.col("b.at").alias("reply_to")))
    joined = rows.join(replies, "__row", "left")
    if replies.isEmpty():
        out = joined.withColumn("thread", F.array(F.col(turn).cast("long")))
    else:
        places = joined.select("__row", "__conv", F.col(turn).cast("long").alias("turn"), F.col("reply_to").cast("long"))
        threads = _threads(scratch.save(places.where("reply_to IS NOT NULL")), _predecessors(rows, turn, scratch), scratch)
        out = joined.join(threads, "__row", "left").withColumn("thread", F.coalesce("path", F.array(F.col(turn).cast("long"))))
    keep = [c for c in messages.columns if c not in (*added, text)]
    return out.select(*keep, F.col("own").alias(text), F.col("reply_to"), F.col("thread"))


def _predecessors(rows: DataFrame, turn: str, scratch: Scratch) -> DataFrame:
    """(__conv, turn, before): each distinct turn with the greatest smaller one of its conversation.

    Turns are ranged over partitions in order, so that a conversation may span
    many. Inside a partition one turn follows the other; the first of a partition
    takes the last of the nearest partition before that has turns (one row a
    partition).
    """
    turns = rows.select("__conv", F.col(turn).cast("long").alias("turn")).where("turn IS NOT NULL").distinct()
    ranged = scratch.save(turns.repartitionByRange("__conv", "turn").withColumn("part", F.spark_partition_id()))
    ends = ranged.groupBy("part").agg(F.max(F.struct("__conv", "turn")).alias("end"))
    ends = ends.select(F.col("part").alias("from"), F.lead("part", 1, 1 << 30).over(Window.orderBy("part")).alias("part"), "end")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = last = part = None
        for b in batches:
            before = []
            for c, t, p in zip(*[x.to_pylist() for x in b.columns[:3]]):
                before.append(last if (c, p) == (conv, part) else None)
                conv, last, part = c, t, p
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(before, pa.int64())], names=["__conv", "turn", "part", "before"])

    near = ranged.repartition("part").sortWithinPartitions("part", "__conv", "turn")
    inside = near.mapInArrow(run, "__conv string, turn long, part int, before long")
    first = inside.where("before IS NULL").join(ends.select("part", "end"), "part", "left")
    over = first.select("__conv", "turn", F.when(F.col("end.__conv") == F.col("__conv"), F.col("end.turn")).alias("before"))
    return scratch.save(inside.where("before IS NOT NULL").select("__conv", "turn", "before").unionByName(over))


def _threads(linked: DataFrame, order: DataFrame, scratch: Scratch) -> DataFrame:
    """(__row, path) of the messages that are linked (__row, __conv, turn, reply_to); ``order``: their conversations' turns."""
    place = lambda t: F.concat(F.col("__conv"), F.lit("|"), F.col(t).cast("string"))
    # several rows at one turn: the place follows the earliest reply
    places = linked.groupBy("__conv", "turn").agg(F.min("reply_to").alias("reply_to"))
    places = scratch.save(places.join(order, ["__conv", "turn"]).withColumn("near", F.col("before") == F.col("reply_to")))
    near = places.where("near").select(place("turn").alias("node"), place("reply_to").alias("to"))
    heads = jump(near, scratch)  # messages that go on -> the head of their thread
    down = places.where("NOT near").select(place("turn").alias("node"), place("reply_to").alias("to"), "turn")
    d, h = down.alias("d"), heads.alias("h")
    down = d.join(h, F.col("d.to") == F.col("h.node"), "left").select("d.node", F.coalesce("h.to", "d.to").alias("up"), F.array("d.turn").alias("path"))
    state = scratch.save(down)
    while True:  # paths double until they reach a thread without a parent
        a, b = state.alias("a"), state.alias("b")
        step = a.join(b, F.col("a.up") == F.col("b.node"), "left")
        after = scratch.save(step.select("a.node", F.coalesce("b.up", "a.up").alias("up"), F.concat(F.coalesce("b.path", F.array().cast("array<bigint>")), F.col("a.path")).alias("path"), F.col("b.up").isNotNull().alias("moved")))
        moved = not after.where("moved").isEmpty()
        state = after.select("node", "up", "path")
        if not moved:
            break
    top = lambda c: F.array(F.substring_index(F.col(c), "|", -1).cast("long"))
    full = state.select("node", F.concat(top("up"), "path").alias("path"))
    own = linked.select("__row", place("turn").alias("node")).alias("m").join(heads.alias("h"), F.col("m.node") == F.col("h.node"), "left")
    own = own.select("m.__row", F.coalesce("h.to", "m.node").alias("head"))
    return own.join(full.withColumnRenamed("node", "head"), "head", "left").select("__row", F.coalesce("path", top("head")).alias("path"))


def reply_ordered(linked: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """The rows in reply order, ranged over partitions: to be written as ordered files."""
    return linked.repartitionByRange(conv, "thread", turn).sortWithinPartitions(conv, "thread", turn)
