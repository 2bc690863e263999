"""Conversations out of reply trees, and their text with turn marks."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.operators.scratch import materialize

#: Strings that mean something to this template or to other common ones (fixed values).
CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
BEGIN, SEP, END = "<|turn|>", "\n", "<|end|>\n"

_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROLS))
_TURN = re.compile(re.escape(BEGIN) + "(.*?)" + SEP + "(.*?)" + re.escape(END), re.DOTALL)


def escape(text: str) -> str:
    """Backslashes are doubled, then one is put after the first character of a control string."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def escape_role(role: str) -> str:
    """A role also gives up its line breaks, which end it: \\n stands for one."""
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(\\|n|)", lambda m: {"\\": "\\", "n": "\n", "": ""}[m[1]], role)


def read_back(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end of the escaped text) of every turn."""
    return [(unescape_role(m[1]), unescape(m[2]), m.start(2), m.end(2)) for m in _TURN.finditer(formatted)]


def reply_paths(messages: DataFrame, *, branches: int = 1) -> DataFrame:
    """Rows (conv, leaf, id, depth): the messages on the `branches` best root-to-leaf
    paths of every conversation's trees, depth counted up from the root.

    `messages` has conv, id, parent (null for a root) and score; ids are unique in a
    conversation. A path's score is the mean of its messages', null as 0; ties go to the
    smallest leaf. The paths come from self-joins that double their reach each round, so
    a thread of n replies takes log2(n) rounds; each round is a written table. A parent
    that is not there makes a root; messages on a circle have none and lie on no path.
    Only chosen leaves are unrolled into rows.
    """
    known = messages.select("conv", "id")
    parents = known.select(F.col("conv").alias("c"), F.col("id").alias("p"))
    linked = messages.join(parents, (F.col("conv") == F.col("c")) & (F.col("parent") == F.col("p")), "left")
    start = linked.select(
        "conv", "id", F.col("p").alias("up"), F.lit(1).cast("long").alias("steps"),
        F.coalesce("score", F.lit(0.0)).cast("double").alias("sum"),
    )
    hops, n = [materialize(start, "hops")], None
    while (left := hops[-1].where("up IS NOT NULL").count()) and left != n:
        # As long as threads reach the root, fewer messages have something above them,
        # and only those are joined; the others have their whole path.
        n, now = left, hops[-1]
        above = now.select(
            F.col("conv").alias("c"), F.col("id").alias("p"), F.col("up").alias("next"),
            F.col("steps").alias("more"), F.col("sum").alias("plus"),
        )
        under = now.where("up IS NOT NULL")
        moved = under.join(above, (F.col("conv") == F.col("c")) & (F.col("up") == F.col("p"))).select(
            "conv", "id", F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps"),
            (F.col("sum") + F.col("plus")).alias("sum"),
        )
        hops.append(materialize(now.where("up IS NULL").unionByName(moved), "hops"))
    whole = hops[-1].where("up IS NULL")
    inner = linked.where("p IS NOT NULL").select("conv", F.col("p").alias("id")).distinct()
    leaves = whole.join(inner, ["conv", "id"], "left_anti")
    rank = F.row_number().over(W.partitionBy("conv").orderBy(F.desc(F.col("sum") / F.col("steps")), "id"))
    chosen = leaves.withColumn("rank", rank).where(F.col("rank") <= branches)
    paths = chosen.select("conv", F.col("id").alias("leaf"), "id", F.col("steps").alias("depth"))
    paths = materialize(paths, "paths")
    for k, hop in enumerate(hops[:-1]):
        # The rows so far reach 2^k - 1 replies up from their leaf; each now adds its 2^k-th.
        up = hop.where("up IS NOT NULL").select(F.col("conv").alias("c"), F.col("id").alias("p"), "up")
        above = paths.join(up, (F.col("conv") == F.col("c")) & (F.col("id") == F.col("p"))).select(
            "conv", "leaf", F.col("up").alias("id"), (F.col("depth") - (1 << k)).alias("depth")
        )
        paths = materialize(paths.unionByName(above), "paths")
    return paths


def format_paths(turns: DataFrame) -> DataFrame:
    """One row per path: conv, leaf, formatted, loss (spans of code points: start, end of
    the assistant's escaped texts). `turns` has conv, leaf, depth, role, text.

    A path's turns go to one task, sorted, and are written out as they come, so a task
    holds the text of one conversation and a batch of turns. A null role or text is
    empty. Turns of equal depth, if any, are in order of role and text.
    """

    def work(batches):
        key, parts, spans, at = None, [], [], 0
        out: list[tuple] = []
        for batch in batches:
            for conv, leaf, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (conv, leaf) != key:
                    if key is not None:
                        out.append((*key, "".join(parts), spans))
                    key, parts, spans, at = (conv, leaf), [], [], 0
                head, body = BEGIN + escape_role(role or "") + SEP, escape(text or "")
                if role == "assistant":
                    spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
                parts += [head, body, END]
                at += len(head) + len(body) + len(END)
            if out:
                yield _formatted(out)
                out = []
        if key is not None:
            yield _formatted([(*key, "".join(parts), spans)])

    dealt = turns.repartition("conv", "leaf").sortWithinPartitions("conv", "leaf", "depth", "role", "text")
    return dealt.select("conv", "leaf", "role", "text").mapInArrow(
        work, "conv long, leaf long, formatted string, loss array<struct<start:long,end:long>>"
    )


def _formatted(rows: list[tuple]) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = [pa.int64(), pa.int64(), pa.string(), span]
    columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, ["conv", "leaf", "formatted", "loss"])


def thread_tree(rows: DataFrame) -> DataFrame:
    """conversations(conv_id, turn, role, text) as a reply tree: conv, id, parent, score,
    role, text. Each turn answers the one before it; repeats of a turn follow one another
    in order of role and text. An id is the turn's place in its conversation, so gaps
    and null turns (which come first) do no harm; a null conversation is one of its own.
    The score, text length, only matters where there are branches. A conversation's
    turns meet in one task, as its text has to be written by one anyway."""
    order = W.partitionBy("conv").orderBy("turn", "role", "text")
    place = F.row_number().over(order).cast("long")
    return rows.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(-(1 << 62))).alias("conv"), "turn", "role", "text"
    ).select(
        "conv", place.alias("id"), F.nullif(place - 1, F.lit(0)).alias("parent"),
        F.char_length(F.coalesce("text", F.lit(""))).cast("double").alias("score"), "role", "text",
    )


def format_trees(messages: DataFrame, *, branches: int = 1) -> DataFrame:
    """reply_paths() of the messages, each path formatted as one conversation."""
    narrow = materialize(messages.select("conv", "id", "parent", "score"), "messages")
    paths = reply_paths(narrow, branches=branches)
    return format_paths(paths.join(messages.select("conv", "id", "role", "text"), ["conv", "id"]))


