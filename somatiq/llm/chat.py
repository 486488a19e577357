"""Chat formatting of reply trees.

Nodes point at their parents. Iterative self-joins by pointer doubling give each node its root and
depth and each leaf the score of its branch (as many rounds as the logarithm of the greatest
depth, however long a chain is); each root's best branches become one conversation each. The
template marks turns, escapes control strings inside texts reversibly, and lists the spans that
the loss covers (the assistant's texts).

Edge cases: a null text is empty, a null role is ``user``; roles may hold any characters, line
breaks included; rows without a conversation id are one conversation; a node whose parent doesn't
exist, and each node in or under a cycle, is a root; repeated rows of a turn follow each other by
role and text; a conversation without an assistant has an empty mask; an empty table gives an empty
result; extra columns are ignored. A formatted conversation is one value of one row, so it is put
together in one task and has to stay below Spark's 2 GB for a value.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, durable

#: Control strings of this and of other common templates, escaped inside texts.
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>")
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    """Backslashes are doubled; a control string gets a backslash after its first character."""
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def escape_role(role: Column) -> Column:
    """As in texts; a line break, which ends a role, gets a backslash before it."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def parse_formatted(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read back from a formatted conversation."""
    turns = re.findall(re.escape(OPEN) + r"((?:\\.|[^\\\n])*)\n(.*?)" + re.escape(CLOSE), formatted, re.S)
    return [(unescape(role), unescape(text)) for role, text in turns]


def reply_branches(nodes: DataFrame, per_root: int = 1) -> DataFrame:
    """node_id, root_id, branch (rank 1 best), depth for the nodes of each root's best branches.

    nodes: node_id, parent_id (null: root), score. A branch's score is the sum of its nodes'
    scores; ties go to the deeper branch, then to the smaller leaf.
    """
    ids = nodes.select("node_id", "parent_id", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    known = ids.select(F.col("node_id").alias("p"))
    base = durable(ids.join(known, F.col("parent_id") == F.col("p"), "left").select("node_id", F.col("p").alias("up"), "score"), "chat-nodes")
    # Pointer jumping: (at, depth, score) sums from a node up to, without, the node it points at.
    # Only nodes that don't point at a root yet take part in a round.
    roots = base.where("up is null").select(F.col("node_id").alias("r"))
    first = base.join(roots, F.col("up") == F.col("r"), "left").select("node_id", F.coalesce("up", "node_id").alias("at"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("depth"), F.when(F.col("up").isNull(), 0.0).otherwise(F.col("score")).alias("score"), (F.col("up").isNull() | F.col("r").isNotNull()).alias("done"))
    state = durable(first, "chat-state")
    left, before = state.where("not done").count(), -1
    while left and left != before:
        there = state.select(F.col("node_id").alias("a"), F.col("at").alias("a_at"), F.col("depth").alias("a_depth"), F.col("score").alias("a_score"), F.col("done").alias("a_done"))
        moved = state.where("not done").join(there, F.col("at") == F.col("a")).select("node_id", F.col("a_at").alias("at"), (F.col("depth") + F.col("a_depth")).alias("depth"), (F.col("score") + F.col("a_score")).alias("score"), F.col("a_done").alias("done"))
        older, state = state, durable(state.where("done").unionByName(moved), "chat-state")
        discard(older)
        before, left = left, state.where("not done").count()
    if left:  # in a cycle, or under one: roots of their own
        lost = state.where("not done").select(F.col("node_id").alias("l"))
        base = durable(base.join(lost, F.col("node_id") == F.col("l"), "left").select("node_id", F.when(F.col("l").isNull(), F.col("up")).alias("up"), "score"), "chat-nodes")
        alone = state.where("not done").select("node_id", F.col("node_id").alias("at"), F.lit(0).cast("long").alias("depth"), F.lit(0.0).alias("score"), F.lit(True).alias("done"))
        state = durable(state.where("done").unionByName(alone), "chat-state")
    top = base.where("up is null").select(F.col("node_id").alias("r"), F.col("score").alias("r_score"))
    place = durable(state.join(top, F.col("at") == F.col("r")).select("node_id", F.col("at").alias("root_id"), "depth", (F.col("score") + F.col("r_score")).alias("score")), "chat-places")
    parents = base.where("up is not null").select("up").distinct()
    leaves = place.join(parents, F.col("node_id") == F.col("up"), "left_anti")
    rank = Window.partitionBy("root_id").orderBy(F.desc("score"), F.desc("depth"), "node_id")
    chosen = leaves.withColumn("branch", F.row_number().over(rank)).where(F.col("branch") <= per_root).select("node_id", "root_id", "branch")
    # All ancestors of the chosen leaves: each round doubles the stretch that is covered, and the
    # jump of the next round is this one's taken twice, where there is one.
    level = base.where("up is not null").select("node_id", "up")
    while not level.isEmpty():
        hop = level.select(F.col("node_id").alias("a"), "up")
        older = [t for t in (chosen, level) if hasattr(t, "durable_path")]
        chosen = durable(chosen.unionByName(chosen.join(hop, F.col("node_id") == F.col("a")).select(F.col("up").alias("node_id"), "root_id", "branch")), "chat-chosen")
        level = durable(level.join(level.select(F.col("node_id").alias("a"), F.col("up").alias("far")), F.col("up") == F.col("a")).select("node_id", F.col("far").alias("up")), "chat-level")
        discard(*older)
    return chosen.join(place.select(F.col("node_id").alias("n"), "depth"), F.col("node_id") == F.col("n")).drop("n")


def format_branches(turns: DataFrame) -> DataFrame:
    """conv_id, branch, n_turns, formatted, loss_spans from conv_id, branch, depth, role, text.

    loss_spans: array of (begin, end) code points in formatted, each an assistant's escaped text.
    """
    part = turns.select("conv_id", "branch", "depth", F.coalesce("role", F.lit("user")).alias("role"), escape(F.col("text")).alias("body")).withColumn("head", F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n")))
    whole = part.groupBy("conv_id", "branch").agg(F.array_sort(F.collect_list(F.struct("depth", "role", "head", "body"))).alias("turns"))
    spans = F.aggregate(
        "turns",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<begin:bigint,end:bigint>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc.at + F.length(t.head) + F.length(t.body) + len(CLOSE)).alias("at"),
            F.when(t.role == "assistant", F.concat(acc.spans, F.array(F.struct((acc.at + F.length(t.head)).cast("long").alias("begin"), (acc.at + F.length(t.head) + F.length(t.body)).cast("long").alias("end"))))).otherwise(acc.spans).alias("spans"),
        ),
    ).spans
    return whole.select("conv_id", "branch", F.size("turns").cast("long").alias("n_turns"), F.array_join(F.transform("turns", lambda t: F.concat(t.head, t.body, F.lit(CLOSE))), "").alias("formatted"), spans.alias("loss_spans"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as reply trees of one branch each."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    plain = rows.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    placed = plain.withColumn("place", F.row_number().over(order))
    numbered = durable(placed.select(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")), F.col("place")).alias("node_id"), F.when(F.col("place") > 1, F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")), F.col("place") - 1)).alias("parent_id"), F.length("text").alias("score"), "conv_id", "role", "text"), "chat-rows")
    kept = reply_branches(numbered.select("node_id", "parent_id", "score")).select(F.col("node_id").alias("kept_id"), "branch", "depth")
    return format_branches(numbered.join(kept, F.col("node_id") == F.col("kept_id")))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted conversations say, parsed from them alone."""

    def digest(batches):
        for b in batches:
            out = []
            for conv, text, spans in zip(b.conv_id, b.formatted, b.loss_spans, strict=True):
                turns = parse_formatted(text)
                said = "".join(f"{r}\n{t}\n" for r, t in turns)
                loss = "".join(unescape(text[s["begin"] : s["end"]]) for s in spans)
                out.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            frame = pd.DataFrame(out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            frame["conv_id"] = frame.conv_id.astype("Int64")
            yield frame

    return formatted.select("conv_id", "formatted", "loss_spans").mapInPandas(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
