"""Chat formatting over reply trees.

Messages point to the message they answer. Repeated self-joins double each message's pointer, from
its parent to the 2nd, 4th, 8th ... ancestor, so a branch of any length is resolved in
logarithmically many joins. That gives every leaf its root and its branch's total score; the best
branches of each tree are chosen by an aggregate, their messages are found again through the
stored pointers, and each path is formatted as one conversation.

The template: ``<turn>role\\ntext</turn>\\n``. Inside roles and texts a backslash becomes ``\\b``,
``<`` becomes ``\\l`` and, in roles, a newline becomes ``\\n``, so no control string can stand in
them and :func:`parsed` gets the turns back exactly.

Defined results: null text and null role are empty; a null conversation id is an id of its own; a
message whose parent is missing is a root; :func:`chained` orders rows of one turn by role, then
text (null turn first), and repeated rows are turns of their own; an empty table gives no rows;
of rows with one message id the least (parent, role, text) counts; a message that answers itself
through others raises ValueError. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import stored, text_of

OPEN, CLOSE = "<turn>", "</turn>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\l"),
                               F.lit("<")), F.lit("\\b"), F.lit("\\"))


def chained(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """Plain conversations as trees of one branch: each turn answers the one before."""
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                        text_of(role).alias("role"), text_of(text).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("node"),
                       "role", "text").select(
        "conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role", "text", F.lit(1.0).alias("score"))


def _key(name: str = "conv_id") -> Column:
    """A join key that a null id has as well."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias("conv")


def chosen_paths(messages: DataFrame, best: int = 1) -> tuple[DataFrame, DataFrame]:
    """(messages as stored, paths): conv, leaf, ``up`` (steps above the leaf), node."""
    kept = stored(messages.groupBy("conv_id", _key(), "node").agg(F.min(F.struct(
        "parent", text_of("role").alias("role"), text_of("text").alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))).alias("m"))
        .select("conv_id", "conv", "node", "m.*"), "tree-messages")
    nodes = kept.select("conv", "node", "parent", "score")
    there = nodes.select("conv", F.col("node").alias("parent"), F.lit(True).alias("known"))
    linked = nodes.join(there, ["conv", "parent"], "left").select(
        "conv", "node", F.when(F.col("known"), F.col("parent")).alias("anc"), "score",
        F.col("node").alias("last"))
    # (conv, node, anc): anc is the 2**k-th ancestor; score and last cover the nodes before it.
    jumps, done, k, size = [], [], 0, kept.count()
    step = stored(linked, "tree-jump-0")
    while True:
        open_ = step.where("anc IS NOT NULL")
        done.append(step.where("anc IS NULL").select("conv", "node", "score",
                                                     F.col("last").alias("root")))
        if open_.isEmpty():
            break
        if 2 ** k > size:  # longer than any branch could be
            raise ValueError("messages answer each other in a circle")
        jumps.append(open_.select("conv", "node", "anc"))
        k += 1
        # A pointer already at its root ends there: its score is the rest of the branch.
        far = step if k == 1 else step.unionByName(_resolved(done[:-1], step))
        step = stored(open_.alias("a").join(
            far.alias("b"), (F.col("a.conv") == F.col("b.conv")) & (F.col("a.anc") == F.col("b.node"))
        ).select("a.conv", "a.node", F.col("b.anc").alias("anc"),
                 (F.col("a.score") + F.col("b.score")).alias("score"),
                 F.col("b.last").alias("last")), f"tree-jump-{k}")
    resolved = done[0]
    for part in done[1:]:
        resolved = resolved.unionByName(part)
    parents = linked.where("anc IS NOT NULL").select("conv", F.col("anc").alias("node"))
    leaves = resolved.join(parents.distinct(), ["conv", "node"], "left_anti")
    rank = Window.partitionBy("conv", "root").orderBy(F.desc("score"), "node")
    if best == 1:
        chosen = leaves.groupBy("conv", "root").agg(
            F.min(F.struct((-F.col("score")).alias("s"), "node")).alias("m")).select(
            "conv", F.col("m.node").alias("leaf"))
    else:
        chosen = leaves.select("*", F.row_number().over(rank).alias("r")).where(
            F.col("r") <= best).select("conv", F.col("node").alias("leaf"))
    paths = chosen.select("conv", "leaf", F.col("leaf").alias("node"), F.lit(0).alias("up"))
    for k in reversed(range(len(jumps))):
        # Every distance is a sum of different powers of two, so each ancestor comes up once.
        paths = stored(paths, f"tree-paths-{k + 1}") if k < len(jumps) - 1 else paths
        further = paths.join(jumps[k], ["conv", "node"]).select(
            "conv", "leaf", F.col("anc").alias("node"), (F.col("up") + 2 ** k).alias("up"))
        paths = paths.unionByName(further)
    return kept, paths


def _resolved(done: list[DataFrame], like: DataFrame) -> DataFrame:
    """Nodes whose pointer has ended, in the shape of a step."""
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    kind = dict(like.dtypes)["anc"]
    return whole.select("conv", "node", F.lit(None).cast(kind).alias("anc"), "score",
                        F.col("root").alias("last"))


def formatted(messages: DataFrame, best: int = 1, learn: str = "assistant") -> DataFrame:
    """One row per chosen path: conv_id, leaf, ``formatted`` and ``loss_spans`` (start and length,
    in characters of ``formatted``, of the texts said by ``learn``)."""
    kept, paths = chosen_paths(messages, best)
    turns = paths.join(kept, ["conv", "node"]).groupBy("conv_id", "conv", "leaf").agg(
        F.sort_array(F.collect_list(F.struct(
            (-F.col("up")).alias("at"), "node",
            escaped_role(F.col("role")).alias("role"), (F.col("role") == learn).alias("learn"),
            escaped(F.col("text")).alias("text")))).alias("turns"))
    shown = F.transform("turns", lambda t: F.concat(
        F.lit(OPEN), t["role"], F.lit("\n"), t["text"], F.lit(CLOSE)))
    spans = F.aggregate(
        "turns", F.struct(F.lit(0).alias("end"),
                          F.expr("array()").cast("array<struct<start:int,length:int>>")
                          .alias("spans")),
        lambda acc, t: F.struct(
            (acc["end"] + len(OPEN) + F.length(t["role"]) + 1 + F.length(t["text"]) + len(CLOSE))
            .alias("end"),
            F.when(t["learn"], F.concat(acc["spans"], F.array(F.struct(
                (acc["end"] + len(OPEN) + F.length(t["role"]) + 1).alias("start"),
                F.length(t["text"]).alias("length"))))).otherwise(acc["spans"]).alias("spans")))
    return turns.select("conv_id", "leaf", F.array_join(shown, "").alias("formatted"),
                        spans["spans"].alias("loss_spans"))


def parsed(text: Column) -> Column:
    """The turns of a formatted conversation: an array of (role, text)."""
    pieces = F.filter(F.split(text, OPEN), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(
        unescaped_role(F.substring_index(p, "\n", 1)).alias("role"),
        unescaped(F.substring(p, F.length(F.substring_index(p, "\n", 1)) + 2,
                              F.length(p) - F.length(F.substring_index(p, "\n", 1)) - 1
                              - len(CLOSE))).alias("text")))


def masked(text: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(spans, lambda s: unescaped(
        F.substring(text, s["start"] + 1, s["length"])))
