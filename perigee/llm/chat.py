"""Chat formatting from reply trees, with DataFrame operations only.

A message names its parent; a leaf's path to its root is one possible conversation. Paths are
enumerated by iterative self-joins that double their reach: after step i every (leaf, node)
pair closer than 2**i is known, and an edge table leads 2**i levels up. The work is the total
length of the paths times the logarithm of the depth; texts join only at the end.

Defined results. Null tree: one tree of its own. A parent that is null, unknown, or does not
precede its child (so also any cycle) makes the child a root. A repeated message id counts once
per row; replies hang on the first copy, further copies are leaves. Null role or text: empty.
Null score: 0. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perigee.llm.common import stored

# The template. Control strings cannot occur in escaped texts.
TURN_START = "### "
ROLE_END = ": "
TURN_END = " </turn>\n"
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), ("#", "&num;"), (":", "&colon;")]


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _prepared(messages: DataFrame, tree: str, node: str, parent: str, order: list[str], score: str | None) -> DataFrame:
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    plain = messages.select(
        F.col(tree).alias("tree"),
        key(tree).alias("tree_key"),
        key(node).alias("node"),
        F.when(F.col(parent).isNotNull(), key(parent)).alias("parent"),
        F.struct(*order).alias("at"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        (F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)).alias("score"),
    )
    copies = Window.partitionBy("tree_key", "node").orderBy("at", "role", "text")
    return plain.withColumn("copy", F.row_number().over(copies))


def reply_paths(messages: DataFrame, tree: str, node: str, parent: str, order: list[str], score: str | None = None,
                keep: int | None = None) -> DataFrame:
    """All turns of the ``keep`` best paths of every tree (None: of all paths).

    ``order`` must increase from parent to child. Paths rank by their summed score, highest
    first, ties by the order of their leaves. Returns tree, path (the rank, from 1), depth
    (0 at the root), role, text.
    """
    rows = stored(_prepared(messages, tree, node, parent, order, score), "chat-messages")
    first = rows.where("copy = 1").select("tree_key", F.col("node").alias("parent"), F.col("at").alias("parent_at"))
    edges = (
        rows.where("parent is not null")
        .join(first, ["tree_key", "parent"])
        .where("parent_at < at")
        .select("tree_key", "node", "copy", F.col("parent").alias("up"))
    )
    edges = stored(edges, "chat-edges")
    leaves = rows.join(
        edges.select("tree_key", F.col("up").alias("node"), F.lit(1).alias("copy")).distinct(),
        ["tree_key", "node", "copy"], "left_anti",
    )
    pairs = leaves.select(
        "tree_key", F.col("node").alias("leaf"), F.col("copy").alias("leaf_copy"), "node", "copy", F.lit(0).cast("long").alias("dist")
    )
    reach = 1
    while not edges.isEmpty():
        further = pairs.join(edges, ["tree_key", "node", "copy"]).select(
            "tree_key", "leaf", "leaf_copy", F.col("up").alias("node"), F.lit(1).alias("copy"), (F.col("dist") + reach).alias("dist")
        )
        pairs = stored(pairs.unionByName(further), "chat-paths")
        above = edges.where("copy = 1").select("tree_key", F.col("node").alias("up"), F.col("up").alias("top"))
        edges = stored(edges.join(above, ["tree_key", "up"]).select("tree_key", "node", "copy", F.col("top").alias("up")), "chat-edges")
        reach *= 2
    turns = pairs.join(rows, ["tree_key", "node", "copy"])
    if keep is not None or score is not None:
        total = turns.groupBy("tree_key", "leaf", "leaf_copy").agg(F.sum("score").alias("total"), F.max("at").alias("leaf_at"))
    else:
        total = leaves.select("tree_key", F.col("node").alias("leaf"), F.col("copy").alias("leaf_copy"), F.lit(0.0).alias("total"), F.col("at").alias("leaf_at"))
    best = Window.partitionBy("tree_key").orderBy(F.col("total").desc(), "leaf_at", "leaf", "leaf_copy")
    ranked = total.withColumn("path", F.row_number().over(best)).select("tree_key", "leaf", "leaf_copy", "path")
    if keep is not None:
        ranked = ranked.where(F.col("path") <= keep)
    return turns.join(ranked, ["tree_key", "leaf", "leaf_copy"]).select(
        "tree", "tree_key", "path", (-F.col("dist")).alias("depth"), "role", "text"
    )


def format_paths(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per path: tree, path, n_turns, formatted, loss_spans.

    ``loss_spans`` are code point ranges (start, stop) of ``formatted``, one per turn of
    ``loss_role``, covering exactly its escaped text.
    """
    head = F.concat(F.lit(TURN_START), escape(F.col("role")), F.lit(ROLE_END))
    body = escape(F.col("text"))
    so_far = Window.partitionBy("tree_key", "path").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shown = (
        turns.select("tree", "tree_key", "path", "depth", "role", head.alias("head"), body.alias("body"))
        .withColumn("size", F.length("head") + F.length("body") + F.lit(len(TURN_END)))
        .withColumn("stop", F.sum("size").over(so_far) - F.lit(len(TURN_END)))
        .withColumn("rendered", F.concat("head", "body", F.lit(TURN_END)))
        .withColumn("span", F.when(F.col("role") == loss_role, F.struct((F.col("stop") - F.length("body")).alias("start"), F.col("stop").alias("stop"))))
    )
    rows = F.array_sort(F.collect_list(F.struct("depth", "rendered", "span")))
    return shown.groupBy("tree_key", "path").agg(F.first("tree").alias("tree"), F.count(F.lit(1)).alias("n_turns"), rows.alias("rows")).select(
        "tree", "path", "n_turns",
        F.array_join(F.transform("rows", lambda r: r["rendered"]), "").alias("formatted"),
        F.filter(F.transform("rows", lambda r: r["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def parse_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped."""
    pieces = F.split(formatted, TURN_END, -1)
    bodies = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.substr(p, F.lit(len(TURN_START) + 1)))
    return F.transform(
        bodies,
        lambda p: F.struct(
            unescape(F.substring_index(p, ROLE_END, 1)).alias("role"),
            unescape(F.substr(p, F.instr(p, ROLE_END) + F.lit(len(ROLE_END)))).alias("text"),
        ),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    parts = F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int"))))
    return F.array_join(parts, "")


def conversations_as_trees(conversations: DataFrame) -> DataFrame:
    """Linear conversations as reply trees: every row replies to the one before it.

    Rows are numbered by turn (null first), ties by role and text, so repeated rows stay turns.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = conversations.select("conv_id", "turn", "role", "text").withColumn("at", F.row_number().over(order).cast("long"))
    return numbered.withColumn("reply_to", F.when(F.col("at") > 1, F.col("at") - 1))
