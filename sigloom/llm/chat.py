"""Chat formatting of reply trees, in DataFrame functions only.

``reply_paths`` follows parents by self-joins that double their reach each round, so a tree of depth d needs about
log2(d) joins.  That gives the summed score of every root-to-leaf path; the leaves of a tree are ranked by it, and the
nodes of the chosen paths are gathered with the same jump tables.  ``format_chat`` writes each chosen path as one text.

The template marks a turn as ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line break.  Inside roles and texts a
backslash is doubled and every control string of this or other common templates gets a backslash after its first
character, so reading back is exact.  The loss mask covers the texts of assistant turns.

Null roles and texts count as empty; rows without a tree id form one tree whose id is null; a node whose parent is
missing is a root; nodes on a cycle have no root and belong to no path; equal rows are turns of their own; an empty
table gives an empty result; further columns may have any names.  A row without a node id is no reply and has no replies: it
stands for itself, as a root beside the others of its tree, and each such row is a path of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.scale import settle

OPEN, MIDDLE, CLOSE = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
# What opens a control string of common chat templates, and how it goes on.
_CONTROL = r"(?i)(<)(\||/?s>|</?sys>>|(?:unk|pad|bos|eos)>)|(\[)(/?inst\])"


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _CONTROL, r"$1$3\\$2$4")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def reply_paths(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """(tree, leaf, node, place): the nodes of the ``keep`` best root-to-leaf paths of every tree, placed from 1.

    ``nodes``: tree (no nulls), node (unique in its tree), parent, score (null counts as 0).  Paths are ranked by their
    summed score, then the longer path, then the smaller leaf.
    """
    nodes = settle(nodes.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")), "nodes")
    real = nodes.select("tree", F.col("node").alias("parent"), F.col("node").alias("up"))
    first = nodes.join(real, ["tree", "parent"], "left")
    live = settle(first.select("tree", "node", "up", F.col("score").alias("total"), F.lit(1).alias("steps")), "jumps")
    parents = live.filter("up is not null").select("tree", F.col("up").alias("node")).distinct()
    # ``done``: nodes whose pointer has passed the root, with the score and length of their whole path.
    done, jumps = live.filter("up is null"), []
    live = live.filter("up is not null")
    # A round doubles the reach of the others; beyond 2 ** 40 only a cycle is left.
    while len(jumps) < 40 and live.limit(1).count():
        jumps.append(live.select("tree", "node", "up"))
        on = live.unionByName(done).select(
            "tree", F.col("node").alias("up"), F.col("up").alias("far"), F.col("total").alias("t2"), F.col("steps").alias("s2")
        )
        further = live.join(on, ["tree", "up"]).select(
            "tree",
            "node",
            F.col("far").alias("up"),
            (F.col("total") + F.col("t2")).alias("total"),
            (F.col("steps") + F.col("s2")).alias("steps"),
        )
        further = settle(further, "jumps")
        done, live = done.unionByName(further.filter("up is null")), further.filter("up is not null")
    leaves = done.join(parents, ["tree", "node"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), F.desc("steps"), "node"))
    paths = leaves.withColumn("rank", rank).filter(F.col("rank") <= keep)
    paths = paths.select("tree", F.col("node").alias("leaf"), "node", F.col("steps").alias("place"))
    for power in range(len(jumps) - 1, -1, -1):
        above = paths.join(jumps[power], ["tree", "node"]).select(
            "tree", "leaf", F.col("up").alias("node"), (F.col("place") - (1 << power)).alias("place")
        )
        paths = settle(paths.unionByName(above), "paths")
    return paths


def format_turns(turns: Column) -> Column:
    """One text of an array of turns (role, text)."""

    def one(t: Column) -> Column:
        return F.concat(F.lit(OPEN), escaped(t["role"]), F.lit(MIDDLE), escaped(t["text"]), F.lit(CLOSE))

    return F.array_join(F.transform(turns, one), "")


def loss_spans(turns: Column) -> Column:
    """array<struct<start, end>>: where the assistant's texts stand in the formatted text, in code points."""
    sizes = F.transform(
        turns,
        lambda t: F.struct(
            (F.length(escaped(t["role"])) + F.lit(len(OPEN + MIDDLE))).alias("skip"),
            F.length(escaped(t["text"])).alias("size"),
            (t["role"] == "assistant").alias("told"),
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start: int, end: int>>)").alias("spans"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + x["skip"]
        end = begin + x["size"]
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        spans = F.when(x["told"], F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((end + F.lit(len(CLOSE))).alias("at"), spans.alias("spans"))

    return F.aggregate(sizes, start, step, lambda state: state["spans"])


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted text."""
    parts = F.split(formatted, r"<\|im_end\|>\n", -1)

    def one(x: Column) -> Column:
        both = F.split(F.substring(x, len(OPEN) + 1, 1 << 30), r"<\|im_sep\|>", -1)
        return F.struct(unescaped(both[0]).alias("role"), unescaped(both[1]).alias("text"))

    return F.transform(F.filter(parts, lambda x: x != ""), one)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, joined."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def _numbered(rows: DataFrame) -> DataFrame:
    """Nodes and parents as structs that are never null: rows without a node id are numbered within their tree and have no parent."""
    order = Window.partitionBy("tree").orderBy("role", "text", "score")
    bare = rows.filter("_node is null").withColumn("_no", F.row_number().over(order))
    kind = rows.schema["_node"].dataType
    rows = rows.filter("_node is not null").withColumn("_no", F.lit(0)).unionByName(bare)
    node = F.struct(F.col("_node").alias("id"), "_no").alias("node")
    parent = F.when(F.col("_node").isNotNull() & F.col("_parent").isNotNull(), F.struct(F.col("_parent").cast(kind).alias("id"), F.lit(0).alias("_no")))
    return rows.select("id", "tree", node, parent.alias("parent"), "role", "text", "score")


def format_chat(
    nodes: DataFrame, tree_col: str, node_col: str, parent_col: str, role_col: str, text_col: str, score_col: str, keep: int = 1
) -> DataFrame:
    """(tree id, leaf, formatted, loss): the ``keep`` best paths of every tree, one text each."""
    rows = nodes.select(
        F.col(tree_col).alias("id"),
        # Text keys, so that rows without an id join as well.
        F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit("")).alias("tree"),
        F.col(node_col).alias("_node"),
        F.col(parent_col).alias("_parent"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.col(score_col).alias("score"),
    )
    rows = _numbered(rows)
    paths = reply_paths(rows, keep)
    said = paths.join(rows.select("tree", "node", "id", "role", "text"), ["tree", "node"])
    turns = F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("turns")
    whole = said.groupBy("tree", "leaf").agg(F.first("id").alias("id"), turns)
    texts = whole.select("id", F.col("leaf")["id"].alias("leaf"), "turns", format_turns(F.col("turns")).alias("formatted"))
    return texts.select(F.col("id").alias(tree_col), "leaf", "formatted", loss_spans(F.col("turns")).alias("loss"))


def chains(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """A table of turns as reply trees without branches: each row answers the one before it by turn."""
    order = Window.partitionBy(id_col).orderBy(turn_col, "role", "text")
    rows = conversations.select(id_col, turn_col, "role", "text", F.row_number().over(order).alias("node"))
    return rows.select(id_col, "node", (F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))
