"""Connected components of an edge table, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm.common import small
from sigloom.scale import settle


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b: long): equal labels mean that a path joins the nodes.

    Each round lets every node point to the neighbour (or itself) that comes first in an order drawn anew, and
    contracts the graph along the pointers, so the number of nodes falls by a constant factor a round whatever the
    shape of a component.  Minima are taken in the tasks before the shuffle, so a node with very many links is one row
    per task.  Nulls are no nodes; loops and repeated links change nothing; an empty table gives an empty one.
    """
    live = settle(edges.filter("a is not null and b is not null").select("a", "b").filter("a <> b").distinct(), "links")
    labels = None
    turn = 0
    while live.limit(1).count():
        both = live.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            live.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )

        def drawn(column: str, turn: int = turn):
            return F.struct(F.xxhash64(F.col(column), F.lit(turn)).alias("draw"), F.col(column).alias("id"))

        first = both.groupBy("node").agg(F.min(drawn("other")).alias("near"))
        moves = settle(first.select("node", F.least("near", drawn("node"))["id"].alias("to")), "moves")
        ours = small(moves)
        moved = (
            live.join(ours.select(F.col("node").alias("a"), F.col("to").alias("a2")), "a")
            .join(ours.select(F.col("node").alias("b"), F.col("to").alias("b2")), "b")
            .filter("a2 <> b2")
            .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
            .distinct()
        )
        if labels is None:
            labels = moves.withColumnRenamed("to", "label")
        else:
            onward = ours.select(F.col("node").alias("label"), F.col("to").alias("next"))
            labels = settle(
                labels.join(onward, "label", "left").select("node", F.coalesce("next", "label").alias("label")), "labels"
            )
        live = settle(moved, "links")
        turn += 1
    if labels is None:
        return live.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
