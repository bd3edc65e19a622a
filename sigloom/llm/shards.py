"""Sharding by vector bin packing.

Rows with equal texts are a group.  Groups are bundled by the hash of their text into ``shards * bundles`` bundles; a
group with more than ``1 / (shards * bundles)`` of all bytes, tokens or rows is placed by itself.  Such a group stays
whole as well, unless a shard cannot hold it: it is cut, into parts of about a bundle by hash of the id, only if its bytes,
tokens or rows exceed a shard's share of ``1 / shards`` less ``TOLERANCE`` of it, or if other large groups leave no shard
the room, so that a shard would get more than ``TOLERANCE`` above its share of the bytes.  Bundles and groups are items with
a vector (bytes, tokens, rows).  They are packed on the driver, which sees at most ``7 * shards * bundles`` sums whatever
the input: largest first, each into the shard where the dot product of its vector with the residual capacity is highest
among the shards that still have room for its bytes.  The law that holds is ``bytes``.

Slots are numbered inside the parts of a large group even if it stays whole, so no task ranks a whole hot group.

A null or empty text has size 1; a null id is one id like any other for the parts; repeated rows each get their own
slot; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigloom.llm.common import text_of
from sigloom.scale import settle

SHARDS = 16
BUNDLES = 128
LAW = "bytes"
# Share of a shard that large groups may leave free, or go beyond.
TOLERANCE = 0.05


def pack(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item; ``items``: one row of (bytes, tokens, rows) each."""
    total = np.maximum(items.sum(axis=0), 1.0)
    share = items / total
    room = np.full((shards, items.shape[1]), 1.0 / shards)
    out = np.zeros(len(items), dtype=np.int64)
    for i in np.lexsort((np.arange(len(items)), -share.max(axis=1))):
        fit = room @ share[i]
        open_to = room[:, 0] >= share[i, 0]
        # Where no shard has room left for the bytes, the one with the most room takes the item.
        out[i] = np.argmax(np.where(open_to, fit, -np.inf)) if open_to.any() else np.argmax(room[:, 0])
        room[out[i]] -= share[i]
    return out


def place(of: list[str], sums: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each bundle (``of`` is empty) and of each part of a large group (``of`` is the group).

    The parts of a group get one shard, unless no shard can hold the group.
    """
    shares = sums / np.maximum(sums.sum(axis=0), 1.0)
    groups: dict[str, list[int]] = {}
    for i, group in enumerate(of):
        if group:
            groups.setdefault(group, []).append(i)
    limit = (1 - TOLERANCE) / shards
    whole = {g: own for g, own in groups.items() if len(own) == 1 or shares[own].sum(axis=0).max() <= limit}
    while True:
        units = list(whole.values()) + [[i] for i, group in enumerate(of) if group not in whole]
        home = pack(np.array([sums[own].sum(axis=0) for own in units]).reshape(-1, sums.shape[1]), shards)
        out = np.zeros(len(of), dtype=np.int64)
        for own, shard in zip(units, home.tolist(), strict=True):
            out[own] = shard
        load = np.bincount(out, weights=shares[:, 0], minlength=shards)
        cut = []
        for shard in np.flatnonzero(load > (1 + TOLERANCE) / shards).tolist():
            inside = [(shares[own, 0].sum(), g) for g, own in whole.items() if len(own) > 1 and out[own[0]] == shard]
            # The smallest group that frees enough, else the largest.
            enough = [x for x in inside if x[0] >= load[shard] - 1 / shards]
            cut += [min(enough)[1] if enough else max(inside)[1]] if inside else []
        if not cut:
            return out
        for g in cut:
            del whole[g]


def assign_shards(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, bundles: int = BUNDLES
) -> DataFrame:
    """(id, size, text_crc32, shard, slot): every row, slots gapless from 0 in each shard."""
    text = text_of(text_col)
    # Words of a text, counted by its single spaces.
    tokens = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1
    rows = docs.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("_group"),
        tokens.cast("long").alias("_tokens"),
    )
    rows = settle(rows, "sizes")
    count = shards * bundles
    measures = [F.sum("size").alias("b"), F.sum("_tokens").alias("t"), F.count(F.lit(1)).alias("n")]
    totals = [x or 0 for x in rows.agg(*measures).first()]
    share = F.greatest(*(F.col(c) / F.lit(float(max(total, 1))) for c, total in zip("btn", totals, strict=True)))
    # At most ``count`` groups can be larger than this in each of the three measures.
    large = rows.groupBy("_group").agg(*measures).withColumn("_share", share).filter(F.col("_share") * count > 1)
    parts = F.ceil(F.col("_share") * count).cast("int")
    large = F.broadcast(settle(large.select("_group", parts.alias("_parts")), "large"))
    bundle = F.pmod(F.conv(F.substring("_group", 1, 12), 16, 10).cast("long"), F.lit(count))
    part = F.pmod(F.xxhash64("_id"), F.col("_parts").cast("long"))
    item = F.when(F.col("_parts").isNull(), F.struct(F.lit("").alias("of"), bundle.alias("part"))).otherwise(
        F.struct(F.col("_group").alias("of"), part.alias("part"))
    )
    rows = rows.join(large, "_group", "left").select("_id", "size", "text_crc32", "_tokens", item.alias("_item"))
    sums = rows.groupBy("_item").agg(*measures)
    items = sorted(sums.collect(), key=lambda r: tuple(r["_item"]))
    placed = place([r["_item"]["of"] for r in items], np.array([[r.b, r.t, r.n] for r in items], dtype=float).reshape(-1, 3), shards)
    begin, plan = [0] * shards, []
    for r, shard in zip(items, placed.tolist(), strict=True):
        plan.append((tuple(r["_item"]), shard, begin[shard]))
        begin[shard] += r.n
    spark = docs.sparkSession
    plan = spark.createDataFrame(plan, "_item struct<of:string,part:bigint>, shard int, _begin bigint")
    inside = F.row_number().over(Window.partitionBy("_item").orderBy("_id", "text_crc32", "size")) - 1
    placed = rows.select("*", inside.alias("_place")).join(F.broadcast(plan), "_item")
    return placed.select(
        F.col("_id").alias(id_col), "size", "text_crc32", "shard", (F.col("_begin") + F.col("_place")).cast("long").alias("slot")
    )
