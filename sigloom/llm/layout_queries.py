"""The registered queries of the operators outside the corpus pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.llm import chat, repeats, shards, topk, urls
from sigloom.llm.common import table


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    judged = urls.filter_urls(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("bad", 6).alias("block_score"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that repeated strings of 200 bytes cover, per document, and a digest of the others."""
    rows = repeats.drop_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, packed by bytes, tokens and rows."""
    placed = shards.assign_shards(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(shards.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and one made of control strings, formatted and read back."""
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role")
    odd = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role, F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = chat.chains(own.unionByName(odd))
    said = chat.format_chat(rows, "conv_id", "node", "parent", "role", "text", "score")
    back = said.select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("told")
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("told").cast("long").alias("loss_chars"),
        F.sha2("told", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products of every twentieth vector with all others."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("raw"))
    rows = rows.filter(F.col("id").isNotNull() & topk.usable(F.col("raw")))
    rows = rows.select("id", F.transform("raw", lambda x: F.floor(F.lit(64.0) * x).cast("double")).alias("vector"))
    found = topk.nearest(rows, rows.filter(F.col("id") % 20 == 0), 20)
    return found.select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))


QUERIES = {
    "op3_url_filter": op3_url_filter,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op8_sharding": op8_sharding,
    "op9_chat_format": op9_chat_format,
    "op10_topk_search": op10_topk_search,
}
