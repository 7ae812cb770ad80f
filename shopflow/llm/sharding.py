"""Weighted rendezvous hashing of stable record keys over shards.

Each shard draws -ln(u) / weight for a key, u hashed from key and shard, and the
smallest draw wins.  A draw does not depend on the other shards, so one more
shard takes rows only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopflow.llm.common import col, materialise


def _number(text: Column, digits: int) -> Column:
    """An even number from the first hexadecimal digits of the text's MD5."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def _draws(key: Column, weights: list[float], seed: int) -> Column:
    """Each shard's draw for the key with its number, in shard order; weight 0: never drawn first."""
    w = F.array(*(F.lit(float(x)) for x in weights))
    name = F.coalesce(key.cast("string"), F.lit(""))

    def draw(weight: Column, shard: Column) -> Column:
        u = (_number(F.concat_ws(":", F.lit(str(seed)), name, shard.cast("string")), 12) + 0.5) / float(1 << 48)
        return F.struct(F.when(weight > 0, -F.log(u) / weight).otherwise(F.lit(float("inf"))).alias("draw"),
                        shard.cast("int").alias("shard"))

    return F.transform(w, draw)


def shard_of(key: Column, weights: list[float], seed: int = 9) -> Column:
    """Shard of a key; a null key is one key like any other; equal draws go to the lower shard."""
    return F.array_min(_draws(key, weights, seed))["shard"]


def assign(docs: DataFrame, weights: list[float], new_weight: float = 1.0, id_col: str = "doc_id",
           text_col: str = "text", row_bytes: int = 16, parts: int = 256, seed: int = 9) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per row of ``docs``.

    size is the text's UTF-8 bytes (null: none) and ``row_bytes``.  slot numbers a shard's rows
    from 0 without gap: by hash part, then id, crc and size; rows that agree in all of these
    are alike and take the places among themselves in any order.  grown_shard is the shard with
    one more shard of ``new_weight``.  No group holds more than about 1 / (shards x
    ``parts``) of the rows, unless they share the id.  An empty table gives no rows.  Other columns are ignored.
    """
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must be numbers >= 0, one at least above")
    count = len(weights)
    text = col(text_col)
    rows = docs.select(
        col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + row_bytes).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long").alias("text_crc32"))
    drawn = rows.withColumn("draws", _draws(F.col("doc_id"), [*weights, new_weight], seed))
    rows = materialise(drawn.select(
        "doc_id", "size", "text_crc32", F.array_min(F.slice("draws", 1, count))["shard"].alias("shard"),
        F.array_min("draws")["shard"].alias("grown_shard"),
        (_number(F.concat_ws(":", F.lit("part"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                             F.col("text_crc32").cast("string")), 8) % parts).cast("int").alias("part")), "shards")
    # at most shards x parts rows, whatever the input
    sizes = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("place", F.row_number().over(inside) - 1)
            .join(F.broadcast(starts), ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("start") + F.col("place")).cast("long").alias("slot"), "grown_shard"))
