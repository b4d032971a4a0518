"""Sharding by weighted rendezvous hashing of record keys (native).

Every shard draws a score for a record, ``-ln(u) / weight`` with ``u`` a
uniform number from a hash of (key, shard); the lowest score wins.  A record's
shard depends on its key, the shard numbers and their weights only.  One more
shard changes no other score, so records move only into the new shard, about
``1 / (shards + 1)`` of them when weights are equal.

``slot`` numbers the records of a shard from 0 without gaps.  A window over a
whole shard would sort it in one task, so each shard is cut into
``slot_buckets`` hash buckets: rows are numbered inside their bucket, and the
bucket's start is the sum of the counts before it.  That table has at most
shards x ``slot_buckets`` rows (both parameters), so it is broadcast whatever
the input size.  Only key, size and checksum are shuffled, never texts.

Edge cases: a null text has 0 bytes and the checksum of the empty text; all
null keys go to one shard; rows repeating a key share its shard and get slots
of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsdq.llm.common import text_or_empty


def _score(key: Column, shard: int, weight: float) -> Column:
    h = F.xxhash64(key, F.lit(shard))
    u = (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) * F.lit(2.0 ** -53)
    return -F.log(u) / F.lit(float(weight))


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard (0 to ``len(weights) - 1``) that wins ``key``; a shard of
    weight 0 wins none, and ties go to the smaller shard number."""
    if not any(w > 0 for w in weights):
        raise ValueError("at least one shard needs a positive weight")
    scores = [F.struct(_score(key, s, w).alias("score"), F.lit(s).alias("shard"))
              for s, w in enumerate(weights) if w > 0]
    return F.array_min(F.array(*scores)).getField("shard")


def assign_slots(rows: DataFrame, shard: str, key: str, slot_buckets: int) -> DataFrame:
    """Add ``slot``: gapless from 0 inside each shard, by a hash of the key."""
    rows = rows.withColumn("__order", F.xxhash64(F.lit("slot"), F.col(key))) \
        .withColumn("__bucket", F.pmod(F.col("__order"), F.lit(slot_buckets)).cast("int"))
    before = Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(F.col(shard).alias("__s"), F.col("__bucket").alias("__b")) \
        .agg(F.count("*").alias("__n")) \
        .withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0).cast("long"))).drop("__n")
    inside = Window.partitionBy(shard, "__bucket").orderBy("__order", key)
    return rows.withColumn("__at", F.row_number().over(inside) - 1) \
        .join(F.broadcast(starts), (F.col(shard) == F.col("__s")) & (F.col("__bucket") == F.col("__b"))) \
        .withColumn("slot", F.col("__start") + F.col("__at")) \
        .drop("__order", "__bucket", "__at", "__s", "__b", "__start")


def shard_records(docs: DataFrame, weights: list[float], grown_weight: float | None = 1.0,
                  key: str = "doc_id", slot_buckets: int = 256) -> DataFrame:
    """``key, size, text_crc32, law, shard, slot, grown_shard`` of every row;
    ``grown_shard`` is the shard after one more of weight ``grown_weight``."""
    text = text_or_empty()
    k = F.col(key)
    grown = F.lit(None).cast("int") if grown_weight is None else rendezvous(k, [*weights, grown_weight])
    rows = docs.select(k, (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
                       rendezvous(k, weights).alias("shard"), grown.alias("grown_shard"))
    return assign_slots(rows, "shard", key, slot_buckets) \
        .select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
