"""Rendezvous hashing of stable record keys over weighted shards, in column expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoarfrost.llm.common import gapless, stored


def rendezvous(keys: Sequence[str], weights: Sequence[float], seed: int = 0) -> Column:
    """The shard that wins for a key: each shard draws weight / -ln(u), with u in (0, 1) from a hash of
    the key and the shard's number alone, and the highest draw wins (ties: the smaller shard).

    A draw does not depend on the other shards. A shard that is added, or whose weight grows, can only
    win records for itself; one that goes only loses its own. Null keys hash like any other value.
    """
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("every shard needs a positive weight")
    draws = []
    for shard, weight in enumerate(weights):
        bits = F.shiftrightunsigned(F.xxhash64(*keys, F.lit(seed), F.lit(shard)), 11)
        u = (bits.cast("double") + 0.5) / float(1 << 53)
        draws.append(F.struct((F.lit(float(weight)) / -F.log(u)).alias("draw"), F.lit(-shard).alias("minus")))
    return -(F.greatest(*draws) if len(draws) > 1 else draws[0])["minus"]


def shard_records(docs: DataFrame, weights: Sequence[float], added: float = 1.0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every record with its shard, its place in the shard and its shard after one more was added.

    Returns the key, size (UTF-8 bytes of the text plus 16), text_crc32 (unsigned), law, shard, slot
    (gapless from 0 in each shard) and grown_shard (with one more shard of weight `added`).

    A null text has no bytes. Records with equal or null keys go to the same shard, each with a slot of
    its own. Equal texts under different keys are placed independently, since only the key decides.
    An empty table gives an empty result. Other columns of the input are not looked at.
    """
    record = F.coalesce(F.col(text), F.lit("")).cast("binary")
    narrow = docs.select(
        F.col(key),
        (F.octet_length(record).cast("long") + 16).alias("size"),
        F.crc32(record).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous([key], weights).cast("int").alias("shard"),
        rendezvous([key], [*weights, added]).cast("int").alias("grown_shard"),
        F.monotonically_increasing_id().alias("_row"),
    )
    # Stored once, so the row numbers that break up hot keys stay what they are when a task is run again.
    numbered = gapless(stored(narrow, "shards"), "shard", "_row", "slot")
    return numbered.select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
