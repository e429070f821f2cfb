"""Sharding by weighted rendezvous hashing of stable record keys.

Every (key, shard) pair has a pseudo-random number u in (0, 1); the record goes to the shard with the
least -ln(u) / weight. Adding a shard changes no other pair's number, so records move only into it, and
in proportion to weights.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import materialise

_BITS = 52


def _draw(key: Column, shard: int) -> Column:
    """(0, 1) from 52 bits of the MD5 of "key:shard"; the same on every engine and in every run."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f":{shard}")).cast("binary")), 1, _BITS // 4)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**_BITS))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Array of (distance, shard) structs, one for each shard with a positive weight."""
    key = F.coalesce(key.cast("string"), F.lit("null"))
    return F.array(*[F.struct((-F.log(_draw(key, s)) / F.lit(float(w))).alias("d"), F.lit(s).alias("s")) for s, w in enumerate(weights) if w > 0])


def shard(df: DataFrame, weights: Sequence[float] = (1.0,) * 24, added: float = 1.0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, size, text_crc32, law, shard, slot, grown_shard.

    weights: of shards 0 to n-1; added: of a further shard n, for grown_shard. size is the text's UTF-8
    bytes plus 8; slots count each shard's rows from 0 in order of key, size and crc. Null keys are one
    key; null texts count as empty; repeated rows get slots of their own. An empty table gives no rows.
    Other columns of the input, whatever their names, are not read.

    Slots need no task that holds a shard: rows are dealt into ranges of the key, counted per range and
    shard, and numbered within both behind the sum of the ranges before.
    """
    n = len(weights)
    value = F.coalesce(df[text], F.lit("")).cast("binary")
    near = df.select(df[key].alias("k"), (F.octet_length(value) + F.lit(8)).cast("long").alias("size"), F.crc32(value).alias("text_crc32"), rendezvous(df[key], [*weights, added]).alias("near"))
    near = near.select(
        "k", "size", "text_crc32",
        F.array_min(F.filter("near", lambda x: x["s"] < n))["s"].alias("shard"),
        F.array_min("near")["s"].alias("grown_shard"),
        F.monotonically_increasing_id().alias("row"),  # parts a key that repeats without bound
    )
    ranged = materialise(near).repartitionByRange("k", "size", "text_crc32", "row").withColumn("range", F.spark_partition_id())
    ranged = materialise(ranged)
    counts = ranged.groupBy("shard", "range").count()
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "range").orderBy("k", "size", "text_crc32", "row")
    numbered = ranged.withColumn("i", F.row_number().over(within) - 1).join(starts, ["shard", "range"])
    return numbered.select(F.col("k").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("start") + F.col("i")).cast("long").alias("slot"), "grown_shard")
