"""Hydrate: entity tables to posts, the two aggregate tables, counts and orphan rates, as an ordered list of named stages."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators import aggregates, posts

Tables = dict[str, DataFrame]

#: In this order; later stages read what earlier ones add.
STAGES: list[tuple[str, Callable[[Tables], DataFrame]]] = [
    ("posts", lambda t: posts.build_posts(t["posts_from_records"], t["posts_from_targets"])),
    ("post_aggs", lambda t: aggregates.post_aggs(t["posts"], t["likes"], t["reposts"])),
    ("actor_aggs", lambda t: aggregates.actor_aggs_from_posts(t["actors"], t["follows"], t["blocks"], t["posts"], t["likes"], t["reposts"], t["post_aggs"])),
]

#: What a bucket of each aggregate table is chosen by, and in its inputs.
BUCKET_KEYS = {"post_aggs": "uri_id", "actor_aggs": "did_id"}
COUNTED = ("actors", "follows", "blocks", "likes", "reposts", "posts", "actor_aggs", "post_aggs")


def chunked(df: DataFrame, key: str, n: int, dry_run: bool = False) -> DataFrame:
    """The table as the union of its n buckets by unsigned remainder of the key; only the first with dry_run, unless it is the only one.

    Spark bounds its own hash tables, so this is for parity and for dry runs: filters on the key reach the scans.
    """
    if n < 1:
        raise ValueError("at least one bucket")
    return reduce(DataFrame.unionByName, [aggregates.bucket(df, key, n, k) for k in range(1 if dry_run else n)])


def counts(tables: Tables) -> DataFrame:
    """(place, name, n) of each table, without collecting any."""
    spark = next(iter(tables.values())).sparkSession
    frames = [tables[t].agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("place"), F.lit(t).alias("name"), "n") for i, t in enumerate(COUNTED) if t in tables]
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], "place INT, name STRING, n BIGINT")


def metadata(spark: SparkSession, date: str, source: str, backup_id: int | None, built_at: str, version: str, memory: str) -> DataFrame:
    """The snapshot's one-row description; text is cast to DATE and TIMESTAMP_NTZ."""
    row = spark.createDataFrame([(date, source, backup_id, built_at, version, memory)], "d STRING, source_url STRING, backup_id BIGINT, b STRING, engine_version STRING, memory_limit STRING")
    return row.select(F.col("d").cast("date").alias("snapshot_date"), "source_url", "backup_id", F.col("b").cast("timestamp_ntz").alias("built_at"), "engine_version", "memory_limit")
