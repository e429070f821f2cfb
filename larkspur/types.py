"""Schemas of the snapshot's tables, and unsigned 64-bit numbers kept as BIGINT bits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Collections, record paths and the alphabet of time-based keys.
POST = "app.bsky.feed.post"
LIKE = "app.bsky.feed.like"
REPOST = "app.bsky.feed.repost"
FOLLOW = "app.bsky.graph.follow"
BLOCK = "app.bsky.graph.block"
PROFILE = "app.bsky.actor.profile"
REPLY_ROOT = ".reply.root.uri"
REPLY_PARENT = ".reply.parent.uri"
EMBED_RECORD = ".embed.record.uri"
EMBED_RECORD_MEDIA = ".embed.recordWithMedia.record.record.uri"
SUBJECT = ".subject"
SUBJECT_URI = ".subject.uri"
TID_ALPHABET = "234567abcdefghijklmnopqrstuvwxyz"

POST_REFS = (REPLY_ROOT, REPLY_PARENT, EMBED_RECORD, EMBED_RECORD_MEDIA)

ACTORS = "did_id BIGINT, did STRING, active BOOLEAN"
ACTOR_EDGES = "src_did_id BIGINT, dst_did_id BIGINT, rkey STRING, created_at TIMESTAMP_NTZ"
POST_EDGES = "actor_did_id BIGINT, subject_uri_id BIGINT, rkey STRING, created_at TIMESTAMP_NTZ"
SIGHTINGS = "uri_id BIGINT, author_did_id BIGINT, rkey STRING, created_at TIMESTAMP_NTZ, reply_root_uri_id BIGINT, reply_parent_uri_id BIGINT, quote_uri_id BIGINT"

TABLES = {"actors": ACTORS, "follows": ACTOR_EDGES, "blocks": ACTOR_EDGES, "likes": POST_EDGES, "reposts": POST_EDGES, "posts_from_records": SIGHTINGS, "posts_from_targets": SIGHTINGS}

_LOW = -(2**63)


def _wide(n: int) -> Column:
    return F.lit(str(n)).cast("decimal(20,0)")


def signed(column: Column) -> Column:
    """An unsigned number, as Spark reads it from Parquet (DECIMAL(20,0)), as the BIGINT of the same bits."""
    wide = column.cast("decimal(20,0)")
    return F.when(wide >= _wide(2**63), wide - _wide(2**64)).otherwise(wide).cast("bigint")


def unsigned(column: Column) -> Column:
    """The other way: BIGINT bits as DECIMAL(20,0) of 0 to 2**64 - 1."""
    wide = column.cast("decimal(20,0)")
    return F.when(column < 0, wide + _wide(2**64)).otherwise(wide).cast("decimal(20,0)")


def normalised(df: DataFrame) -> DataFrame:
    """Every DECIMAL(20,0) column, which is how unsigned ones are read, as BIGINT."""
    wide = {f.name for f in df.schema if isinstance(f.dataType, DecimalType) and f.dataType.precision == 20 and f.dataType.scale == 0}
    return df.withColumns({c: signed(F.col(f"`{c}`")) for c in wide}) if wide else df


def umod(column: Column, n: int) -> Column:
    """The unsigned remainder of BIGINT bits by a positive n."""
    if not 0 < n <= 2**62:
        raise ValueError(f"cannot take a remainder by {n}")
    wide = F.lit(n).cast("bigint")  # 2**64 mod n goes on top of negative ones; both parts are below n
    return F.pmod(F.pmod(column, wide) + F.when(column < 0, F.lit(2**64 % n).cast("bigint")).otherwise(F.lit(0).cast("bigint")), wide)


def umax(column: Column) -> Column:
    """The unsigned maximum of a group: flipping the top bit turns unsigned order into signed order."""
    return F.max(column.bitwiseXOR(F.lit(_LOW))).bitwiseXOR(F.lit(_LOW))
