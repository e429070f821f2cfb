"""Links resolved into the edges and posts of the snapshot: equi-joins that the planner picks strategies for, heavy keys in parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.types import EMBED_RECORD, EMBED_RECORD_MEDIA, REPLY_PARENT, REPLY_ROOT, umax

REF_COLUMNS = {REPLY_ROOT: "reply_root_uri_id", REPLY_PARENT: "reply_parent_uri_id", EMBED_RECORD: "embed_uri_id", EMBED_RECORD_MEDIA: "embed_media_uri_id"}


#: Rows of one key that a join's task may have to take.
HEAVY = 1 << 22


def parted_join(rows: DataFrame, known: DataFrame, key: str, spread_by: list[str], how: str, heavy: int = HEAVY) -> DataFrame:
    """rows joined to known by the key, those of a key with more than `heavy` rows in parts of about so many.

    The parts are told apart by a hash of spread_by. known's rows of such a key go to each of its parts. Heavy keys are counted
    in the plan, combined before the shuffle; there are at most rows / heavy of them, so that they are broadcast.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > heavy) & F.col(key).isNotNull())
    parts = F.broadcast(counts.select(key, F.ceil(F.col("n") / heavy).cast("int").alias("parts")))
    many = F.coalesce("parts", F.lit(1))
    left = rows.join(parts, key, "left").withColumn("part", F.pmod(F.xxhash64(*spread_by), many)).drop("parts")
    right = known.join(parts, key, "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), many.cast("bigint") - 1))).drop("parts")
    return left.join(right, [key, "part"], how).drop("part")


def actor_edges(keyed: DataFrame, target_actors: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """Follows or blocks: targets that are no actor disappear."""
    return parted_join(keyed, target_actors, "target_id", ["src_did_id", "rkey"], "inner", heavy).select("src_did_id", "dst_did_id", "rkey", "created_at")


def post_edges(keyed: DataFrame, target_posts: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """Likes or reposts: targets that nothing is known of stay, with a null subject."""
    joined = parted_join(keyed, target_posts, "target_id", ["src_did_id", "rkey"], "left", heavy)
    return joined.select(F.col("src_did_id").alias("actor_did_id"), F.col("uri_id").alias("subject_uri_id"), "rkey", "created_at")


def resolved_refs(refs: DataFrame, target_posts: DataFrame) -> DataFrame:
    """(post_uri_id, rpath, uri_id); references to unknown targets drop."""
    return refs.join(target_posts, "target_id").select("post_uri_id", "rpath", "uri_id")


def pivoted_refs(resolved: DataFrame) -> DataFrame:
    """One row per post with a column for each path: the unsigned largest id, where a post has several."""
    ids = [umax(F.when(F.col("rpath") == path, F.col("uri_id"))).alias(name) for path, name in REF_COLUMNS.items()]
    return resolved.groupBy("post_uri_id").agg(*ids)


def posts_from_records(records: DataFrame, pivoted: DataFrame) -> DataFrame:
    """Posts of records in the columns of SIGHTINGS; those without references too. A quote is the embedded record, or else the one beside media."""
    joined = records.join(pivoted, "post_uri_id", "left")
    return joined.select(F.col("post_uri_id").alias("uri_id"), F.col("did_id").alias("author_did_id"), "rkey", "created_at", "reply_root_uri_id", "reply_parent_uri_id", F.coalesce("embed_uri_id", "embed_media_uri_id").alias("quote_uri_id"))


def distinct_posts(sighted: DataFrame) -> DataFrame:
    """One row per uri_id; rows of one id are alike but for how they came about."""
    return sighted.dropDuplicates(["uri_id"])
