"""Decoded records and targets, routed into the edges and references that the snapshot is joined from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.ids import post_uri, uri_id
from larkspur.functions.tids import tid_time
from larkspur.functions.uris import parse_uri
from larkspur.types import BLOCK, FOLLOW, LIKE, POST, POST_REFS, REPOST, SUBJECT, SUBJECT_URI

BRANCHES = {POST: "post", LIKE: "like", REPOST: "repost", FOLLOW: "follow", BLOCK: "block"}


def routed(records: DataFrame) -> DataFrame:
    """Records of the five collections with their `branch`; profiles and unknown collections are dropped."""
    branch = F.lit(None).cast("string")
    for collection, name in BRANCHES.items():
        branch = F.when(F.col("collection") == collection, name).otherwise(branch)
    return records.where(F.col("collection").isin(*BRANCHES)).withColumn("branch", branch)


def first_target(links: Column, rpath: str) -> Column:
    """target_id of the first link with that path; null without one."""
    return F.get(F.filter(links, lambda x: x["rpath"] == rpath), F.lit(0))["target_id"]


def keyed(records: DataFrame, collection: str, rpath: str) -> DataFrame:
    """(target_id, src_did_id, rkey, created_at) of a collection's records that link through the path; others are dropped."""
    rows = records.where(F.col("collection") == collection).select(first_target(F.col("links"), rpath).alias("target_id"), F.col("did_id").alias("src_did_id"), "rkey", tid_time(F.col("rkey")).alias("created_at"))
    return rows.where(F.col("target_id").isNotNull())


def post_records(records: DataFrame, actors: DataFrame) -> DataFrame:
    """(post_uri_id, did_id, rkey, created_at, links) of posts whose author is an actor; others are dropped with all they refer to."""
    posts = records.where(F.col("collection") == POST)
    return posts.join(actors.select("did_id", "did"), "did_id").select(uri_id(post_uri(F.col("did"), F.col("rkey"))).alias("post_uri_id"), "did_id", "rkey", tid_time(F.col("rkey")).alias("created_at"), "links")


def post_refs(posts: DataFrame) -> DataFrame:
    """(post_uri_id, rpath, target_id) of every link with one of the four reference paths, repeats included."""
    links = posts.select("post_uri_id", F.explode(F.filter("links", lambda x: x["rpath"].isin(*POST_REFS))).alias("link"))
    return links.select("post_uri_id", "link.rpath", "link.target_id")


def _is(pairs: list[tuple[str, str]]) -> Column:
    out = F.lit(False)
    for collection, rpath in pairs:
        out = out | ((F.col("collection") == collection) & (F.col("rpath") == rpath))
    return out


def names_post() -> Column:
    return _is([*[(POST, r) for r in POST_REFS], (LIKE, SUBJECT_URI), (REPOST, SUBJECT_URI)])


def names_actor() -> Column:
    return _is([(FOLLOW, SUBJECT), (BLOCK, SUBJECT)])


def target_posts(targets: DataFrame) -> DataFrame:
    """(target_id, uri_id): targets in the place of a post, hashed whatever they are."""
    return targets.where(names_post()).select("target_id", uri_id(F.col("target")).alias("uri_id"))


def target_actors(targets: DataFrame, actors: DataFrame) -> DataFrame:
    """(target_id, dst_did_id): targets in the place of an actor, if they are one."""
    return targets.where(names_actor()).join(actors.select(F.col("did").alias("target"), F.col("did_id").alias("dst_did_id")), "target").select("target_id", "dst_did_id")


def sighted_posts(targets: DataFrame, actors: DataFrame) -> DataFrame:
    """Posts that any target names by URI, if the author is an actor, in the columns of SIGHTINGS, without references; the hash is of the target as it is."""
    uri = targets.select("target", parse_uri(F.col("target")).alias("uri")).where(F.col("uri.collection") == POST)
    none = F.lit(None).cast("bigint")
    return uri.join(actors.select(F.col("did").alias("author"), F.col("did_id").alias("author_did_id")), F.col("uri.did") == F.col("author")).select(
        uri_id(F.col("target")).alias("uri_id"), "author_did_id", F.col("uri.rkey").alias("rkey"), tid_time(F.col("uri.rkey")).alias("created_at"), none.alias("reply_root_uri_id"), none.alias("reply_parent_uri_id"), none.alias("quote_uri_id")
    )
