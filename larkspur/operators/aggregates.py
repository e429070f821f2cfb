"""The two wide aggregate tables and the checks on edges.

Each count is a partial aggregate on its key. The wide tables are not joined from counts: all rows that say something of a
key go under each other with the kind of thing they say, and one aggregate, combined before the shuffle, counts the kinds. So
a viral post or actor is a heavy key of no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.types import umod

ACTOR_COUNTS = ("follows", "followers", "blocks_out", "blocks_in", "posts", "likes_out", "likes_in", "reposts_out", "reposts_in", "replies_out", "quotes_out", "quoted_count")
POST_COUNTS = ("likes", "reposts", "replies", "quotes")


def count_by(df: DataFrame, column: str, key: str, name: str) -> DataFrame:
    """(key, name): rows of each value that is not null."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias(key)).agg(F.count(F.lit(1)).alias(name))


def posts_by_author(posts: DataFrame) -> DataFrame:
    """(did_id, posts, replies_out, quotes_out) in one pass."""
    return posts.groupBy(F.col("author_did_id").alias("did_id")).agg(F.count(F.lit(1)).alias("posts"), F.count("reply_parent_uri_id").alias("replies_out"), F.count("quote_uri_id").alias("quotes_out"))


def received(edges: DataFrame, subject: str, posts: DataFrame, name: str) -> DataFrame:
    """(did_id, name): edges to posts in the table, by the post's author."""
    by_post = count_by(edges, subject, "uri_id", "n")
    return by_post.join(posts.select("uri_id", "author_did_id"), "uri_id").groupBy(F.col("author_did_id").alias("did_id")).agg(F.sum("n").cast("bigint").alias(name))


def _said(df: DataFrame, key: str, facts: list[tuple[str, str]], *more: Column) -> DataFrame:
    """(key, kind, more) for each row and fact (column, kind), from one pass over the rows; facts of null are none."""
    rows = df.select(F.explode(F.array(*[F.struct(F.col(c).alias(key), F.lit(kind).alias("kind")) for c, kind in facts])).alias("fact"), *more)
    return rows.select("fact.*", *[c for c in rows.columns if c != "fact"]).where(F.col(key).isNotNull())


def _is(kind: str) -> Column:
    return F.col("kind") == kind


def post_aggs(posts: DataFrame, likes: DataFrame, reposts: DataFrame) -> DataFrame:
    """uri_id and its likes, reposts, direct replies and quotes; a row for every post."""
    said = _said(posts, "uri_id", [("uri_id", "post"), ("reply_parent_uri_id", "replies"), ("quote_uri_id", "quotes")])
    said = said.unionByName(_said(likes, "uri_id", [("subject_uri_id", "likes")])).unionByName(_said(reposts, "uri_id", [("subject_uri_id", "reposts")]))
    found = said.groupBy("uri_id").agg(F.count_if(_is("post")).alias("there"), *[F.count_if(_is(c)).alias(c) for c in POST_COUNTS])
    return found.where("there > 0").drop("there")


_POST_FACTS = ("replied", "quoting", "likes", "reposts", "quotes")


def _by_actor(actors: DataFrame, follows: DataFrame, blocks: DataFrame, likes: DataFrame, reposts: DataFrame, per_post: DataFrame) -> DataFrame:
    """The twelve counts; per_post: (author_did_id, replied, quoting, likes, reposts, quotes), a row for each post."""
    said = _said(follows, "did_id", [("src_did_id", "follows"), ("dst_did_id", "followers")])
    for df, facts in ((blocks, [("src_did_id", "blocks_out"), ("dst_did_id", "blocks_in")]), (likes, [("actor_did_id", "likes_out")]), (reposts, [("actor_did_id", "reposts_out")])):
        said = said.unionByName(_said(df, "did_id", facts))
    said = said.withColumns({c: F.lit(0).cast("bigint") for c in _POST_FACTS})
    said = said.unionByName(_said(per_post, "did_id", [("author_did_id", "posts")], *[F.col(c).cast("bigint").alias(c) for c in _POST_FACTS]))
    sums = dict(zip(("replies_out", "quotes_out", "likes_in", "reposts_in", "quoted_count"), _POST_FACTS, strict=True))
    found = said.groupBy("did_id").agg(*[F.sum(sums[c]).alias(c) if c in sums else F.count_if(_is(c)).alias(c) for c in ACTOR_COUNTS])
    return actors.select("did_id").join(found, "did_id", "left").select("did_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ACTOR_COUNTS])


def actor_aggs(actors: DataFrame, follows: DataFrame, blocks: DataFrame, posts: DataFrame, likes: DataFrame, reposts: DataFrame) -> DataFrame:
    """did_id and twelve counts; a row for every actor, active or not. Posts, one row each, are read once."""
    own = [F.col("author_did_id"), F.col("reply_parent_uri_id").isNotNull().alias("replied"), F.col("quote_uri_id").isNotNull().alias("quoting")]
    none = [F.lit(None).cast("bigint").alias("author_did_id"), F.lit(None).cast("boolean").alias("replied"), F.lit(None).cast("boolean").alias("quoting")]
    said = _said(posts, "uri_id", [("uri_id", "post"), ("quote_uri_id", "quotes")], *own)
    for df, kind in ((likes, "likes"), (reposts, "reposts")):
        said = said.unionByName(_said(df, "uri_id", [("subject_uri_id", kind)], *none))
    post = lambda c: F.max(F.when(_is("post"), F.col(c))).alias(c)
    per_post = said.groupBy("uri_id").agg(post("author_did_id"), post("replied"), post("quoting"), *[F.count_if(_is(c)).alias(c) for c in ("likes", "reposts", "quotes")])
    return _by_actor(actors, follows, blocks, likes, reposts, per_post.where("author_did_id is not null"))


def actor_aggs_from_posts(actors: DataFrame, follows: DataFrame, blocks: DataFrame, posts: DataFrame, likes: DataFrame, reposts: DataFrame, per_post: DataFrame) -> DataFrame:
    """The same from a finished post_aggs: what authors receive is the sum over their posts."""
    flags = posts.select("uri_id", "author_did_id", F.col("reply_parent_uri_id").isNotNull().alias("replied"), F.col("quote_uri_id").isNotNull().alias("quoting"))
    return _by_actor(actors, follows, blocks, likes, reposts, flags.join(per_post, "uri_id", "left"))


def bucket(df: DataFrame, key: str, n: int, k: int) -> DataFrame:
    """Rows whose key, unsigned, leaves k when divided by n."""
    return df.where(umod(F.col(key), n) == k)


def orphan_rate(edges: DataFrame, posts: DataFrame) -> DataFrame:
    """One row: the share of edges without a post, null subjects included; null without edges.

    Edges are counted by subject before they meet the posts, so that no subject makes a task heavy.
    """
    by_subject = edges.groupBy("subject_uri_id").agg(F.count(F.lit(1)).alias("n"))
    met = by_subject.join(posts.select(F.col("uri_id").alias("subject_uri_id"), F.lit(1).alias("known")), "subject_uri_id", "left")
    lost = F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0))
    return met.agg((lost.cast("double") / F.greatest(F.sum("n"), F.lit(1))).alias("orphan_rate"))


def on_day(df: DataFrame, day: str) -> Column:
    """created_at within a day given as yyyy-mm-dd."""
    start = F.lit(day).cast("timestamp_ntz")
    return (df["created_at"] >= start) & (df["created_at"] < start + F.expr("INTERVAL 1 DAY"))


def follows_on_day(follows: DataFrame, day: str) -> DataFrame:
    return follows.where(on_day(follows, day)).agg(F.count(F.lit(1)).alias("n"))


def share_on_day(follows: DataFrame, day: str) -> DataFrame:
    """Percent of follows made that day; null without follows."""
    return follows.agg((F.try_divide(F.lit(100.0) * F.count_if(on_day(follows, day)), F.count(F.lit(1)))).alias("pct"))


def liked_posts(posts: DataFrame, likes: DataFrame) -> DataFrame:
    """Posts with a like, each once. Subjects are made distinct before they move, so that a viral post is one row by then."""
    return posts.join(likes.select(F.col("subject_uri_id").alias("uri_id")).distinct(), "uri_id", "left_semi")


def collisions(uris: DataFrame) -> DataFrame:
    """(uri_id, uris) of ids that stand for more than one URI; input (uri_id, uri)."""
    return uris.groupBy("uri_id").agg(F.countDistinct("uri").alias("uris")).where("uris > 1")
