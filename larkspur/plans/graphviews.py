"""A star-schema dataset seen as the social graph: the views that the registered queries run on, as SQL that Spark and other engines share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Key ranges that references are folded into; fixed, whatever the size of the data.
N_POSTS, N_ACTORS = 15000, 1500

_NO_REFS = "CAST(NULL AS BIGINT) AS reply_root_uri_id, CAST(NULL AS BIGINT) AS reply_parent_uri_id, CAST(NULL AS BIGINT) AS quote_uri_id"
_LINKS = {
    ".subject": "CASE WHEN l_linenumber % 2 = 0 THEN '.subject' ELSE '.subject.uri' END, l_orderkey",
    ".subject.uri": "'.subject.uri', l_orderkey + 1000000",
    "reply": "CASE WHEN l_suppkey % 3 = 0 THEN '.reply.root.uri' ELSE '.reply.parent.uri' END, l_partkey",
    "media": "'.embed.images', l_suppkey",
    "quote": "CASE WHEN l_suppkey % 5 = 0 THEN '.embed.record.uri' ELSE '.embed.recordWithMedia.record.record.uri' END, l_partkey + 7",
}

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "actors": (("customer",), "SELECT c_custkey AS did_id, c_name AS did, c_acctbal >= 0 AS active FROM customer"),
    "posts_from_records": (("orders",), f"SELECT o_orderkey AS uri_id, o_custkey AS author_did_id, CAST(o_orderkey AS STRING) AS rkey, o_orderdate AS created_at, CASE WHEN o_orderkey % 5 = 0 THEN (o_orderkey * 7 + 3) % {N_POSTS} END AS reply_root_uri_id, CASE WHEN o_orderkey % 5 = 0 THEN (o_orderkey * 7 + 3) % {N_POSTS} END AS reply_parent_uri_id, CASE WHEN o_orderkey % 20 = 1 THEN (o_orderkey * 11 + 5) % {N_POSTS} END AS quote_uri_id FROM orders WHERE o_orderstatus <> 'P'"),
    "posts_from_targets": (("orders",), f"SELECT o_orderkey AS uri_id, o_custkey AS author_did_id, CAST(o_orderkey AS STRING) AS rkey, o_orderdate AS created_at, {_NO_REFS} FROM orders WHERE o_orderkey % 3 <> 1"),
    "likes": (("lineitem",), "SELECT l_partkey AS actor_did_id, CASE WHEN l_linenumber <> 7 THEN l_orderkey + l_linenumber * 100 END AS subject_uri_id, CAST(l_suppkey AS STRING) AS rkey, l_shipdate AS created_at FROM lineitem"),
    "reposts": (("events",), "SELECT user_id AS actor_did_id, event_id * 2 AS subject_uri_id, CAST(event_id AS STRING) AS rkey, ts AS created_at FROM events WHERE event_type = 'view'"),
    "follows": (("events",), f"SELECT user_id AS src_did_id, event_id % {N_ACTORS} AS dst_did_id, CAST(event_id AS STRING) AS rkey, ts AS created_at FROM events WHERE event_type = 'signup'"),
    "blocks": (("events",), f"SELECT user_id AS src_did_id, event_id % {N_ACTORS} AS dst_did_id, CAST(event_id AS STRING) AS rkey, ts AS created_at FROM events WHERE event_type = 'error'"),
    # Links before they are resolved: targets leave some ids out, so that joins have rows without a partner.
    "lt_follow": (("events",), "SELECT event_id AS target_id, user_id AS src_did_id, CAST(event_id AS STRING) AS rkey, ts AS created_at FROM events WHERE event_type = 'signup'"),
    "lt_block": (("events",), "SELECT event_id AS target_id, user_id AS src_did_id, CAST(event_id AS STRING) AS rkey, ts AS created_at FROM events WHERE event_type = 'error'"),
    "lt_like": (("lineitem",), "SELECT l_orderkey AS target_id, l_partkey AS src_did_id, CAST(l_linenumber AS STRING) AS rkey, l_shipdate AS created_at FROM lineitem"),
    "lt_repost": (("events",), "SELECT event_id AS target_id, user_id AS src_did_id, CAST(event_id AS STRING) AS rkey, ts AS created_at FROM events WHERE event_type = 'view'"),
    "t_did_refs": (("events",), f"SELECT event_id AS target_id, event_id * 3 % {N_ACTORS} AS dst_did_id FROM events WHERE event_id % 10 <> 0"),
    "t_post_refs": (("orders",), "SELECT o_orderkey AS target_id, o_orderkey * 3 + 1 AS uri_id FROM orders WHERE o_orderkey % 4 <> 0"),
    "lt_post_records": (("orders",), "SELECT o_orderkey AS post_uri_id, o_custkey AS did_id, CAST(o_orderkey AS STRING) AS rkey, o_orderdate AS created_at FROM orders"),
    "lt_post_refs": (("lineitem",), "SELECT l_orderkey AS post_uri_id, CASE l_linenumber % 5 WHEN 0 THEN '.reply.root.uri' WHEN 1 THEN '.reply.parent.uri' WHEN 2 THEN '.embed.record.uri' WHEN 3 THEN '.embed.recordWithMedia.record.record.uri' ELSE '.embed.images' END AS rpath, l_partkey AS target_id FROM lineitem WHERE l_linenumber % 5 <> 4"),
    "uris": (("pages",), "SELECT page_id % 100 AS uri_id, url AS uri FROM pages"),
}

#: Decoded records, each with five links; arrays of structs are written differently by each engine.
RECORDS_TABLE = "lineitem"
RECORDS_COLUMNS = "l_partkey AS did_id, CASE l_linenumber WHEN 1 THEN 'app.bsky.feed.post' WHEN 2 THEN 'app.bsky.feed.like' WHEN 3 THEN 'app.bsky.feed.repost' WHEN 4 THEN 'app.bsky.graph.follow' WHEN 5 THEN 'app.bsky.graph.block' WHEN 6 THEN 'app.bsky.actor.profile' ELSE 'com.example.other' END AS collection, l_orderkey AS post_uri_id, l_suppkey AS tag"


def _record_links(struct: str, array: str) -> str:
    return array.format(", ".join(struct.format(*_LINKS[k].rsplit(", ", 1)) for k in _LINKS))


def spark_sql(name: str) -> str:
    if name == "records":
        return f"SELECT {RECORDS_COLUMNS}, {_record_links("named_struct('rpath', {}, 'target_id', {})", 'array({})')} AS links FROM {RECORDS_TABLE}"
    return VIEWS[name][1]


def ansi_sql(name: str) -> str:
    """The same view for an engine with ANSI types and list literals."""
    if name == "records":
        return f"SELECT {RECORDS_COLUMNS}, {_record_links("{{'rpath': {}, 'target_id': {}}}", '[{}]')} AS links FROM {RECORDS_TABLE}"
    return VIEWS[name][1].replace("AS STRING", "AS VARCHAR")


def view(spark: SparkSession, sf_dir: str, name: str, opened: dict[str, DataFrame] | None = None) -> DataFrame:
    """The view over Parquet under sf_dir, without session-wide names. opened: tables that are open already, to which it adds its own, so that a query of several views lists and infers each once."""
    tables = (RECORDS_TABLE,) if name == "records" else VIEWS[name][0]
    opened = {} if opened is None else opened
    for t in tables:
        if t not in opened:
            opened[t] = spark.read.parquet(f"{sf_dir}/{t}.parquet")
    frames = {t: opened[t] for t in tables}
    sql = spark_sql(name)
    for t in tables:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}")
    return _formatted(spark, sql, frames)


def _formatted(spark: SparkSession, sql: str, frames: dict[str, DataFrame]) -> DataFrame:
    return spark.sql(sql, **frames)
