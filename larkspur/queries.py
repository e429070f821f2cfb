"""The registered queries over the star-schema tables seen as a social graph, and the same in ANSI SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import ids, tids, uris
from larkspur.operators import aggregates, edges, posts, records
from larkspur.plans import hydrate
from larkspur.plans.graphviews import ansi_sql, view
from larkspur.sources import bincode, kv, objects
from larkspur.types import FOLLOW, POST, SUBJECT, SUBJECT_URI, TID_ALPHABET, umod

Query = Callable[[SparkSession, str], DataFrame]
U64 = 2**64
#: The five primes of XXH64.
PRIMES = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)


def xxh64_sql(rows: str, key: str, name: str) -> str:
    """XXH64 with seed 0 in SQL, from its specification, in 128-bit numbers; rows: SQL of the key and the bytes as hex, h."""
    p1, p2, p3, p4, p5 = PRIMES
    times = lambda a, b: f"(({a}) * {b}::UHUGEINT % {U64}::UHUGEINT)"
    plus = lambda a, b: f"((({a}) + ({b})) % {U64}::UHUGEINT)"
    turn = lambda a, n: f"(({a}) * {2**n}::UHUGEINT % {U64}::UHUGEINT + ({a}) // {2 ** (64 - n)}::UHUGEINT)"
    fold = lambda a, n: f"xor({a}, ({a}) // {2**n}::UHUGEINT)"
    read = lambda at, n: f"list_reduce(list_concat([0::UHUGEINT], list_reverse(b[({at}) + 1 : ({at}) + {n}])), lambda a, y: a * 256::UHUGEINT + y)"
    lane = lambda start, i: f"list_reduce(list_concat([{start % U64}::UHUGEINT], list_transform(range(n // 32), lambda s: {read(f's * 32 + {8 * i}', 8)})), lambda v, k: {times(turn(plus('v', times('k', p2)), 31), p1)})"
    mixed = lambda k: times(turn(times(k, p2), 31), p1)
    lanes = ", ".join(f"{lane(x, i)} AS v{i + 1}" for i, x in enumerate((p1 + p2, p2, 0, -p1)))
    whole = plus(plus(turn("v1", 1), turn("v2", 7)), plus(turn("v3", 12), turn("v4", 18)))
    merged = f"list_reduce([{whole}, v1, v2, v3, v4], lambda h, v: {plus(times(f'xor(h, {mixed("v")})', p1), p4)})"
    eights = f"list_reduce(list_concat([h0], list_transform(range((n % 32) // 8), lambda s: {read('(n // 32) * 32 + s * 8', 8)})), lambda h, k: {plus(times(turn(f'xor(h, {mixed("k")})', 27), p1), p4)})"
    four = f"xor(h1, {times(read('(n // 8) * 8', 4), p1)})"
    ones = f"list_reduce(list_concat([h2], b[(n // 4) * 4 + 1 :]), lambda h, k: {times(turn(f'xor(h, {times("k", p5)})', 11), p1)})"
    return f"""
        WITH r AS ({rows}), b AS (SELECT {key}, list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::INT::UHUGEINT) AS b FROM r), l AS (SELECT *, len(b) AS n FROM b),
             a AS (SELECT *, {lanes} FROM l), s AS (SELECT *, {plus(f"CASE WHEN n >= 32 THEN {merged} ELSE {p5}::UHUGEINT END", "n::UHUGEINT")} AS h0 FROM a),
             e AS (SELECT *, {eights} AS h1 FROM s), f AS (SELECT *, CASE WHEN n % 8 >= 4 THEN {plus(times(turn(four, 23), p2), p3)} ELSE h1 END AS h2 FROM e),
             o AS (SELECT *, {ones} AS h3 FROM f), x AS (SELECT *, {times(fold("h3", 33), p2)} AS h4 FROM o), y AS (SELECT *, {times(fold("h4", 29), p3)} AS h5 FROM x), z AS (SELECT *, {fold("h5", 32)} AS h6 FROM y)
        SELECT {key}, (CASE WHEN h6 >= {2**63}::UHUGEINT THEN h6::HUGEINT - {U64}::HUGEINT ELSE h6::HUGEINT END)::BIGINT AS {name} FROM z
    """


QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DAY = "2024-01-15"
CHUNKS = 4


def query(oracle: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query under its function's name, with SQL over the named views if it has an oracle."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ctes = ", ".join(f"{v} AS ({ansi_sql(v) if v != 'posts' else POSTS})" for v in views)
            ORACLES[f.__name__] = f"WITH {ctes} {oracle}" if ctes else oracle
        return f

    return put


_SIGHTED = ("posts_from_records", "posts_from_targets")
_REST = "author_did_id, rkey, created_at, reply_root_uri_id, reply_parent_uri_id, quote_uri_id"
_UNION = "SELECT *, 'record' AS source FROM posts_from_records UNION ALL BY NAME SELECT *, 'target_only' AS source FROM posts_from_targets"
#: Column by column the first value that isn't null, records before targets, larger ones first where several say something.
POSTS = f"SELECT uri_id, {', '.join(f"first({c} ORDER BY source, {c} DESC) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in _REST.split(', '))}, min(source) AS source FROM ({_UNION}) GROUP BY uri_id"
_P = (*_SIGHTED, "posts")


def _posts(spark: SparkSession, d: str, opened: dict[str, DataFrame] | None = None) -> DataFrame:
    opened = {} if opened is None else opened
    return posts.build_posts(*(view(spark, d, t, opened) for t in _SIGHTED))


def _graph(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    opened: dict[str, DataFrame] = {}
    return {t: view(spark, d, t, opened) for t in ("actors", "follows", "blocks", "likes", "reposts")} | {"posts": _posts(spark, d, opened)}


def _events(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/events.parquet")


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/pages.parquet")


# Scans, routing, projections


@query("SELECT did_id, did, active FROM actors", ("actors",))
def scan_actors(spark, d):
    return view(spark, d, "actors")


@query("SELECT did_id, collection, post_uri_id, CASE collection WHEN 'app.bsky.feed.post' THEN 'post' WHEN 'app.bsky.feed.like' THEN 'like' WHEN 'app.bsky.feed.repost' THEN 'repost' WHEN 'app.bsky.graph.follow' THEN 'follow' WHEN 'app.bsky.graph.block' THEN 'block' END AS branch FROM records WHERE collection LIKE 'app.bsky.feed.%' OR collection LIKE 'app.bsky.graph.%'", ("records",))
def route_by_collection(spark, d):
    return records.routed(view(spark, d, "records")).select("did_id", "collection", "post_uri_id", "branch")


@query("SELECT post_uri_id, u.l.rpath AS rpath, u.l.target_id AS target_id FROM (SELECT post_uri_id, unnest(links) AS l FROM records WHERE collection = 'app.bsky.feed.post') u WHERE u.l.rpath IN ('.reply.root.uri', '.reply.parent.uri', '.embed.record.uri', '.embed.recordWithMedia.record.record.uri')", ("records",))
def explode_refs(spark, d):
    return records.post_refs(view(spark, d, "records").where(F.col("collection") == POST))


@query("SELECT did_id, post_uri_id, list_filter(links, lambda x: x.rpath = '.subject.uri')[1].target_id AS target_id FROM records WHERE collection = 'app.bsky.feed.like' UNION ALL SELECT did_id, post_uri_id, list_filter(links, lambda x: x.rpath = '.subject')[1].target_id FROM records WHERE collection = 'app.bsky.graph.follow' AND len(list_filter(links, lambda x: x.rpath = '.subject')) > 0", ("records",))
def first_subject(spark, d):
    rows = view(spark, d, "records")
    got = [rows.where(F.col("collection") == c).select("did_id", "post_uri_id", records.first_target(F.col("links"), p).alias("target_id")) for c, p in ((records.LIKE, SUBJECT_URI), (FOLLOW, SUBJECT))]
    return got[0].unionByName(got[1]).where("target_id is not null")


# Joins


def _edge_sql(left: str) -> str:
    return f"SELECT src_did_id, dst_did_id, rkey, created_at FROM {left} JOIN t_did_refs USING (target_id)"


@query(_edge_sql("lt_follow"), ("lt_follow", "t_did_refs"))
def join_inner_follows(spark, d):
    return edges.actor_edges(view(spark, d, "lt_follow"), view(spark, d, "t_did_refs"))


@query(_edge_sql("lt_block"), ("lt_block", "t_did_refs"))
def join_inner_blocks(spark, d):
    return edges.actor_edges(view(spark, d, "lt_block"), view(spark, d, "t_did_refs"))


def _subject_sql(left: str) -> str:
    return f"SELECT src_did_id AS actor_did_id, uri_id AS subject_uri_id, rkey, created_at FROM {left} LEFT JOIN t_post_refs USING (target_id)"


@query(_subject_sql("lt_like"), ("lt_like", "t_post_refs"))
def join_left_likes(spark, d):
    return edges.post_edges(view(spark, d, "lt_like"), view(spark, d, "t_post_refs"))


@query(_subject_sql("lt_repost"), ("lt_repost", "t_post_refs"))
def join_left_reposts(spark, d):
    return edges.post_edges(view(spark, d, "lt_repost"), view(spark, d, "t_post_refs"))


_RESOLVED = "SELECT post_uri_id, rpath, uri_id FROM lt_post_refs JOIN t_post_refs USING (target_id)"
_PIVOTED = f"SELECT post_uri_id, {', '.join(f"max(uri_id) FILTER (WHERE rpath = '{path}') AS {name}" for path, name in edges.REF_COLUMNS.items())} FROM ({_RESOLVED}) GROUP BY post_uri_id"


@query(_RESOLVED, ("lt_post_refs", "t_post_refs"))
def resolve_refs(spark, d):
    return edges.resolved_refs(view(spark, d, "lt_post_refs"), view(spark, d, "t_post_refs"))


@query(_PIVOTED, ("lt_post_refs", "t_post_refs"))
def pivot_refs(spark, d):
    return edges.pivoted_refs(resolve_refs(spark, d))


@query(f"SELECT post_uri_id AS uri_id, did_id AS author_did_id, rkey, created_at, reply_root_uri_id, reply_parent_uri_id, coalesce(embed_uri_id, embed_media_uri_id) AS quote_uri_id FROM lt_post_records LEFT JOIN ({_PIVOTED}) USING (post_uri_id)", ("lt_post_records", "lt_post_refs", "t_post_refs"))
def posts_from_records(spark, d):
    return edges.posts_from_records(view(spark, d, "lt_post_records"), pivot_refs(spark, d))


@query(f"SELECT DISTINCT ON (uri_id) uri_id, {_REST} FROM (SELECT * FROM posts_from_targets UNION ALL SELECT * FROM posts_from_targets WHERE uri_id % 2 = 0)", ("posts_from_targets",))
def distinct_on_posts(spark, d):
    rows = view(spark, d, "posts_from_targets")
    return edges.distinct_posts(rows.unionByName(rows.where("uri_id % 2 = 0")))


# Posts and aggregates


@query(_UNION, _SIGHTED)
def posts_union_all(spark, d):
    return posts.sightings(view(spark, d, "posts_from_records"), view(spark, d, "posts_from_targets"))


@query("SELECT * FROM posts", _P)
def build_posts(spark, d):
    return _posts(spark, d)


_BY_AUTHOR = "SELECT author_did_id AS did_id, count(*) AS posts, count(reply_parent_uri_id) AS replies_out, count(quote_uri_id) AS quotes_out FROM posts GROUP BY author_did_id"


@query(_BY_AUTHOR, _P)
def posts_by_author(spark, d):
    return aggregates.posts_by_author(_posts(spark, d))


def _count_sql(table: str, column: str, key: str, name: str) -> str:
    return f"SELECT {column} AS {key}, count(*) AS {name} FROM {table} WHERE {column} IS NOT NULL GROUP BY 1"


#: query name: table, column, key, count
COUNTS = {
    "count_by_follow_src": ("follows", "src_did_id", "did_id", "follows"), "count_by_follow_dst": ("follows", "dst_did_id", "did_id", "followers"),
    "count_by_block_src": ("blocks", "src_did_id", "did_id", "blocks_out"), "count_by_block_dst": ("blocks", "dst_did_id", "did_id", "blocks_in"),
    "count_by_like_actor": ("likes", "actor_did_id", "did_id", "likes_out"), "count_by_repost_actor": ("reposts", "actor_did_id", "did_id", "reposts_out"),
    "count_by_like_subject": ("likes", "subject_uri_id", "uri_id", "likes"), "count_by_repost_subject": ("reposts", "subject_uri_id", "uri_id", "reposts"),
    "replies_by_parent": ("posts", "reply_parent_uri_id", "uri_id", "replies"), "quotes_by_target": ("posts", "quote_uri_id", "uri_id", "quotes"),
}


def _count_query(name: str, spec: tuple[str, str, str, str]) -> None:
    def run(spark, d):
        return aggregates.count_by(_posts(spark, d) if spec[0] == "posts" else view(spark, d, spec[0]), *spec[1:])

    run.__name__ = name
    query(_count_sql(*spec), _P if spec[0] == "posts" else (spec[0],))(run)


for _name, _spec in COUNTS.items():
    _count_query(_name, _spec)

_RECEIVED = "SELECT p.author_did_id AS did_id, count(*) AS {name} FROM {edges} e JOIN posts p ON e.{subject} = p.uri_id GROUP BY 1"


@query(_RECEIVED.format(name="likes_in", edges="likes", subject="subject_uri_id"), (*_P, "likes"))
def likes_in(spark, d):
    return aggregates.received(view(spark, d, "likes"), "subject_uri_id", _posts(spark, d), "likes_in")


@query(_RECEIVED.format(name="reposts_in", edges="reposts", subject="subject_uri_id"), (*_P, "reposts"))
def reposts_in(spark, d):
    return aggregates.received(view(spark, d, "reposts"), "subject_uri_id", _posts(spark, d), "reposts_in")


@query(_RECEIVED.format(name="quoted_count", edges="posts", subject="quote_uri_id"), _P)
def quoted_count(spark, d):
    p = _posts(spark, d)
    return aggregates.received(p, "quote_uri_id", p, "quoted_count")


_ALL = (*_P, "actors", "follows", "blocks", "likes", "reposts")
_PARTS = [_count_sql(*COUNTS[c]) for c in COUNTS if COUNTS[c][2] == "did_id"] + [_BY_AUTHOR] + [_RECEIVED.format(name=n, edges=e, subject=s) for n, e, s in (("likes_in", "likes", "subject_uri_id"), ("reposts_in", "reposts", "subject_uri_id"), ("quoted_count", "posts", "quote_uri_id"))]
_ACTOR_AGGS = "SELECT did_id, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in aggregates.ACTOR_COUNTS) + " FROM actors " + " ".join(f"LEFT JOIN ({p}) USING (did_id)" for p in _PARTS)
_POST_PARTS = [_count_sql(*COUNTS[c]) for c in COUNTS if COUNTS[c][2] == "uri_id"]
_POST_AGGS = "SELECT uri_id, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in aggregates.POST_COUNTS) + " FROM posts " + " ".join(f"LEFT JOIN ({p}) USING (uri_id)" for p in _POST_PARTS)
_POST_VIEWS = (*_P, "likes", "reposts")


def _actor_aggs(g: dict[str, DataFrame]) -> DataFrame:
    return aggregates.actor_aggs(g["actors"], g["follows"], g["blocks"], g["posts"], g["likes"], g["reposts"])


def _post_aggs(g: dict[str, DataFrame]) -> DataFrame:
    return aggregates.post_aggs(g["posts"], g["likes"], g["reposts"])


@query(_ACTOR_AGGS, _ALL)
def actor_aggs(spark, d):
    return _actor_aggs(_graph(spark, d))


@query(_ACTOR_AGGS, _ALL)
def actor_aggs_from_post_aggs(spark, d):
    g = _graph(spark, d)
    return aggregates.actor_aggs_from_posts(g["actors"], g["follows"], g["blocks"], g["posts"], g["likes"], g["reposts"], _post_aggs(g))


@query(_ACTOR_AGGS, _ALL)
def actor_aggs_chunked(spark, d):
    return hydrate.chunked(actor_aggs(spark, d), "did_id", CHUNKS)


@query(_POST_AGGS, _POST_VIEWS)
def post_aggs(spark, d):
    return _post_aggs(_graph(spark, d))


@query(_POST_AGGS, _POST_VIEWS)
def post_aggs_chunked(spark, d):
    return hydrate.chunked(post_aggs(spark, d), "uri_id", CHUNKS)


@query(f"SELECT * FROM ({_POST_AGGS}) WHERE uri_id % {CHUNKS} = 0", _POST_VIEWS)
def post_aggs_dry_run(spark, d):
    return hydrate.chunked(post_aggs(spark, d), "uri_id", CHUNKS, dry_run=True)


# Checks and questions

_ORPHANS = "SELECT avg(CASE WHEN uri_id IS NULL THEN 1 ELSE 0 END) AS orphan_rate FROM {} LEFT JOIN posts ON subject_uri_id = uri_id"


@query(_ORPHANS.format("likes"), (*_P, "likes"))
def orphan_rate_likes(spark, d):
    return aggregates.orphan_rate(view(spark, d, "likes"), _posts(spark, d))


@query(_ORPHANS.format("reposts"), (*_P, "reposts"))
def orphan_rate_reposts(spark, d):
    return aggregates.orphan_rate(view(spark, d, "reposts"), _posts(spark, d))


_ON_DAY = f"created_at >= TIMESTAMP '{DAY} 00:00:00' AND created_at < TIMESTAMP '{DAY} 00:00:00' + INTERVAL 1 DAY"


@query(f"SELECT count(*) AS n FROM follows WHERE {_ON_DAY}", ("follows",))
def follows_on_day(spark, d):
    return aggregates.follows_on_day(view(spark, d, "follows"), DAY)


@query(f"SELECT CAST(100 * count(*) FILTER (WHERE {_ON_DAY}) AS DOUBLE) / count(*) AS pct FROM follows", ("follows",))
def pct_follows_on_day(spark, d):
    return aggregates.share_on_day(view(spark, d, "follows"), DAY)


_LIKED = "FROM posts WHERE uri_id IN (SELECT subject_uri_id FROM likes)"


@query(f"SELECT count(DISTINCT author_did_id) AS n {_LIKED}", (*_P, "likes"))
def posters_with_likes(spark, d):
    return aggregates.liked_posts(_posts(spark, d), view(spark, d, "likes")).agg(F.countDistinct("author_did_id").alias("n"))


@query(f"SELECT count(*) AS n {_LIKED}", (*_P, "likes"))
def posts_with_likes(spark, d):
    return aggregates.liked_posts(_posts(spark, d), view(spark, d, "likes")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT uri_id, count(DISTINCT uri) AS uris FROM uris GROUP BY uri_id HAVING count(DISTINCT uri) > 1", ("uris",))
def collision_check(spark, d):
    return aggregates.collisions(view(spark, d, "uris"))


@query(" UNION ALL ".join(f"SELECT {i} AS place, '{t}' AS name, count(*) AS n FROM {t if not t.endswith('_aggs') else '(' + (_ACTOR_AGGS if t == 'actor_aggs' else _POST_AGGS) + ')'}" for i, t in enumerate(hydrate.COUNTED)), _ALL)
def table_counts(spark, d):
    g = _graph(spark, d)
    return hydrate.counts(g | {"actor_aggs": _actor_aggs(g), "post_aggs": _post_aggs(g)})


# Scalar functions

_TID = f"translate(lpad(to_base(epoch_us(ts), 32), 11, '0') || lpad(to_base(event_id % 1024, 32), 2, '0'), '0123456789ABCDEFGHIJKLMNOPQRSTUV', '{TID_ALPHABET}')"


def _tid() -> Column:
    return tids.tid_encode(F.unix_micros(F.col("ts").cast("timestamp")), (F.col("event_id") % 1024).cast("int"))


@query(f"SELECT event_id, {_TID} AS tid FROM events")
def tid_encode(spark, d):
    return _events(spark, d).select("event_id", _tid().alias("tid"))


@query(f"SELECT event_id, make_timestamp(list_reduce(list_transform(range(1, 12), lambda i: instr('{TID_ALPHABET}', substr(tid, i, 1)) - 1), lambda a, b: a * 32 + b)::BIGINT) AS created_at FROM (SELECT event_id, {_TID} AS tid FROM events)")
def tid_decode(spark, d):
    return _events(spark, d).select("event_id", tids.tid_time(_tid()).alias("created_at"))


@query("SELECT page_id, CASE WHEN ok THEN parts[1] END AS did, CASE WHEN ok THEN parts[2] END AS collection, CASE WHEN ok THEN array_to_string(parts[3:], '/') END AS rkey FROM (SELECT *, starts_with(url, 'http://') AND len(parts) >= 3 AS ok FROM (SELECT page_id, url, string_split(substr(url, 8), '/') AS parts FROM pages))")
def parse_uri(spark, d):
    return _pages(spark, d).select("page_id", uris.parse_uri(F.col("url"), "http://").alias("u")).select("page_id", "u.did", "u.collection", "u.rkey")


@query(xxh64_sql("SELECT page_id, hex(encode(url)) AS h FROM pages", "page_id", "uri_id"))
def uri_id_hash(spark, d):
    return _pages(spark, d).select("page_id", ids.uri_id(F.col("url")).alias("uri_id"))


_LITTLE = "array_to_string(list_reverse(regexp_extract_all(lpad(to_base(page_id, 16), 16, '0'), '..')), '')"


@query(xxh64_sql(f"SELECT page_id, hex(encode('like')) || '00' || {_LITTLE} || hex(encode(url)) AS h FROM pages", "page_id", "record_id"))
def record_id_hash(spark, d):
    return _pages(spark, d).select("page_id", ids.record_id("like", F.col("page_id"), F.col("url")).alias("record_id"))


# Decoding: what tables say, encoded as index entries and decoded again


@query("SELECT c_name AS did, c_custkey AS did_id, c_acctbal >= 0 AS active FROM customer")
def decode_actors(spark, d):
    rows = spark.read.parquet(f"{d}/customer.parquet")
    entry = bincode.string_column(F.col("c_name")), F.concat(bincode.integer_column(F.col("c_custkey")), bincode.boolean_column(F.col("c_acctbal") >= 0))
    return kv.entries(rows.select(F.lit("did_ids").alias("cf"), entry[0].alias("key"), entry[1].alias("value")), "did_ids")


@query("SELECT o_orderkey * 1000003 AS target_id, CAST(o_custkey AS VARCHAR) AS target, o_orderstatus AS collection, o_orderpriority AS rpath FROM orders")
def decode_targets(spark, d):
    rows = spark.read.parquet(f"{d}/orders.parquet")
    key = F.unhex(F.lpad(F.hex(F.col("o_orderkey") * 1000003), 16, "0"))
    value = F.concat(*[bincode.string_column(F.col(c).cast("string")) for c in ("o_custkey", "o_orderstatus", "o_orderpriority")])
    return kv.entries(rows.select(F.lit("target_ids").alias("cf"), key.alias("key"), value.alias("value")), "target_ids")


_LINK_IDS = {"l_linestatus": "l_partkey", "l_returnflag": "l_orderkey * 70000", "l_suppkey": "l_suppkey * 5000000000"}
_DECODED_LINKS = " UNION ALL ".join(f"SELECT l_partkey AS did_id, l_returnflag AS collection, CAST(l_orderkey AS VARCHAR) AS rkey, CAST({c} AS VARCHAR) AS rpath, {n} AS target_id FROM lineitem WHERE l_linenumber > {i}" for i, (c, n) in enumerate(_LINK_IDS.items()))


@query(_DECODED_LINKS)
def decode_links(spark, d):
    rows = spark.read.parquet(f"{d}/lineitem.parquet")
    key = F.concat(bincode.integer_column(F.col("l_partkey")), bincode.string_column(F.col("l_returnflag")), bincode.string_column(F.col("l_orderkey").cast("string")))
    links = [F.when(F.col("l_linenumber") > i, F.concat(bincode.string_column(F.col(c).cast("string")), bincode.integer_column(F.expr(n)))).otherwise(F.lit(b"")) for i, (c, n) in enumerate(_LINK_IDS.items())]
    value = F.concat(bincode.integer_column(F.least(F.col("l_linenumber"), F.lit(len(links))).cast("bigint")), *links)
    got = kv.entries(rows.select(F.lit("link_targets").alias("cf"), key.alias("key"), value.alias("value")), "link_targets")
    return got.select("did_id", "collection", "rkey", F.explode("links").alias("link")).select("did_id", "collection", "rkey", "link.*")


@query("SELECT o_orderkey, CAST((CASE WHEN k < 0 THEN k::HUGEINT + 18446744073709551616 ELSE k::HUGEINT END) % 7 AS BIGINT) AS bucket FROM (SELECT o_orderkey, o_orderkey * 1000003 - 7000000000 AS k FROM orders)")
def umod_bucket(spark, d):
    key = F.col("o_orderkey") * F.lit(1000003).cast("bigint") - F.lit(7000000000)
    return spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", umod(key, 7).alias("bucket"))


# Listings

_LISTED = "SELECT substr(url, strpos(url, '//') + 2) AS key, length(html) AS size, page_id FROM pages"


def _listed(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).select(F.substring_index("url", "//", -1).alias("key"), F.length("html").cast("bigint").alias("size"), "page_id")


@query(f"SELECT split_part(key, '/', 1) AS prefix, CAST(sum(size) AS BIGINT) AS bytes, count(*) AS objects FROM ({_LISTED}) GROUP BY 1")
def top_prefixes(spark, d):
    return objects.by_prefix(_listed(spark, d))


@query(f"SELECT DISTINCT key FROM ({_LISTED}) WHERE key NOT IN (SELECT key FROM ({_LISTED}) WHERE page_id % 3 <> 0)")
def missing_keys(spark, d):
    rows = _listed(spark, d)
    return objects.missing(rows.where("page_id % 3 <> 0").select("key", "size"), rows)


@query(f"SELECT key, size FROM ({_LISTED}) WHERE page_id % 3 <> 0 AND key IN (SELECT key FROM ({_LISTED}) WHERE page_id % 2 = 0)")
def found_keys(spark, d):
    rows = _listed(spark, d)
    return objects.found(rows.where("page_id % 3 <> 0").select("key", "size"), rows.where("page_id % 2 = 0"))


@query("SELECT DATE '2024-01-15' AS snapshot_date, 'file:///index' AS source_url, CAST(679 AS BIGINT) AS backup_id, TIMESTAMP '2024-01-16 01:02:03' AS built_at, '0.1' AS engine_version, '4GiB' AS memory_limit")
def snapshot_metadata(spark, d):
    return hydrate.metadata(spark, "2024-01-15", "file:///index", 679, "2024-01-16 01:02:03", "0.1", "4GiB")
