"""Every registered query of the engine's own against its SQL, and those without against other means."""

import pytest
import xxhash
from pyspark.sql import functions as F

from larkspur.queries import ORACLES, QUERIES

SIZE = "sf0.001"
DIR = f"/root/testdata/{SIZE}"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    names = sorted(df.columns)
    rows = sorted(repr(tuple(r)) for r in df.select(*names).collect())
    assert (names, rows) == duck(SIZE, ORACLES[name])


def test_hashes(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{DIR}/pages.parquet").collect()}
    for r in QUERIES["uri_id_hash"](spark, DIR).collect():
        assert r.uri_id % 2**64 == xxhash.xxh64_intdigest(urls[r.page_id])
    for r in QUERIES["record_id_hash"](spark, DIR).collect():
        assert r.record_id % 2**64 == xxhash.xxh64_intdigest(b"like\0" + r.page_id.to_bytes(8, "little") + urls[r.page_id].encode())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_scan_reads_only_what_it_needs(spark):
    plan = QUERIES["follows_on_day"](spark, DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan
    assert "GreaterThanOrEqual(ts" in plan and "EqualTo(event_type,signup)" in plan


def test_aggregates_hold_together(spark):
    from larkspur.plans.graphviews import view
    from larkspur.queries import _graph, _post_aggs

    g = _graph(spark, DIR)
    per_post = _post_aggs(g)
    subjects = g["likes"].join(g["posts"], g["likes"].subject_uri_id == g["posts"].uri_id)
    assert per_post.agg({"likes": "sum"}).first()[0] == subjects.count()
    assert per_post.count() == g["posts"].count() == g["posts"].select("uri_id").distinct().count()
    assert QUERIES["actor_aggs"](spark, DIR).count() == g["actors"].count()
    known = {r.uri_id for r in view(spark, DIR, "posts_from_records").select("uri_id").collect()}
    assert all((r.source == "record") == (r.uri_id in known) for r in g["posts"].collect())


def test_posts_of_records_with_nulls(spark):
    """A record's null gives way to what a target says; several sightings of one kind give the largest value."""
    import duckdb

    from larkspur.operators import posts
    from larkspur.queries import POSTS
    from larkspur.types import SIGHTINGS

    records = [(1, 10, "a", None, None, 5, None), (2, None, None, None, None, None, None), (3, 30, "c", None, 1, 2, 3), (4, 40, "d", None, None, None, 9), (4, 41, None, None, 7, None, 8)]
    targets = [(1, 11, "b", None, 4, 6, 7), (2, 20, "x", None, None, None, None), (5, 50, "e", None, None, None, None), (5, 51, None, None, 1, None, None)]
    names = [x.split()[0] for x in SIGHTINGS.split(", ")]
    got = posts.build_posts(spark.createDataFrame(records, SIGHTINGS), spark.createDataFrame(targets, SIGHTINGS)).select(*names, "source")
    con = duckdb.connect()
    for table, rows in (("posts_from_records", records), ("posts_from_targets", targets)):
        con.execute(f"CREATE TABLE {table} ({', '.join(f'{n} {"VARCHAR" if n == "rkey" else "TIMESTAMP" if n == "created_at" else "BIGINT"}' for n in names)})")
        con.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * 7)})", rows)
    want = con.execute(f"SELECT {', '.join(names)}, source FROM ({POSTS})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want))
    assert {r.uri_id: (r.author_did_id, r.reply_parent_uri_id, r.source) for r in got.collect()}[2] == (20, None, "record")


@pytest.mark.parametrize("heavy", [5, 100, 1 << 22])
def test_one_key_with_most_rows(spark, heavy):
    """Nine rows in ten have one key: the joins' parts and the semi-join give what plain joins do."""
    from larkspur.operators import aggregates, edges

    keyed = spark.range(1000).selectExpr("CASE WHEN id % 10 < 9 THEN 7 WHEN id % 20 = 9 THEN id ELSE null END AS target_id", "id AS src_did_id", "string(id % 50) AS rkey", "CAST(null AS TIMESTAMP_NTZ) AS created_at")
    known = spark.range(500).selectExpr("id AS target_id", "id * 3 AS uri_id", "id * 3 AS dst_did_id")
    plain = sorted(map(repr, (tuple(r) for r in keyed.join(known, "target_id", "left").select("src_did_id", "uri_id", "rkey", "created_at").collect())))
    assert sorted(map(repr, (tuple(r) for r in edges.post_edges(keyed, known.drop("dst_did_id"), heavy).collect()))) == plain
    inner = keyed.join(known, "target_id").select("src_did_id", "dst_did_id", "rkey", "created_at")
    assert sorted(map(repr, edges.actor_edges(keyed, known.drop("uri_id"), heavy).collect())) == sorted(map(repr, inner.collect()))
    parts = edges.parted_join(keyed, known, "target_id", ["src_did_id", "rkey"], "left", heavy).groupBy(F.spark_partition_id()).count()
    assert parts.agg(F.sum("count")).first()[0] == 1000
    likes = keyed.selectExpr("target_id AS subject_uri_id")
    assert aggregates.liked_posts(spark.range(10).withColumnRenamed("id", "uri_id"), likes).collect()[0].uri_id == 7


def test_other_queries_without_the_subpackage(monkeypatch):
    import builtins
    import sys

    import __spark_entry__

    kept = builtins.__import__
    for name in [m for m in sys.modules if m.startswith("larkspur.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(builtins, "__import__", lambda name, *a, **k: (_ for _ in ()).throw(ImportError(name)) if name.split(".")[0] == "zstandard" else kept(name, *a, **k))
    monkeypatch.delitem(sys.modules, "zstandard", raising=False)
    assert set(__spark_entry__.queries()) == set(QUERIES) and set(__spark_entry__.oracle_sql()) == set(ORACLES)
