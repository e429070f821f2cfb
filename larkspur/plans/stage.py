"""Stage: the index's entries to the seven entity tables. Nothing is computed before a table is written or counted."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators import edges, records
from larkspur.sources import kv as index
from larkspur.types import BLOCK, FOLLOW, LIKE, REPOST, SUBJECT, SUBJECT_URI

BRANCH_PATHS = {"follows": (FOLLOW, SUBJECT), "blocks": (BLOCK, SUBJECT), "likes": (LIKE, SUBJECT_URI), "reposts": (REPOST, SUBJECT_URI)}


#: The families that tables are made from.
READ = ("did_ids", "link_targets", "target_ids")


@dataclass
class Staged:
    tables: dict[str, DataFrame]
    parts: dict[str, DataFrame]  # what the tables are joined from


def stage(kv: DataFrame) -> Staged:
    """Lazy tables from an index, which is decoded for each of them; a build keeps the decoded families and joins those."""
    return join(*(index.entries(kv, cf) for cf in READ))


def join(actors: DataFrame, links: DataFrame, targets: DataFrame) -> Staged:
    """Lazy tables from the decoded families."""
    parts = {f"lt_{name[:-1]}": records.keyed(links, *path) for name, path in BRANCH_PATHS.items()}
    posts = records.post_records(links, actors)
    parts |= {"lt_post_records": posts.drop("links"), "lt_post_refs": records.post_refs(posts), "t_post_refs": records.target_posts(targets), "t_did_refs": records.target_actors(targets, actors), "posts_from_targets_raw": records.sighted_posts(targets, actors)}
    pivoted = edges.pivoted_refs(edges.resolved_refs(parts["lt_post_refs"], parts["t_post_refs"]))
    tables = {
        "actors": actors.select("did_id", "did", "active"),
        "follows": edges.actor_edges(parts["lt_follow"], parts["t_did_refs"]),
        "blocks": edges.actor_edges(parts["lt_block"], parts["t_did_refs"]),
        "likes": edges.post_edges(parts["lt_like"], parts["t_post_refs"]),
        "reposts": edges.post_edges(parts["lt_repost"], parts["t_post_refs"]),
        "posts_from_records": edges.posts_from_records(parts["lt_post_records"], pivoted),
        "posts_from_targets": edges.distinct_posts(parts["posts_from_targets_raw"]),
    }
    return Staged(tables, parts)


def lost(actors: DataFrame, links: DataFrame, targets: DataFrame) -> DataFrame:
    """(name, n) of what the decoded families name and lack, and of rows that nothing is made from."""
    parsed = targets.select(records.parse_uri(F.col("target")).alias("u")).where(F.col("u.collection") == records.POST)
    return _counts({
        "missing_author": links.where(F.col("collection") == records.POST).join(actors, "did_id", "left_anti"),
        "missing_did": targets.where(records.names_actor()).join(actors.select(F.col("did").alias("target")), "target", "left_anti"),
        "missing_post_author": parsed.select(F.col("u.did").alias("did")).join(actors, "did", "left_anti"),
        "unused": targets.where(~(records.names_post() | records.names_actor())),
    })


def _counts(frames: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, df in frames.items()])


def report(kv: DataFrame) -> DataFrame:
    """(name, n): entries scanned and bad of each family, records by branch, and what targets and records fail to name. Decodes the index anew."""
    bad = [index.decoded(kv, cf).agg(F.count(F.lit(1)).alias("scanned"), F.count_if(F.col("entry").isNull()).alias("bad")).select(F.explode(F.create_map(F.lit(f"{cf}_scanned"), "scanned", F.lit(f"{cf}_bad"), "bad")).alias("name", "n")) for cf in ("did_ids", "link_targets", "target_ids")]
    families = [index.entries(kv, cf) for cf in READ]
    return reduce(DataFrame.unionByName, [*bad, _counts(join(*families).parts), lost(*families)])
