"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import materialise


def _contract(roots: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's links as stars on their least nodes: as many rows at most, and short paths. roots: with a row for each star's own node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            root.setdefault(x, x)
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
        stars = [(x, find(x)) for x in root if roots or find(x) != x]
        yield pa.RecordBatch.from_arrays([pa.array([s[i] for s in stars], pa.int64()) for i in (0, 1)], ["node", "component"] if roots else ["a", "b"])

    return run


def components(links: DataFrame, per_task: int = 200_000) -> DataFrame:
    """links (a long, b long), kept, any number of times and either way round -> (node, component): each linked node and the least one it reaches.

    Links are first contracted in tasks of about per_task links each, which is all where one such task holds them. Else nodes
    take part in sums and minima only, never all the links of one in a task; each round is kept in the shared folder; rounds
    end when nothing changes, after a number that grows with the logarithm of the longest path.
    """
    links = links.where("a <> b").select("a", "b")
    tasks = -(-links.count() // per_task)
    if tasks <= 1:
        return materialise(links.coalesce(1).mapInArrow(_contract(True), "node long, component long"))
    stars = links.coalesce(tasks).mapInArrow(_contract(False), "a long, b long").distinct()
    stars, before = materialise(stars), None
    while True:
        now = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first()
        if now == before:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = now
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        stars = materialise(small)
