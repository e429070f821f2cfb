"""Tables of vectors, dealt into blocks that stay where they are while packets of queries pass through them."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import free_name, lean, materialise, small

#: One block's answer to a packet: places in the packet, ids and scores, of at least each query's k best or all there are.
Answer = tuple[np.ndarray, np.ndarray, np.ndarray]
#: About how many packets weigh as much as a block.
_PACKETS_TO_BLOCK = 32
FOUND = {"query_id": "long", "mark": "long", "vec_id": "long"}


def usable(df: DataFrame, key: str, vector: str, zero: bool) -> DataFrame:
    """(id, v as doubles, dim) of rows whose key and components are all there and finite; zero: zero vectors too."""
    v = df[vector].cast("array<double>")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    out = df.select(df[key].cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.coalesce(ok, F.lit(False)))
    if not zero:
        out = out.where(F.exists("v", lambda x: x != 0))
    return out.withColumn("dim", F.size("v"))


def dealt(rows: DataFrame, size: int) -> DataFrame:
    """The rows with (dim, block), dealt by position so that no repeated key fills a block. The rows' order must be the same when a task is run again, as a scan's is."""
    dims = materialise(rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / size).cast("long").alias("blocks")))
    numbered = rows.withColumn("i", F.monotonically_increasing_id()).join(small(dims, dims.count()), "dim")
    return numbered.withColumn("block", F.pmod(F.col("i") + F.shiftright("i", 33), "blocks")).drop("i", "blocks")


def _packets(queries: DataFrame, size: int) -> DataFrame:
    """(dim, packet, asked, marks, vectors): about `size` different queries to a row, dealt by a hash, so that a lost task makes the same again."""
    queries = queries.dropDuplicates(["id", "v"]).withColumn("mark", F.xxhash64("v"))
    dims = materialise(queries.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / size).cast("long").alias("packets")))
    rows = queries.join(small(dims, dims.count()), "dim").withColumn("packet", F.pmod(F.xxhash64(F.lit(41), "id", "mark"), "packets"))

    def packed(t: pa.Table) -> pa.Table:
        dim = t["dim"][0].as_py()
        bytes_ = [t["id"].to_numpy().tobytes(), t["mark"].to_numpy().tobytes(), matrix(t["v"], dim).tobytes()]
        return pa.table([pa.array([dim], pa.int32()), pa.array([t["packet"][0].as_py()], pa.int64()), *[pa.array([x], pa.binary()) for x in bytes_]], names=["dim", "packet", "asked", "marks", "vectors"])

    return materialise(rows.select("id", "v", "dim", "mark", "packet").groupBy("dim", "packet").applyInArrow(packed, "dim int, packet long, asked binary, marks binary, vectors binary"))


def met(index: DataFrame, queries: DataFrame, k: int, packet: int, held: int, load: Callable[[dict[str, Any]], Any], ask: Callable[[Any, np.ndarray, np.ndarray], Answer], score: str, tasks: int | None = None) -> DataFrame:
    """(query_id, mark, vec_id, score): each query's k best of every lot of blocks of its dimension; mark tells apart queries of one id.

    A stated set of queries against all rows, in blocks. A lot is up to `held` blocks that one task loads together; packets of
    queries then stream past them, so that a task holds its lot and one batch of packets whatever the number of queries. With I
    bytes of blocks and Q of queries, `copies` of each lot share the queries: I * copies + Q * lots bytes move, least where
    copies is about sqrt(Q * tasks / I). tasks: how many to make at least, three for each core if not given. index has dim, block.
    """
    spark = index.sparkSession
    packets = _packets(queries, packet)
    least = tasks or 3 * spark.sparkContext.defaultParallelism
    dims = index.groupBy("dim").agg((F.max("block") + 1).alias("blocks")).join(packets.groupBy("dim").agg(F.count(F.lit(1)).alias("packets")), "dim")
    fewest = F.ceil(F.col("blocks") / held)
    want = F.greatest(F.lit(least), fewest)
    shared = F.greatest(F.lit(1), F.round(F.sqrt(F.col("packets") * want / (F.col("blocks") * _PACKETS_TO_BLOCK))))
    plan = dims.withColumn("lots", F.least(F.col("blocks"), F.greatest(F.ceil(want / shared), fewest)).cast("long"))
    plan = plan.withColumn("copies", F.greatest(F.lit(1), F.least(F.col("packets"), F.floor(want / F.col("lots")))).cast("long"))
    plan = materialise(plan.select("dim", "lots", "copies"))
    n_dims, n_tasks = plan.agg(F.count(F.lit(1)), F.coalesce(F.max(F.col("lots") * F.col("copies")), F.lit(1))).first()
    plan = small(plan, n_dims)

    row = free_name(index, "row")
    block = F.struct(*[c for c in index.columns if c != "dim"])
    none = lambda *names: [F.lit(None).cast("binary").alias(c) for c in names]
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    left = index.join(plan, "dim").select("dim", F.pmod("block", "lots").alias("lot"), upto("copies").alias("copy"), "copies", F.lit(0).alias("turn"), F.col("block").alias("n"), block.alias(row), *none("asked", "marks", "vectors"))
    right = packets.join(plan, "dim").select("dim", upto("lots").alias("lot"), F.pmod("packet", "copies").alias("copy"), "copies", F.lit(1).alias("turn"), F.col("packet").alias("n"), F.lit(None).cast(left.schema[row].dataType).alias(row), "asked", "marks", "vectors")
    both = left.unionByName(right).repartitionById(n_tasks, F.pmod(F.col("lot") * F.col("copies") + F.col("copy") + F.col("dim"), F.lit(n_tasks)).cast("int"))
    both = both.sortWithinPartitions("dim", "lot", "copy", "turn", "n").drop("copies")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, loaded = None, []
        for batch in batches:
            names = batch.schema.names
            for i in range(batch.num_rows):
                x = {c: batch.column(names.index(c))[i] for c in names}
                dim, here = x["dim"].as_py(), tuple(x[c].as_py() for c in ("dim", "lot", "copy"))
                if here != at:
                    at, loaded = here, []
                if not x["turn"].as_py():
                    loaded.append(load(x[row].as_py() | {"dim": dim}))
                    continue
                asked, marks = (np.frombuffer(x[c].as_py(), np.int64) for c in ("asked", "marks"))
                q = np.frombuffer(x["vectors"].as_py(), np.float64).reshape(len(asked), dim)
                answers = [ask(block, asked, q) for block in loaded]
                if not answers:
                    continue
                place, ids, scores = (np.concatenate(c) for c in zip(*answers, strict=True))
                order = np.lexsort((ids, -scores if scores.dtype.kind == "f" else ~scores, place))
                place, ids, scores = place[order], ids[order], scores[order]
                first = np.searchsorted(place, place)
                kept = np.arange(len(place)) - first < k
                place = place[kept]
                yield pa.RecordBatch.from_arrays([pa.array(asked[place]), pa.array(marks[place]), pa.array(ids[kept]), pa.array(scores[kept])], [*FOUND, "score"])

    return lean(both).mapInArrow(run, ", ".join(f"{n} {t}" for n, t in (FOUND | {"score": score}).items()))


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if column.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query's rows, by score, ties to the smaller id: query_id, rank, vec_id, score. Queries of one id with other vectors are ranked apart."""
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
