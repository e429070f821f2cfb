"""The key-value index as a dataset (cf STRING, key BINARY, value BINARY), partitioned by column family, and its decoding.

Each family is decoded in one pass over Arrow batches, column by column. Rows that are no entry of the family are kept as a null `entry`, so
that callers can count what they skip; `entries` drops them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larkspur.sources import bincode

FAMILIES = ("did_ids", "target_ids", "target_links", "link_targets")
KV = "cf STRING, key BINARY, value BINARY"

DECODED = {
    "did_ids": "did STRING, did_id BIGINT, active BOOLEAN",
    "target_ids": "target_id BIGINT, target STRING, collection STRING, rpath STRING",
    "link_targets": "did_id BIGINT, collection STRING, rkey STRING, links ARRAY<STRUCT<rpath: STRING, target_id: BIGINT>>",
    "target_links": "target_id BIGINT, linkers ARRAY<STRUCT<did_id: BIGINT, rkey: STRING>>",
}


def read(spark: SparkSession, path: str) -> DataFrame:
    """The index under a folder that write() made, or any Parquet of the three columns."""
    return spark.read.schema(KV).parquet(path)


def write(rows: DataFrame, path: str) -> None:
    """Keep an index, one folder per family, so that a pass reads its own family only."""
    rows.select("cf", "key", "value").write.mode("overwrite").partitionBy("cf").option("compression", "zstd").parquet(path)


def decoded(kv: DataFrame, cf: str, keep: str | None = None) -> DataFrame:
    """(entry STRUCT or null[, key]) of each row of the direction that is read: forward DIDs (keys of other than 8 bytes), reverse targets (keys of 8 bytes)."""
    rows = kv.where(F.col("cf") == cf)
    if cf == "did_ids":
        rows = rows.where(F.octet_length("key") != 8)
    elif cf == "target_ids":
        rows = rows.where(F.octet_length("key") == 8)
    schema = StructType().add("entry", StructType.fromDDL(DECODED[cf]))
    if keep:
        schema = schema.add(keep, "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = bincode.entries(cf, batch.column(0), batch.column(1))
            yield pa.RecordBatch.from_arrays([found, *[batch.column(0)] * bool(keep)], schema.fieldNames())

    return rows.select("key", "value").mapInArrow(run, schema)


def entries(kv: DataFrame, cf: str, watch: Observation | None = None) -> DataFrame:
    """The family's decoded columns. watch: gets `scanned` and `bad`, the rows that couldn't be decoded and are left out."""
    rows = decoded(kv, cf)
    if watch is not None:
        rows = rows.observe(watch, F.count(F.lit(1)).alias("scanned"), F.count_if(F.col("entry").isNull()).alias("bad"))
    return rows.where("entry is not null").select("entry.*")


def first_bad(kv: DataFrame, cf: str) -> bytes | None:
    """The key of some row that is no entry of the family, for a message."""
    names = kv.where(F.col("cf") == cf)
    row = decoded(names, cf, keep="key").where("entry is null").first()
    return None if row is None or row.key is None else bytes(row.key)


def statistics(spark: SparkSession, path: str) -> DataFrame:
    """Per family, all four of them: keys and bytes of files, from listings and footers; no column of a partitioned index is read.

    The bytes of files that don't lie in a family's folder are told under a null family.
    """
    names = spark.createDataFrame([(i, c) for i, c in enumerate(FAMILIES)] + [(len(FAMILIES), None)], "place INT, cf STRING")
    keys = read(spark, path).groupBy("cf").agg(F.count(F.lit(1)).alias("keys"))
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(F.endswith("path", F.lit(".parquet")))
    sizes = listed.groupBy(F.nullif(F.regexp_extract("path", "/cf=([^/]*)/[^/]*$", 1), F.lit("")).alias("folder")).agg(F.sum("length").alias("file_bytes"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    both = names.join(F.broadcast(keys.withColumnRenamed("cf", "k")), F.col("cf").eqNullSafe(F.col("k")), "left").join(F.broadcast(sizes), F.col("cf").eqNullSafe(F.col("folder")), "left")
    return both.where("cf is not null or file_bytes > 0").orderBy("place").select("cf", zero("keys"), zero("file_bytes"))


def estimate_keys(spark: SparkSession, path: str, cf: str) -> int:
    """A family's keys, of both directions, from footers; 0 where there is none."""
    return next((r["keys"] for r in statistics(spark, path).where(F.col("cf") == cf).collect()), 0)


class Index:
    """Builds an index in memory, both directions of each entry, for tests and small fixtures."""

    def __init__(self) -> None:
        self.rows: dict[tuple[str, bytes], bytes] = {}

    def put(self, cf: str, key: bytes, value: bytes) -> None:
        self.rows[cf, key] = value

    def actor(self, did: str, did_id: int, active: bool = True) -> None:
        self.put("did_ids", bincode.string(did), bincode.integer(did_id) + bytes([active]))
        self.put("did_ids", did_id.to_bytes(8, "big"), bincode.string(did))

    def target(self, target: str, collection: str, rpath: str, target_id: int) -> None:
        key = bincode.string(target) + bincode.string(collection) + bincode.string(rpath)
        self.put("target_ids", key, bincode.integer(target_id))
        self.put("target_ids", target_id.to_bytes(8, "big"), key)

    def record(self, did_id: int, collection: str, rkey: str, links: list[tuple[str, int]]) -> None:
        self.put("link_targets", bincode.integer(did_id) + bincode.string(collection) + bincode.string(rkey), bincode.pairs(links, bincode.string, bincode.integer))

    def linkers(self, target_id: int, who: list[tuple[int, str]]) -> None:
        self.put("target_links", bincode.integer(target_id), bincode.pairs(who, bincode.integer, bincode.string))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(cf, bytearray(k), bytearray(v)) for (cf, k), v in self.rows.items()], KV)
