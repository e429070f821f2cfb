"""Index entries that arrive as Parquet files, routed as a stream. Stateless: joins and aggregates stay with the batch build."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larkspur.operators import records
from larkspur.sources import kv as index


def arriving(spark: SparkSession, path: str, files_per_batch: int = 64) -> DataFrame:
    return spark.readStream.schema(index.KV).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def routed(kv: DataFrame) -> DataFrame:
    """Records of the five collections, decoded, with their branch."""
    return records.routed(index.entries(kv, "link_targets"))


def start(kv: DataFrame, path: str, checkpoint: str):
    """Append routed records to a folder per branch, once each, until what has arrived is through."""
    return routed(kv).writeStream.format("parquet").partitionBy("branch").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
