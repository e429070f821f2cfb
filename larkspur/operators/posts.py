"""The posts table: all sightings of a post in one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECORD, TARGET_ONLY = "record", "target_only"
_VALUES = ("author_did_id", "rkey", "created_at", "reply_root_uri_id", "reply_parent_uri_id", "quote_uri_id")


def sightings(from_records: DataFrame, from_targets: DataFrame) -> DataFrame:
    """Both inputs under each other, with their source."""
    columns = ["uri_id", *_VALUES]
    return from_records.select(*columns, F.lit(RECORD).alias("source")).unionByName(from_targets.select(*columns, F.lit(TARGET_ONLY).alias("source")))


def _best(column: str) -> Column:
    """The record's value if there is one that is not null, or else another sighting's."""
    record = F.max(F.when(F.col("source") == RECORD, F.col(column)))
    return F.coalesce(record, F.max(column)).alias(column)


def build_posts(from_records: DataFrame, from_targets: DataFrame) -> DataFrame:
    """One row per uri_id. Values come from the record, sighting by sighting where it has a null; `source` says whether there is a record.

    Where several sightings of one source differ, the largest value is taken, so that reruns agree.
    """
    return sightings(from_records, from_targets).groupBy("uri_id").agg(*[_best(c) for c in _VALUES], F.min("source").alias("source"))
