"""AT-URIs taken apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_uri(uri: Column, scheme: str = "at://") -> Column:
    """struct(did, collection, rkey), or null: the scheme, case and all, then three parts at the first two slashes; parts may be empty."""
    parts = F.split(F.substr(uri, F.lit(len(scheme) + 1)), "/", 3)
    return F.when(F.startswith(uri, F.lit(scheme)) & (F.size(parts) == 3), F.struct(parts[0].alias("did"), parts[1].alias("collection"), F.get(parts, F.lit(2)).alias("rkey")))


def top_prefix(path: Column) -> Column:
    """What is before the first slash; the whole path without one."""
    return F.substring_index(path, "/", 1)
