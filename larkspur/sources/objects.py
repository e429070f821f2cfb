"""Listings of an object store and manifests of its backups, as DataFrames."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.uris import top_prefix

LISTING = "key STRING, size BIGINT"
_log = logging.getLogger(__name__)


def listing(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """(key, size) of the files under a folder or bucket whose key, the path below root, begins with the prefix.

    Spark lists the store, in parallel where it has many folders; no file is opened. Files that begin with "." or "_" are none of it.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    at = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString().rstrip("/")
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("size"))
    below = F.length(F.regexp_replace(F.lit(at), "^file:/+", "file:/")) + 2  # paths of the local store come with one slash or three
    return rows.select(F.substr(F.regexp_replace("path", "^file:/+", "file:/"), below).alias("key"), "size").where(F.startswith("key", F.lit(prefix)))


def manifest(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """(paths, the count that the manifest states on its third line). A path is what precedes the first white space of each later line."""
    lines = spark.read.text(path, wholetext=True).select(F.split("value", r"\r?\n").alias("lines"))
    stated = lines.select(F.trim(F.get("lines", F.lit(2))).cast("int")).first()
    if stated is None or stated[0] is None:
        raise ValueError(f"{path}: too short for a manifest")
    rest = lines.select(F.explode(F.slice("lines", 4, 2**30)).alias("line")).where(F.trim("line") != "")
    return rest.select(F.get(F.split(F.trim("line"), r"\s+"), F.lit(0)).alias("key")), stated[0]


def by_prefix(objects: DataFrame) -> DataFrame:
    """prefix, bytes, objects: sums by what precedes the first slash, largest first."""
    return objects.groupBy(top_prefix(F.col("key")).alias("prefix")).agg(F.sum("size").cast("bigint").alias("bytes"), F.count(F.lit(1)).alias("objects")).orderBy(F.desc("bytes"), "prefix")


def found(objects: DataFrame, wanted: DataFrame) -> DataFrame:
    """Listed objects that a manifest names."""
    return objects.join(wanted.select("key").distinct(), "key", "left_semi")


def missing(objects: DataFrame, wanted: DataFrame) -> DataFrame:
    """Keys that a manifest names and the listing lacks, each once, in order of code points."""
    return wanted.select("key").distinct().join(objects, "key", "left_anti").orderBy("key")


def check(objects: DataFrame, wanted: DataFrame, stated: int | None = None, first: int = 5) -> dict[str, object]:
    """What a manifest's objects come to: how many it names and the store has, their bytes, and the first few that are missing.

    A count that the manifest states and that its lines don't bear out is warned of.
    """
    named = wanted.select("key").distinct().count()
    lines = wanted.count()
    if stated is not None and stated != lines:
        _log.warning("the manifest says %d files and names %d", stated, lines)
    n, size = found(objects, wanted).agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    lost = [r.key for r in missing(objects, wanted).limit(first).collect()]
    return {"named": named, "found": n, "bytes": size, "missing": named - n, "first_missing": lost}
