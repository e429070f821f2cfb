"""Builds in a work folder on any store: mirror the index, stage it, hydrate the snapshot, describe it, upload it."""

from __future__ import annotations

import concurrent.futures
import datetime
import json
import logging
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larkspur.operators.aggregates import orphan_rate
from larkspur.plans import hydrate as model
from larkspur.plans import stage as staging
from larkspur.plans.config import Config
from larkspur.sources import kv as index
from larkspur.sources.files import Files
from larkspur.types import TABLES, normalised

VERSION = "0.1"
SCHEMA_VERSION = 1
FINAL = {"compression": "zstd", "parquet.compression.codec.zstd.level": "3", "parquet.block.row.count.limit": "1000000"}
SCRATCH = {"compression": "lz4_raw", "parquet.block.row.count.limit": "1000000"}
_log = logging.getLogger(__name__)


def write(df: DataFrame, path: str, options: dict[str, str] | None = None, mode: str = "overwrite") -> None:
    """Parquet that appears as a whole: Spark's commit renames what tasks wrote."""
    df.write.mode(mode).options(**(FINAL if options is None else options)).parquet(path)


def views(spark: SparkSession, raw: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """A temporary view on each table's Parquet; projections and filters reach the files. Unsigned columns become BIGINT."""
    out = {}
    for name in names or list(TABLES):
        out[name] = normalised(spark.read.parquet(f"{raw}/{name}.parquet"))
        out[name].createOrReplaceTempView(name)
    return out


def backup_of(files: Files, cfg: Config) -> tuple[str, int | None]:
    """The index to copy and its number: the source itself, or of a folder of numbered ones the one asked for, else the latest."""
    numbered = {int(name): name for name in files.folders(cfg.source) if name.isdecimal()}
    if not numbered:
        return cfg.source, cfg.backup_id
    n = max(numbered) if cfg.backup_id is None else cfg.backup_id
    if n not in numbered:
        raise FileNotFoundError(f"no backup {n} at {cfg.source}; there are {sorted(numbered)}")
    return f"{cfg.source}/{numbered[n]}", n


def mirror(spark: SparkSession, cfg: Config) -> dict[str, Any]:
    """Copy the chosen index to the work folder, unless a finished copy of it is there. The mark of one is `.cursor`, written last.

    The executors copy, a family to a folder; the copy is then held against the source, by family: keys, and a checksum over all bytes.
    """
    files, mark = Files(spark), f"{cfg.mirror_dir}/.cursor"
    if files.exists(mark):
        return {"bytes": files.bytes(cfg.mirror_dir), "skipped": True}
    source, number = backup_of(files, cfg)
    if not any(path.endswith(".parquet") for path, _ in files.files(source)):
        raise FileNotFoundError(f"no index at {source}")
    index.write(index.read(spark, source), cfg.mirror_dir)
    sums = lambda path: {tuple(r) for r in index.read(spark, path).groupBy("cf").agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("key", "value"))).collect()}
    if sums(source) != sums(cfg.mirror_dir):
        raise ValueError(f"the copy of {source} differs from it")
    files.write(mark, json.dumps({"source": source, "backup_id": number}))
    update_metadata(spark, cfg, backup_id=number)
    return {"bytes": files.bytes(cfg.mirror_dir), "skipped": False}


def decoded(spark: SparkSession, cfg: Config, kv: DataFrame) -> tuple[list[DataFrame], dict[str, int]]:
    """The decoded families, written to the scratch folder so that no lost executor decodes them again, and how many entries were scanned and bad."""
    out, counters = [], {}
    for cf in staging.READ:
        watch = Observation(cf)
        write(index.entries(kv, cf, watch), path := f"{cfg.scratch_dir}/{cf}.parquet", SCRATCH)
        counters |= {f"{cf}_{k}": v for k, v in watch.get.items()}
        if watch.get["bad"]:
            _log.warning("%s: %d of %d entries are malformed and left out, such as %r", cf, watch.get["bad"], watch.get["scanned"], index.first_bad(kv, cf))
        out.append(spark.read.parquet(path))
    return out, counters


def stage(spark: SparkSession, cfg: Config, source: str | None = None) -> dict[str, int]:
    """Write the seven entity tables; their row counts, read back from the files. What was scanned, bad and missing goes to the metadata."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(min(cfg.batch_size, 10_000)))
    families, counters = decoded(spark, cfg, index.read(spark, source or cfg.mirror_dir))
    for name, df in staging.join(*families).tables.items():
        write(df, f"{cfg.raw_dir}/{name}.parquet")
    counters |= {r.name: r.n for r in staging.lost(*families).collect()}
    Files(spark).remove(cfg.scratch_dir)
    out = {name: spark.read.parquet(f"{cfg.raw_dir}/{name}.parquet").count() for name in TABLES}
    update_metadata(spark, cfg, stage_counts=list(out.items()), stage_counters=counters)
    return out


def write_chunks(spark: SparkSession, df: DataFrame, key: str, path: str, n: int, dry_run: bool = False) -> list[int]:
    """Write a table bucket by bucket, the first over what is there, the others behind it; rows after each."""
    totals = []
    for k in range(1 if dry_run else n):
        write(model.aggregates.bucket(df, key, n, k), path, mode="overwrite" if k == 0 else "append")
        totals.append(spark.read.parquet(path).count())
    return totals


def hydrate(spark: SparkSession, cfg: Config) -> dict[str, Any]:
    """Write posts and the aggregate tables over the entity tables, then the counts, orphan rates and description."""
    tables = views(spark, cfg.raw_dir)
    for name, build in model.STAGES:
        path = f"{cfg.snapshot_dir}/{name}.parquet"
        df = build(tables)
        if name in model.BUCKET_KEYS and (cfg.chunks or 1) > 1:
            write_chunks(spark, df, model.BUCKET_KEYS[name], path, cfg.chunks or 1, cfg.chunk_dry_run)
        else:
            write(df, path)
        tables[name] = spark.read.parquet(path)
        tables[name].createOrReplaceTempView(name)
    counts = {r.name: r.n for r in model.counts(tables).orderBy("place").collect()}
    rates = {t: orphan_rate(tables[t], tables["posts"]).first()[0] or 0.0 for t in ("likes", "reposts")}
    now = datetime.datetime.now(datetime.UTC).replace(tzinfo=None).isoformat(sep=" ", timespec="seconds")
    write(model.metadata(spark, cfg.snapshot_date, cfg.source, cfg.backup_id, now, VERSION, cfg.memory()), f"{cfg.snapshot_dir}/snapshot_metadata.parquet")
    update_metadata(spark, cfg, hydrate_counts=list(counts.items()), orphan_like_rate=rates["likes"], orphan_repost_rate=rates["reposts"])
    return {"counts": counts, "orphan_rates": rates}


def update_metadata(spark: SparkSession, cfg: Config, **found: Any) -> str:
    """Put what was found into the date's JSON, on top of what is there; an earlier backup id stays if none is set now."""
    path, files = f"{cfg.snapshot_dir}/snapshot_metadata.json", Files(spark)
    seed = {"backup_id": None, "mirror_bytes": 0, "stage_counts": [], "stage_counters": {}, "hydrate_counts": [], "orphan_like_rate": None, "orphan_repost_rate": None, "upload": None}
    old = json.loads(files.read(path) or "{}")
    new = seed | old | {k: v for k, v in found.items() if k != "backup_id" or v is not None}
    new |= {"date": cfg.snapshot_date, "url": cfg.source, "schema_version": SCHEMA_VERSION, "generated_at": datetime.datetime.now(datetime.UTC).isoformat()}
    if cfg.backup_id is not None:
        new["backup_id"] = cfg.backup_id
    files.write(path, json.dumps(new, indent=2))
    return path


def upload(spark: SparkSession, cfg: Config) -> dict[str, int]:
    """Copy the date's folders to the store through Hadoop's file systems, which send large files in parts; files and bytes."""
    if cfg.upload is None:
        raise ValueError("no upload section")
    for k, v in cfg.upload.options().items():
        spark._jsc.hadoopConfiguration().set(k, v)
    files, out = Files(spark), {"files": 0, "bytes": 0}
    todo: list[tuple[str, str, int]] = []
    for name, folder in (("raw", cfg.raw_dir), ("snapshot", cfg.snapshot_dir)):
        if name not in cfg.upload.include:
            continue
        if not files.exists(folder):
            _log.warning("nothing to upload at %s", folder)
            continue
        prefix = "/".join(x for x in (cfg.upload.root().rstrip("/"), cfg.upload.prefix.strip("/"), name, cfg.snapshot_date) if x)
        todo += [(f"{folder}/{path}", f"{prefix}/{path}", size) for path, size in files.files(folder)]

    def put(item: tuple[str, str, int]) -> int:
        files.copy(item[0], item[1])
        return item[2]

    with concurrent.futures.ThreadPoolExecutor(cfg.upload.concurrency) as pool:
        for n in pool.map(put, todo):
            out = {"files": out["files"] + 1, "bytes": out["bytes"] + n}
    update_metadata(spark, cfg, upload=out)
    return out


def inspect(spark: SparkSession, path: str) -> dict[str, dict[str, int]]:
    """Keys and bytes of files of each family, and `total`, from footers and listings."""
    out = {r.cf or "other": {"keys": r["keys"], "file_bytes": r.file_bytes} for r in index.statistics(spark, path).collect()}
    return out | {"total": {k: sum(x[k] for x in out.values()) for k in ("keys", "file_bytes")}}


def build(spark: SparkSession, cfg: Config, log: Callable[[str], None] = print) -> None:
    done = mirror(spark, cfg)
    update_metadata(spark, cfg, mirror_bytes=done["bytes"])
    log(f"mirror: {done['bytes']} bytes")
    log(f"stage: {stage(spark, cfg)}")
    log(f"hydrate: {hydrate(spark, cfg)}")
