"""What the operators of this subpackage share: materialising, table access, words and bounded broadcasts."""

from __future__ import annotations

import contextlib
import math
import re
import tempfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
#: Only A-Z change; other letters keep their case whatever the locale.
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
#: Most rows a table may have to be broadcast without looking at its bytes; its rows must be narrow.
BROADCAST_ROWS = 100_000


def words(text: str | None) -> list[str]:
    """Lower-cased (A-Z only) words of a text; none of a null."""
    return WORD_RE.findall(text.translate(ASCII_LOWER)) if text else []


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share; one of our own only in a local session that has none, as in tests."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="larkspur-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


#: Folders of checkpoints made since the innermost open scratch() began.
_made: list[list[str]] = []


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder, which outlives lost executors."""
    shared_folder(df.sparkSession)
    out = df.checkpoint(eager=True)
    if _made:
        _made[-1].append(out._jdf.queryExecution().logical().rdd().getCheckpointFile().get())
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any store that Spark reaches."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is materialised inside is removed at the end, for steps that have written their result elsewhere by then.

    Other checkpoints live as long as the frames that read them: spark.cleaner.referenceTracking.cleanCheckpoints removes those.
    """
    _made.append([])
    try:
        yield
    finally:
        for path in _made.pop():
            remove(spark, path)


def spread(df: DataFrame) -> DataFrame:
    """A scan's rows over all cores where its files or row groups are fewer; else the scan as it is, and nothing moves."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def lean(df: DataFrame) -> DataFrame:
    """The frame; its session hands at most 8 MB of rows to Python at once from now on, unless it says otherwise than Spark does.

    The setting stays, since the frame runs later. Long texts make Spark's 64 MB batches the largest thing in a worker's and in an executor's memory.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name) in ("67108864b", "67108864", "64m", "64MB"):
        conf.set(name, "8m")
    return df


def small(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint if the table, of known row count, is within BROADCAST_ROWS; else the planner's choice."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that the frame lacks, whatever the case; callers' extra columns never clash with ours."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def held_out(key: Column) -> Column:
    """One row in five, by the CRC-32 of the key as text; rows without a key too (crc of "" is 0). Labels are never learned from them."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def share_of(key: Column, part: float, seed: int) -> Column:
    """True for about that part of keys, the same ones in every run."""
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) < F.lit(int(min(part, 1.0) * (1 << 30)))


def thinned(rows: DataFrame, key: str, text: str, text_bytes: int, seed: int) -> DataFrame:
    """The rows, or about the share of them, by a hash of the key, whose texts come to text_bytes."""
    held = rows.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    return rows if held <= text_bytes else rows.where(share_of(F.col(key), text_bytes / held, seed))


def with_field(df: DataFrame, name: str, kind: DataType) -> StructType:
    return StructType([*df.schema.fields, StructField(name, kind)])


def sifted(df: DataFrame, value: Column, keys: DataFrame, name: str, seed: int = 23) -> DataFrame:
    """The rows with a boolean column more: true wherever the BIGINT value is among the keys (one BIGINT column), and seldom elsewhere.

    The keys become a bitmap of 16 bits each, 2**26 bits at most whatever their number, which is broadcast in words of 64: 2**20
    narrow rows at most. No row is moved; what passes wrongly has to be told apart by a join, which then moves few rows. Beyond
    some 2**25 keys the bitmap fills up and more rows pass: the join moves more, up to all rows, and stays right.
    """
    word, bit, held = (free_name(df, x) for x in ("word", "bit", "held"))
    hashed = keys.select(F.xxhash64(F.lit(seed), keys[keys.columns[0]]).alias("h"))
    bits = 1 << int(min(max(16, math.ceil(math.log2(max(hashed.count(), 1) * 16))), 26))
    place = lambda h: F.shiftright(h.bitwiseAND(F.lit(bits - 1)), 6)
    within = lambda h: h.bitwiseAND(F.lit(63)).cast("int")
    words_ = hashed.groupBy(place(F.col("h")).alias(word)).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), within(F.col("h")))).alias(held))
    h = F.xxhash64(F.lit(seed), value)
    found = df.withColumn(word, place(h)).withColumn(bit, within(h)).join(F.broadcast(materialise(words_)), word, "left")
    is_set = F.call_function("shiftright", F.col(held), F.col(bit)).bitwiseAND(F.lit(1)) == 1
    return found.withColumn(name, F.coalesce(is_set, F.lit(False))).select(*[df[c] for c in df.columns], name)
