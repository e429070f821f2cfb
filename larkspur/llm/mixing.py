"""Mixing sources to target weights by pivotal dependent rounding.

All documents of a source are to be copied target / size times. The whole part of that is certain; the
fraction is a probability. Pivotal steps take two documents with open probabilities and move words
(size times probability) from one to the other, at random but fair in the mean, until one of them is at
0 or 1. Words are kept exactly, so a source misses its target by the rounding of one last document.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, VariantType

from larkspur.llm.common import free_name, materialise, sifted, small, word_count

_EDGE = 1e-9


def numbered(df: DataFrame, by: str, name: str) -> DataFrame:
    """The rows with their place in the order of a column, nulls last, from 0, kept in the shared folder. No task holds more than a range of them."""
    part = free_name(df, "part")
    order = F.col(by).asc_nulls_last()
    ranges = materialise(df.repartitionByRange(order).withColumn(part, F.spark_partition_id()))
    held = ranges.groupBy(part).agg(F.count(F.lit(1)).alias("n"))  # a row for each partition
    start = held.select(part, (F.sum("n").over(Window.orderBy(part)) - F.col("n")).alias(name))
    place = F.row_number().over(Window.partitionBy(part).orderBy(order)) - 1
    return ranges.join(F.broadcast(start), part).withColumn(name, F.col(name) + place).drop(part)


def targets(sizes: DataFrame, weights: Sequence[float] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, n) -> the same with target, one row per source, kept in the shared folder.

    Sources by code point, null last, take the weights in turn. share of all sizes is dealt by weight;
    no target is above most times its source, and what is over goes to the others by weight. The level is
    raised round by round until no more sources are full, each round a sum over all.
    """
    turn = F.array(*[F.lit(float(w)) for w in weights])
    s = materialise(numbered(sizes, "source", "place").withColumn("w", F.get(turn, F.col("place") % len(weights))).drop("place"))
    full, level, n_full = F.lit(False), 0.0, -1
    while True:
        filled, open_, n, total = s.agg(
            F.coalesce(F.sum(F.when(full, F.col("source_size"))), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("w"))), F.lit(0.0)),
            F.count_if(full), F.coalesce(F.sum("source_size"), F.lit(0)),
        ).first()
        if n == n_full or not open_:
            break
        level, n_full = (share * total - most * filled) / open_, n
        full = F.lit(level) * F.col("w") > F.lit(most) * F.col("source_size")
    level = F.lit(level if open_ else float("inf"))
    return s.select("source", "source_size", "n", F.least(F.lit(most) * F.col("source_size"), level * F.col("w")).cast("double").alias("target"))


def _open(p: float) -> bool:
    return _EDGE < p < 1 - _EDGE


def _chain(size: np.ndarray, p: np.ndarray, items: np.ndarray, draws: np.ndarray) -> int:
    """Pair the open one with the next, move words until one of them is whole, go on; what stays open, or -1."""
    at = -1
    for i in items:
        if not _open(p[i]):
            continue
        if at < 0:
            at = i
            continue
        a, b = size[at], size[i]
        gain, loss = min(a * (1 - p[at]), b * p[i]), min(a * p[at], b * (1 - p[i]))
        moved = gain if draws[i] * (gain + loss) < loss else -loss
        p[at] += moved / a
        p[i] -= moved / b
        at = at if _open(p[at]) else i if _open(p[i]) else -1
    return at


def pivotal(size: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, int]:
    """Round probabilities to 0 or 1, keeping the sum of size * p but for one last one; its index, or -1.

    Large documents are paired first. What they leave open is settled against all the smaller ones at once, each of them
    giving or taking in proportion, so that what stays open in the end is small. Every probability is kept in the mean.
    """
    p = p.astype(float).copy()
    draws = rng.random((2, len(p)))
    empty = size == 0
    p[empty] = 0
    items = np.argsort(-size, kind="stable")
    items = items[(p[items] > _EDGE) & (p[items] < 1 - _EDGE)]
    while True:
        cut = len(items) - len(items) // 4 if len(items) > 4 else len(items)
        tail = items[cut:]
        at = _chain(size, p, items[:cut], draws[0])
        tail = tail[(p[tail] > _EDGE) & (p[tail] < 1 - _EDGE)]
        if at >= 0 and len(tail):
            give, take = size[tail] @ p[tail], size[tail] @ (1 - p[tail])
            gain, loss = min(size[at] * (1 - p[at]), give), min(size[at] * p[at], take)
            if draws[1, at] * (gain + loss) < loss:
                p[at] += gain / size[at]
                p[tail] *= 1 - gain / give
            else:
                p[at] -= loss / size[at]
                p[tail] += (1 - p[tail]) * (loss / take)
        items = np.concatenate([[at], tail]) if at >= 0 and _open(p[at]) and len(tail) else tail
        if not len(tail):
            break
    if at >= 0 and not _open(p[at]):
        at = -1
    whole = np.arange(len(p)) != at
    p[whole] = np.round(p[whole])
    return p, at


def _mark(df: DataFrame) -> Column:
    """A number for a row's values: rows of one number are the same row several times."""
    plain = lambda f: F.col(f"`{f.name}`") if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, VariantType) else F.to_json(F.struct(F.col(f"`{f.name}`")))
    return F.xxhash64(*[x for f in df.schema.fields for x in (F.lit(f.name), plain(f), F.col(f"`{f.name}`").isNull())])


def copies(df: DataFrame, weights: Sequence[float] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, key: str = "doc_id", text: str = "text", source: str = "source", group: int = 1024, fan_in: int = 64, seed: int = 11) -> DataFrame:
    """(key, mark, size, source, source_size, target, copies): a row for each row of df, by the names given here; texts stay behind.

    Rows alike in all columns have one mark and are numbered, so that repeats are rounded apart, in groups of their own.
    """
    sized = df.select(_mark(df).alias("mark"), F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    alike = materialise(sized.groupBy("mark", "key", "source", "size").agg(F.count(F.lit(1)).alias("rows")))
    sizes = alike.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum("rows").alias("n"))
    plan = materialise(targets(sizes, weights, share, most).withColumnRenamed("source", "src"))
    n_sources, most_groups = plan.agg(F.count(F.lit(1)), F.coalesce(F.max(F.ceil(F.col("n") / group)), F.lit(1))).first()
    rows = alike.withColumn("turn", F.explode(F.sequence(F.lit(1).cast("long"), "rows"))).drop("rows")
    rows = rows.join(small(plan, n_sources), F.col("source").eqNullSafe(F.col("src"))).drop("src")
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), F.coalesce(F.col("key").cast("string"), F.lit("null")), "size", "mark", "turn"))
    rows = rows.withColumn("p", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)).withColumn("copies", F.floor("p").cast("long")).withColumn("p", F.col("p") - F.floor("p"))
    rows = rows.withColumn("b", F.pmod("h", F.ceil(F.col("n") / group).cast("long"))).drop("turn", "n")

    def level(frame: DataFrame, last: bool, depth: int) -> DataFrame:
        def rounded(x: pa.Table) -> pa.Table:
            hash_, words = x["h"].to_numpy(), x["size"].to_numpy()
            x = x.take(order := np.lexsort((words, hash_)))
            rng = np.random.default_rng([seed, depth, int(hash_[order[0]]) & (2**63 - 1), len(order)])
            got, at = pivotal(words[order].astype(float), x["p"].to_numpy(), rng)
            if at >= 0 and last:
                got[at], at = float(got[at] >= 0.5), -1
            done = np.arange(len(order)) != at
            for name, values in (("copies", x["copies"].to_numpy() + np.where(done, got, 0).astype("int64")), ("p", np.where(done, -1.0, got))):
                x = x.set_column(x.column_names.index(name), name, pa.array(values))
            return x

        return frame.groupBy("source", "b").applyInArrow(rounded, frame.schema)

    depth, out, groups = 0, [], int(most_groups)
    while True:
        last = groups == 1
        done = level(rows, last, depth)
        if last:
            out.append(done)
            break
        done = materialise(done)
        out.append(done.where("p < 0"))
        rows = done.where("p >= 0").withColumn("b", F.floor(F.col("b") / fan_in).cast("long"))
        groups, depth = -(-groups // fan_in), depth + 1
    whole = out[0]
    for x in out[1:]:
        whole = whole.unionByName(x)
    return whole.drop("h", "b", "p")


def mix(df: DataFrame, weights: Sequence[float] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, key: str = "doc_id", text: str = "text", source: str = "source", group: int = 1024, fan_in: int = 64, seed: int = 11, prefix: str = "mix") -> DataFrame:
    """All rows and columns, and <prefix>_size, <prefix>_source_size, <prefix>_target, <prefix>_copies.

    Size is the number of words; null texts and empty ones have none and get 0 copies. Null sources are
    one source. Repeated rows are rounded apart. An empty table gives no rows. The outcome depends on
    the rows' values and seed alone, so reruns agree. Clashing column names are the caller's to avoid by prefix.

    The tree: each source is dealt by a hash of the row into groups of about `group` documents, each
    rounded in one task; its one open document goes on to the next level, `fan_in` groups to one, until
    a source has one left, which goes to the nearer whole number. Only narrow rows go through it; texts meet the outcome in
    one join by the row's mark, in which a row that is there several times takes part once.
    """
    mark, maybe, m, first, turn, n, low, all_ = (free_name(df, x) for x in ("mark", "maybe", "m", "first", "turn", "n", "low", "all"))
    found = copies(df, weights, share, most, key, text, source, group, fan_in, seed)
    found = found.groupBy(F.col("mark").alias(m)).agg(F.count(F.lit(1)).alias(n), F.min("copies").alias(low), F.sum("copies").alias(all_), *[F.max(c).alias(f"{prefix}_{c}") for c in ("size", "source_size", "target")])
    found = materialise(found)
    marked = sifted(df.withColumn(mark, _mark(df)), F.col(mark), found.where(F.col(n) > 1).select(m), maybe)
    once = marked.where(~F.col(maybe)).join(found.where(F.col(n) == 1), F.col(mark) == F.col(m)).withColumn(f"{prefix}_copies", F.col(all_))
    one = marked.where(maybe).groupBy(mark).agg(*[F.first(F.col(f"`{c}`")).alias(c) for c in df.columns])
    many = one.join(found, F.col(mark) == F.col(m)).withColumn(first, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(1024).cast("long"))))
    many = many.withColumn(turn, F.explode(F.sequence(F.col(first), F.least(F.col(first) + 1023, F.col(n) - 1))))
    more = F.col(turn) < F.col(all_) - F.col(n) * F.col(low)
    many = many.withColumn(f"{prefix}_copies", F.col(low) + more.cast("long"))
    columns = [*[f"`{c}`" for c in df.columns], *(f"{prefix}_{x}" for x in ("size", "source_size", "target", "copies"))]
    return once.select(columns).unionByName(many.select(columns))
