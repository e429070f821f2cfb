"""Near-duplicate documents: MinHash bands for candidates, sequential Bayesian verification, exact confirmation.

1. Each text becomes its set of word shingles; texts with equal sets are one class from here on.
2. Classes meet in the buckets of their signature's bands. Each is compared with its buckets' least members.
3. A comparison looks at one batch of the signature after another. With a uniform prior on the similarity it ends as soon
   as the posterior chance of the threshold being reached is below the chosen miss probability.
4. Survivors join classes into clusters, distributed. Buckets that still hold several clusters are gone through member by
   member, so that every pair that shares a bucket is either compared or in one cluster.
5. Within clusters, each holding all links that its members can have, pairs are compared again and survivors are confirmed
   on the full sets, but for those already connected. Confirmed links give the components.

No step writes down the pairs of a group. Groups above a size are cut into chunks that all meet a few pivots; only members
that these leave apart from the group's main part go on to meet every chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import free_name, lean, materialise, sifted
from larkspur.llm.components import components
from larkspur.llm.shingles import MinHash, digest, sets
from larkspur.operators.edges import parted_join

#: Narrow rows of one join key that a task may have to take.
HEAVY = 1 << 20
#: Nodes xor'ed with these have other least members, which makes pivots of them.
_MASKS = tuple(int(x) for x in np.random.default_rng(3).integers(0, 2**62, 6))


@dataclass(frozen=True)
class Settings:
    """words: of a shingle. percent: the least similarity. A pair at it shares no band with probability (1 - s**rows)**bands, 2e-5 here."""

    words: int = 5
    percent: int = 80
    bands: int = 36
    rows: int = 6
    batch: int = 36
    miss: float = 1e-5
    chunk: int = 4096
    chunk_shingles: int = 1 << 21

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def needed(settings: Settings) -> list[tuple[int, int]]:
    """(compared, least matches to go on) after each batch of signature bytes. Unlike shingles agree in a byte by chance, 1 in 256."""
    s = (np.arange(4000) + 0.5) / 4000
    p = s + (1 - s) / 256
    out = []
    for n in range(settings.batch, settings.hashes + 1, settings.batch):
        least = n + 1
        for m in range(n, -1, -1):
            logs = m * np.log(p) + (n - m) * np.log1p(-p)
            mass = np.exp(logs - logs.max())
            if mass[s >= settings.percent / 100].sum() < settings.miss * mass.sum():
                break
            least = m
        out.append((n, least))
    return out


def alike(a: np.ndarray, b: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Which rows of two signature matrices (the first may be one row) survive every batch."""
    alive = np.arange(len(b))
    same, done = np.zeros(len(b), np.int32), 0
    for n, least in steps:
        left = a[alive, done:n] if len(a) > 1 or len(b) == 1 else a[:, done:n]
        same = same + (left == b[alive, done:n]).sum(axis=1, dtype=np.int32)
        keep = same >= least
        alive, same, done = alive[keep], same[keep], n
        if not len(alive):
            break
    return alive


class Group:
    """Members of a group in one task: nodes, labels of what is known to be connected, signatures and, to confirm links, sets."""

    def __init__(self, nodes: np.ndarray, labels: np.ndarray, signatures: np.ndarray, members: list[np.ndarray] | None, settings: Settings, steps: list[tuple[int, int]]) -> None:
        self.nodes, self.labels, self.signatures, self.settings, self.steps = nodes, labels.copy(), signatures, settings, steps
        self.sizes = None
        if members is not None:
            self.sizes = np.array([len(x) for x in members])
            self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
            words, self.codes = np.unique(np.concatenate([np.zeros(0, np.uint64), *members]), return_inverse=True)
            self.mark = np.zeros(len(words), bool)
        self.links: list[tuple[int, int]] = []

    def meet(self, i: int, others: np.ndarray) -> None:
        """Link member i to those of the others that it is not connected to yet and is similar to."""
        others = others[self.labels[others] != self.labels[i]]
        if self.sizes is not None:
            small, large = np.minimum(self.sizes[others], self.sizes[i]), np.maximum(self.sizes[others], self.sizes[i])
            others = others[100 * small >= self.settings.percent * large]
        if not len(others):
            return
        others = others[alike(self.signatures[i : i + 1], self.signatures[others], self.steps)]
        if self.sizes is not None and len(others):
            own = self.codes[self.starts[i] : self.starts[i + 1]]
            self.mark[own] = True
            both = np.array([np.count_nonzero(self.mark[self.codes[self.starts[j] : self.starts[j + 1]]]) for j in others])
            self.mark[own] = False
            others = others[100 * both >= self.settings.percent * (self.sizes[others] + self.sizes[i] - both)]
        for j in others:
            if self.labels[j] != self.labels[i]:
                self.links.append((int(self.nodes[i]), int(self.nodes[j])))
                self.labels[self.labels == self.labels[j]] = self.labels[i]

    def all(self) -> None:
        """Every member meets those behind it, until all are connected."""
        rest = np.arange(len(self.nodes))
        while len(rest) > 1 and (self.labels[rest] != self.labels[rest[0]]).any():
            self.meet(int(rest[0]), rest := rest[1:])

    def across(self, left: np.ndarray, right: np.ndarray) -> None:
        for i in left:
            self.meet(int(i), right)


def _group(t: pa.Table, at: np.ndarray, settings: Settings, steps: list[tuple[int, int]]) -> Group:
    t = t.take(at)
    signatures = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint8).reshape(len(at), -1)
    members = [np.frombuffer(x, np.uint64) for x in t["members"].to_pylist()] if "members" in t.column_names else None
    return Group(t["node"].to_numpy(), t["label"].to_numpy(), signatures, members, settings, steps)


def _links(found: list[tuple[int, int]]) -> pa.Table:
    return pa.table({x: pa.array([f[i] for f in found], pa.int64()) for i, x in enumerate("ab")})


def within(rows: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) that connect what is similar within groups; rows, kept: (grp, node, label, size, sig[, members]).

    Members of one label count as connected. Groups of one chunk go through whole, several to a task. Larger ones first meet
    in chunks, with pivots; then what has another label than most of the group meets all its chunks.
    """
    steps = needed(settings)
    sized = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.greatest(F.count(F.lit(1)) / settings.chunk, F.sum("size") / settings.chunk_shingles)).cast("long").alias("chunks"), *[F.min(F.col("node").bitwiseXOR(F.lit(m))).alias(f"p{i}") for i, m in enumerate(_MASKS)])
    sized = materialise(sized)
    small, large = sized.agg(F.coalesce(F.sum(F.when(F.col("chunks") <= 1, F.col("n"))), F.lit(0)), F.coalesce(F.max("chunks"), F.lit(0))).first()
    packs = max(1, small // 512)

    def packed(t: pa.Table) -> pa.Table:
        groups, found = t["grp"].to_numpy(), []
        order = np.lexsort((t["node"].to_numpy(), groups))
        for at in np.split(order, np.flatnonzero(np.diff(groups[order])) + 1):
            g = _group(t, at, settings, steps)
            g.all()
            found += g.links
        return _links(found)

    whole = rows.join(sized.where("chunks <= 1 and n > 1").select("grp"), "grp").withColumn("pack", F.pmod(F.xxhash64("grp"), F.lit(packs)))
    out = whole.groupBy("pack").applyInArrow(packed, "a long, b long")
    if large <= 1:
        return materialise(out)

    cut = rows.join(sized.where("chunks > 1"), "grp").withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks"))
    pivot = F.lit(False)
    for i, m in enumerate(_MASKS):
        pivot = pivot | (F.col("node").bitwiseXOR(F.lit(m)) == F.col(f"p{i}"))
    cut = materialise(cut.withColumn("pivot", pivot))
    everywhere = cut.where("pivot").withColumn("own", F.col("chunk")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).where("own <> chunk").drop("own")

    def first(t: pa.Table) -> pa.Table:
        pivots = np.flatnonzero(t["pivot"].to_numpy(zero_copy_only=False))
        g = _group(t, np.arange(len(t)), settings, steps)
        g.across(pivots, np.arange(len(t)))
        g.all()
        return _links(g.links)

    out = materialise(out.unionByName(cut.unionByName(everywhere).groupBy("grp", "chunk").applyInArrow(first, "a long, b long")))
    joined = components(out.unionByName(cut.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))))
    cut = cut.drop(*[f"p{i}" for i in range(len(_MASKS))], "pivot").join(joined.withColumnRenamed("node", "nd"), F.col("node") == F.col("nd"), "left").withColumn("label", F.coalesce("component", "label")).drop("nd", "component")
    parts = cut.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("k"))
    main = parts.groupBy("grp").agg(F.max_by("label", F.struct("k", "label")).alias("main"), F.sum("k").alias("all"), F.max("k").alias("most")).where(F.col("all") > F.col("most"))
    main = main.withColumn("lots", F.ceil((F.col("all") - F.col("most")) / settings.chunk).cast("long"))
    cut = cut.join(main.drop("all", "most"), "grp")
    strays = cut.where("label <> main").withColumn("lot", F.pmod(F.xxhash64("node", "grp"), "lots")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    every = cut.withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)))

    def second(a: pa.Table, b: pa.Table) -> pa.Table:
        if not len(a) or not len(b):
            return _links([])
        g = _group(pa.concat_tables([a, b]), np.arange(len(a) + len(b)), settings, steps)
        g.across(np.arange(len(a)), np.arange(len(a), len(a) + len(b)))
        return _links(g.links)

    keys = ("grp", "chunk", "lot")
    columns = [c for c in ("grp", "chunk", "lot", "node", "label", "sig", "members") if c in cut.columns or c in keys]
    crossed = strays.select(*columns).toDF(*columns).groupBy(*keys).cogroup(every.select(*columns).toDF(*columns).groupBy(*keys)).applyInArrow(second, "a long, b long")
    return materialise(out.unionByName(materialise(crossed)))


def _signed(docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, mark, n, digest, bands, sig) of each row; the last three null without words."""
    hasher = MinHash(settings.hashes)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, bands, sigs = [], [], [], []
            for x in sets(batch.column(2), settings.words):
                n.append(len(x))
                s = hasher.signature(x)
                digests.append(digest(x) if len(x) else None)
                sigs.append(s.astype(np.uint8).tobytes() if len(x) else None)
                bands.append(_keys(s, settings) if len(x) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())], ["doc_id", "mark", "n", "digest", "bands", "sig"])

    return docs.mapInArrow(signed, "doc_id long, mark long, n long, digest binary, bands array<long>, sig binary")


def _keys(signature: np.ndarray, settings: Settings) -> np.ndarray:
    """A number for each band, of its place and its rows."""
    x = np.arange(1, settings.bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for column in signature.reshape(settings.bands, settings.rows).T:
        x = (x ^ column) * np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(32)
    return x.view(np.int64)


def _surviving(pairs: DataFrame, signatures: DataFrame, settings: Settings) -> DataFrame:
    steps = needed(settings)
    named: Callable[[str], DataFrame] = lambda x: signatures.select(F.col("node").alias(x), F.col("sig").alias(f"sig_{x}"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
            yield batch.select([0, 1]).take(pa.array(alike(a, b, steps))) if batch.num_rows else batch.select([0, 1])

    signed = parted_join(parted_join(pairs, named("b"), "b", ["a"], "inner", HEAVY), named("a"), "a", ["b"], "inner", HEAVY)
    return signed.select("a", "b", "sig_a", "sig_b").mapInArrow(compared, "a long, b long")


def _identity(key: Column, mark: Column) -> list[Column]:
    """A row's key and text in three columns without nulls, to join and group by."""
    return [F.coalesce(key, F.lit(0).cast("bigint")).alias("k"), key.isNull().alias("none"), mark.alias("m")]


def _of_one_key(held: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Links (a, b) between the classes that texts of one key are in; None where no key has several."""
    keyed = held.where("doc_id is not null").select("doc_id", "digest")
    several = materialise(keyed.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low <> high").select("doc_id", "low"))
    if several.isEmpty():
        return None
    several = materialise(parted_join(several, classes.select(F.col("digest").alias("low"), F.col("node").alias("b")), "low", ["doc_id"], "inner", HEAVY))
    texts = materialise(parted_join(keyed.distinct(), several, "doc_id", ["digest"], "inner", HEAVY).where("digest <> low").select("digest", "b"))
    return parted_join(texts, classes.select("digest", F.col("node").alias("a")), "digest", ["b"], "inner", HEAVY).select("a", "b")


def near_duplicates(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text", mark: str | None = None) -> DataFrame:  # noqa: B008
    """Per row: key, n_shingles, component_id (the least key that links reach, its own included), kept (key = component_id).

    Words are runs of what is not ASCII white space, A-Z in lower case. A text with fewer words than a shingle has its whole
    sequence as one; null and empty texts have none and link with nothing. Rows with equal keys are one document with several
    texts. Rows with a null key are each a document: their texts link like others, their component_id is null where links reach
    no key, and then the rows of one of their texts are kept. An empty table gives no rows. Other columns are ignored. mark: a
    further column of this name, the text's xxhash64, by which unique() finds the row again.
    """
    rows = materialise(_signed(lean(docs).select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text")), settings))
    held = rows.where("digest is not null")
    # Equal sets have equal signatures. own and mark name a row of the class: the least key's.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("first")
    classes = held.groupBy("digest").agg(first, F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    classes = materialise(classes.select(F.monotonically_increasing_id().alias("node"), "digest", F.col("first.doc_id").alias("own"), F.col("first.mark").alias("mark"), "bands", "sig"))

    entries = classes.select("node", F.explode("bands").alias("grp"))
    buckets = entries.groupBy("grp").agg(F.count(F.lit(1)).alias("k"), F.min("node").alias("least"), F.min(F.col("node").bitwiseXOR(F.lit(_MASKS[0]))).bitwiseXOR(F.lit(_MASKS[0])).alias("other")).where("k > 1")
    met = materialise(entries.join(buckets, "grp").select("grp", "node", "k", "least", "other"))
    pairs = met.select("node", F.explode(F.array("least", "other")).alias("p")).where("node <> p").select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b")).distinct()
    near = materialise(_surviving(materialise(pairs), classes, settings))
    clusters = components(near)

    labelled = met.where("k > 2").join(clusters.withColumnRenamed("node", "nd"), F.col("node") == F.col("nd"), "left").select("grp", "node", F.coalesce("component", "node").alias("label"))
    open_ = labelled.groupBy("grp").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("grp")
    open_rows = materialise(labelled.join(open_, "grp"))
    if not open_rows.isEmpty():
        signed = open_rows.join(classes.select("node", "sig", F.lit(0).alias("size")), "node")
        more = within(materialise(signed.select("grp", "node", "label", "size", "sig")), settings)
        near = near.unionByName(more)
        clusters = components(near)

    # Full sets are made anew from one text of each clustered class.
    clustered = clusters.join(classes, "node").select(F.col("component").alias("grp"), "node", "digest", "sig", *_identity(F.col("own"), F.col("mark")))
    clustered = materialise(clustered)
    texts = docs.select(*_identity(F.col(key).cast("long"), F.xxhash64(text)), F.col(text).alias("text"))
    both = F.xxhash64("k", "none", "m")
    texts = sifted(texts, both, clustered.select(both), "maybe").where("maybe")  # so that few other texts are moved
    texts = texts.groupBy("k", "none", "m").agg(F.first("text").alias("text"))  # repeated rows are one before they move
    clustered = clustered.join(texts, ["k", "none", "m"]).select("text", "digest", "grp", "node", "sig")

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(sets(batch.column(0), settings.words))
            right = [i for i, (x, d) in enumerate(zip(found, batch.column(1).to_pylist(), strict=True)) if len(x) and digest(x) == d]
            t = batch.take(pa.array(right, pa.int64()))
            yield pa.RecordBatch.from_arrays([t.column(2), t.column(3), t.column(3), pa.array([len(found[i]) for i in right], pa.int64()), t.column(4), pa.array([found[i].tobytes() for i in right], pa.binary())], ["grp", "node", "label", "size", "sig", "members"])

    full = clustered.mapInArrow(filled, "grp long, node long, label long, size long, sig binary, members binary")
    links = within(materialise(full), settings)
    if (more := _of_one_key(held, classes)) is not None:
        links = links.unionByName(more)
    joined = components(links)

    least = joined.join(classes.select("node", "own"), "node").groupBy("component").agg(F.min("own").alias("component_id"))
    reached = parted_join(joined, least, "component", ["node"], "inner", HEAVY)
    named = classes.select("node", "digest", "own", F.col("mark").alias("m")).join(reached, "node", "left")
    # The text that stays where links reach no key is that of the component's least node.
    chosen = F.when(F.col("node") == F.coalesce("component", "node"), F.col("m"))
    named = named.select("digest", F.coalesce("component_id", "own").alias("component_id"), chosen.alias("chosen"))
    out = parted_join(held.select("doc_id", "mark", "n", "digest"), named, "digest", ["doc_id", "mark"], "inner", HEAVY)
    kept = F.when(F.col("component_id").isNull(), F.col("mark") == F.col("chosen")).otherwise(F.col("doc_id") == F.col("component_id"))
    out = out.select("mark", "doc_id", "n", "component_id", F.coalesce(kept, F.lit(False)).alias("kept"))
    out = out.unionByName(rows.where("digest is null").select("mark", "doc_id", "n", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept")))
    return out.select(*[F.col("mark").alias(m) for m in [mark] if m], F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), "component_id", "kept")


def unique(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:  # noqa: B008
    """The rows, all their columns, of the documents that stay: one of each group. Of rows that repeat key and text one stays."""
    stays, maybe, mark = (free_name(docs, x) for x in ("stays", "maybe", "mark"))
    rows = near_duplicates(docs, settings, key, text, mark)
    rows = materialise(rows.groupBy(*_identity(F.col(key), F.col(mark))).agg(F.max("kept").alias(stays), F.count(F.lit(1)).alias("n")))
    doubtful = rows.where(~F.col(stays) | (F.col("n") > 1)).drop("n")
    # A document whose text and key are certainly no doubtful ones stays as it is, without being moved; the others are looked up,
    # rows that repeat key and text as one, combined before they move.
    names = [free_name(docs, x) for x in ("k", "none", "m")]
    doubtful = doubtful.withColumnsRenamed(dict(zip(("k", "none", "m"), names, strict=True)))
    identity = [c.alias(n) for c, n in zip(_identity(F.col(key).cast("long"), F.xxhash64(text)), names, strict=True)]
    own = sifted(docs.select("*", *identity), F.xxhash64(*names), doubtful.select(F.xxhash64(*names)), maybe)
    asked = own.where(F.col(maybe)).dropDuplicates(names)
    found = asked.join(doubtful, names, "left").where(F.coalesce(stays, F.lit(True)))
    return own.where(~F.col(maybe)).select(docs.columns).unionByName(found.select(docs.columns))
