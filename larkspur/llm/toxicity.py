"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic examples are the positives; any other text is unlabelled, whatever labels say of it. A linear model over
the presence of words and word beginnings, and of beginnings that come twice, is trained on the risk pi * R+(positives) + max(0, R-(unlabelled) - pi *
R-(positives)) with the logistic loss; where the second part falls below zero its gradient is turned round. pi, the share
of toxic text, is that of the labels learned from.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from larkspur.llm.common import held_out, lean, materialise, scratch, share_of, small, thinned, with_field, words

_EDGES = ".,;:!?\"'()[]{}<>*#$%&|-_/\\"
#: Features of texts that a task holds at once, but for those of one text.
_HELD = 1 << 16


def features(text: str | None) -> set[str]:
    """Distinct words without punctuation around them, and beginnings of 4, 5 and 6 letters of longer ones: once if any word has them, once more if two do."""
    out, begun = set(), Counter()
    for w, n in Counter(words(text)).items():
        w = w.strip(_EDGES)
        out.add(w)
        for k in (4, 5, 6):
            if len(w) > k:
                begun[w[:k]] += n
    for w, n in begun.items():
        out.add(f"{w}*")
        if n > 1:
            out.add(f"{w}**")
    return out


def _kind(found: set[str]) -> int:
    """Alike for most near copies, which then count once in training."""
    plain = [w for w in found if not w.endswith("*")]
    least = [min((xxhash.xxh32_intdigest(w, seed) for w in plain), default=0) for seed in (1, 2, 3, 4)]
    return xxhash.xxh64_intdigest(repr(least)) >> 1


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    prior: float

    def __post_init__(self) -> None:
        #: First letters of the beginnings that tell; most words have none of them.
        self.heads = {f[:4] for f in self.weights if f.endswith("*")}

    def score(self, text: str | None) -> float:
        """0 to 1 over the whole text; a null or empty text gets what no evidence gives. The weights of all features() are summed, without making those that tell nothing."""
        weights, heads = self.weights, self.heads
        hits: set[str] = set()
        begun: Counter[str] = Counter()
        for w, n in Counter(words(text)).items():
            w = w.strip(_EDGES)
            if w in weights:
                hits.add(w)
            if w[:4] in heads:
                for k in (4, 5, 6):
                    if len(w) > k:
                        begun[w[:k]] += n
        z = self.bias + sum(weights[w] for w in hits)
        z += sum(weights.get(f"{w}*", 0.0) + (weights.get(f"{w}**", 0.0) if n > 1 else 0.0) for w, n in begun.items())
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def risk(gp: np.ndarray, gu: np.ndarray, prior: float, beta: float = 0.0) -> tuple[float, np.ndarray, np.ndarray]:
    """The non-negative risk at the scores of positives and of unlabelled rows, and the direction of its descent in either.

    Where the part that stands for negatives is below -beta, the direction climbs back out of that part instead.
    """
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    np_, nu = max(len(gp), 1), max(len(gu), 1)
    negative = np.logaddexp(0, gu).sum() / nu - prior * np.logaddexp(0, gp).sum() / np_
    positive = prior * np.logaddexp(0, -gp).sum() / np_
    dp_plus, dp_minus, du_minus = -prior * sig(-gp) / np_, -prior * sig(gp) / np_, sig(gu) / nu
    if negative >= -beta:
        return positive + max(negative, 0.0), dp_plus + dp_minus, du_minus
    return positive, -dp_minus, -du_minus


def nnpu(p_rows: list[np.ndarray], u_rows: list[np.ndarray], n_features: int, prior: float, steps: int = 600, rate: float = 0.1, sparsity: float = 3e-5, beta: float = 0.0) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the whole sample, weights shrunk toward 0 at each step so that few features tell; rows are arrays of feature numbers."""

    def sparse(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
        return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64), max(len(rows), 1)

    (pi, pj, np_), (ui, uj, nu) = sparse(p_rows), sparse(u_rows)
    w, b = np.zeros(n_features), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for t in range(1, steps + 1):
        gp = b + np.bincount(pi, w[pj], minlength=np_)[:np_]
        gu = b + np.bincount(ui, w[uj], minlength=nu)[:nu]
        _, dp, du = risk(gp[: len(p_rows)], gu[: len(u_rows)], prior, beta)
        grad = np.zeros(n_features + 1)
        grad[:-1] = np.bincount(pj, dp[pi] if len(pi) else None, minlength=n_features) + np.bincount(uj, du[ui] if len(ui) else None, minlength=n_features)
        grad[-1] = dp.sum() + du.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
        shrink = rate * sparsity / (np.sqrt(v[:-1] / (1 - 0.999**t)) + 1e-8)
        w = np.sign(w) * np.maximum(np.abs(w) - shrink, 0)
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", positives: int = 4000, unlabelled: int = 12000, text_bytes: int = 64 << 20, least: int = 4, lift: float = 3.0, chance: float = 0.05) -> Model:
    """A model from about `positives` confirmed toxic rows and about `unlabelled` others at most, and of either no more than come to about text_bytes of text, chosen by a hash of the key.

    Only rows outside the held-out fold are looked at. A key with several labels is toxic if one of them says so; near copies
    count once. Features are all those of at least `least` positives that are `lift` times as frequent among them as in
    unlabelled text, and more frequent than would come about for any of the candidates with that chance. They are counted and
    chosen by the executors: what the driver gets are the features chosen and, for each row of the sample, which of them it has.
    Null texts count as empty ones. Without any positive, no text is toxic.
    """
    known = labels.where(~held_out(F.col(key)) & F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.max(F.col(label)).alias("y"))
    n_known, n_toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("y") == 1).cast("long")), F.lit(0))).first()
    if not n_toxic:
        return Model({}, -6.0, 0.0)
    prior = float(np.clip(n_toxic / n_known, 0.001, 0.9))
    toxic = known.where((F.col("y") == 1) & share_of(F.col("k"), positives / n_toxic, 3)).select("k")
    pool = lean(docs).where(~held_out(F.col(key))).select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows, size = pool.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    part = min(unlabelled / max(rows, 1), text_bytes / max(size, 1))
    confirmed = pool.join(small(toxic, positives), F.col("key") == F.col("k"), "left_semi")
    kept = thinned(confirmed, "key", "text", text_bytes, 7).select(F.lit(True).alias("p"), "text")
    sample = kept.unionByName(pool.where(share_of(F.col("key"), part, 5)).select(F.lit(False).alias("p"), "text"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: list[set[str]] = []
            first = held = 0
            for i, x in enumerate(batch.column(1), 1):
                sets.append(features(x.as_py()))
                held += len(sets[-1])
                if held >= _HELD or i == batch.num_rows:  # a batch's features are many times its texts
                    yield pa.RecordBatch.from_arrays([batch.column(0)[first:i], pa.array([_kind(x) for x in sets], pa.int64()), pa.array([sorted(x) for x in sets], pa.list_(pa.string()))], ["p", "kind", "found"])
                    sets, first, held = [], i, 0

    with scratch(docs.sparkSession):
        rows = sample.mapInArrow(found, "p boolean, kind long, found array<string>")
        rows = materialise(rows.groupBy("p", "kind").agg(F.min_by("found", F.struct(F.size("found"), F.xxhash64("found"))).alias("found")))
        n_p, n_u = (max(x, 1) for x in rows.agg(F.count_if("p"), F.count_if(~F.col("p"))).first())
        often = materialise(rows.select("p", F.explode("found").alias("f")).groupBy("f").agg(F.count_if("p").alias("in_p"), F.count_if(~F.col("p")).alias("in_u")).where(F.col("in_p") >= least))
        expected = F.lit(n_p) * (F.col("in_u") + 1) / F.lit(n_u)
        surprise = F.col("in_p") * F.log(F.col("in_p") / expected) - (F.col("in_p") - expected)  # Chernoff's bound on a Poisson tail
        telling = (F.col("in_p") >= lift * expected) & (F.col("in_p") > expected) & (surprise >= float(np.log(max(often.count(), 1) / chance)))
        names = [r.f for r in often.where(telling).orderBy("f").collect()]
        number = {f: i for i, f in enumerate(names)}

        def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes = [np.array(sorted(number[f] for f in x.as_py() if f in number), np.int32).tobytes() for x in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.binary())], ["p", "codes"])

        got = sorted((not r.p, bytes(r.codes)) for r in rows.select("p", "found").mapInArrow(coded, "p boolean, codes binary").collect())
    p_rows, u_rows = ([np.frombuffer(codes, np.int32) for other, codes in got if other == x] for x in (False, True))
    w, b = nnpu(p_rows, u_rows, len(names), prior)
    return Model({f: float(x) for f, x in zip(names, w, strict=True) if x}, b, prior)


def score(docs: DataFrame, model: Model, column: str = "score", text: str = "text") -> DataFrame:
    """The same rows and columns and one more: the whole text's score. Repeated rows score alike; an empty table stays one."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = batch.schema.get_field_index(text)
            yield batch.append_column(column, pa.array([model.score(x.as_py()) for x in batch.column(i)], pa.float64()))

    return lean(docs).mapInArrow(scored, with_field(docs, column, DoubleType()))
