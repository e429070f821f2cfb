"""Quality by ordinal cumulative-link regression on graded ratings.

One vector of hashed-text weights and ordered thresholds t1 < t2 < ... are learned together: P(grade <= k) is
sigmoid(t_k - w.x). Expected grades and the probability of a target grade or better follow for selection.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import held_out, lean, share_of, small, thinned, words

BITS = 18


def hashed(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values: words by damped count, at unit length, and the text's shape in steps (length, repeats, marks)."""
    found = words(text)
    counts = Counter(found)
    n = len(found)
    lines = [x for x in (text or "").split("\n") if x]
    marks = sum(v for w, v in counts.items() if not w[0].isalnum() or not w[-1].isalnum())
    pairs = len(set(zip(found, found[1:], strict=False)))
    step = lambda x: int(8 * x + 1e-9)
    shape = [
        f"\nn{int(2 * math.log2(n + 1))}", f"\nd{step(len(counts) / max(n, 1))}", f"\np{step(pairs / max(n - 1, 1))}", f"\nl{step(len(set(lines)) / max(len(lines), 1))}",
        f"\nm{step(marks / max(n, 1))}", f"\nt{step(max(counts.values(), default=0) / max(n, 1))}", f"\nw{min(int(len(text or '') / max(n, 1)), 20)}", f"\ns{step(sum(v for w, v in counts.items() if len(w) == 1) / max(n, 1))}",
    ]
    damped = np.array([1 + math.log(v) for v in counts.values()])
    damped /= np.sqrt((damped**2).sum()) if n else 1.0
    at = np.array([zlib.crc32(w.encode(errors="replace")) >> (32 - BITS) for w in [*counts, *shape]], np.int32)
    return at, np.concatenate([damped, np.full(len(shape), 0.5)]).astype(np.float32)


@dataclass
class Model:
    grades: list[float]
    thresholds: np.ndarray
    weights: np.ndarray

    def chances(self, z: np.ndarray) -> np.ndarray:
        """P(grade) for each row and grade."""
        if not self.grades:
            return np.zeros((len(z), 0))
        below = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - z[:, None], -40, 40)))
        edges = np.concatenate([np.zeros((len(z), 1)), below, np.ones((len(z), 1))], axis=1)
        return np.diff(edges, axis=1)


def likelihood(z: np.ndarray, level: np.ndarray, t: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The mean of -log P(level) at scores z and thresholds t, and its gradient in z and in t."""
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    k = len(t) + 1
    hi = np.where(level < k - 1, sig(t[np.minimum(level, k - 2)] - z), 1.0)
    lo = np.where(level > 0, sig(t[np.maximum(level - 1, 0)] - z), 0.0)
    p = np.maximum(hi - lo, 1e-9)
    dhi, dlo = hi * (1 - hi) / p / len(z), lo * (1 - lo) / p / len(z)
    dt = np.zeros(k - 1)
    np.add.at(dt, np.minimum(level, k - 2), np.where(level < k - 1, -dhi, 0))
    np.add.at(dt, np.maximum(level - 1, 0), np.where(level > 0, dlo, 0))
    return float(-np.log(p).mean()), dhi - dlo, dt


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, passes: int = 12, batch: int = 64, rate: float = 0.3, decay: float = 1e-6, seed: int = 1) -> Model:
    """Adagrad on the negative log-likelihood; thresholds are a first one and positive steps. Fewer than two grades need no weights."""
    grades = sorted(set(y.tolist()))
    k = len(grades)
    w = np.zeros(1 << BITS)
    if k < 2:
        return Model(grades, np.zeros(0), w)
    level = np.searchsorted(grades, y)
    below = np.clip(np.cumsum(np.bincount(level, minlength=k))[:-1] / len(y), 1e-3, 1 - 1e-3)
    t = np.log(below / (1 - below))
    a = np.concatenate([t[:1], np.log(np.maximum(np.diff(t), 1e-3))])
    gw, ga = np.full(1 << BITS, 1e-2), np.full(k - 1, 1e-2)
    rng = np.random.default_rng(seed)
    for _ in range(passes):
        order = rng.permutation(len(rows))
        for s in range(0, len(rows), batch):
            pick = order[s : s + batch]
            at = np.concatenate([rows[i][0] for i in pick])
            value = np.concatenate([rows[i][1] for i in pick])
            row = np.repeat(np.arange(len(pick)), [len(rows[i][0]) for i in pick])
            z = np.bincount(row, w[at] * value, minlength=len(pick))
            t = np.concatenate([a[:1], a[0] + np.cumsum(np.exp(a[1:]))])
            _, dz, dt = likelihood(z, level[pick], t)
            da = np.concatenate([[dt.sum()], [dt[j:].sum() * np.exp(a[j]) for j in range(1, k - 1)]])
            buckets, where = np.unique(at, return_inverse=True)
            g = np.bincount(where, value * dz[row]) + decay * w[buckets]
            gw[buckets] += g**2
            w[buckets] -= rate * g / np.sqrt(gw[buckets])
            ga += da**2
            a -= rate * da / np.sqrt(ga)
    return Model(grades, np.concatenate([a[:1], a[0] + np.cumsum(np.exp(a[1:]))]), w.astype(np.float32))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = 12000, text_bytes: int = 64 << 20) -> Model:
    """A model from about `rows` rated rows at most, and no more than come to about text_bytes of text, chosen by a hash of the key, outside the held-out fold.

    Of a key's ratings the lowest counts. The driver gets 8 bytes for each different word of a chosen text, and 64 for its shape.
    """
    rated = labels.where(~held_out(F.col(key)) & F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.min(label).cast("double").alias("y"))
    n = rated.count()
    chosen = small(rated.where(share_of(F.col("k"), rows / max(n, 1), 9)), rows)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [hashed(x.as_py()) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([p[i].tobytes() for p in pairs], pa.binary()) for i in (0, 1)] + [batch.column(1)], ["at", "value", "y"])

    joined = lean(docs).select(F.col(key).alias("key"), F.col(text).alias("text")).join(chosen, F.col("key") == F.col("k")).select("key", "text", "y")
    got = thinned(joined, "key", "text", text_bytes, 7).select("text", "y").mapInArrow(coded, "at binary, value binary, y double")
    sample = sorted((r.y, bytes(r.at), bytes(r.value)) for r in got.collect())
    return fit([(np.frombuffer(at, np.int32), np.frombuffer(value, np.float32)) for _, at, value in sample], np.array([y for y, *_ in sample]))


def grade(docs: DataFrame, model: Model, target: float | None = None, least: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, held_out, expected_grade, tail_prob of `target` (the best grade, if none is given) or better, kept (tail_prob >= least).

    Null and empty texts are graded by their shape alone. Without any rating, grades are null and all rows are kept.
    """
    target = target if target is not None else max(model.grades, default=0.0)

    def graded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = np.array(model.grades)
        for batch in batches:
            z = np.array([float(model.weights[at] @ value) for at, value in (hashed(x.as_py()) for x in batch.column(1))])
            p = model.chances(z)
            none = [None] * len(z)
            expected, tail = (none, none) if not model.grades else (p @ values, p[:, values >= target].sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(expected, pa.float64()), pa.array(tail, pa.float64())], [key, "held_out", "expected_grade", "tail_prob"])

    kind = docs.schema[key].dataType.simpleString()
    out = lean(docs).select(key, text, held_out(F.col(key)).alias("held_out")).mapInArrow(graded, f"`{key}` {kind}, held_out boolean, expected_grade double, tail_prob double")
    return out.withColumn("kept", F.coalesce(F.col("tail_prob") >= least, F.lit(True)))
