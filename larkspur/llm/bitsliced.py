"""Exact top-k search by inner product over a bit-sliced index.

Every component is quantised to an integer; each block of rows keeps, for each component and each binary place, a
bitmap over its rows. A query's scores are summed for all rows at once by adding those slices, shifted by the places of
the query's own bits, with bitmap adders; the sum is a stack of slices again. The top rows are then selected from the
most significant slice downward, and rows that tie at the boundary are resolved by id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import materialise
from larkspur.llm.vectors import Answer, best, dealt, matrix, met, usable

INDEX = "dim int, block long, rows int, ids binary, low binary, places binary, slices binary"


def _pack(bits: np.ndarray) -> np.ndarray:
    """Boolean rows to bitmaps of 64-bit words; bit i is row i."""
    pad = -bits.shape[-1] % 64
    bits = np.pad(bits, [(0, 0)] * (bits.ndim - 1) + [(0, pad)])
    return np.ascontiguousarray(np.packbits(bits, axis=-1, bitorder="little")).view(np.uint64)


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def _scores(values: np.ndarray, query: np.ndarray) -> np.ndarray:
    """The rows' products with the query; an OverflowError if one doesn't fit a long."""
    if (np.abs(values.astype(float)) @ np.abs(query.astype(float)) < 2.0**62).all():
        return values @ query
    exact = [sum(a * b for a, b in zip(row, query.tolist(), strict=True)) for row in values.tolist()]
    if any(not -(2**63) <= x < 2**63 for x in exact):
        raise OverflowError("a score doesn't fit a long")
    return np.array(exact, np.int64)


class Slices:
    """One block: ids in order, the lowest value and number of binary places of each component, and its slices."""

    def __init__(self, ids: np.ndarray, low: np.ndarray, places: np.ndarray, slices: np.ndarray) -> None:
        self.ids, self.low, self.places, self.slices = ids, low, places, slices
        self.inverse = ~slices

    @classmethod
    def build(cls, ids: np.ndarray, values: np.ndarray) -> Slices:
        order = np.argsort(ids, kind="stable")
        ids, values = ids[order], values[order]
        low = values.min(axis=0)
        u = values.astype(np.uint64) - low.astype(np.uint64)  # a difference may need 64 bits
        places = np.array([int(x).bit_length() for x in u.max(axis=0)], dtype=np.int64)
        slices = np.stack([_pack(((u >> np.uint64(b)) & np.uint64(1)).astype(bool).T) for b in range(max(places.max(initial=0), 1))], axis=1) if values.shape[1] else np.zeros((0, 1, -(-len(ids) // 64)), np.uint64)
        return cls(ids, low, places, slices)

    def sums(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices, lowest first, of each row's score less a number that is the same for all rows.

        Components that the query counts negatively are added as complements, so that nothing is subtracted.
        """
        size = np.abs(query).astype(np.uint64)
        stack: dict[int, list[np.ndarray]] = {}
        for a in range(int(size.max(initial=0)).bit_length()):
            for source, chosen in ((self.slices, query > 0), (self.inverse, query < 0)):
                at = np.flatnonzero(chosen & ((size >> np.uint64(a)) & np.uint64(1) == 1))
                for b in range(int(self.places[at].max(initial=0))):
                    has = at[self.places[at] > b]
                    stack.setdefault(a + b, []).append(source[has, b])
        out, place, carried = [], 0, []
        while carried or any(p >= place for p in stack):
            x = [*stack.pop(place, []), *carried]
            x, carried = (np.concatenate(x) if x else np.zeros((0, self.slices.shape[-1]), np.uint64)), []
            while len(x) > 1:  # full adders, three slices to one and a carry; a half adder for the last two
                n = len(x) // 3
                if n:
                    a, b, c = x[:n], x[n : 2 * n], x[2 * n : 3 * n]
                    t = a ^ b
                    carried.append((a & b) | (t & c))
                    x = np.concatenate([t ^ c, x[3 * n :]])
                else:
                    carried.append((x[:1] & x[1:2]))
                    x = x[:1] ^ x[1:2]
            out.append(x[0] if len(x) else np.zeros(self.slices.shape[-1], np.uint64))
            place += 1
        return out

    def top(self, query: np.ndarray, k: int, own: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but those of id `own`; of rows that tie for the last places, the smaller ids."""
        open_ = _pack(self.ids != own if own is not None else np.ones(len(self.ids), bool))
        sure = np.zeros_like(open_)
        for s in reversed(self.sums(query)):
            with_ = sure | (open_ & s)
            n = _count(with_)
            if n > k:
                open_ &= s
            else:
                sure, open_ = with_, open_ & ~s
                if n == k:
                    open_ = np.zeros_like(open_)
                    break
        rows = _rows(sure)
        rows = np.concatenate([rows, _rows(open_)[: k - len(rows)]])
        return self.ids[rows], _scores(self.values(rows), query)

    def values(self, rows: np.ndarray) -> np.ndarray:
        """The rows' integers, put together from the slices."""
        words, bit = rows // 64, (rows % 64).astype(np.uint64)
        bits = (self.slices[:, :, words] >> bit) & np.uint64(1)
        return (bits.astype(np.int64) << np.arange(self.slices.shape[1])[None, :, None]).sum(axis=1).T + self.low


def quantised(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(id, v, dim), v being floor(scale * x) in doubles. Null and non-finite components take no part with their vectors; one whose v doesn't fit a long fails the job, like a score that doesn't."""
    whole = lambda x: F.when(F.abs(x * F.lit(scale)) < F.lit(2.0**63), F.floor(x * F.lit(scale)).cast("double")).otherwise(F.raise_error(F.lit(f"a component times {scale} doesn't fit a long")).cast("double"))
    return usable(df, key, vector, zero=True).withColumn("v", F.transform("v", whole))


def build(rows: DataFrame, block: int = 1 << 14) -> DataFrame:
    """The index: a row of INDEX for each block of about `block` rows of one dimension, kept in the shared folder."""

    def one(x: pa.Table) -> pa.Table:
        dim = x["dim"][0].as_py()
        s = Slices.build(x["id"].to_numpy(), matrix(x["v"], dim).astype(np.int64))
        data = [[dim], [x["block"][0].as_py()], [len(s.ids)], *([a.tobytes()] for a in (s.ids, s.low, s.places, s.slices))]
        return pa.table([pa.array(c, t) for c, t in zip(data, (pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4), strict=True)], names=[x.split()[0] for x in INDEX.split(", ")])

    return materialise(dealt(rows, block).groupBy("dim", "block").applyInArrow(one, INDEX))


def search(index: DataFrame, queries: DataFrame, k: int, chunk: int = 128, held: int = 16, tasks: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest integer inner products with rows of other ids, all rows if fewer.

    queries: (id, v, dim) as quantised() gives them. Ties go to the smaller vec_id; a repeated id counts as often as it has
    rows; equal query rows are answered once, rows of one id with other vectors each. No rows or no queries give no rows;
    vectors only meet those of their dimension. chunk: queries to a packet. held: blocks that a task may hold at once.
    """

    def load(row: dict) -> Slices:
        low, places = np.frombuffer(row["low"], np.int64), np.frombuffer(row["places"], np.int64)
        slices = np.frombuffer(row["slices"], np.uint64).reshape(row["dim"], max(int(places.max(initial=0)), 1), -(-row["rows"] // 64))
        return Slices(np.frombuffer(row["ids"], np.int64), low, places, slices)

    def ask(block: Slices, asked: np.ndarray, q: np.ndarray) -> Answer:
        found = [block.top(v, k, int(own)) for own, v in zip(asked, q.astype(np.int64), strict=True)]
        place = np.repeat(np.arange(len(asked)), [len(ids) for ids, _ in found])
        return place, np.concatenate([ids for ids, _ in found]), np.concatenate([scores for _, scores in found])

    return best(met(index, queries, k, chunk, held, load, ask, "long", tasks), k)
