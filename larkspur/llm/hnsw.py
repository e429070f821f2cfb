"""Approximate nearest neighbours by inner product: a hierarchical navigable small-world graph per shard.

A shard's graph is a stack of layers, each a flat array of neighbour numbers, -1 where there are fewer. The inner product
is turned into a distance by one more component, sqrt(R^2 - |x|^2) with R the longest vector, which queries have as 0.
Equal vectors are one node with a list of ids, so copies never crowd a neighbourhood. Layers are built from the top; nodes
go in by batches, whose searches run side by side as array operations. Each shard answers every query; answers are merged
by their exact scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import materialise
from larkspur.llm.vectors import Answer, best, dealt, matrix, met, usable

INDEX = "dim int, block long, nodes int, vectors binary, ids binary, starts binary, levels array<struct<nodes:int,width:int,neighbours:binary>>"


def _nearest(d: np.ndarray, k: int) -> np.ndarray:
    """Columns of each row's k least, in order."""
    if k < d.shape[1]:
        at = np.argpartition(d, k - 1, axis=1)[:, :k]
        return np.take_along_axis(at, np.argsort(np.take_along_axis(d, at, 1), axis=1, kind="stable"), 1)
    return np.argsort(d, axis=1, kind="stable")


def beam(x: np.ndarray, norms: np.ndarray, links: np.ndarray, q: np.ndarray, entries: np.ndarray, width: int, at_once: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Best-first searches of all queries side by side: (nodes, squared distances) of up to `width` each, nearest first, -1 and inf behind.

    Each step goes on from a query's nearest `at_once` open nodes, so that its list is kept in order once for all of them.
    """
    n = len(q)
    qq = np.einsum("ij,ij->i", q, q)
    seen = np.zeros((n, len(x) + 1), bool)
    seen[:, -1] = True
    ids = np.full((n, width), -1, np.int32)
    ds = np.full((n, width), np.inf, np.float32)
    done = np.ones((n, width), bool)
    at = np.arange(n)[:, None]
    e = entries[:, :width]
    ids[:, : e.shape[1]] = e
    ds[:, : e.shape[1]] = np.where(e >= 0, qq[:, None] - 2 * np.einsum("ikj,ij->ik", x[e], q) + norms[e], np.inf)
    done[:, : e.shape[1]] = e < 0
    seen[at, e] = True
    # Which column a node is new from, where several of a step's nodes link to it.
    at_once = min(at_once, width)
    first = np.zeros((n, len(x) + 1), np.int16)
    columns = np.arange(at_once * links.shape[1], dtype=np.int16)
    live = np.arange(n)
    while True:
        live = live[~done[live].all(axis=1)]
        if not len(live):
            break
        d = np.where(done[live], np.inf, ds[live])
        pick = np.argpartition(d, at_once - 1, axis=1)[:, :at_once] if at_once < width else np.tile(np.arange(width), (len(live), 1))
        open_ = ~done[live[:, None], pick]
        done[live[:, None], pick] = True
        near = np.where(open_[:, :, None], links[np.take_along_axis(ids[live], pick, 1)], -1).reshape(len(live), -1)
        first[live[:, None], near] = columns
        near = np.where(seen[live[:, None], near] | (first[live[:, None], near] != columns), -1, near)
        seen[live[:, None], near] = True
        most = int((near >= 0).sum(axis=1).max())
        if not most:
            continue
        near = np.take_along_axis(near, np.argsort(near < 0, axis=1, kind="stable")[:, :most], 1)
        new = qq[live, None] - 2 * np.matmul(x[near], q[live, :, None])[:, :, 0] + norms[near]
        new[near < 0] = np.inf
        all_d = np.concatenate([ds[live], new], axis=1)
        keep = np.argpartition(all_d, width - 1, axis=1)[:, :width]
        ds[live] = np.take_along_axis(all_d, keep, 1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], near], axis=1), keep, 1)
        done[live] = np.take_along_axis(np.concatenate([done[live], near < 0], axis=1), keep, 1)
    order = np.argsort(ds, axis=1, kind="stable")
    ids, ds = np.take_along_axis(ids, order, 1), np.take_along_axis(ds, order, 1)
    return np.where(np.isfinite(ds), ids, -1), ds


def diverse(x: np.ndarray, candidates: np.ndarray, d: np.ndarray, m: int) -> np.ndarray:
    """Of each row's candidates, nearest first, those closer to the node than to any chosen before, then the nearest others, up to m."""
    n, c = candidates.shape
    v = x[candidates]
    vv = np.einsum("ijk,ijk->ij", v, v)
    between = vv[:, :, None] + vv[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
    chosen = np.zeros((n, c), bool)
    count = np.zeros(n, int)
    for j in range(c):
        ok = (candidates[:, j] >= 0) & (count < m) & ~(chosen[:, :j] & (between[:, j, :j] < d[:, j : j + 1])).any(axis=1)
        chosen[:, j] = ok
        count += ok
    rank = np.where(chosen, 0, 1) + np.where(candidates < 0, 2, 0)
    order = np.argsort(rank, axis=1, kind="stable")[:, :m]
    out = np.full((n, m), -1, np.int32)
    out[:, : order.shape[1]] = np.take_along_axis(candidates, order, 1)
    return out


class Graph:
    """The graph of one shard. Nodes are numbered so that each layer holds a prefix of them."""

    def __init__(self, vectors: np.ndarray, levels: list[np.ndarray]) -> None:
        self.vectors, self.levels = vectors, levels  # levels[0] is the lowest
        square = np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64)
        self.x = np.concatenate([vectors, np.sqrt(np.maximum(square.max(initial=0) - square, 0))[:, None]], axis=1).astype(np.float32)
        self.norms = np.einsum("ij,ij->i", self.x, self.x)

    @classmethod
    def build(cls, vectors: np.ndarray, m: int = 24, width: int = 96, batch: int = 512, seed: int = 7) -> Graph:
        n = len(vectors)
        height = np.minimum(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(m), 8).astype(int)
        order = np.argsort(-height, kind="stable")
        g, height = cls(vectors[order], []), height[order]
        g.order = order
        built: list[np.ndarray] = []
        for level in range(int(height.max(initial=0)), -1, -1):
            size = int((height >= level).sum())
            g.levels = built[::-1]
            links = g._layer(size, int((height > level).sum()), 2 * m if level == 0 else m, width, batch)
            built.append(links)
        g.levels = built[::-1]
        return g

    def _layer(self, size: int, above: int, m: int, width: int, batch: int) -> np.ndarray:
        x, norms = self.x[:size], self.norms[:size]
        links = np.full((size, m), -1, np.int32)
        start = 0
        while start < size:
            stop = min(size, start + min(batch, max(start, 64)))
            q = x[start:stop]
            inside = norms[None, start:stop] + norms[start:stop, None] - 2 * (q @ q.T)
            np.fill_diagonal(inside, np.inf)
            at = _nearest(inside, min(width, stop - start))
            ids, ds = (at + start).astype(np.int32), np.take_along_axis(inside, at, 1)
            ids[~np.isfinite(ds)] = -1
            if start:
                entries = np.zeros((stop - start, 1), np.int32)
                if above and start >= above:
                    entries = self.entries(q)
                far, far_d = beam(x[:start], norms[:start], links[:start], q, entries, width)
                ids, ds = np.concatenate([ids, far], axis=1), np.concatenate([ds, far_d], axis=1)
            near = _nearest(ds, min(width, ds.shape[1]))
            ids, ds = np.take_along_axis(ids, near, 1), np.take_along_axis(ds, near, 1)
            links[start:stop] = diverse(x, ids, ds, m)
            self._back(links, x, norms, start, stop, m)
            start = stop
        return links

    @staticmethod
    def _back(links: np.ndarray, x: np.ndarray, norms: np.ndarray, start: int, stop: int, m: int) -> None:
        """Link the batch's neighbours back; those with too many keep a diverse choice."""
        new = links[start:stop]
        source = np.repeat(np.arange(start, stop, dtype=np.int32), new.shape[1])[new.ravel() >= 0]
        target = new.ravel()[new.ravel() >= 0]
        twice = (links[target] == source[:, None]).any(axis=1)
        source, target = source[~twice], target[~twice]
        if not len(target):
            return
        d = norms[source] + norms[target] - 2 * np.einsum("ij,ij->i", x[source], x[target])
        order = np.lexsort((d, target))
        source, target = source[order], target[order]
        nodes, first, n = np.unique(target, return_index=True, return_counts=True)
        rank = np.arange(len(target)) - np.repeat(first, n)
        kept = rank < 2 * m  # the nearest of a hub's new neighbours
        more = np.full((len(nodes), min(2 * m, int(n.max()))), -1, np.int32)
        more[np.repeat(np.arange(len(nodes)), n)[kept], rank[kept]] = source[kept]
        ids = np.concatenate([links[nodes], more], axis=1)
        ds = norms[nodes, None] + norms[ids] - 2 * np.matmul(x[ids], x[nodes][:, :, None])[:, :, 0]
        ds[ids < 0] = np.inf
        near = np.argsort(ds, axis=1, kind="stable")
        ids, ds = np.take_along_axis(ids, near, 1), np.take_along_axis(ds, near, 1)
        few = (ids >= 0).sum(axis=1) <= m
        out = ids[:, :m].copy()
        if (~few).any():
            out[~few] = diverse(x, ids[~few], ds[~few], m)
        links[nodes] = out

    def entries(self, q: np.ndarray) -> np.ndarray:
        """Where each query enters the layer below those built: down from the top, nearest by nearest."""
        at = np.zeros((len(q), 1), np.int32)
        for links in self.levels[::-1]:
            at = beam(self.x[: len(links)], self.norms[: len(links)], links, q, at, 4)[0]
            at = np.where(at < 0, at[:, :1], at)[:, :1]
        return at

    def search(self, q: np.ndarray, width: int, starts: np.ndarray | None = None) -> np.ndarray:
        """Nodes of the largest inner products with each query that the search finds, -1 behind. starts: nodes that all searches of the lowest layer start from, instead of where the layers above lead."""
        # A query's length changes no order of inner products, so that tiny and huge ones lose no precision.
        length = np.sqrt(np.einsum("ij,ij->i", q, q))[:, None]
        scale = np.sqrt(self.norms.max(initial=0)) or 1.0
        q = np.concatenate([q / np.where(length > 0, length, 1) * scale, np.zeros((len(q), 1))], axis=1).astype(np.float32)
        lowest, self.levels = self.levels[0], self.levels[1:]
        entries = self.entries(q) if starts is None else np.tile(starts.astype(np.int32), (len(q), 1))
        self.levels = [lowest, *self.levels]
        return beam(self.x, self.norms, lowest, q, entries, width)[0]


class Shard:
    """A shard that answers: its graph, the original vectors in the graph's order, and each node's ids, in order."""

    def __init__(self, row: dict) -> None:
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(row["nodes"], row["dim"])
        self.ids, self.starts = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["starts"], np.int64)
        links = [np.frombuffer(x["neighbours"], np.int32).reshape(x["nodes"], x["width"]) for x in row["levels"]]
        self.graph = Graph(self.vectors / (np.abs(self.vectors).max(initial=0) or 1.0), links)
        self.sizes = np.diff(self.starts)
        self.order = np.argsort(self.ids, kind="stable")
        self.ordered, self.holder = self.ids[self.order], np.repeat(np.arange(len(self.sizes)), self.sizes)[self.order]

    def holders(self, query_id: int) -> np.ndarray:
        """The node of each row that has the query's id."""
        return self.holder[np.searchsorted(self.ordered, query_id) : np.searchsorted(self.ordered, query_id, "right")]

    def nodes(self, asked: np.ndarray, q: np.ndarray, k: int, width: int) -> list[np.ndarray]:
        """Nodes for each query that hold k ids other than its own, or all there are; searches that found fewer are widened, and in the end start everywhere."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(q)
        left, width, everywhere = np.arange(len(q)), max(width, k), False
        while len(left):
            for i, at in zip(left, self.graph.search(q[left], width, np.arange(len(self.vectors)) if everywhere else None), strict=True):
                out[i] = at[at >= 0]
            if everywhere:
                break
            short = []
            for i in left:
                own = self.holders(asked[i])
                held = self.sizes[out[i]].sum() - np.isin(own, out[i]).sum()
                short.append(held < min(k, len(self.ids) - len(own)))
            left, everywhere = left[np.array(short, bool)], width >= len(self.vectors)
            width = min(2 * width, len(self.vectors))
        return out

    def answer(self, asked: np.ndarray, q: np.ndarray, k: int, width: int) -> Answer:
        """At least the k best of the found ids but each query's own, scored in doubles from the original vectors."""
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for i, at in enumerate(self.nodes(asked, q, k, width)):
            s = (self.vectors[at] * q[i]).sum(axis=1)
            order = np.argsort(-s, kind="stable")
            at, s = at[order], s[order]
            if len(at) > k + 1:  # what ties with the last that can be needed stays
                at = at[s >= s[k]]
            # Ids of a node are in order: its first k and the query's own hold all that can be among the k best.
            spans = [self.ids[self.starts[n] : self.starts[n + 1]] for n in at]
            spans = [x[: k + int(np.searchsorted(x, asked[i], "right") - np.searchsorted(x, asked[i]))] if len(x) > k else x for x in spans]
            ids = np.concatenate(spans) if spans else np.zeros(0, np.int64)
            scores = np.repeat(s[: len(at)], [len(x) for x in spans])
            ids, scores = ids[ids != asked[i]], scores[ids != asked[i]]
            top = np.lexsort((ids, -scores))[:k]
            out.append((np.full(len(top), i), ids[top], scores[top]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return columns[0].astype(np.int64), columns[1], columns[2]


def build(rows: DataFrame, shard_rows: int = 1 << 13, m: int = 24, width: int = 96) -> DataFrame:
    """The index: a row of INDEX for each shard of about `shard_rows` rows of one dimension, kept in the shared folder."""

    def one(t: pa.Table) -> pa.Table:
        dim = t["dim"][0].as_py()
        ids, v = t["id"].to_numpy(), matrix(t["v"], dim)
        order = np.lexsort((ids, *v.T)) if dim else np.argsort(ids)
        ids, v = ids[order], v[order]
        first = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]).any(axis=1)]))
        unit = np.abs(v[first]).max(initial=0) or 1.0
        g = Graph.build(v[first] / unit, m, width)
        spans = np.split(ids, first[1:])
        spans = [spans[i] for i in g.order]
        starts = np.concatenate([[0], np.cumsum([len(s) for s in spans])]).astype(np.int64)
        levels = [{"nodes": len(x), "width": x.shape[1], "neighbours": x.tobytes()} for x in g.levels]
        data = [[dim], [t["block"][0].as_py()], [len(first)], [v[first][g.order].tobytes()], [np.concatenate(spans).tobytes()], [starts.tobytes()], [levels]]
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.struct([("nodes", pa.int32()), ("width", pa.int32()), ("neighbours", pa.binary())])))
        return pa.table([pa.array(c, k) for c, k in zip(data, kinds, strict=True)], names=["dim", "block", "nodes", "vectors", "ids", "starts", "levels"])

    return materialise(dealt(rows, shard_rows).groupBy("dim", "block").applyInArrow(one, INDEX))


def search(index: DataFrame, queries: DataFrame, k: int, width: int = 224, chunk: int = 256, held: int = 16, tasks: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: of the rows of other ids, the k of largest inner product that the graphs find; all of them, if fewer.

    queries: (id, v, dim) of usable vectors. Scores are taken anew in doubles from the original vectors; ties go to the
    smaller vec_id. A repeated id counts as often as it has rows; equal query rows are answered once, rows of one id with other
    vectors each. No rows or no queries give no rows; vectors only meet those of their dimension. Every shard's search is of the
    graph, `width` nodes wide, k at least; where it reaches fewer than k ids it is widened until it does or all are reached.
    chunk: queries to a packet. held: shards that a task may hold at once.
    """
    return best(met(index, queries, k, chunk, held, Shard, lambda shard, asked, q: shard.answer(asked, q, k, width), "double", tasks), k)


def vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v, dim) of the rows that take part: zero vectors, nulls and those with null or non-finite components don't."""
    return usable(df, key, vector, zero=False).where(F.col("dim") > 0)
