"""Approximate nearest neighbours: one hierarchical navigable small-world
graph per shard, stored as flat neighbour arrays, and merged shard results.

Rows are dealt to shards by a hash of their id, so that shards are even
whatever the vectors are. Each shard's graph is built in one task of bounded
size over its distinct vectors (a vector that very many rows share is one
node) and written as a row of flat arrays. A block of queries meets each
shard once; its ``k`` best of every shard are merged, nearest first, ties to
the smaller id. Distances are Euclidean in double precision on the vectors
as given.

Defined cases: rows whose id or vector is null, whose vector is empty or
zero, or holds a null or a number that is not finite, take no part; vectors
are compared with those of their own dimension; rows that share the query's
id are the query's own; an id that stands on several rows counts with its
nearest vector; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from heapq import heappop, heappush, heapreplace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tellus.llm.common import written

K = 10
#: Rows of a shard, about; queries of a block, about.
SHARD_ROWS, BLOCK_ROWS = 4096, 1024
#: Tasks that build shards, at most: four per shard, so that few share a task.
BUILD_TASKS = 10_000
#: Links of a node (twice as many in the lowest layer); width of the search
#: while building, and of the search for answers.
LINKS, BUILD_WIDTH, SEARCH_WIDTH = 14, 72, 128


class Graph:
    """Layers of links over the rows of ``x``. ``links[layer][node]``: list."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.square = (x * x).sum(1)
        self.links: list[dict[int, list[int]]] = []
        self.entry = -1

    def distance(self, q: np.ndarray, qq: float, nodes: list[int]) -> list[float]:
        """Squared distances, to steer the search."""
        return (self.square[nodes] - 2.0 * (self.x[nodes] @ q) + qq).tolist()

    def search(self, q: np.ndarray, qq: float, start: list[tuple[float, int]], width: int, layer: int) -> list[tuple[float, int]]:
        """Up to ``width`` near nodes of a layer, nearest first."""
        links, seen = self.links[layer], {n for _, n in start}
        todo, best = sorted(start), [(-d, n) for d, n in start]
        best.sort()
        while todo:
            d, node = heappop(todo)
            if len(best) >= width and d > -best[0][0]:
                break
            new = [n for n in links[node] if n not in seen]
            if not new:
                continue
            seen.update(new)
            for d, n in zip(self.distance(q, qq, new), new):
                if len(best) < width:
                    heappush(best, (-d, n))
                elif d < -best[0][0]:
                    heapreplace(best, (-d, n))
                else:
                    continue
                heappush(todo, (d, n))
        return sorted((-d, n) for d, n in best)

    def choose(self, near: list[tuple[float, int]], most: int) -> list[int]:
        """Nodes to link to: each nearer to the new node than to one chosen
        before; the nearest of the others fill up."""
        if len(near) <= most:
            return [n for _, n in near]
        nodes = [n for _, n in near]
        v = self.x[nodes]
        s = self.square[nodes]
        between = s[:, None] - 2.0 * (v @ v.T) + s[None, :]
        closest = np.full(len(nodes), np.inf)
        kept, rest = [], []
        for i, (d, n) in enumerate(near):
            if d < closest[i]:
                kept.append(n)
                if len(kept) == most:
                    break
                np.minimum(closest, between[i], out=closest)
            else:
                rest.append(n)
        return kept + rest[:most - len(kept)]

    def add(self, node: int, top: int) -> None:
        """Link a node into layers 0 to ``top``."""
        q, qq = self.x[node], float(self.square[node])
        if self.entry < 0:
            self.links = [{node: []} for _ in range(top + 1)]
            self.entry = node
            return
        near = [(self.distance(q, qq, [self.entry])[0], self.entry)]
        for layer in range(len(self.links) - 1, -1, -1):
            if layer > top:
                near = self.search(q, qq, near, 1, layer)
                continue
            near = self.search(q, qq, near, BUILD_WIDTH, layer)
            links, most = self.links[layer], LINKS * (2 if layer == 0 else 1)
            links[node] = self.choose(near, LINKS)
            for n in links[node]:
                own = links[n]
                own.append(node)
                if len(own) > most + 6:  # prune a few at a time
                    d = self.distance(self.x[n], float(self.square[n]), own)
                    links[n] = self.choose(sorted(zip(d, own)), most)
        while len(self.links) <= top:
            self.links.append({node: []})
            self.entry = node

    def nearest(self, q: np.ndarray, width: int) -> list[int]:
        qq = float(q @ q)
        near = [(self.distance(q, qq, [self.entry])[0], self.entry)]
        for layer in range(len(self.links) - 1, 0, -1):
            near = self.search(q, qq, near, 1, layer)
        return [n for _, n in self.search(q, qq, near, width, 0)]


def build(x: np.ndarray, seed: int = 0) -> Graph:
    g = Graph(x)
    tops = np.minimum((-np.log(1.0 - np.random.default_rng(seed).random(len(x))) / np.log(LINKS)).astype(int), 8)
    for node, top in enumerate(tops.tolist()):
        g.add(node, top)
    return g


def flatten(g: Graph) -> tuple[bytes, bytes, bytes]:
    """Nodes of all layers, where each node's links begin, and the links;
    layers follow one another, each headed by -1."""
    nodes, at, links = [], [0], []
    for layer in g.links:
        nodes.append(-1)
        at.append(len(links))
        for n, own in layer.items():
            nodes.append(n)
            links += own
            at.append(len(links))
    return tuple(np.array(a, np.int32).tobytes() for a in (nodes, at, links))  # type: ignore[return-value]


def restore(x: np.ndarray, entry: int, nodes: bytes, at: bytes, links: bytes) -> Graph:
    g = Graph(x)
    g.entry = entry
    nodes, at, links = (np.frombuffer(b, np.int32).tolist() for b in (nodes, at, links))
    for i, n in enumerate(nodes):
        if n < 0:
            g.links.append({})
        else:
            g.links[-1][n] = links[at[i]:at[i + 1]]
    return g


def usable(vec: Column) -> Column:
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(fine & F.exists(vec, lambda x: x != 0), F.lit(False))


def _prepared(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    d = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return d.filter(F.col("id").isNotNull() & usable(F.col("vec"))).withColumn("dim", F.size("vec"))


_INDEX = "dim int, shard int, entry int, vectors binary, nodes binary, at binary, links binary, ids binary, id_at binary"


def _build_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("id", kind="stable")
    x, node = np.unique(np.array(rows["vec"].tolist(), np.float64), axis=0, return_inverse=True)
    x = x + 0.0  # -0 becomes 0
    order = np.random.default_rng(int(key[1])).permutation(len(x))  # not by value
    rank = np.empty(len(x), np.int64)
    rank[order] = np.arange(len(x))
    x, node = np.ascontiguousarray(x[order]), rank[node.ravel()]
    g = build(x, int(key[1]))
    pairs = np.unique(np.stack([node, rows["id"].to_numpy(np.int64)], 1), axis=0)
    id_at = np.searchsorted(pairs[:, 0], np.arange(len(x) + 1)).astype(np.int64)
    return pd.DataFrame([(key[0], key[1], g.entry, x.tobytes(), *flatten(g), pairs[:, 1].tobytes(), id_at.tobytes())],
                        columns=[c.split()[0] for c in _INDEX.split(", ")])


def index(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard: its graph, vectors and ids as flat arrays."""
    d = _prepared(df, id_col, vec_col)
    shards = 1 + d.count() // shard_rows
    d = d.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    d = d.repartition(min(BUILD_TASKS, 4 * shards), "dim", "shard")
    return written(d.groupBy("dim", "shard").applyInPandas(_build_shard, _INDEX), "hnsw")


def _search_shard(k: int, width: int) -> object:
    def run(key: tuple, queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        out = []
        for s in shard.itertuples():
            x = np.frombuffer(s.vectors, np.float64).reshape(-1, int(s.dim))
            g = restore(x, int(s.entry), s.nodes, s.at, s.links)
            ids, id_at = np.frombuffer(s.ids, np.int64), np.frombuffer(s.id_at, np.int64)
            for qid, vec in zip(queries["id"], queries["vec"]):
                q = np.asarray(vec, np.float64)
                near = g.nearest(q, max(width, k + 1))
                d = np.sqrt(((x[near] - q) ** 2).sum(1))
                found: list[tuple[float, int]] = []
                known = {int(qid)}
                for j in np.lexsort((ids[id_at[near]], d)):
                    if len(found) >= k and d[j] > found[k - 1][0]:
                        break
                    own = ids[id_at[near[j]]:id_at[near[j] + 1]].tolist()  # ascending, so the first few are enough
                    new = [i for i in own[:k + len(known)] if i not in known][:k]
                    known.update(new)
                    found = sorted(found + [(float(d[j]), i) for i in new])
                out += [(int(qid), i, dist) for dist, i in found[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])
    return run


def search(shards: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
           width: int = SEARCH_WIDTH, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query."""
    q = _prepared(queries, id_col, vec_col).groupBy("id").agg(F.min("vec").alias("vec"), F.min_by("dim", "vec").alias("dim"))
    q = written(q, "queries")
    blocks = 1 + q.count() // block_rows
    q = q.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    places = shards.select(F.col("dim").alias("dim"), F.col("shard").alias("shard"))
    asked = q.join(places, "dim")  # each query goes to each shard of its dimension once
    held = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dim", "shard", "block"]
    found = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(
        _search_shard(k, width), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
