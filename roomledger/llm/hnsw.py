"""Nearest neighbours by a hierarchical navigable small-world graph per shard.

The vectors are dealt to shards, by hash or, as an option, by nearness first. Each shard builds
a graph over its different vectors, held as one flat array of neighbour numbers per layer. The
arrays are written to the shared folder once, and each meets the queries in groups of a bounded
number; a query's results of all shards are merged by their exact distances. Equal vectors of a
shard are one node, so that copies do not cut the graph into islands.
"""

from __future__ import annotations

from collections.abc import Sequence
from heapq import heappop, heappush, heapreplace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomledger.llm.common import written

ROWS_PER_SHARD = 4096
#: A shard of long vectors has fewer rows, so that its vectors take no more than this.
SHARD_BYTES = 8 << 20
#: Queries that one group holds next to the arrays of a shard, on average.
QUERIES_PER_GROUP = 1024
#: Cells of near vectors, and the rows that their centres are fitted on, at most.
MOST_CELLS = 1024
CELL_SAMPLE = 20_000
MOST_TASKS = 20_000
LINKS = 16  # per node; twice as many on the lowest layer
BREADTH_BUILD = 48
BREADTH_SEARCH = 96


class Graph:
    """``layers[l]`` holds the neighbours of each node of layer ``l``, -1 where there is none."""

    def __init__(self, vectors: np.ndarray, links: int = LINKS, breadth: int = BREADTH_BUILD, seed: int = 1):
        self.vectors = vectors
        self.squares = np.einsum("ij,ij->i", vectors, vectors)
        n = len(vectors)
        self.links, self.breadth = links, breadth
        draw = np.random.default_rng(seed)
        levels = np.minimum((-np.log(draw.uniform(1e-12, 1, n)) / np.log(links)).astype(int), 12)
        self.layers = [np.full((n, links * 2 if l == 0 else links), -1, np.int32) for l in range(int(levels.max(initial=0)) + 1)]
        self.filled = [np.zeros(n, np.int32) for _ in self.layers]
        self.mark = np.zeros(n, np.int64)
        self.round = 0
        self.entry, self.top = 0, int(levels[0]) if n else 0
        for node in range(1, n):
            self._insert(node, int(levels[node]))

    def arrays(self) -> dict:
        """The graph as flat arrays of bytes, one for each layer."""
        return {
            "vectors": self.vectors.tobytes(),
            "layers": [x.tobytes() for x in self.layers],
            "filled": [x.tobytes() for x in self.filled],
            "entry": self.entry,
        }

    @classmethod
    def of_arrays(cls, dim: int, vectors: bytes, layers: Sequence[bytes], filled: Sequence[bytes], entry: int) -> Graph:
        """The graph that ``arrays`` wrote, for searching; nothing is built again."""
        graph = cls.__new__(cls)
        graph.vectors = np.frombuffer(vectors, np.float64).reshape(-1, dim)
        graph.squares = np.einsum("ij,ij->i", graph.vectors, graph.vectors)
        graph.filled = [np.frombuffer(x, np.int32) for x in filled]
        graph.layers = [np.frombuffer(x, np.int32).reshape(len(graph.vectors), -1) for x in layers]
        graph.mark = np.zeros(len(graph.vectors), np.int64)
        graph.round, graph.entry, graph.top = 0, int(entry), len(layers) - 1
        return graph

    def _distances(self, query: np.ndarray, square: float, nodes: np.ndarray) -> np.ndarray:
        return self.squares[nodes] - 2 * (self.vectors[nodes] @ query) + square

    def _descend(self, query, square, node: int, layer: int) -> int:
        best = float(self._distances(query, square, np.array([node]))[0])
        while True:
            around = self.layers[layer][node, : self.filled[layer][node]]
            if not len(around):
                return node
            d = self._distances(query, square, around)
            k = int(d.argmin())
            if d[k] >= best:
                return node
            node, best = int(around[k]), float(d[k])

    def _search(self, query, square, start: int, layer: int, breadth: int) -> list[tuple[float, int]]:
        """The nearest found, at most ``breadth``, nearest first."""
        self.round += 1
        mark, now = self.mark, self.round
        mark[start] = now
        d = float(self._distances(query, square, np.array([start]))[0])
        open_nodes, found = [(d, start)], [(-d, start)]
        table, filled = self.layers[layer], self.filled[layer]
        while open_nodes:
            d, node = heappop(open_nodes)
            if d > -found[0][0] and len(found) >= breadth:
                break
            around = table[node, : filled[node]]
            around = around[mark[around] != now]
            if not len(around):
                continue
            mark[around] = now
            for x, y in zip(self._distances(query, square, around).tolist(), around.tolist()):
                if len(found) < breadth:
                    heappush(found, (-x, y))
                    heappush(open_nodes, (x, y))
                elif x < -found[0][0]:
                    heapreplace(found, (-x, y))
                    heappush(open_nodes, (x, y))
        return sorted((-x, y) for x, y in found)

    def _choose(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Of the nearest those that are nearer to the node than to any one chosen before."""
        if len(found) <= most:
            return [y for _, y in found]
        nodes = np.array([y for _, y in found])
        rows = self.vectors[nodes]
        apart = self.squares[nodes][:, None] - 2 * (rows @ rows.T) + self.squares[nodes][None, :]
        chosen: list[int] = []
        nearest = np.full(len(nodes), np.inf)
        for i, (d, _) in enumerate(found):
            if len(chosen) == most:
                break
            if d < nearest[i]:
                chosen.append(i)
                np.minimum(nearest, apart[i], out=nearest)
        for i in range(len(nodes)):
            if len(chosen) >= most:
                break
            if i not in chosen:
                chosen.append(i)
        return nodes[chosen].tolist()

    def _insert(self, node: int, level: int) -> None:
        query, square = self.vectors[node], float(self.squares[node])
        at = self.entry
        for layer in range(self.top, level, -1):
            at = self._descend(query, square, at, layer)
        for layer in range(min(level, self.top), -1, -1):
            found = self._search(query, square, at, layer, self.breadth)
            at = found[0][1]
            table, filled = self.layers[layer], self.filled[layer]
            most = table.shape[1]
            near = self._choose(found, self.links)
            table[node, : len(near)] = near
            filled[node] = len(near)
            for other in near:
                k = filled[other]
                if k < most:
                    table[other, k] = node
                    filled[other] += 1
                else:
                    nodes = np.append(table[other], node)
                    d = self._distances(self.vectors[other], self.squares[other], nodes)
                    order = np.argsort(d, kind="stable")
                    kept = self._choose([(float(d[i]), int(nodes[i])) for i in order], most)
                    table[other, : len(kept)] = kept
                    filled[other] = len(kept)
        if level > self.top:
            self.entry, self.top = node, level

    def nearest(self, query: np.ndarray, k: int, breadth: int = BREADTH_SEARCH) -> list[int]:
        if not len(self.vectors):
            return []
        square = float(query @ query)
        at = self.entry
        for layer in range(self.top, 0, -1):
            at = self._descend(query, square, at, layer)
        return [y for _, y in self._search(query, square, at, 0, max(k, breadth))]


GRAPH = "ids binary, begins binary, vectors binary, layers array<binary>, filled array<binary>, entry int"


def build_shard(ids: np.ndarray, vectors: np.ndarray) -> dict:
    """The arrays of a shard: its graph, and the ids of each node, which lie side by side."""
    distinct, number = np.unique(vectors, axis=0, return_inverse=True)
    order = np.lexsort((ids, number.ravel()))
    begins = np.searchsorted(number.ravel()[order], np.arange(len(distinct) + 1))
    return {"ids": ids[order].tobytes(), "begins": begins.astype(np.int64).tobytes(), **Graph(distinct).arrays()}


def search_shard(shard: dict, query_ids: np.ndarray, queries: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` nearest found rows of one shard for each query, but for the query's own id."""
    ids, begins = (np.frombuffer(shard[name], np.int64) for name in ("ids", "begins"))
    graph = Graph.of_arrays(queries.shape[1], *(shard[name] for name in ("vectors", "layers", "filled", "entry")))
    rows = []
    for query_id, query in zip(query_ids.tolist(), queries):
        nodes = np.array(graph.nearest(query, k + 1), np.int64)
        exact = np.sqrt(np.sum((graph.vectors[nodes] - query) ** 2, axis=1))
        hits = []
        for i in np.argsort(exact, kind="stable"):
            if len(hits) > k and exact[i] > hits[-1][0]:
                break
            node = nodes[i]
            members = ids[begins[node] : begins[node + 1]][: k + 1].tolist()
            hits.extend((float(exact[i]), m) for m in members if m != query_id)
        rows.extend((query_id, m, d) for d, m in sorted(hits)[:k])
    return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])


def cell_centres(table: DataFrame, rows_per_cell: int, steps: int = 8) -> dict[int, np.ndarray]:
    """Centres of cells of near vectors for each vector length, by k-means on a bounded sample.

    The sample is the ``CELL_SAMPLE`` rows with the smallest hashes. There is one cell for
    ``rows_per_cell`` rows, at most ``MOST_CELLS`` and the different rows of the sample.
    """
    n = table.count()
    sample = table.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(CELL_SAMPLE).collect()
    by_length: dict[int, list] = {}
    for r in sample:
        by_length.setdefault(len(r["vector"]), []).append(r["vector"])
    centres = {}
    for dim, rows in by_length.items():
        x = np.unique(np.array(rows, np.float64), axis=0)
        cells = max(1, min(len(x), MOST_CELLS, -(-n * len(rows) // (len(sample) * rows_per_cell))))
        c = x[np.random.default_rng(1).permutation(len(x))[:cells]]
        for _ in range(steps):
            own = (np.einsum("ij,ij->i", c, c) - 2 * x @ c.T).argmin(axis=1)
            sums = np.zeros_like(c)
            np.add.at(sums, own, x)
            held = np.bincount(own, minlength=len(c))
            c = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], c)
        centres[dim] = c
    return centres


def nearest_cells(vector: Column, centres: dict[int, np.ndarray], n: int) -> Column:
    """The numbers of the ``n`` cells nearest to a vector; cell 0 for an unknown length."""

    @F.pandas_udf("array<int>")
    def cells(vectors: pd.Series) -> pd.Series:
        out = []
        for v in vectors:
            c = centres.get(len(v))
            out.append([0] if c is None else np.argsort(((c - v) ** 2).sum(axis=1), kind="stable")[:n].tolist())
        return pd.Series(out)

    return cells(vector)


def usable(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows that take part, in double precision; a repeated row once.

    Left out: vectors that are null, empty, zero or hold a null or a component that is not
    finite, and rows without an id.
    """
    vector = F.col(vector_col).cast("array<double>")
    fit = (
        "vec_id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0"
        " AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
        " AND exists(vector, x -> x <> 0)"
    )
    return table.select(F.col(id_col).alias("vec_id"), vector.alias("vector")).where(fit).distinct()


def nearest(
    table: DataFrame,
    queries: DataFrame,
    k: int = 10,
    rows_per_shard: int = ROWS_PER_SHARD,
    queries_per_group: int = QUERIES_PER_GROUP,
    probes: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of ``table`` to each query.

    ``table`` and ``queries`` have (vec_id, vector) as ``usable`` gives them. The row with the
    query's own id is no candidate; vectors of another length are none either. Nearest first,
    of equal distances the smaller id. The graph is approximate, the distances are exact. An
    id that stands at several different vectors keeps each of them, but enters a result once.

    Without ``probes`` each shard answers each query, whatever the vectors look like: the work
    grows with the product of rows and queries. With it the rows are dealt to cells of near
    vectors, a cell of many rows to several shards, and a query goes to the shards of its
    ``probes`` nearest cells only. That keeps the recall where vectors lie in clusters; where
    they point in all directions it does not.
    """
    placed, asked = (d.withColumn("dim", F.size("vector")) for d in (table, queries))
    if probes is None:
        placed, asked = (d.withColumn("cell", F.lit(0)) for d in (placed, asked))
    else:
        centres = cell_centres(table, rows_per_shard)
        placed = placed.withColumn("cell", nearest_cells(F.col("vector"), centres, 1)[0])
        asked = asked.withColumn("cell", F.explode(nearest_cells(F.col("vector"), centres, probes)))
    shard_rows = F.greatest(F.lit(1), F.least(F.lit(rows_per_shard), F.floor(SHARD_BYTES / (8 * F.col("dim")))))
    sizes = placed.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select("dim", "cell", F.ceil(F.col("n") / shard_rows).cast("int").alias("shards"))
    blocks = asked.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / queries_per_group).cast("int").alias("blocks"))
    sizes = written(sizes.join(blocks, ["dim", "cell"]), "sizes")  # a row for each length and cell
    tasks = sizes.agg(F.sum("shards").alias("shards"), F.sum(F.col("shards").cast("long") * F.col("blocks")).alias("groups")).first()
    by_shard, by_group = (max(1, min(MOST_TASKS, n or 0)) for n in tasks)
    spread = F.xxhash64("vec_id", "vector")
    shard, group = ["dim", "cell", "shard"], ["dim", "cell", "shard", "block"]

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        made = build_shard(rows["vec_id"].to_numpy(np.int64), np.array(rows["vector"].tolist(), np.float64))
        return pd.DataFrame([{**dict(zip(shard, key)), **made}])

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        vectors = np.array(right["vector"].tolist(), np.float64)
        return search_shard(left.iloc[0].to_dict(), right["vec_id"].to_numpy(np.int64), vectors, k)

    rows = placed.join(F.broadcast(sizes), ["dim", "cell"]).withColumn("shard", F.pmod(spread, "shards").cast("int"))
    rows = rows.select(*shard, "vec_id", "vector").repartition(by_shard, *shard)
    graphs = rows.groupBy(*shard).applyInPandas(build, f"dim int, cell int, shard int, {GRAPH}")
    graphs = written(graphs, "graphs").join(F.broadcast(sizes.select("dim", "cell", "blocks")), ["dim", "cell"])
    graphs = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    asked = asked.join(F.broadcast(sizes), ["dim", "cell"]).withColumn("block", F.pmod(spread, "blocks").cast("int"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).select(*group, "vec_id", "vector")
    found = (
        graphs.repartition(by_group, *group).groupBy(*group)
        .cogroup(asked.repartition(by_group, *group).groupBy(*group))
        .applyInPandas(run, "query_id long, vec_id long, score double")
    )
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
