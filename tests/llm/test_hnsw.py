import numpy as np
import pytest

from roomledger.llm import hnsw
from roomledger.llm.common import read
from roomledger.llm.queries import op10_hnsw_shards

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int"


def table(spark, rows):
    return hnsw.usable(spark.createDataFrame([(i, v, 0, 0.5, 3) for i, v in rows], SCHEMA))


def slow(rows, query_id, k):
    vectors = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    query = dict(vectors)[query_id]
    found = sorted((float(np.sqrt(((v - query) ** 2).sum())), i) for i, v in vectors if i != query_id and len(v) == len(query))
    return found[:k]


def test_recall_on_the_table(spark, sf_dir):
    got = op10_hnsw_shards(spark, sf_dir).collect()
    rows = [(r["vec_id"], r["vector"]) for r in hnsw.usable(read(spark, sf_dir, "embeddings")).collect()]
    queries = [i for i, _ in rows if i % 100 == 0]
    hits = 0
    for q in queries:
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r for r, _, _ in own] == list(range(1, 11))
        assert [(s, i) for _, i, s in own] == sorted((s, i) for _, i, s in own)
        want = {i for _, i in slow(rows, q, 10)}
        hits += len(want & {i for _, i, _ in own})
        exact = dict(rows)
        for _, i, s in own:
            assert s == pytest.approx(np.sqrt(((np.array(exact[i]) - exact[q]) ** 2).sum()))
    assert hits >= 0.95 * 10 * len(queries)


def test_shards_and_copies(spark):
    """A third of the rows are one vector; several shards; the result is exact here."""
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=6).tolist()) for i in range(400)]
    rows += [(400 + i, rows[0][1]) for i in range(200)]
    found = table(spark, rows)
    got = hnsw.nearest(found, found.where("vec_id % 100 = 0"), 10, rows_per_shard=100).collect()
    for q in range(0, 600, 100):
        own = [(r["score"], r["vec_id"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])]
        want = slow(rows, q, 10)
        assert [i for _, i in own] == [i for _, i in want]
        assert np.allclose([s for s, _ in own], [s for s, _ in want])


def test_recall_on_full_shards_of_clustered_vectors(spark):
    """Four shards of 500 rows in 20 clusters, against brute force."""
    draw = np.random.default_rng(11)
    centres = draw.normal(size=(20, 16))
    rows = [(i, (centres[i % 20] + 0.2 * draw.normal(size=16)).tolist()) for i in range(2000)]
    found = table(spark, rows)
    got = hnsw.nearest(found, found.where("vec_id % 100 = 0"), 10, rows_per_shard=500).collect()
    hits = 0
    for q in range(0, 2000, 100):
        own = {r["vec_id"] for r in got if r["query_id"] == q}
        assert len(own) == 10
        hits += len(own & {i for _, i in slow(rows, q, 10)})
    assert hits >= 0.95 * 200


def test_groups_of_queries_and_arrays(spark, monkeypatch):
    """Whatever the groups of queries, the result is the same, and a group is bounded."""
    draw = np.random.default_rng(7)
    rows = [(i, draw.normal(size=8).tolist()) for i in range(600)]
    rows += [(5000, draw.normal(size=8).tolist()) for _ in range(300)]  # one id holds a third of all rows
    found = table(spark, rows)
    asked = found.where("vec_id % 2 = 0")
    one = hnsw.nearest(found, asked, 5, rows_per_shard=200).orderBy("query_id", "rank").collect()
    many = hnsw.nearest(found, asked, 5, rows_per_shard=200, queries_per_group=40)
    assert many.orderBy("query_id", "rank").collect() == one
    assert len(one) == 5 * 301
    monkeypatch.setattr(hnsw, "SHARD_BYTES", 50 * 8 * 8)  # 50 rows of 8 components
    narrow = hnsw.nearest(found, asked, 5, rows_per_shard=200).orderBy("query_id", "rank").collect()
    same = len({(r["query_id"], r["vec_id"]) for r in narrow} & {(r["query_id"], r["vec_id"]) for r in one})
    assert same >= 0.98 * len(one)


def test_graph_is_read_back_whole():
    vectors = np.random.default_rng(2).normal(size=(300, 5))
    built = hnsw.Graph(vectors)
    again = hnsw.Graph.of_arrays(5, **built.arrays())
    for query in vectors[:40] + 0.1:
        assert again.nearest(query, 10) == built.nearest(query, 10)


@pytest.mark.parametrize("probes, least", [(3, 0.9), (6, 0.95)])
def test_cells_of_near_vectors(spark, probes, least):
    """20 clusters, one with a third of the rows and therefore several cells."""
    draw = np.random.default_rng(12)
    centres = draw.normal(size=(20, 16))
    rows = [(i, (centres[i % 20 if i % 3 else 0] + 0.2 * draw.normal(size=16)).tolist()) for i in range(2000)]
    found = table(spark, rows)
    assert hnsw.cell_centres(found, 100)[16].shape == (20, 16)
    got = hnsw.nearest(found, found.where("vec_id % 20 = 0"), 10, rows_per_shard=100, probes=probes).collect()
    hits = 0
    for q in range(0, 2000, 20):
        own = {r["vec_id"] for r in got if r["query_id"] == q}
        assert len(own) == 10
        hits += len(own & {i for _, i in slow(rows, q, 10)})
    print("recall", probes, hits / 1000)
    assert hits >= least * 1000


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]),
        (6, [float("inf"), 1.0]), (None, [1.0, 1.0]), (7, [1.0, 0.0]), (8, [0.0, 1.0]), (8, [0.0, 1.0]),
        (9, [1.0, 0.0, 0.0]), (100, [2.0, 0.0]),
    ]
    found = table(spark, rows)
    got = [tuple(r) for r in hnsw.nearest(found, found.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()]
    assert [(q, k, i) for q, k, i, _ in got] == [(0, 1, 7), (0, 2, 100), (0, 3, 8), (100, 1, 0), (100, 2, 7), (100, 3, 8)]
    near = hnsw.nearest(found, found.where("vec_id % 100 = 0"), probes=2, rows_per_shard=2)
    assert {r["query_id"] for r in near.collect()} == {0, 100}
    empty = table(spark, [])
    assert hnsw.nearest(empty, empty).count() == 0
    assert hnsw.nearest(empty, empty, probes=2).count() == 0


def test_graph_arrays_are_flat_and_bounded():
    graph = hnsw.Graph(np.random.default_rng(0).normal(size=(500, 8)))
    for layer, filled in zip(graph.layers, graph.filled):
        width = layer.shape[1]
        assert layer.dtype == np.int32 and filled.max() <= width
        for row, n in zip(layer, filled):
            assert (row[:n] >= 0).all() and (row[n:] == -1).all() and len(set(row[:n])) == n
