import math
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import ODD_ROWS
from pyspark.sql import functions as F

from roomledger.llm import ctw
from roomledger.llm.queries import op4_context_tree


class SlowTree:
    """Context-tree weighting by its recursive definition, one node at a time."""

    def __init__(self, texts):
        counts = np.zeros(256, np.int64)
        for t in texts:
            for b in self.coded(t):
                counts[b] += 1
        code = ctw.huffman(counts)
        self.path = [
            [(int(code.node[k]), int(code.bit[k])) for k in range(code.start[b], code.start[b] + code.length[b])]
            for b in range(256)
        ]
        self.counts = defaultdict(lambda: [0, 0])
        for t in texts:
            for path, bit in self.steps(t):
                for node in path:
                    self.counts[node][bit] += 1
        self.children = defaultdict(set)
        for context, node in self.counts:
            if context:
                self.children[context[1:], node].add((context, node))
        self.memo = {}

    def coded(self, text):
        return b" ".join(ctw.words_of(text)) + b"\n"

    def steps(self, text):
        raw = b"\n" * ctw.DEPTH + self.coded(text)
        for i in range(ctw.DEPTH, len(raw)):
            for node, bit in self.path[raw[i]]:
                yield [(raw[i - d : i], node) for d in range(ctw.DEPTH + 1)], bit

    def kt(self, node):
        a, b = self.counts.get(node, (0, 0))
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)

    def weighted(self, node):
        if node not in self.memo:
            own = self.kt(node)
            if len(node[0]) < ctw.DEPTH:
                own = np.logaddexp(own, sum(map(self.weighted, self.children[node]))) - math.log(2)
            self.memo[node] = own
        return self.memo[node]

    def predict(self, path, bit, depth=0):
        node = path[depth]
        a, b = self.counts.get(node, (0, 0))
        estimate = ((b if bit else a) + 0.5) / (a + b + 1)
        if depth == ctw.DEPTH:
            return estimate
        own = math.exp(self.kt(node) - math.log(2) - self.weighted(node))
        return own * estimate + (1 - own) * self.predict(path, bit, depth + 1)

    def score(self, text):
        return sum(math.log10(self.predict(p, b)) for p, b in self.steps(text))


TEXTS = ["the cat sat on the mat", "The cat\tthe hat", "a dög", "", "zz the", None, "the " * 50, "the cat"]


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 150, "portion_bytes": 9}, {"hot_keys": 2}, {"hot_keys": 0, "portion_bytes": 30}])
def test_scores_equal_brute_force(spark, documents, sizes):
    """Also in blocks of few texts, in portions of few words and with contexts cut deeper."""
    rows = [*enumerate(TEXTS), (7, "the cat")]
    held = {2, 4}
    got = ctw.score(documents(rows).coalesce(1), F.col("doc_id").isin(*held), **sizes).collect()
    assert len(got) == len(rows)
    texts = [(i, t or "") for i, t in rows]
    training = [t for i, t in texts if i not in held]
    tree = SlowTree(training)
    tokens = Counter(w for t in training for w in [*ctw.words_of(t), "end"])
    n, v = sum(tokens.values()), len(tokens)
    for r in got:
        text = dict(texts)[r["doc_id"]]
        own = [*ctw.words_of(text), "end"]
        assert r["held_out"] == (r["doc_id"] in held)
        assert (r["n_tokens"], r["train_tokens"]) == (len(own), n)
        assert r["n_known"] == sum(tokens[w] > 0 for w in own)
        assert r["base_score"] == pytest.approx(sum(math.log10((tokens[w] + 1) / (n + v + 1)) for w in own))
        assert r["score"] == pytest.approx(tree.score(text))
        assert r["bits_per_byte"] == pytest.approx(-tree.score(text) * math.log2(10) / len(tree.coded(text)))


def test_many_blocks_and_portions(spark, documents, tmp_path):
    """The features of a block show that a partition is cut into many; the scores stay the same."""
    rows = [(i, "some words " * (i % 7) + f"and {i % 13}") for i in range(300)]
    path = str(tmp_path / "docs")
    documents(rows).repartition(2).write.parquet(path)
    docs = spark.read.parquet(path)
    held = F.col("doc_id") % 3 == 0
    whole = {r["doc_id"]: r["score"] for r in ctw.score(docs, held).collect()}
    small = ctw.score(docs, held, block_bytes=2_000, portion_bytes=50, hot_keys=5)
    got = {r["doc_id"]: r["score"] for r in small.collect()}
    assert got == pytest.approx(whole, abs=1e-9)
    batch = pa.RecordBatch.from_pydict({"text": [t for _, t in rows], "held_out": [False] * len(rows)})
    found = list(ctw.gather(iter([batch]), ctw._Blocks(3, 2_000), 50))
    blocks = {b for r in found for b in r.column("block").to_pylist()}
    assert len(blocks) > 10 and min(blocks) == 3 << 24


def test_a_very_long_text_in_bounded_memory():
    """A text of 12 MB; what is held beside it does not grow with it."""
    draw = np.random.default_rng(5)
    words = [bytes(draw.integers(97, 123, k).astype(np.uint8)).decode() for k in draw.integers(2, 9, 500)]

    def peak(n):
        text = " ".join(words[i] for i in draw.integers(0, len(words), n))
        batch = pa.RecordBatch.from_pydict({"text": [text], "held_out": [False]})
        tracemalloc.start()
        found = list(ctw.gather(iter([batch]), ctw._Blocks(0, ctw.BLOCK_BYTES), 1 << 18))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        total = sum(sum(r.column("n").to_pylist()) for r in found if r.column("gram").null_count == 0)
        assert total == len(text) + 1
        return len(text), most

    short, little = peak(200_000)
    long, much = peak(2_000_000)
    assert long > 11_000_000 and much - little < 4 * (long - short)


def test_pieces_of_a_text_are_coded_as_the_whole():
    raw = b"  One two\t\nthree   FOUR fivefivefive six  "
    whole = list(ctw.pieces(0, raw, 1000))
    keys, valid, _ = ctw.packed(whole)
    for size in range(1, 30):
        cut = list(ctw.pieces(0, raw, size))
        assert [w for p in cut for w in p.words] == whole[0].words
        own, coded, _ = ctw.packed(cut)
        assert own[coded].tolist() == keys[valid].tolist()


def test_odd_rows(spark, documents):
    got = ctw.score(documents(ODD_ROWS), F.coalesce(F.col("doc_id") == 4, F.lit(False))).collect()
    assert len(got) == len(ODD_ROWS)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2, 3)}) == 1
    assert ctw.score(documents([]), F.lit(False)).count() == 0
    alone = ctw.score(documents([(1, "ab")]), F.lit(True)).first()
    assert (alone["train_tokens"], alone["n_known"], alone["base_score"]) == (0, 0, 0.0)
    code = ctw.huffman(np.zeros(256, np.int64))
    decisions = sum(int(code.length[b]) for b in b"ab\n")
    assert alone["score"] == pytest.approx(-decisions * math.log10(2))


def test_probabilities_of_a_byte_sum_to_one():
    keys = np.array([(0x0A0A0A0A61 << 8) | b for b in range(256)])
    n = np.zeros(256, np.int64)
    n[[97, 98, 10]] = 5, 2, 1
    code = ctw.huffman(n)
    ids, zeros, ones, weighted, predicted = ctw.subtree(keys, n, code)
    tables = np.zeros((3, 65536))
    at = ((ids >> 8) & 255) << 8 | (ids & 255)
    for table, v in zip(tables, (zeros, ones, weighted)):
        np.add.at(table, at, v)
    p = ctw.log10_predictions(keys, predicted, ctw.top(*tables.reshape(3, 256, 256)), code)
    assert (10**p).sum() == pytest.approx(1)


def test_whole_table(spark, sf_dir):
    rows = op4_context_tree(spark, sf_dir).collect()
    assert len(rows) == 1000
    held = [r for r in rows if r["held_out"]]
    assert sum(r["bits_per_byte"] for r in held) / len(held) < 2.4
