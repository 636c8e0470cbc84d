"""Quality rules with an isolation forest on their statistics.

Each text is described by counts (words, symbols, repeated lines and so on). Trees of random
splits are grown on all documents, each tree on a share of them; a document that such splits
isolate after few steps is an anomaly. The anomaly score above which a document is rejected is
calibrated on all labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.llm.common import labelled_sample, written
from roomledger.operators.quantiles import exact_quantiles

TREES = 128
# A tree gets this many rows at least, if there are as many.
ROWS_PER_TREE = 256
# Share of the rows labelled good that calibration may reject, at most.
GOOD_ROWS_LOST = 0.002

LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of the words

_SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_pipes", "n_exclamations", "n_distinct"]


def _code(words: Sequence[bytes]) -> tuple[np.ndarray, int]:
    numbers: dict[bytes, int] = {}
    known = numbers.setdefault
    return np.array([known(w, len(numbers)) for w in words], np.int64), len(numbers)


def repeated_words(codes: np.ndarray, n_codes: int) -> int:
    """Words that lie in a window of three words which occurs at least twice."""
    if len(codes) < 4:
        return 0
    pairs = codes[:-1] * n_codes + codes[1:]
    if n_codes > 1 << 20:  # three codes would not fit into 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * n_codes + codes[2:]
    order = np.argsort(windows, kind="stable")
    equal = np.diff(windows[order]) == 0
    twice = np.zeros(len(windows), bool)
    twice[order[1:]] = equal
    twice[order[:-1]] |= equal
    covered = np.zeros(len(codes), bool)
    for shift in range(3):
        covered[shift : shift + len(windows)] |= twice
    return int(covered.sum())


def counts(text: str) -> list[int]:
    """``COUNTS`` of a text; words are runs other than blanks and control white space."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    codes, n_codes = _code(words)
    blank = int(by_byte[9:14].sum() + by_byte[32])
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    return [
        len(words),
        len(text) - blank,
        int(by_byte[list(_SYMBOLS)].sum()),
        len(lines) - len(set(lines)),
        repeated_words(codes, n_codes),
        len(lines),
        int(by_byte[65:91].sum()),
        int(by_byte[ord("|")]),
        int(by_byte[ord("!")]),
        n_codes,
    ]


def statistics(rows: np.ndarray) -> np.ndarray:
    """What the trees split on, from ``COUNTS``: shares that hardly depend on the length.

    Mean word length, symbols, repeated lines, words in repeated windows, capitals, bars,
    exclamation marks, different words and words per line, all as they are.
    """
    n, lines = np.maximum(rows[:, 0], 1), np.maximum(rows[:, 5], 1)
    return np.column_stack(
        [
            rows[:, 1] / n,
            rows[:, 2] / n,
            rows[:, 3] / lines,
            rows[:, 4] / n,
            rows[:, 6] / np.maximum(rows[:, 1], 1),
            rows[:, 7] / n,
            rows[:, 8] / n,
            rows[:, 9] / n,
            rows[:, 0] / lines,
        ]
    )


N_STATISTICS = 9
# A scale is the range of the middle half of all documents, and this at least.
SCALE_RANGE = (0.25, 0.75)
LEAST_SCALE = 0.05


def scale_of(rows: DataFrame) -> np.ndarray:
    """The usual range of each statistic in ``s``; the rows are divided by it before trees are grown."""
    values = rows.select(F.posexplode("s").alias("statistic", "value"))
    found = exact_quantiles(values, "value", dict(zip(("low", "high"), SCALE_RANGE)), ["statistic"])
    scale = np.ones(N_STATISTICS)
    for r in found.collect():
        scale[r["statistic"]] = max(r["high"] - r["low"], LEAST_SCALE)
    return scale


def base_failed(found: Sequence[int]) -> bool:
    return found[0] < LEAST_WORDS or 100 * found[4] > MOST_REPEATED * found[0]


# The forest


def mean_path(n: float) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    if n < 2:
        return 0.0
    return 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


@dataclass(frozen=True)
class Forest:
    """Flat arrays over all trees: a node's split, and at a leaf its path length."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    rows_per_tree: int
    depth: int

    def reach(self, x: np.ndarray, node: np.ndarray) -> np.ndarray:
        """The nodes without a split at which rows arrive that start at ``node``."""
        at_row = np.arange(len(x))
        for _ in range(self.depth):
            f = self.feature[node]
            inner = f >= 0
            if not inner.any():
                break
            less = x[at_row, np.maximum(f, 0)] < self.split[node]
            node = np.where(inner, np.where(less, self.left[node], self.right[node]), node)
        return node

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 to the power of minus the mean path over that of random data: 0 to 1."""
        total = np.zeros(len(x))
        for root in self.roots:
            total += self.path[self.reach(x, np.full(len(x), root))]
        normal = mean_path(self.rows_per_tree) or 1.0
        return 2.0 ** (-total / max(1, len(self.roots)) / normal)


@dataclass(frozen=True)
class Rows:
    """A table (number, s) of ``n`` rows: a random number and statistics, still to be divided by ``scale``."""

    table: DataFrame
    n: int
    scale: np.ndarray

    def __len__(self) -> int:
        return self.n


def _arrivals(
    forest: Forest, x: np.ndarray, numbers: np.ndarray, shares: int, first: int
) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the nodes from ``first`` on that they reach, each row in ``shares`` trees.

    A row's number gives its first tree and an odd step to the next ones; the steps repeat no
    tree where the number of trees is a power of two.
    """
    trees = len(forest.roots)
    places, nodes = [], []
    for j in range(shares):
        tree = (numbers % trees + j * (2 * (numbers // trees % trees) + 1)) % trees
        node = forest.reach(x, forest.roots[tree])
        places.append(np.flatnonzero(node >= first))
        nodes.append(node[places[-1]])
    return np.concatenate(places), np.concatenate(nodes)


def _ranges(x: np.ndarray | Rows, forest: Forest, numbers: np.ndarray | None, shares: int, first: int):
    """(node, rows, lowest, highest values) of the nodes from ``first`` on, in their order."""
    if isinstance(x, Rows):
        return _ranges_on_spark(x, forest, shares, first)
    places, nodes = _arrivals(forest, x, numbers, shares, first)
    order = np.argsort(nodes, kind="stable")
    found, starts, n = np.unique(nodes[order], return_index=True, return_counts=True)
    part = x[places[order]]
    return zip(found, n, np.minimum.reduceat(part, starts), np.maximum.reduceat(part, starts))


def _ranges_on_spark(x: Rows, forest: Forest, shares: int, first: int):
    """The same over a table: a row for each arrival, merged before it is sent."""
    scale = x.scale
    names = [f"s{i}" for i in range(N_STATISTICS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column("s").flatten().to_numpy().reshape(-1, N_STATISTICS) / scale
            places, nodes = _arrivals(forest, values, batch.column("number").to_numpy(), shares, first)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), *map(pa.array, values[places].T)], ["node", *names])

    reached = x.table.select("number", "s").mapInArrow(run, ", ".join(["node bigint", *(f"{c} double" for c in names)]))
    spans = [F.array(*[side(c) for c in names]).alias(out) for side, out in ((F.min, "low"), (F.max, "high"))]
    # at most as many rows as a level of all trees has nodes
    found = reached.groupBy("node").agg(F.count("*").alias("n"), *spans).collect()
    return [(r["node"], r["n"], np.array(r["low"]), np.array(r["high"])) for r in sorted(found, key=lambda r: r["node"])]


def grow(x: np.ndarray | Rows, trees: int = TREES, rows: int = ROWS_PER_TREE, seed: int = 7) -> Forest:
    """Trees split at random to a depth of log2(rows), which together hold every row of ``x``.

    Each row stands in as many trees as it takes to give a tree ``rows`` rows, in one at least
    and in all at most, so a tree of a large table has more. The trees grow level by level: a
    node is split between the lowest and the highest of all its rows, and a node without a
    split knows how many rows it has. A column is split with a chance in proportion to its
    range, so that ordinary spread in the other columns does not hide rows that stand far out
    in one.
    """
    draw = np.random.default_rng(seed)
    size = len(x)
    trees = trees if size else 0
    shares = min(trees, -(-trees * rows // max(1, size)))
    depth = max(1, math.ceil(math.log2(max(2, min(rows, size)))))
    numbers = None if isinstance(x, Rows) else draw.integers(0, 1 << 40, size)
    nodes: list[list[float]] = [[-1, 0.0, i, i, 0.0] for i in range(max(1, trees))]  # feature, split, left, right, path

    def forest() -> Forest:
        table = np.array(nodes, float)
        whole = table[:, [0, 2, 3]].astype(np.int64)
        in_tree = round(shares * size / trees) if trees else 0
        return Forest(whole[:, 0], table[:, 1], whole[:, 1], whole[:, 2], table[:, 4], np.arange(trees), in_tree, depth)

    first = 0
    for level in range(depth + 1):
        if first == len(nodes) or not trees:
            break
        found, first = _ranges(x, forest(), numbers, shares, first), len(nodes)
        for at, n, low, high in found:
            nodes[at][4] = level + mean_path(n)
            span = high - low
            if level < depth and span.any():
                f = int(draw.choice(len(span), p=span / span.sum()))
                left = len(nodes)
                nodes[at] = [f, draw.uniform(low[f], high[f]), left, left + 1, 0.0]
                nodes += [[-1, 0.0, child, child, level + 1.0] for child in (left, left + 1)]
    return forest()


@dataclass(frozen=True)
class Model:
    forest: Forest
    threshold: float
    scale: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The anomaly of rows of ``COUNTS``."""
        return self.forest.score(statistics(rows) / self.scale)


def threshold(scores: np.ndarray, good: np.ndarray, lost: float = GOOD_ROWS_LOST) -> float:
    """The smallest score that rejects at most the share ``lost`` of the good rows.

    Between two classes that the scores tell apart it lies half way. Without labelled rows
    nothing is rejected.
    """
    if not good.any():
        return math.inf
    order = np.sort(scores[good])[::-1]
    allowed = order[min(len(order) - 1, int(lost * len(order)))]
    above = scores[~good & (scores > allowed)]
    return between(allowed, above.min() if len(above) else None)


def between(allowed: float, above: float | None) -> float:
    """The threshold from the largest score to keep and the smallest one of a bad row above it."""
    return float(np.nextafter(allowed, 2)) if above is None else float((allowed + above) / 2)


def _measured(docs: DataFrame) -> DataFrame:
    """(doc_id, x, s): ``COUNTS`` and statistics of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = np.array([counts(t or "") for t in batch.column("text").to_pylist()])
            x = pa.array(list(found), pa.list_(pa.int64()))
            s = pa.array(list(statistics(found.astype(float))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), x, s], ["doc_id", "x", "s"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, x array<bigint>, s array<double>")


def _calibrated(rows: DataFrame, forest: Forest, scale: np.ndarray) -> float:
    """``threshold`` of the rows (s, good) that a table holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("s").flatten().to_numpy().reshape(-1, N_STATISTICS) / scale
                yield pa.RecordBatch.from_arrays([pa.array(forest.score(x)), batch.column("good")], ["score", "good"])

    scored = written(rows.select("s", "good").mapInArrow(run, "score double, good boolean"), "anomalies")
    allowed = exact_quantiles(scored.where("good"), "score", {"allowed": 1 - GOOD_ROWS_LOST}).first()["allowed"]
    if allowed is None:
        return math.inf
    above = scored.where(~F.col("good") & (F.col("score") > allowed)).agg(F.min("score")).first()[0]
    return between(allowed, above)


def fit(docs: DataFrame, labels: DataFrame, limit: int | None = None) -> Model:
    """Grow the forest on all documents and calibrate on all labelled ones (doc_id, quality).

    Rows of a document with equal counts are one, so that copies do not fill the forest. A
    ``limit`` takes at most so many labelled documents, those with the smallest hashes of their
    ids. What comes to the driver are the nodes of the trees, scales and the threshold.
    """
    measured = _measured(docs).distinct()
    # any spread of the rows over the trees will do, if it does not depend on their order
    number = F.shiftrightunsigned(F.xxhash64("doc_id", "x"), 24).alias("number")
    rows = written(measured.select("*", number), "statistics")
    n = rows.count()
    scale = scale_of(rows)
    forest = grow(Rows(rows, n, scale))
    passing = rows.where(~((F.col("x")[0] < LEAST_WORDS) | (100 * F.col("x")[4] > MOST_REPEATED * F.col("x")[0])))
    labelled = passing.join(labelled_sample(labels, "quality", F.lit(False), limit), "doc_id")
    return Model(forest, _calibrated(labelled.select("s", (F.col("label") != 0).alias("good")), forest, scale), scale)


def judge(docs: DataFrame, model: Model, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` of each row, ``COUNTS``, ``base_failed``, ``anomaly`` and ``kept``.

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated windows.
    ``kept``: neither that nor an anomaly above the threshold. A null text is empty and fails.
    Rows are judged one by one: repeated rows give repeated results.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.array([counts(t or "") for t in batch.column("text").to_pylist()], np.int64)
            scores = model.score(rows.astype(float))
            failed = (rows[:, 0] < LEAST_WORDS) | (100 * rows[:, 4] > MOST_REPEATED * rows[:, 0])
            kept = ~failed & ~(scores >= model.threshold)
            arrays = [*map(batch.column, carry), *(pa.array(rows[:, i]) for i in range(len(COUNTS)))]
            arrays += [pa.array(failed), pa.array(scores), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = [*carry, *COUNTS, "base_failed", "anomaly", "kept"]
    rows = docs.select(*dict.fromkeys([*carry, "text"]))
    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carry]
    kinds += [f"{c} bigint" for c in COUNTS]
    return rows.mapInArrow(run, ", ".join([*kinds, "base_failed boolean, anomaly double, kept boolean"]))
