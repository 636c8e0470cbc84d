"""Document quality by Bradley-Terry ranking of preference pairs.

Each pair holds a document that is labelled good and one that is labelled bad, and all such
pairs count. The strength of a document is linear in its features; the chance that the good one
of a pair is preferred is the logistic function of the difference of strengths. So the model is
fitted by logistic loss on feature differences. The pairs are never made: the loss depends on
two strengths alone and is smooth, so a row is replaced by its share in a few nodes near its
strength (polynomial interpolation), and the pairs of nodes are summed. The cut between good and bad is that quantile of the strengths of the
training rows which tells their classes apart best; the score is logistic in the strength and
0.7 at the cut.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from roomledger.llm.common import labelled_sample, written
from roomledger.operators.blocks import with_blocks

CUT_SCORE = 0.7
QUANTILES = 1000
PENALTY = 1.0
# Strengths are cut into cells; a polynomial through the nodes of a cell gives the loss of its
# rows to about eight digits.
CELL_WIDTH = 2.0
NODES = 10
# Sums differ in their last digits with the order of the rows; these digits are kept.
MOMENT_DIGITS = 9
WEIGHT_DECIMALS = 6

_CLASS = np.zeros(256, np.int64)  # letters and bytes above ASCII: 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
for _b in b"#*$%&<>^~=+_\\{}@":
    _CLASS[_b] = 4
_CLASS[ord("!")] = 5
_CLASS[ord("|")] = 6
for _b in b".,;:?'\"-()[]/`":
    _CLASS[_b] = 7
N_CLASSES = 8


def features(text: str) -> np.ndarray:
    """Shares and logarithms that do not depend on the language; all zero but one if empty."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return np.array([0.0] * (N_FEATURES - 1) + [1.0])
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    by_class = np.bincount(_CLASS, weights=by_byte, minlength=N_CLASSES)
    marks = by_class[4:7] / n
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated_lines = 1 - len(set(lines)) / len(lines)
    following = Counter(zip(words, words[1:]))
    repeated_pairs = 1 - len(following) / max(1, n - 1)
    in_a_row = sum(map(bytes.__eq__, words, words[1:])) / n
    size = len(raw) - by_class[3]
    return np.array(
        [
            math.log1p(n),
            min(1.0, n / 50),
            size / n / 10,
            min(marks[0], 1.0),
            min(marks[1], 1.0),
            min(marks[2], 1.0),
            float(marks[0] > 0.05),
            float(marks[1] > 0.05),
            float(marks[2] > 0.05),
            by_class[1] / size,
            float(by_class[1] > 0.3 * size),
            by_class[2] / size,
            by_class[7] / n,
            1 - len(counts) / n,
            counts.most_common(1)[0][1] / n,
            repeated_pairs,
            float(repeated_pairs > 0.3),
            in_a_row,
            repeated_lines,
            math.log1p(len(lines)),
            0.0,
        ]
    )


N_FEATURES = 21


@dataclass(frozen=True)
class Model:
    """``strength`` is linear; ``cut`` is the quantile of it where the score is 0.7."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def strength(self, x: np.ndarray) -> float:
        return float(((x - self.mean) / self.scale) @ self.weights)

    def score(self, text: str) -> float:
        z = math.log(CUT_SCORE / (1 - CUT_SCORE)) + self.slope * (self.strength(features(text)) - self.cut)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _indifferent() -> Model:
    zeros = np.zeros(N_FEATURES)
    return Model(zeros, np.ones(N_FEATURES), zeros, -1.0, 1.0)


# All pairs

_AT = np.polynomial.chebyshev.chebpts1(NODES)
_TO_NODES = np.polynomial.chebyshev.chebvander(_AT, NODES - 1).T * (2 / NODES)
_TO_NODES[0] /= 2

Sums = dict[tuple[bool, int], np.ndarray]
"""(good, cell): for each node of the cell the sums of 1, the features and their products."""


def _strengths(z: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return (z * weights).sum(axis=1)  # a row's sum does not depend on the other rows


def _add(sums: Sums, z: np.ndarray, good: np.ndarray, weights: np.ndarray) -> None:
    """Add rows to the nodes near their strengths."""
    place = _strengths(z, weights) / CELL_WIDTH
    cell = np.floor(place).astype(np.int64)
    share = np.polynomial.chebyshev.chebvander(2 * (place - cell) - 1, NODES - 1) @ _TO_NODES
    i, j = np.triu_indices(z.shape[1])
    for key in set(zip(good.tolist(), cell.tolist())):
        rows = (good == key[0]) & (cell == key[1])
        part = z[rows]
        held = share[rows].T @ np.column_stack([np.ones(len(part)), part, part[:, i] * part[:, j]])
        sums[key] = sums[key] + held if key in sums else held


def _nodes(sums: Sums, good: bool, k: int) -> tuple[np.ndarray, ...]:
    """Strengths of the nodes of a class, and their sums of rows, features and products."""
    cells = sorted(c for g, c in sums if g == good)
    held = np.concatenate([sums[good, c] for c in cells])
    at = np.concatenate([CELL_WIDTH * (c + (_AT + 1) / 2) for c in cells])
    return at, held[:, 0], held[:, 1 : k + 1], held[:, k + 1 :]


def _pair_loss(sums: Sums, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and curvature over all pairs of a good and a bad row, with the prior.

    The pairs weigh as much as the rows together.
    """
    k = len(weights)
    at, n, x, xx = _nodes(sums, True, k)
    at_bad, n_bad, x_bad, xx_bad = _nodes(sums, False, k)
    loss, gradient, cross = 0.0, np.zeros(k), np.zeros((k, k))
    products, of_bad = np.zeros(xx.shape[1]), np.zeros(len(at_bad))
    for part in np.split(np.arange(len(at)), len(at) // NODES):  # the nodes of a cell with all bad ones
        apart = at[part, None] - at_bad
        lost = 1 / (1 + np.exp(np.clip(apart, -700, 700)))
        bend = lost * (1 - lost)
        loss += n[part] @ np.logaddexp(0, -apart) @ n_bad
        gradient -= x[part].T @ (lost @ n_bad) - (n[part] @ lost) @ x_bad
        products += (bend @ n_bad) @ xx[part]
        of_bad += n[part] @ bend
        cross += x[part].T @ bend @ x_bad
    products += of_bad @ xx_bad
    curvature = np.zeros((k, k))
    curvature[np.triu_indices(k)] = products
    curvature = curvature + np.triu(curvature, 1).T - cross - cross.T
    weight = (n.sum() + n_bad.sum()) / (n.sum() * n_bad.sum())
    return (
        weight * loss + PENALTY / 2 * weights @ weights,
        weight * gradient + PENALTY * weights,
        weight * curvature + PENALTY * np.eye(k),
    )


def _newton(sums: Callable[[np.ndarray], Sums], k: int, steps: int = 60) -> np.ndarray:
    """The weights of least loss; ``sums`` gives the node sums of all rows for given weights."""
    w = np.zeros(k)
    loss, gradient, curvature = _pair_loss(sums(w), w)
    for _ in range(steps):
        step = np.linalg.solve(curvature, gradient)
        while True:
            new = w - step
            there = _pair_loss(sums(new), new)
            if there[0] <= loss + 1e-9 * abs(loss) or np.abs(step).max() < 1e-7:
                break
            step /= 2
        w, (loss, gradient, curvature) = new, there
        if np.abs(step).max() < 1e-7:
            break
    return np.round(w, WEIGHT_DECIMALS)


def _wanted(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the quantiles among ``n`` sorted strengths, and their neighbours."""
    place = np.arange(QUANTILES) / QUANTILES * (n - 1)
    return place, np.floor(place).astype(np.int64), np.ceil(place).astype(np.int64)


def _best_quantile(keys: np.ndarray, n_good: int, n_bad: int) -> float:
    """The quantile that tells the classes apart best.

    ``keys`` has a row for each different strength that a quantile lies at or next to: the
    strength, the rows below it and up to it, and the good ones of both, in order.
    """
    place, low, high = _wanted(n_good + n_bad)
    at, above = (keys[np.searchsorted(keys[:, 2], ranks, side="right")] for ranks in (low, high))
    cuts = at[:, 0] + (above[:, 0] - at[:, 0]) * (place - low)
    exact = cuts <= at[:, 0]
    below, good_below = np.where(exact, at[:, 1], at[:, 2]), np.where(exact, at[:, 3], at[:, 4])
    cuts, first = np.unique(cuts, return_index=True)
    kept = 1 - good_below[first] / n_good
    rejected = (below - good_below)[first] / n_bad
    # good rows lost count more than bad rows kept
    gain = 2 * kept + rejected
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float(cuts[best[len(best) // 2]])


def _rounded(x: Sequence[float]) -> np.ndarray:
    return np.array([float(f"{v:.{MOMENT_DIGITS}g}") for v in x])


def fit_pairs(x: np.ndarray, good: np.ndarray) -> Model:
    """Bradley-Terry on all pairs of a good and a bad row of an array; ``fit`` is for tables."""
    if good.all() or not good.any():
        return _indifferent()
    mean, scale = _rounded(x.mean(axis=0)), _rounded(np.maximum(x.std(axis=0), 1e-6))
    z = (x - mean) / scale

    def sums(weights: np.ndarray) -> Sums:
        found: Sums = {}
        _add(found, z, good, weights)
        return found

    weights = _newton(sums, x.shape[1])
    strength = _strengths(z, weights)
    values, at, rows = np.unique(strength, return_inverse=True, return_counts=True)
    through, good_rows = np.cumsum(rows), np.bincount(at, weights=good)
    keys = np.column_stack([values, through - rows, through, np.cumsum(good_rows) - good_rows, np.cumsum(good_rows)])
    cut = _best_quantile(keys, int(good.sum()), int((~good).sum()))
    below = strength[strength < cut]
    return Model(mean, scale, weights, (cut + below.max()) / 2 if len(below) else cut, 1.0)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, N_FEATURES)


def _sums_on_spark(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray) -> Sums:
    """The node sums of a table (x, good): each task's, added up by cell."""
    kind = "good boolean, cell bigint, held array<double>"

    def made(sums: Sums) -> pa.RecordBatch:
        columns = [pa.array([g for g, _ in sums], pa.bool_()), pa.array([c for _, c in sums], pa.int64())]
        held = pa.array([v.ravel() for v in sums.values()], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([*columns, held], ["good", "cell", "held"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Sums = {}
        for batch in batches:
            if batch.num_rows:
                _add(sums, (_matrix(batch) - mean) / scale, batch.column("good").to_numpy(zero_copy_only=False), weights)
        yield made(sums)

    def merged(table: pa.Table) -> pa.Table:
        key = table["good"][0].as_py(), table["cell"][0].as_py()
        return pa.Table.from_batches([made({key: np.sum([h.values.to_numpy() for h in table["held"]], axis=0)})])

    found = rows.mapInArrow(run, kind).groupBy("good", "cell").applyInArrow(merged, kind).collect()
    return {(r["good"], r["cell"]): np.array(r["held"]).reshape(NODES, -1) for r in found}


def _quantile_keys(strengths: DataFrame, n: int) -> np.ndarray:
    """``keys`` of ``_best_quantile`` for a table (strength, good): counts within ordered blocks."""
    keys = strengths.groupBy(F.struct("strength").alias("key")).agg(
        F.count("*").alias("rows"), F.sum(F.col("good").cast("long")).alias("good_rows")
    )
    cut, _ = with_blocks(keys, "key", [False], "rows")
    cut = cut.select("key.strength", "rows", "good_rows", "__block")
    # one row for each block, of which there are a bounded number
    earlier = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = cut.groupBy("__block").agg(F.sum("rows").alias("rows"), F.sum("good_rows").alias("good_rows"))
    before = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("rows", "good_rows")]
    within = Window.partitionBy("__block").orderBy("strength")
    through = {c: F.sum(c).over(within) + F.col(f"{c}_before") for c in ("rows", "good_rows")}
    counted = cut.join(F.broadcast(blocks.select("__block", *before)), "__block").select(
        "strength",
        (through["rows"] - F.col("rows")).alias("below"),
        through["rows"].alias("through"),
        (through["good_rows"] - F.col("good_rows")).alias("good_below"),
        through["good_rows"].alias("good_through"),
    )
    _, low, high = _wanted(n)
    ranks = np.union1d(low, high)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = np.searchsorted(ranks, batch.column("below").to_numpy())
            yield batch.filter(pa.array(first < np.searchsorted(ranks, batch.column("through").to_numpy())))

    kept = counted.mapInArrow(run, "strength double, below bigint, through bigint, good_below bigint, good_through bigint")
    return np.array(sorted(map(tuple, kept.collect())), float)


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, limit: int | None = None) -> Model:
    """Fit on all labelled documents (doc_id, quality) that are not held out.

    Rows of a document with equal features count once, so that copies outweigh no other
    document. Without rows of both classes nothing is preferred and every score is above 0.7.
    A ``limit`` takes at most so many documents, those with the smallest hashes of their ids.
    What comes to the driver are sums for the nodes of the cells and the rows next to quantiles.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t or "").tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    # features are joined, not texts: they are small enough to be sent
    measured = docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(measure, f"doc_id {kind}, x array<double>")
    labelled = measured.join(labelled_sample(labels, "quality", held_out, limit), "doc_id").distinct()
    rows = written(labelled.select("x", (F.col("label") > 0).alias("good")), "features")
    n = {r["good"]: r["count"] for r in rows.groupBy("good").count().collect()}
    if len(n) < 2:
        return _indifferent()
    sides = [side(F.col("x")[i]).alias(f"{name}{i}") for name, side in (("m", F.avg), ("s", F.stddev_pop)) for i in range(N_FEATURES)]
    found = np.array(rows.agg(*sides).first())
    mean, scale = _rounded(found[:N_FEATURES]), _rounded(np.maximum(found[N_FEATURES:], 1e-6))
    weights = _newton(lambda w: _sums_on_spark(rows, mean, scale, w), N_FEATURES)

    def strength(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = _strengths((_matrix(batch) - mean) / scale, weights)
                yield pa.RecordBatch.from_arrays([pa.array(found), batch.column("good")], ["strength", "good"])

    strengths = written(rows.mapInArrow(strength, "strength double, good boolean"), "strengths")
    cut = _best_quantile(_quantile_keys(strengths, sum(n.values())), n[True], n[False])
    below = strengths.where(F.col("strength") < cut).agg(F.max("strength")).first()[0]
    return Model(mean, scale, weights, cut if below is None else (cut + below) / 2, 1.0)


def score(docs: DataFrame, model: Model, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` of each row and its ``quality`` (0 to 1).

    A null text is empty; an empty text has features of its own. Rows are scored one by one:
    repeated rows give repeated results, other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            scores = pa.array([model.score(t or "") for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([*map(batch.column, carry), scores], [*carry, "quality"])

    rows = docs.select(*dict.fromkeys([*carry, "text"]))
    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carry]
    return rows.mapInArrow(run, ", ".join([*kinds, "quality double"]))
