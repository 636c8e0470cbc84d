"""Language-model scores by context-tree weighting over bytes.

Each byte is decomposed into binary decisions, along the Huffman code of the training texts'
bytes (every byte counts once more, so that each has a code); each decision has its own context
tree over the preceding bytes. A node's Krichevsky-Trofimov estimate and what its deeper contexts
predict are mixed by the posterior weights that the training texts give, over all depths from
0 to ``DEPTH``. As both are functions of counts, the tree is computed from the counts of byte
sequences of length ``DEPTH + 1``: bottom-up for the weights, top-down for the predictions.

A text is coded as its words (A-Z lower-cased) joined by one blank, and one end byte. Its
contexts begin with ends, as if an empty text stood before it.

The texts are cut into blocks, and a block into portions. A block sends each of its different words and sequences once,
with their counts in training texts, and gets back the word's count and the sequence's
prediction; then its texts are scored. Sequences that occur only in texts that are held out
take part with the count 0, so that their predictions come from the shorter contexts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomledger.llm.common import whole_texts, written

DEPTH = 5
#: Depth at which the tree is cut into parts; above it there are at most 256 contexts.
LOW = 2
END = b"\n"
BLOCK_BYTES = 18 << 20
PORTION_BYTES = 1 << 20
KEYS_PER_PART = 50_000
#: A context of depth 2 with more sequences is cut deeper.
HOT_KEYS = 200_000
BLANKS = re.compile(rb"[\x20\x09-\x0D]+")
LOG2 = math.log(2)


# The tree


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For positive numbers, by Stirling's series after a shift upwards."""
    x = np.asarray(x, float)
    shift = np.zeros_like(x)
    y = x.copy()
    while (small := y < 10).any():
        shift += np.where(small, np.log(y), 0)
        y = np.where(small, y + 1, y)
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of any sequence with these counts."""
    half = 2 * math.lgamma(0.5)
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - half - log_gamma(zeros + ones + 1)


def kt_one(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return (ones + 0.5) / (zeros + ones + 1)


@dataclass(frozen=True)
class Decisions:
    """The decisions of each byte: nodes (1 to 255) and bits from ``start`` on, ``length`` many."""

    node: np.ndarray
    bit: np.ndarray
    start: np.ndarray
    length: np.ndarray

    def of(self, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, node, bit) of all decisions of ``byte``, one after the other."""
        n = self.length[byte]
        row = np.repeat(np.arange(len(byte)), n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + self.start[byte][row]
        return row, self.node[at], self.bit[at]


def huffman(counts: np.ndarray) -> Decisions:
    """Decisions by the Huffman code for 256 counts plus one each."""
    heap = [(int(c) + 1, b, b) for b, c in enumerate(counts)]
    heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    for name in range(256, 511):
        (n0, _, zero), (n1, _, one) = heappop(heap), heappop(heap)
        parent[zero], parent[one] = (name, 0), (name, 1)
        heappush(heap, (n0 + n1, name, name))
    node, bit, start, length = [], [], [], []
    for byte in range(256):
        path, at = [], byte
        while at in parent:
            path.append(parent[at])
            at = parent[at][0]
        start.append(len(node))
        length.append(len(path))
        for name, taken in reversed(path):
            node.append(name - 255)
            bit.append(taken)
    return Decisions(*(np.array(x, np.int64) for x in (node, bit, start, length)))


def subtree(keys: np.ndarray, n: np.ndarray, decisions: Decisions, depth: int = DEPTH, low: int = LOW):
    """The nodes of depth ``low`` and what they predict for each key.

    ``keys`` are packed sequences of ``depth + 1`` bytes, the last of them the coded byte, and
    hold all sequences under their contexts of depth ``low``. Gives (nodes, zeros, ones,
    log_weighted) of depth ``low``, a node being the context and the decision, and for all
    decisions of the keys the probability of a 1.
    """
    row, decision, bit = decisions.of(keys & 255)
    ids, at = np.unique((((keys >> 8) << 8)[row]) | decision, return_inverse=True)
    weights = n.astype(float)[row]
    ones = np.bincount(at, weights * bit, len(ids))
    zeros = np.bincount(at, weights, len(ids)) - ones
    weighted = log_kt(zeros, ones)
    predicted = kt_one(zeros, ones)[at]
    for d in range(depth - 1, low - 1, -1):
        above = (((ids >> 8) & ((1 << 8 * d) - 1)) << 8) | (ids & 255)
        ids, to = np.unique(above, return_inverse=True)
        zeros, ones, deeper = (np.bincount(to, v, len(ids)) for v in (zeros, ones, weighted))
        own = log_kt(zeros, ones)
        weighted = np.logaddexp(own, deeper) - LOG2
        share = np.exp(own - LOG2 - weighted)
        at = to[at]
        predicted = share[at] * kt_one(zeros, ones)[at] + (1 - share[at]) * predicted
    return ids, zeros, ones, weighted, predicted


def top(zeros: np.ndarray, ones: np.ndarray, deeper: np.ndarray):
    """For depth 0 and 1: the mass they give to a 1 and to a 0, and what is left for depth 2.

    The arguments are 256 contexts by 256 decisions; ``deeper`` sums the log-weighted
    probabilities of the contexts of depth 2.
    """
    own1 = log_kt(zeros, ones)
    weighted1 = np.logaddexp(own1, deeper) - LOG2
    share1 = np.exp(own1 - LOG2 - weighted1)
    all_zeros, all_ones, below = zeros.sum(axis=0), ones.sum(axis=0), weighted1.sum(axis=0)
    own0 = log_kt(all_zeros, all_ones)
    share0 = np.exp(own0 - LOG2 - (np.logaddexp(own0, below) - LOG2))[None, :]
    p0, p1 = kt_one(all_zeros, all_ones)[None, :], kt_one(zeros, ones)
    one = share0 * p0 + (1 - share0) * share1 * p1
    zero = share0 * (1 - p0) + (1 - share0) * share1 * (1 - p1)
    return one, zero, (1 - share0) * (1 - share1)


def log10_predictions(keys: np.ndarray, predicted: np.ndarray, upper, decisions: Decisions) -> np.ndarray:
    one, zero, left = upper
    row, decision, bit = decisions.of(keys & 255)
    recent = ((keys >> 8) & 255)[row]
    rest = left[recent, decision]
    p = np.where(
        bit == 1,
        one[recent, decision] + rest * predicted,
        zero[recent, decision] + rest * (1 - predicted),
    )
    return np.bincount(row, np.log10(p), len(keys))


# Texts


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


@dataclass(frozen=True)
class Piece:
    """Words of a row that follow one another, the bytes coded before them, and whether the
    text ends with them."""

    row: int
    words: list[bytes]
    head: bytes = END * DEPTH
    last: bool = True


def pieces(row: int, raw: bytes, size: int) -> Iterator[Piece]:
    """A text in pieces of about ``size`` bytes, cut between words."""
    if len(raw) <= size:
        yield Piece(row, raw.lower().split())
        return
    raw = raw.strip()
    at, head = 0, END * DEPTH
    while gap := BLANKS.search(raw, at + size):
        words = raw[at : gap.start()].lower().split()
        yield Piece(row, words, head, False)
        head = (head + b" ".join(words[-DEPTH:]) + b" ")[-DEPTH:]
        at = gap.end()
    yield Piece(row, raw[at:].lower().split(), head)


def packed(portion: Sequence[Piece], depth: int = DEPTH):
    """(keys, valid, begins): the sequences of pieces laid one after the other, each after the
    ``depth`` bytes before it; ``valid`` where the last byte is coded; where each piece begins."""
    parts = [p.head + b" ".join(p.words) + (END if p.last else b" ") for p in portion]
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    begins = np.cumsum(lengths) - lengths
    raw = np.frombuffer(b"".join(parts), np.uint8)
    n = len(raw) - depth
    keys = np.zeros(n, np.int64)
    for i in range(depth + 1):
        keys <<= 8
        keys |= raw[i : i + n]
    valid = np.ones(n, bool)
    for b in begins[1:].tolist():
        valid[b - depth : b] = False
    return keys, valid, begins


def portions(texts: pa.Array | pa.ChunkedArray, size: int) -> Iterator[list[Piece]]:
    """The pieces of texts, about ``size`` bytes at a time, so that few words are held at once."""
    held: list[Piece] = []
    total = 0
    for row, text in enumerate(texts.cast(pa.binary())):
        for piece in pieces(row, text.as_py() or b"", size):
            held.append(piece)
            total += len(piece.head) + sum(map(len, piece.words)) + len(piece.words)
            if total >= size:
                yield held
                held, total = [], 0
    if held:
        yield held


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted runs of different keys as one; a stable sort merges them."""
    keys = np.concatenate([k for k, _ in found])
    n = np.concatenate([c for _, c in found])
    found.clear()
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else order
    return keys[first], np.add.reduceat(n, first) if len(first) else n


# Blocks


class _Blocks:
    """Numbers the blocks of a partition: a new one after ``size`` bytes of text.

    A partition that is read again in the same order is cut at the same rows.
    """

    def __init__(self, partition: int, size: int):
        self.base = partition << 24
        self.block = size
        self.size = 0

    def cut(self, batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
        lengths = pa.compute.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False) + 64
        at = 0
        for i, length in enumerate(lengths.tolist()):
            if (self.size + length) // self.block != self.size // self.block and i > at:
                yield self.base + self.size // self.block, batch.slice(at, i - at)
                at = i
            self.size += length
            if i + 1 == len(lengths):
                yield self.base + (self.size - length) // self.block, batch.slice(at)


def cut(batches: Iterator[pa.RecordBatch], blocks: _Blocks) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, part in blocks.cut(batch):
            numbers = pa.array(np.full(part.num_rows, block, np.int64))
            yield pa.RecordBatch.from_arrays([*part.columns, numbers], [*part.schema.names, "block"])


def gather(batches: Iterator[pa.RecordBatch], blocks: _Blocks, portion_bytes: int) -> Iterator[pa.RecordBatch]:
    """Each different word and sequence of a block, and its count in training texts."""
    current = None
    counts: Counter[bytes] = Counter()
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def out():
        names = ["block", "word", "gram", "n"]
        n = len(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, current, np.int64)),
                pa.array(list(counts), pa.binary()),
                pa.nulls(n, pa.int64()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            names,
        )
        counts.clear()
        keys, k = _merged(found)
        for at in range(0, len(keys), 200_000):
            part = keys[at : at + 200_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(part), current, np.int64)),
                    pa.nulls(len(part), pa.binary()),
                    pa.array(part),
                    pa.array(k[at : at + 200_000]),
                ],
                names,
            )

    def add(keys: np.ndarray, n: np.ndarray) -> None:
        """A run is merged with those before it that are not much longer."""
        found.append((keys, n))
        while len(found) > 1 and len(found[-2][0]) < 2 * len(found[-1][0]):
            found.append(_merged([found.pop(), found.pop()]))

    for batch in batches:
        for block, part in blocks.cut(batch):
            if current is not None and block != current:
                yield from out()
            current = block
            held = part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            for portion in portions(part.column("text"), portion_bytes):
                for piece in portion:
                    if held[piece.row]:
                        for w in set(piece.words):
                            counts[w] += 0
                        counts[END] += 0
                    else:
                        counts.update(piece.words)
                        counts[END] += piece.last
                keys, valid, begins = packed(portion)
                owner = np.repeat(held[[p.row for p in portion]], np.diff(np.append(begins, len(keys) + DEPTH)))[: len(keys)]
                add(*np.unique(keys[valid & ~owner], return_counts=True))
                if owner.any():
                    u = np.unique(keys[valid & owner])
                    add(u, np.zeros(len(u), np.int64))
    if current is not None:
        yield from out()


def score_block(docs: pa.Table, features: pa.Table, portion_bytes: int) -> pa.Table:
    is_word = features.column("gram").is_null()
    words, counted = (features.column(c).filter(is_word) for c in ("word", "value"))
    words = words.combine_chunks()
    counted = counted.to_numpy()
    is_gram = pa.compute.invert(is_word)
    grams, predictions = (features.column(c).filter(is_gram).to_numpy() for c in ("gram", "value"))
    del features
    order = np.argsort(grams)
    grams, predictions = grams[order], predictions[order]
    del order
    n_tokens, n_known, size = (np.zeros(docs.num_rows, np.int64) for _ in range(3))
    base, score = np.zeros(docs.num_rows), np.zeros(docs.num_rows)
    for portion in portions(docs.column("text"), portion_bytes):
        rows = np.array([p.row for p in portion])
        keys, valid, begins = packed(portion)
        coded, to = np.unique(keys[valid], return_inverse=True)
        at = np.minimum(np.searchsorted(grams, coded), len(grams) - 1)
        if (grams[at] != coded).any():
            raise ValueError("a block was read with other texts than before")
        logs = np.zeros(len(keys))
        logs[valid] = predictions[at][to]
        np.add.at(score, rows, np.add.reduceat(logs, begins))
        np.add.at(size, rows, np.diff(np.append(begins, len(keys) + DEPTH)) - DEPTH)
        del keys, valid, coded, to, at, logs
        tokens = pa.array([w for p in portion for w in (*p.words, END)], pa.binary())
        places = pa.compute.index_in(tokens, words)
        if places.null_count:
            raise ValueError("a block was read with other texts than before")
        c = counted[places.to_numpy()]
        lengths = np.array([len(p.words) + 1 for p in portion])
        ends = np.cumsum(lengths) - 1
        goes_on = np.array([not p.last for p in portion])
        counts = np.ones(len(c), np.int64)
        counts[ends[goes_on]] = 0
        first = ends + 1 - lengths
        np.add.at(n_tokens, rows, np.add.reduceat(counts, first))
        np.add.at(n_known, rows, np.add.reduceat(counts * (c > 0), first))
        np.add.at(base, rows, np.add.reduceat(counts * np.log10(c + 1), first))
    return pa.table(
        {
            "doc_id": docs.column("doc_id"),
            "held_out": docs.column("held_out"),
            "n_tokens": n_tokens,
            "n_known": n_known,
            "base_part": base,
            "score": score,
            "n_bytes": size,
        }
    )


# The model


def predictions(grams: DataFrame, hot_keys: int = HOT_KEYS) -> DataFrame:
    """(gram, value) of (gram, n): the log10 probability of a sequence's last byte.

    Parts of the tree below contexts of depth 2 are computed apart. A context with more than
    ``hot_keys`` sequences is cut at depth 3 instead, where at most 2^24 sequences can be. The
    contexts of depth 1 and their decisions, at most 65,280 rows, and the 255 decisions of each
    hot context are mixed on the driver.
    """
    of_byte = grams.groupBy(F.col("gram").bitwiseAND(F.lit(255)).alias("byte"))
    rows = of_byte.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("keys")).collect()  # at most 256
    counts = np.zeros(256, np.int64)
    for r in rows:
        counts[r["byte"]] = r["n"]
    decisions = huffman(counts)
    parts = max(64, math.ceil(sum(r["keys"] for r in rows) / KEYS_PER_PART))
    context, deeper = (F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * d) - 1)) for d in (LOW, LOW + 1))
    in_context = grams.groupBy(context.alias("context")).agg(F.count(F.lit(1)).alias("keys"))
    hot = np.sort(np.array([r["context"] for r in in_context.where(F.col("keys") > hot_keys).collect()], np.int64))
    cut_at = F.when(context.isin(hot.tolist()), deeper + F.lit(1 << 24)).otherwise(context) if len(hot) else context
    dealt = grams.withColumn("part", F.pmod(F.xxhash64(cut_at), F.lit(parts)))

    def halves(pdf: pd.DataFrame):
        """(depth, keys, n) of the sequences under ordinary and under hot contexts."""
        pdf = pdf.sort_values("gram")
        keys, n = pdf["gram"].to_numpy(), pdf["n"].to_numpy()
        below = np.isin((keys >> 8) & 0xFFFF, hot)
        for depth, which in ((LOW, ~below), (LOW + 1, below)):
            if which.any():
                yield depth, keys[which], n[which]

    def lower(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for depth, keys, n in halves(pdf):
            ids, zeros, ones, weighted, _ = subtree(keys, n, decisions, low=depth)
            above = (((ids >> 8) & ((1 << 8 * (depth - 1)) - 1)) << 8) | (ids & 255)
            above, to = np.unique(above, return_inverse=True)
            sums = [np.bincount(to, v, len(above)) for v in (zeros, ones, weighted)]
            out.append(pd.DataFrame({"depth": depth - 1, "node": above, "zeros": sums[0], "ones": sums[1], "deeper": sums[2]}))
        return pd.concat(out)

    nodes = (
        dealt.groupBy("part")
        .applyInPandas(lower, "depth int, node long, zeros double, ones double, deeper double")
        .groupBy("depth", "node")
        .agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "deeper")])
        .collect()
    )
    tables = np.zeros((3, 256 * 256))
    hot_tables = np.zeros((3, len(hot), 256))
    for r in nodes:
        if r["depth"] < LOW:
            tables[:, r["node"]] += r["zeros"], r["ones"], r["deeper"]
        else:
            hot_tables[:, np.searchsorted(hot, r["node"] >> 8), r["node"] & 255] = r["zeros"], r["ones"], r["deeper"]
    own = log_kt(*hot_tables[:2])
    hot_weighted = np.logaddexp(own, hot_tables[2]) - LOG2
    hot_share, hot_one = np.exp(own - LOG2 - hot_weighted), kt_one(*hot_tables[:2])
    for i, c in enumerate(hot.tolist()):
        at = (c & 255) << 8
        tables[:, at : at + 256] += hot_tables[0, i], hot_tables[1, i], hot_weighted[i]
    upper = top(*tables.reshape(3, 256, 256))

    def predict(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for depth, keys, n in halves(pdf):
            predicted = subtree(keys, n, decisions, low=depth)[4]
            if depth > LOW:
                row, decision, _ = decisions.of(keys & 255)
                at = np.searchsorted(hot, (keys >> 8) & 0xFFFF)[row]
                share = hot_share[at, decision]
                predicted = share * hot_one[at, decision] + (1 - share) * predicted
            out.append(pd.DataFrame({"gram": keys, "value": log10_predictions(keys, predicted, upper, decisions)}))
        return pd.concat(out)

    return dealt.groupBy("part").applyInPandas(predict, "gram long, value double")


def score(
    docs: DataFrame,
    held_out: Column,
    block_bytes: int = BLOCK_BYTES,
    portion_bytes: int = PORTION_BYTES,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """A row for each text: its log10 probability by the tree and by single words.

    Columns: doc_id, held_out, n_tokens (words and one end), n_known (tokens that occur in
    training texts), train_tokens, base_score (add-one estimate of single tokens), score,
    n_bytes (coded, with the end) and bits_per_byte. Training texts are those that are not
    held out. A null or empty text is its end. Repeated rows count and are scored as often as
    they occur; other columns are left out. Without training texts every decision
    has the probability 1/2 and ``base_score`` is 0. A very long text is a block of its own and is
    worked off in portions cut between words; a word is never cut.

    ``docs`` is read twice and must come in the same partitions with the same order, as a
    table on disk does; write other inputs first. A difference is an error, not a wrong score.
    """
    texts = whole_texts(docs).withColumn("held_out", held_out)
    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return gather(batches, _Blocks(TaskContext.get().partitionId(), block_bytes), portion_bytes)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return cut(batches, _Blocks(TaskContext.get().partitionId(), block_bytes))

    features = written(texts.mapInArrow(gathered, "block long, word binary, gram long, n long"), "features")
    words = features.where("gram IS NULL")
    of_word = Window.partitionBy("word")  # a word has a row for each block
    counted = words.select(
        "block",
        "word",
        F.sum("n").over(of_word).cast("double").alias("value"),
        (F.row_number().over(of_word.orderBy("block")) == 1).alias("first"),
    )
    counted = written(counted, "words")
    grams = features.where("gram IS NOT NULL")
    summed = written(grams.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    valued = grams.select("block", "gram").join(predictions(summed, hot_keys).hint("merge"), "gram")
    answers = counted.select(
        F.col("block").alias("to_block"), "word", F.lit(None).cast("long").alias("gram"), "value"
    ).unionByName(
        valued.select(F.col("block").alias("to_block"), F.lit(None).cast("binary").alias("word"), "gram", "value")
    )
    kind = texts.schema["doc_id"].dataType.simpleString()
    in_blocks = texts.mapInArrow(numbered, f"doc_id {kind}, text string, held_out boolean, block long")
    scored = (
        in_blocks.groupBy("block")
        .cogroup(answers.groupBy("to_block"))
        .applyInArrow(
            lambda left, right: score_block(left, right, portion_bytes),
            f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_part double, score double, n_bytes long",
        )
    )
    totals = counted.where("first").agg(
        F.coalesce(F.sum("value"), F.lit(0.0)).cast("long").alias("train_tokens"),
        F.count(F.when(F.col("value") > 0, 1)).alias("train_distinct"),
    ).first()
    tokens, distinct = totals
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base_part") - F.col("n_tokens") * math.log10(tokens + distinct + 1)).alias("base_score"),
        "score",
        "n_bytes",
        (-F.col("score") * math.log2(10) / F.col("n_bytes")).alias("bits_per_byte"),
    )
