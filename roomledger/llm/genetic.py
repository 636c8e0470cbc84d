"""Best-fit packing by a grouping genetic algorithm on islands.

A document is cut only if it is longer than a window: into whole windows and a shorter first
piece. What is shorter than a window is packed by evolution. An individual is a set of bins. A
crossover injects well-filled bins of one parent whole into the other, removes the bins that
hold one of their pieces a second time, and puts the displaced pieces back by best fit.

Pieces are dealt to blocks by a hash. Several islands evolve a population for each block, each
in a task of its own; after every epoch the elite of an island migrates to the next one. Of the
best individual of a block the well-filled bins stay. The pieces of the others go to fewer
blocks and are packed again, until one block is left, so that only that one has windows with
much room for want of pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.llm.bytebpe import byte_encoder
from roomledger.llm.common import whole_texts, written

WINDOW = 2048
END_ID = 0
BLOCK_PIECES = 2048
ISLANDS = 3
EPOCHS = 2
POPULATION = 4
CHILDREN = 12  # of an island in an epoch
TASK_ISLANDS = 256
ELITE_SHARE = 0.4  # of a parent's bins are injected, at most
KEPT_SHARE = 512  # a window that lacks at most one in so many tokens stays after a round

# An individual: bins as lists of piece numbers, and what each of them lacks to a window.
Individual = tuple[list[list[int]], list[int]]


class Packer:
    """Evolution of one block. ``lengths`` are those of the pieces, at most ``window`` each."""

    def __init__(self, lengths: Sequence[int], window: int = WINDOW, seed: int = 0):
        self.lengths = list(lengths)
        self.window = window
        self.draw = np.random.default_rng(seed)
        self.fewest = -(-sum(self.lengths) // window)

    def best_fit(self, pieces: Sequence[int], bins: list[list[int]], room: list[int]) -> Individual:
        """Put each piece into the bin that it fills most, or into a new one."""
        gaps = sorted((r, i) for i, r in enumerate(room) if r)
        lengths = self.lengths
        for p in pieces:
            length = lengths[p]
            k = bisect_left(gaps, (length,))
            if k < len(gaps):
                r, i = gaps.pop(k)
                bins[i].append(p)
            else:
                r, i = self.window, len(bins)
                bins.append([p])
                room.append(r)
            room[i] = r - length
            if room[i]:
                insort(gaps, (room[i], i))
        return bins, room

    def decreasing(self, pieces: Sequence[int]) -> list[int]:
        return sorted(pieces, key=lambda p: (-self.lengths[p], p))

    def first(self) -> list[Individual]:
        """Best fit in decreasing order, and in orders that are decreasing but for some noise."""
        n = len(self.lengths)
        found = [self.best_fit(self.decreasing(range(n)), [], [])]
        size = np.array(self.lengths, float)
        while len(found) < POPULATION:
            noisy = size * self.draw.uniform(0.6, 1.4, n)
            found.append(self.best_fit(np.argsort(-noisy, kind="stable").tolist(), [], []))
        return found

    def fitness(self, one: Individual) -> tuple[int, float]:
        """Fewer bins are better, then fuller ones: more room in few bins."""
        return -len(one[0]), float(np.sum(np.square(np.array(one[1], float))))

    def cross(self, giver: Individual, taker: Individual) -> Individual:
        bins, room = giver
        full = sorted(range(len(bins)), key=room.__getitem__)
        share = max(1, int(len(full) * self.draw.uniform(ELITE_SHARE / 2, ELITE_SHARE)))
        chosen = self.draw.permutation(full[: 2 * share])[:share].tolist()
        injected = {p for i in chosen for p in bins[i]}
        new_bins = [list(bins[i]) for i in chosen]
        new_room = [room[i] for i in chosen]
        displaced: list[int] = []
        for own, r in zip(*taker):
            if injected.isdisjoint(own):
                new_bins.append(list(own))
                new_room.append(r)
            else:
                displaced.extend(p for p in own if p not in injected)
        return self.best_fit(self.decreasing(displaced), new_bins, new_room)

    def mutate(self, one: Individual) -> Individual:
        """Empty the bins with the most room and a few others, and put their pieces back."""
        bins, room = one
        n = len(bins)
        worst = sorted(range(n), key=room.__getitem__)[-max(2, n // 10) :]
        gone = {*worst, *self.draw.integers(0, n, max(1, n // 20)).tolist()}
        left = [i for i in range(n) if i not in gone]
        out = [p for i in gone for p in bins[i]]
        return self.best_fit(self.decreasing(out), [list(bins[i]) for i in left], [room[i] for i in left])

    def evolve(self, population: list[Individual], children: int = CHILDREN) -> list[Individual]:
        """Best first."""
        population = sorted(population, key=self.fitness, reverse=True)[:POPULATION]
        for _ in range(children):
            if self.done(population[0]):
                break
            a, b = self.draw.choice(len(population), 2, replace=False).tolist() if len(population) > 1 else (0, 0)
            child = self.cross(population[a], population[b])
            if self.draw.uniform() < 0.5:
                child = self.mutate(child)
            population = sorted([*population, child], key=self.fitness, reverse=True)[:POPULATION]
        return population

    def done(self, one: Individual) -> bool:
        """As few bins as there can be, all but one of them full."""
        return len(one[0]) <= self.fewest and sum(map(bool, one[1])) <= 1

    # An individual travels as the number of each piece's bin.

    def told(self, one: Individual) -> bytes:
        bin_of = np.empty(len(self.lengths), "<i4")
        for i, pieces in enumerate(one[0]):
            bin_of[pieces] = i
        return bin_of.tobytes()

    def heard(self, told: bytes) -> Individual:
        bin_of = np.frombuffer(told, "<i4").tolist()
        bins: list[list[int]] = [[] for _ in range(max(bin_of, default=-1) + 1)]
        for p, i in enumerate(bin_of):
            bins[i].append(p)
        lengths = self.lengths
        return bins, [self.window - sum(lengths[p] for p in pieces) for pieces in bins]


# On Spark


def pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """(item, doc_id, piece, start, length, ids_crc32): the pieces of each document.

    The ids of a document are those of the tokenizer and the end id. More than a window is cut
    into whole windows, and a first piece of what is over. ``item`` numbers all pieces.
    """
    texts = whole_texts(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()
    names = ["item", "doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(tokenizer_path)
        item = TaskContext.get().partitionId() << 36
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            found = encoder.encode_all(batch.column("text").to_pylist())
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), found):
                whole = np.append(ids, end_id).astype("<u4")
                first = len(whole) % window or window
                begins = [0, *range(first, len(whole), window)]
                for piece, (begin, end) in enumerate(zip(begins, [*begins[1:], len(whole)])):
                    row = (item, doc_id, piece, begin, end - begin, zlib.crc32(whole[begin:end].tobytes()))
                    for column, value in zip(columns, row):
                        column.append(value)
                    item += 1
            types = [pa.int64(), batch.schema.field("doc_id").type, pa.int32(), *[pa.int64()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return texts.mapInArrow(run, f"item long, doc_id {kind}, piece int, start long, length long, ids_crc32 long")


STATE = "block long, island int, lengths array<int>, population array<binary>, bins int, fullness double"


def _epoch(state: DataFrame, window: int, number: int) -> DataFrame:
    """One epoch of every island; ``population`` is empty at first, ``migrant`` null or an elite."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                packer = Packer(row["lengths"], window, abs(hash((number, row["block"], row["island"]))))
                population = [packer.heard(t) for t in row["population"]] or packer.first()
                if row["migrant"] is not None:
                    population.append(packer.heard(row["migrant"]))
                population = packer.evolve(population)
                bins, fullness = packer.fitness(population[0])
                told = {"block": row["block"], "island": row["island"], "lengths": row["lengths"], "population": [packer.told(one) for one in population], "bins": -bins, "fullness": fullness}
                yield pa.RecordBatch.from_pylist([told], schema)

    schema = pa.schema(
        [("block", pa.int64()), ("island", pa.int32()), ("lengths", pa.list_(pa.int32())), ("population", pa.list_(pa.binary())), ("bins", pa.int32()), ("fullness", pa.float64())]
    )
    return state.mapInArrow(run, STATE)


def evolved(
    blocks: DataFrame, n_blocks: int, window: int = WINDOW, islands: int = ISLANDS, epochs: int = EPOCHS, number: int = 0
) -> DataFrame:
    """(block, best) of blocks (block, lengths): the bin of each piece in the best individual.

    ``islands`` populations of each block evolve apart, at most ``TASK_ISLANDS`` of them in a
    task if there are more than one a shuffle partition. Between epochs the best individual of
    an island migrates to the next one of its block, in a ring.
    """
    width = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(min(n_blocks * islands, width), n_blocks * islands // TASK_ISLANDS)
    state = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "lengths")
    state = state.withColumns({"population": F.array().cast("array<binary>"), "migrant": F.lit(None).cast("binary")})
    for epoch in range(epochs):
        if epoch:
            migrants = state.select("block", ((F.col("island") + 1) % islands).alias("island"), F.col("population")[0].alias("migrant"))
            # a given number of tasks, since rows are few and small but work much
            migrants = migrants.repartition(tasks, "block", "island")
            state = state.drop("migrant").repartition(tasks, "block", "island").join(migrants, ["block", "island"])
        else:
            state = state.repartition(tasks, "block", "island")
        state = written(_epoch(state, window, number * epochs + epoch), "islands")
    merit = F.struct(-F.col("bins"), "fullness", -F.col("island"))
    return state.groupBy("block").agg(F.max_by(F.col("population")[0], merit).alias("best"))


def _laid_out(best: DataFrame, window: int, last: bool) -> DataFrame:
    """(item, length, sequence_id, offset, kept) of blocks (items, lengths, best).

    A sequence is named by the smallest item in it. Kept are windows that are all but full
    and at least seven eighths of a block's windows, the fullest; all of the last block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                items, lengths = row["items"], row["lengths"]
                bins, room = Packer(lengths, window).heard(row["best"])
                order = sorted(range(len(bins)), key=lambda i: (room[i], i))
                rows = []
                for rank, i in enumerate(order):
                    kept = last or room[i] <= window // KEPT_SHARE or rank < len(bins) * 7 // 8
                    name, offset = min(items[p] for p in bins[i]), 0
                    for p in bins[i]:
                        rows.append((items[p], lengths[p], name, offset, kept))
                        offset += lengths[p]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(columns, ["item", "length", "sequence_id", "offset", "kept"])

    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
    return best.mapInArrow(run, "item long, length int, sequence_id long, offset long, kept boolean")


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    block_pieces: int = BLOCK_PIECES,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
) -> DataFrame:
    """A row for each piece of each document (doc_id, text): where its ids lie.

    A null or empty text is the end id alone. Only documents longer than ``window`` are cut; a
    very long one fills whole windows of its own but for its first piece. Repeated rows are
    packed as often as they occur, pieces of equal length are told apart by their number.
    Other columns are left out; an empty table gives no rows.
    """
    cut = written(pieces(docs, tokenizer_path, window, end_id), "pieces")
    full = F.col("length") == window
    places = cut.where(full).select("item", F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left = cut.where(~full).select("item", F.col("length").cast("int").alias("length"))
    number, n = 0, left.count()
    while n:
        blocks = -(-n // block_pieces)
        block = F.pmod(F.xxhash64("item", F.lit(number)), F.lit(blocks))
        content = F.sort_array(F.collect_list(F.struct("length", "item")), asc=False)
        dealt = left.groupBy(block.alias("block")).agg(content.alias("content"))
        dealt = written(dealt.select("block", F.col("content.item").alias("items"), F.col("content.length").alias("lengths")), "blocks")
        best = evolved(dealt.drop("items"), blocks, window, islands, epochs, number)
        laid = written(_laid_out(dealt.join(best, "block"), window, blocks == 1), "windows")
        places = places.unionByName(laid.where("kept").select("item", "sequence_id", "offset"))
        left = laid.where("NOT kept").select("item", "length")
        number, n = number + 1, 0 if blocks == 1 else left.count()
    return cut.join(places, "item").drop("item")
