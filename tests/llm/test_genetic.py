import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest_llm import ODD_ROWS
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roomledger.llm import genetic
from roomledger.llm.queries import BYTE_TOKENIZER, op12_genetic_packing

COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def check(pieces, rows, window=genetic.WINDOW):
    """Every id of every row lies once, whole and gapless; the number of sequences."""
    library = Tokenizer.from_file(BYTE_TOKENIZER)
    wanted, given, sequences = defaultdict(int), defaultdict(int), defaultdict(list)
    for i, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % window or window
        ends = [first, *range(first + window, len(ids) + 1, window)] if len(ids) > window else [len(ids)]
        for piece, (begin, end) in enumerate(zip([0, *ends], ends)):
            wanted[i, piece, begin, end - begin, zlib.crc32(ids[begin:end].tobytes())] += 1
    for p in pieces:
        given[p.doc_id, p.piece, p.start, p.length, p.ids_crc32] += 1
        sequences[p.sequence_id].append((p.offset, p.length))
    assert given == wanted
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= window
    return len(sequences)


def test_every_id_lies_once(documents):
    long = " ".join(f"w{k}" for k in range(5000))
    rows = [*ODD_ROWS, (7, long), (8, long), (9, "x" * 9000), (10, "a <|endoftext|> b"), (11, "日本 " * 300)]
    check(genetic.pack(documents(rows), BYTE_TOKENIZER).collect(), rows)


def test_many_blocks_and_rounds(documents):
    draw = np.random.default_rng(4)
    rows = [(k, " ".join(["of"] * int(n))) for k, n in enumerate(draw.integers(1, 60, 600))]
    rows += [(1000 + k, " ".join(["of"] * 20)) for k in range(300)]  # a third are copies
    found = genetic.pack(documents(rows), BYTE_TOKENIZER, window=64, block_pieces=100).collect()
    packer = genetic.Packer([p.length for p in found], 64)
    at_once = packer.best_fit(packer.decreasing(range(len(found))), [], [])
    assert packer.fewest <= check(found, rows, 64) <= 1.02 * len(at_once[0])


@pytest.mark.parametrize("lengths", [[10], [2048, 1, 2047], [700] * 50, [1500] * 40, [1, 1, 1]])
def test_pieces_that_fit_badly(lengths):
    packer = genetic.Packer(lengths)
    best = packer.evolve(packer.first())[0]
    assert sorted(p for b in best[0] for p in b) == list(range(len(lengths)))
    per_bin = 2048 // lengths[-1]
    assert len(best[0]) == (-(-len(lengths) // per_bin) if len(set(lengths)) == 1 else packer.fewest)


def test_crossover_injects_whole_bins_and_loses_no_piece():
    draw = np.random.default_rng(2)
    packer = genetic.Packer(draw.integers(20, 1500, 300).tolist())
    a, b, *_ = packer.first()
    child = packer.cross(a, b)
    assert sorted(p for pieces in child[0] for p in pieces) == list(range(300))
    assert [2048 - sum(packer.lengths[p] for p in pieces) for pieces in child[0]] == child[1]
    whole = {frozenset(x) for x in a[0]} & {frozenset(x) for x in child[0]}
    assert len(whole) >= 0.15 * len(a[0])
    assert packer.heard(packer.told(child)) == ([sorted(x) for x in child[0]], child[1])


def test_evolution_betters_the_first_generation():
    draw = np.random.default_rng(6)
    packer = genetic.Packer(draw.integers(500, 900, 400).tolist(), seed=1)
    first = packer.first()
    last = packer.evolve(first, 60)[0]
    assert packer.fitness(last) > max(map(packer.fitness, first))


def test_elite_migrates(spark):
    blocks = spark.createDataFrame([(0, [700, 1300, 40] * 30), (1, [2000, 48])], "block long, lengths array<int>")
    best = {r.block: r.best for r in genetic.evolved(blocks, 2, epochs=3).collect()}
    bins, room = genetic.Packer([2000, 48]).heard(bytes(best[1]))
    assert bins == [[0, 1]] and room == [0]
    assert len(genetic.Packer([700, 1300, 40] * 30).heard(bytes(best[0]))[0]) == 30


def test_empty_table(documents):
    assert genetic.pack(documents([]), BYTE_TOKENIZER).collect() == []


def test_query_needs_few_sequences(spark, sf_dir):
    found = op12_genetic_packing(spark, sf_dir)
    assert sorted(found.columns) == sorted(COLUMNS)
    tokens, sequences = found.agg(F.sum("length"), F.count_distinct("sequence_id")).first()
    assert sequences <= 1.005 * tokens / genetic.WINDOW + 1
