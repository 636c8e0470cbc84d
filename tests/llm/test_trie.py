import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from oracle_check import connect, differences

from roomledger.llm import trie
from roomledger.llm.queries import ORACLE_SQL, op11_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, size string, ends long"


def brute_force(rows):
    turns = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            turns[c].append(((turn is not None, turn or 0), digest, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(c - c % 100, [])[:h] + said[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, said in rebuilt.items():
        for d in range(len(said) + 1):
            members[said[:d]].append(c)
            if d:
                children[said[: d - 1]].add(said[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, who in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(who) - 1) * len(path[-1][1]) if path else 0
    found = []
    for path, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(rebuilt[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        found.append((min(who), len(path), parent, len(who), len(children[path]), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=str)


def run(df, **bounds):
    nodes, lists = trie.prefix_trie(trie.with_shared_heads(trie.turn_sequences(df)), **bounds)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in trie.with_digests(nodes, lists).select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    rows = []
    for c in range(400):
        if (c % 100 == 0 and c != 200) or draw.random() < 0.8:  # a base is missing
            for t in range(draw.randrange(9)):
                rows.append((c, draw.choice([t, t, None]), draw.choice(["u", "a", None]), draw.choice(["x", "y", "é😀", "x", None, ""])))
    # a group of copies with a third of all conversations, null ids, a repeated row, a null turn
    rows += [(c * 100, t, "u", "the same") for c in range(1000, 1150) for t in range(3)]
    rows += [(None, 0, "u", "q"), rows[5], (399, None, "s", "z" * 50_000)]
    return [(*r, "k", "s", 7) for r in rows]


@pytest.mark.parametrize("bounds", [{}, {"conversations": 7}, {"conversations": 1}, {"turns": 10}])
def test_equals_brute_force(spark, rows, bounds):
    assert run(spark.createDataFrame(rows, SCHEMA), **bounds) == brute_force(rows)


def test_a_conversation_of_very_many_turns(spark):
    rows = [(c, t, "u", str(t % 3), "k", "s", 7) for c, n in ((0, 3000), (100, 1500)) for t in range(n)]
    found = run(spark.createDataFrame(rows, SCHEMA), turns=100)
    assert sorted(r[1] for r in found) == list(range(3001))
    assert [(r[0], r[3], r[5], r[6]) for r in found if not r[1]] == [(0, 2, 1, 1500)]


def test_empty_tables(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
    assert run(spark.createDataFrame([(None, 1, "u", "t", "k", "s", 7)], SCHEMA)) == []


def test_shard_walk():
    a, b, c = (bytes([k]) * trie.DIGEST_BYTES for k in (1, 2, 3))
    shard = trie.Shard([30, 10, 20], [a + b, a + b, a + c], [[5, 1], [5, 1], [5, 2]])
    assert shard.members(shard.postings[1][b]) == [10, 30] and shard.members(shard.over[2]) == [10, 20, 30]
    nodes = shard.nodes(9)
    lists = {(d, tuple(e)) for d, e in zip(nodes["depth"], nodes["ends"]) if e}
    assert lists == {(2, (10, 30)), (2, (20,))}


def test_a_hot_list_is_sent_in_parts(spark):
    rows = [(c, 0, "u", "hi", "k", "s", 7) for c in range(0, 5000, 100)]
    _, lists = trie.prefix_trie(trie.turn_sequences(spark.createDataFrame(rows, SCHEMA)), conversations=4)
    parts = lists.collect()
    assert len(parts) > 10 and max(len(p.ends) for p in parts) <= 4


def test_query_equals_sql(spark, sf_dir):
    assert differences(op11_prefix_trie(spark, sf_dir), connect(sf_dir), ORACLE_SQL["op11_prefix_trie"]) is None
