import random

import numpy as np
import pytest
import xxhash
from conftest_llm import ODD_ROWS
from pyspark.sql import functions as F

from roomledger.llm import simhash
from roomledger.llm.common import written


def slow_fingerprint(text, size=3):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, most):
    """Smallest id reachable, by comparing all pairs."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= most:
                parent[find(i)] = find(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(prints):
        root = find(i)
        if doc_id is not None:
            smallest[root] = min(doc_id, smallest.get(root, doc_id))
    return [smallest.get(find(i)) for i in range(len(prints))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("most", [3, 2, 0])
def test_components_equal_all_pairs(spark, most):
    draw = random.Random(most)
    prints = [(i, draw.getrandbits(64)) for i in range(150)]
    for i in range(150, 400):  # chains and clusters around earlier ones
        _, base = prints[draw.randrange(len(prints))]
        for bit in draw.sample(range(64), draw.randrange(6)):
            base ^= 1 << bit
        prints.append((1000 - i, base))
    df = spark.createDataFrame([(i, signed(p)) for i, p in prints], "doc_id long, fp long")
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_groups(df, most).collect()}
    assert got == dict(zip((i for i, _ in prints), slow_components(prints, most)))


def test_every_near_pair_meets_at_an_anchor(spark):
    """Brute force over bit patterns: a home anchor is within the replicas of near words."""
    draw = random.Random(5)
    pairs = []
    for _ in range(300):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), 3):
            b ^= 1 << bit
        pairs += [a, b]
    nodes = spark.createDataFrame([(signed(p), signed(p)) for p in pairs], "fp long, part long")
    homes = {(r["half"], r["fp"]): r["home"] for r in simhash._homes(nodes).select("half", "fp", "home").collect()}
    there = {}
    for r in simhash.replicas(nodes).collect():
        there.setdefault((r["half"], r["fp"]), set()).add(r["anchor"])
    for a, b in zip(pairs[::2], pairs[1::2]):
        assert any(homes[h, signed(a)] in there[h, signed(b)] for h in (0, 1))


def test_dense_cluster_is_one_component(spark):
    draw = random.Random(9)
    base = draw.getrandbits(64)
    places = draw.sample(range(64), 11)
    members = {base ^ sum(1 << p for p in places if draw.random() < 0.5) for _ in range(900)}
    df = spark.createDataFrame([(i, signed(m)) for i, m in enumerate(sorted(members))], "doc_id long, fp long")
    nodes = df.select("fp", F.col("doc_id").alias("first"))
    assert {r["component_id"] for r in simhash.components(nodes).collect()} == {0}


def test_fingerprint_equals_the_definition():
    draw = random.Random(1)
    words = ["Alpha", "beta", "É", "x", "yy", "…"]
    texts = [" ".join(draw.choices(words, k=draw.randrange(40))) for _ in range(60)]
    texts += ["", None, "one", "one two", "a\tb\x0bc\nd", "w " * 100_000, "no break space here"]
    for text in texts:
        assert simhash.simhash(text or "", 3) == slow_fingerprint(text)


def test_odd_rows(spark, documents):
    prints = simhash.fingerprints(documents(ODD_ROWS))
    assert prints.columns == ["doc_id", "fp"]
    rows = simhash.near_groups(prints).collect()
    assert len(rows) == len(ODD_ROWS)
    got = {(r["doc_id"], r["component_id"]) for r in rows}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (None, None)}
    hexed = prints.where("doc_id = 1").select(simhash.hex_digits(F.col("fp"))).first()[0]
    assert hexed == "0" * 16


def test_one_row_of_each_group_stays(spark, documents):
    docs = documents([*ODD_ROWS, (0, "a b c"), (0, "a b c")])
    kept = simhash.one_of_each_group(simhash.fingerprints(docs, carry=["doc_id", "text"])).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept) == [(False, 0), (False, 1), (True, None)]


def test_empty_table(spark, documents):
    assert simhash.near_groups(simhash.fingerprints(documents([]))).count() == 0


def test_shingles_of_other_sizes():
    assert len(simhash.shingle_hashes("a b c d e", 2)) == 4
    assert np.array_equal(simhash.shingle_hashes("a b", 2), simhash.shingle_hashes("a b", 5))


def largest_task(spark, df):
    """Rows of the fullest partition, without adaptive execution and automatic broadcasts."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_centre_of_a_star_leaves_no_full_task(spark):
    """A third of the links end at one node."""
    links = spark.range(0, 30_000, 1, 16).selectExpr("id + 10 AS u", "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS v")
    both = written(links.unionByName(links.selectExpr("v AS u", "u AS v")), "both")
    spread = simhash._with_lowest(both)
    assert spread.where("u = 1").count() == 10_001
    assert largest_task(spark, spread) < 11_000
    plain = both.groupBy("u").agg(F.min("v").alias("m")).join(both, "u").select("u", "v", "m")
    assert sorted(spread.collect()) == sorted(plain.collect())


def test_one_component_and_one_fingerprint_with_a_third_of_the_rows_each(spark):
    centre = 0x0123456789ABCDEF
    near = [centre ^ (1 << a) ^ (1 << b) for a in range(63) for b in range(a + 1, 63)][:1500]
    draw = random.Random(5)
    prints = [*near, *[7] * 1500, *(draw.getrandbits(63) for _ in range(1500))]
    rows = [(i, fp) for i, fp in enumerate(prints)]
    df = spark.createDataFrame(rows, "doc_id long, fp long").repartition(16)
    found = simhash.near_groups(df)
    assert largest_task(spark, found) < 1800
    ids = {r.doc_id: r.component_id for r in found.collect()}
    assert len(ids) == 4500 and {ids[i] for i in range(1500)} == {0} and {ids[i] for i in range(1500, 3000)} == {1500}
    assert all(ids[i] == i for i in range(3000, 4500))
