"""SimHash near-duplicates by anchor points of a covering code.

A fingerprint has 64 bits. Two fingerprints that differ in at most ``2 t + 1`` bits differ in
at most ``t`` bits of one of their halves. The anchors of a half are the words of the Hamming
code of length 31 (the 32nd bit of the half is free): its covering radius is 1, so each
fingerprint has one home anchor. A fingerprint is replicated to every anchor within covering
radius plus ``t`` of it, so that it meets, at the home anchor of any fingerprint within ``t``,
that fingerprint. Comparisons are made per anchor, homes against replicas, on all 64 bits.

Equal fingerprints are one node from the start. Fingerprints that differ only inside one of 22
fixed bit triples are linked beforehand (a group of such fingerprints has at most eight
members); the anchors then only look for links between different groups, so that a dense
cluster does not emit all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.llm.common import written
from roomledger.operators.joins import hot_key_limit

SHINGLES_AT_ONCE = 1 << 16
CODE_LENGTH = 31
HOT_ROWS = 64  # a key with fewer rows is never hot
MAX_DISTANCE = 3


# Fingerprints


def shingle_hashes(text: str, size: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each shingle of ``size`` words, repeats included.

    Words are runs of bytes other than blanks and control white space, A-Z lower-cased. Fewer
    words than ``size`` make one shingle; no words make none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[a:b], seed) for a, b in zip(starts, ends[size - 1 :].tolist())], np.uint64
    )


def simhash(text: str, size: int, seed: int = 42) -> int:
    """A bit is 1 if it is set in over half the shingle hashes; no shingles give zero."""
    hashes = shingle_hashes(text, size, seed)
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        part = hashes[at : at + SHINGLES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, shingle_words: int = 3, seed: int = 42, carry: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The columns ``carry`` of each row of ``docs``, and its fingerprint as the long ``fp``.

    A null text is empty. Repeated rows give repeated rows; other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            values = [simhash(t or "", shingle_words, seed) for t in texts]
            bits = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*map(batch.column, carry), bits], [*carry, "fp"])

    rows = docs.select(*dict.fromkeys([*carry, "text"]))
    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carry]
    return rows.mapInArrow(run, ", ".join([*kinds, "fp long"]))


# Links


def _half(fp: Column, half: int) -> Column:
    return F.shiftrightunsigned(fp, 32 * half).bitwiseAND(F.lit((1 << CODE_LENGTH) - 1))


def _syndrome(bits: Column) -> Column:
    """0 for an anchor, else the position (from 1) of the bit that leads to the home anchor."""
    parts = []
    for k in range(5):
        mask = sum(1 << (i - 1) for i in range(1, CODE_LENGTH + 1) if i >> k & 1)
        odd = F.bit_count(bits.bitwiseAND(F.lit(mask))) % 2
        parts.append(F.shiftleft(odd.cast("int"), k))
    return parts[0] + parts[1] + parts[2] + parts[3] + parts[4]


def _homes(nodes: DataFrame) -> DataFrame:
    rows = nodes.withColumn("half", F.explode(F.array(F.lit(0), F.lit(1))))
    rows = rows.withColumn("bits", F.when(F.col("half") == 0, _half(F.col("fp"), 0)).otherwise(_half(F.col("fp"), 1)))
    rows = rows.withColumn("s", _syndrome(F.col("bits")))
    flip = F.expr("CASE WHEN s = 0 THEN 0L ELSE shiftleft(1L, s - 1) END")
    return rows.withColumn("home", F.col("bits").bitwiseXOR(flip))


def replicas(nodes: DataFrame) -> DataFrame:
    """A row for each anchor within distance two: the home and, off an anchor, 15 others.

    Two flips lead from a word with syndrome ``s`` to an anchor if the labels of the flipped
    positions (1 to 31) have the exclusive or ``s``.
    """
    pairs = (
        "CASE WHEN s = 0 THEN array(home) ELSE concat(array(home), transform("
        "filter(sequence(1, 31), i -> (i ^ s) > i),"
        "i -> bits ^ shiftleft(1L, i - 1) ^ shiftleft(1L, (i ^ s) - 1))) END"
    )
    return _homes(nodes).select("half", "fp", "part", F.explode(F.expr(pairs)).alias("anchor"))


def _triple_links(nodes: DataFrame) -> DataFrame:
    """Links from the smallest of each group that agrees outside a bit triple to its others."""
    masks = [sum(1 << b for b in range(i, min(i + 3, 64))) for i in range(0, 64, 3)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = nodes.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.bitwise_not(F.lit(m).cast("long"))) for m in signed])).alias("k", "rest"),
    )
    groups = (
        keyed.groupBy("k", "rest")
        .agg(F.collect_set("fp").alias("members"))  # at most eight
        .where(F.size("members") > 1)
        .select(F.array_min("members").alias("v"), F.explode("members").alias("u"))
    )
    return groups.where("u <> v").distinct()


def spread_join(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Inner join of two written tables, where ``table`` has one row for each ``key``.

    ``n`` of ``table`` is the number of ``rows`` of the key. The rows of hot keys, of which
    there are fewer than ``hot_key_limit``, meet their partner by a broadcast where they are;
    all others take the ordinary join. ``n`` is left out.
    """
    total = table.agg(F.sum("n")).first()[0] or 0
    bound = max(total / hot_key_limit(rows), HOT_ROWS)
    hot = table.where(F.col("n") > bound).drop("n")
    if not hot.take(1):
        return rows.join(table.drop("n"), key)
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(table.where(F.col("n") <= bound).drop("n"), key)
    return cold.unionByName(rows.join(F.broadcast(hot), key))


def _with_lowest(links: DataFrame) -> DataFrame:
    """(u, v, m) of written links (u, v): the smallest neighbour of ``u`` on each of its links."""
    lowest = links.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    return spread_join(links, written(lowest, "lowest"), "u")


def connected(links: DataFrame) -> DataFrame:
    """(u, v) links of longs to (node, root): the smallest node that each can reach.

    Alternates large and small stars until nothing changes: a logarithmic number of rounds in
    practice, each two aggregations and joins of the links, written to the shared folder. The
    links of a node that has very many, the centre of a star, stay spread over all tasks.
    """
    edges = written(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(),
        "links",
    )
    before = None
    while True:
        both = written(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
        large = _with_lowest(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        small = _with_lowest(written(large.where("u <> v").distinct(), "large"))
        stars = small.select("u", F.col("m").alias("v")).unionByName(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        edges = written(stars.distinct(), "stars")
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def _with_roots(nodes: DataFrame, key: str, roots: DataFrame) -> DataFrame:
    """Written ``nodes`` with the ``root`` of each ``key``; a key without links is its own."""
    sizes = nodes.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    found = sizes.join(roots.select(F.col("node").alias(key), "root"), key, "left")
    return spread_join(nodes, written(found.withColumn("root", F.coalesce("root", key)), "roots"), key)


def components(nodes: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Nodes, different fingerprints (fp, first), with their ``component_id`` and ``root``.

    ``first`` is the smallest doc_id of a fingerprint, ``component_id`` that of its component,
    ``root`` the component's smallest fingerprint. ``max_distance`` is 3 or less: the radius of
    the anchors is made for one differing bit in one of two halves.
    """
    if not 0 <= max_distance <= MAX_DISTANCE:
        raise ValueError(f"max_distance must be 0 to {MAX_DISTANCE}")
    parted = nodes.select("fp", F.col("fp").alias("part"))
    if max_distance == MAX_DISTANCE:
        near = connected(_triple_links(nodes)).withColumnRenamed("node", "fp")
        parted = nodes.select("fp").join(near, "fp", "left").select("fp", F.coalesce("root", "fp").alias("part"))
        parted = written(parted, "parts")
    homes = _homes(parted).select(
        F.col("half").alias("half_a"),
        F.col("home").alias("anchor_a"),
        F.col("fp").alias("fp_a"),
        F.col("part").alias("part_a"),
    )
    links = homes.join(
        replicas(parted),
        (F.col("half_a") == F.col("half"))
        & (F.col("anchor_a") == F.col("anchor"))
        & (F.col("part_a") < F.col("part"))
        & (F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp"))) <= max_distance),
    ).select(F.col("part_a").alias("u"), F.col("part").alias("v"))
    rooted = _with_roots(parted, "part", connected(links)).select("fp", "root")
    rooted = written(nodes.join(rooted, "fp"), "rooted")
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("__n"))
    named = spread_join(rooted, written(ids.withColumnRenamed("__n", "n"), "ids"), "root")
    return named.select(*nodes.columns, "component_id", "root")


def _nodes(prints: DataFrame) -> DataFrame:
    """(fp, first, rows) of the different fingerprints: smallest doc_id and number of rows."""
    return written(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows")), "nodes")


def near_groups(prints: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``prints`` (with doc_id and fp) and their ``component_id``.

    Rows link at ``max_distance`` or fewer differing bits. ``component_id`` is the smallest
    doc_id of those reachable, itself included; null only if all of them are null.
    """
    prints = written(prints, "fingerprints")
    found = components(_nodes(prints), max_distance).select("fp", "component_id", F.col("rows").alias("n"))
    # rows of one fingerprint, such as empty texts, stay spread over all tasks
    return spread_join(prints, written(found, "components"), "fp")


def one_of_each_group(prints: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of each component: that of the smallest doc_id, one of them if it is repeated."""
    prints = written(prints, "fingerprints")
    chosen = (
        components(_nodes(prints), max_distance)
        .where(F.col("first").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min("fp").alias("chosen_fp"), F.min("first").alias("chosen_id"))
    )
    kept = prints.join(
        chosen,
        (F.col("fp") == F.col("chosen_fp")) & F.col("doc_id").eqNullSafe(F.col("chosen_id")),
    )
    return kept.dropDuplicates(["root"]).select(*prints.columns)


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
