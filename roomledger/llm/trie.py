"""Prefix trie of conversations by vertical bitmaps.

Conversations are ordered by the digests of their turns and cut into shards of bounded size, so
that almost every subtree lies in one shard, and a hot beginning or a hot group of copies is cut
like anything else. A shard numbers its conversations by id and indexes them: each (position,
turn) has the set of conversations with that turn there, as a bitmap. A depth-first walk meets
a node's bitmap with the postings of the next position: the non-empty intersections are its
children, their popcounts the members, the lowest bit the smallest member, and the bits whose
conversation is over the end list.

Only nodes on the path of the first or the last conversation of a shard may go on in other
shards. They are few; Spark adds up their parts, and counts what several shards have seen once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomledger.llm.common import written
from roomledger.operators.joins import split_join

SHARD_CONVERSATIONS = 4096
SHARD_TURNS = 1 << 16
DIGEST_BYTES = 16
ROOT = bytes(DIGEST_BYTES)
HEAD_TURNS = 6  # heads have fewer turns than that

NODE_COLUMNS = (
    "conv_id long, depth long, parent_conv_id long, parent_key binary, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, ends array<long>, size long, shard long, side int, key binary"
)
NODE_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("parent_key", pa.binary()),
     ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
     ("ends", pa.list_(pa.int64())), ("size", pa.int64()), ("shard", pa.int64()), ("side", pa.int32()), ("key", pa.binary())]
)


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns) of each conversation: (digest, size) of its turns in order.

    The digest is that of role and text (null: empty), in hexadecimal digits, the size the code
    points of the text. Order is by turn, null first; turns of one number are ordered by their
    digests. Repeated rows are turns of their own. Rows without a conv_id are no conversation.
    A conversation is held whole, as 40 bytes a turn, but never its texts.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        F.substring(F.sha2(said, 256), 1, 2 * DIGEST_BYTES).alias("digest"),
        F.length(text).cast("long").alias("size"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("turn", "digest", "size")))
    rows = turns.groupBy("conv_id").agg(ordered.alias("turns"))
    return rows.select("conv_id", F.expr("transform(turns, t -> struct(t.digest AS digest, t.size AS size)) AS turns"))


def with_shared_heads(sequences: DataFrame, family: int = 100, most: int = HEAD_TURNS) -> DataFrame:
    """Each conversation c with its first h turns taken from conversation ``c - c % family``.

    h is the crc32 of c in decimal, modulo ``most``. Of a shorter head all turns are taken, of
    an absent one none; then follow c's own turns after its first h.
    """
    heads = sequences.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head")
    )
    own = sequences.withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
    own = own.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int"))
    joined = own.join(heads, "base", "left")
    # a head of no turns has the type of the turns
    head = "CASE WHEN head IS NULL THEN slice(turns, 1, 0) ELSE slice(head, 1, h) END"
    return joined.select("conv_id", F.expr(f"concat({head}, slice(turns, h + 1, greatest(size(turns) - h, 0))) AS turns"))


class Shard:
    """The bitmaps of some conversations: ids, the turns' digests of each and their sizes."""

    def __init__(self, ids: list[int], keys: list[bytes], sizes: list[list[int]]):
        order = sorted(range(len(ids)), key=ids.__getitem__)
        place = {k: i for i, k in enumerate(order)}
        self.first, self.last = 1 << place[0], 1 << place[len(ids) - 1]
        self.ids = [ids[k] for k in order]
        self.keys = [keys[k] for k in order]
        self.sizes = [sizes[k] for k in order]
        self.postings: list[dict[bytes, int]] = []
        self.over: list[int] = []  # by length, the conversations of that length
        for i, key in enumerate(self.keys):
            bit = 1 << i
            length = len(key) // DIGEST_BYTES
            while len(self.over) <= length:
                self.over.append(0)
                self.postings.append({})
            self.over[length] |= bit
            for p in range(length):
                turn = key[p * DIGEST_BYTES : (p + 1) * DIGEST_BYTES]
                at = self.postings[p]
                at[turn] = at.get(turn, 0) | bit

    def members(self, bits: int) -> list[int]:
        """The conversations of a bitmap, in ascending order."""
        found = []
        while bits:
            low = bits & -bits
            found.append(self.ids[low.bit_length() - 1])
            bits ^= low
        return found

    def nodes(self, shard: int) -> dict[str, list]:
        """Columns of NODE_COLUMNS for the nodes of this shard, in depth-first order.

        Nodes that may go on in other shards have a shard and a side (0: path of the first
        conversation, 1: of the last), with the sums over what only this shard has; a node on
        both sides is on side 1 again, without sums.
        """
        out: dict[str, list] = {n: [] for n in NODE_SCHEMA.names}
        parents: list[int] = []
        edge = self.first | self.last
        open_keys: list[bytes | None] = []
        stack = [((1 << len(self.ids)) - 1, 0, -1, 0, ROOT)]
        sides = []
        while stack:
            bits, depth, parent, size, key = stack.pop()
            me = len(parents)
            parents.append(parent)
            is_open = bool(bits & edge)
            open_keys.append(key if is_open else None)
            n = bits.bit_count()
            over = bits & self.over[depth]
            rest = bits ^ over
            children = closed_children = 0
            while rest:
                i = (rest & -rest).bit_length() - 1
                turn = self.keys[i][depth * DIGEST_BYTES : (depth + 1) * DIGEST_BYTES]
                child = rest & self.postings[depth][turn]
                rest ^= child
                children += 1
                child_key = ROOT
                if child & edge:
                    child_key = hashlib.sha256(key + turn).digest()[:DIGEST_BYTES]
                else:
                    closed_children += 1
                stack.append((child, depth + 1, me, self.sizes[i][depth], child_key))
            parent_open = open_keys[parent] if parent >= 0 else None
            row = (
                self.ids[(bits & -bits).bit_length() - 1], depth,
                out["conv_id"][parent] if parent >= 0 and parent_open is None else None, parent_open,
                n, closed_children if is_open else children,
                int(not children and not is_open), n * size if is_open else (n - 1) * size,
                self.members(over), size, shard if is_open else None,
                (0 if bits & self.first else 1) if is_open else None, key if is_open else None,
            )
            for name, value in zip(out, row):
                out[name].append(value)
            sides.append(bool(bits & self.first) and bool(bits & self.last))
        for me in range(len(parents) - 1, 0, -1):
            for name in ("n_leaves", "saved_tokens"):
                out[name][parents[me]] += out[name][me]
        for me in [k for k, both in enumerate(sides) if both]:
            again = {name: column[me] for name, column in out.items()}
            again |= {"n_convs": 0, "n_children": 0, "n_leaves": 0, "saved_tokens": 0, "ends": [], "side": 1}
            for name, value in again.items():
                out[name].append(value)
        return out


def shard_nodes(sequences: DataFrame, conversations: int = SHARD_CONVERSATIONS, turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of all shards, as ``Shard.nodes`` gives them."""
    rows = sequences.select(
        "conv_id",
        F.unhex(F.array_join("turns.digest", "")).alias("key"),
        F.col("turns.size").alias("sizes"),
    )
    rows = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, keys, sizes, held = [], [], [], 0

        def out() -> pa.RecordBatch:
            nonlocal number
            found = Shard(ids, keys, sizes).nodes(number)
            number += 1
            return pa.RecordBatch.from_pydict(found, NODE_SCHEMA)

        for batch in batches:
            for i, key, size in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "key", "sizes"))):
                ids.append(i)
                keys.append(key)
                sizes.append(size)
                held += len(size)
                if len(ids) >= conversations or held >= turns:
                    yield out()
                    ids, keys, sizes, held = [], [], [], 0
        if ids:
            yield out()

    return rows.mapInArrow(run, NODE_COLUMNS)


def _joined(parts: DataFrame) -> DataFrame:
    """The open nodes of all shards, each once: (key, parent_key, ...) with their full counts.

    What several shards have seen belongs to the first of them. On a path its own nodes are the
    last ones, so sums over a path from its end count each node once for all its ancestors.
    """
    merged = parts.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.min("parent_key").alias("parent_key"),
        F.max("size").alias("size"),
        F.min(F.struct("shard", "side")).alias("owner"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    merged = written(merged, "open-nodes")
    open_children = merged.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("open_children"))
    merged = merged.join(open_children, "key", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("open_children", F.lit(0))
    )
    from_end = Window.partitionBy("shard", "side").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    once = merged.select("key", "owner", "size", (F.col("n_children") == 0).cast("long").alias("leaf"))
    path = split_join(parts.select("shard", "side", "depth", "key"), once, ["key"])
    own = (F.col("owner.shard") == F.col("shard")) & (F.col("owner.side") == F.col("side"))
    path = path.select(
        "key",
        F.sum(F.when(own, F.col("leaf")).otherwise(0)).over(from_end).alias("more_leaves"),
        F.sum(F.when(own, F.col("size")).otherwise(0)).over(from_end).alias("less_tokens"),
    )
    sums = path.groupBy("key").agg(F.sum("more_leaves").alias("more_leaves"), F.sum("less_tokens").alias("less_tokens"))
    return merged.join(sums, "key").select(
        "key",
        "conv_id",
        "depth",
        "parent_key",
        "n_convs",
        "n_children",
        (F.col("n_leaves") + F.col("more_leaves")).alias("n_leaves"),
        (F.col("saved_tokens") - F.col("less_tokens")).alias("saved_tokens"),
    )


def prefix_trie(sequences: DataFrame, conversations: int = SHARD_CONVERSATIONS, turns: int = SHARD_TURNS) -> tuple[DataFrame, DataFrame]:
    """Nodes of the trie of ``sequences`` (conv_id, turns), and end lists in parts.

    A node, known by (conv_id, depth), is a distinct sequence of the first ``depth`` turns;
    ``conv_id`` is its smallest member. ``ends`` lists in ascending order the members that are
    over there; where it is null, the list of the node's ``key`` is in the second table, in
    parts that ascend with ``part``, so that a list of any length is never one value.
    A conversation without turns ends at the root. Without conversations there is no node.
    ``conversations`` and ``turns`` bound a shard; one conversation is never cut.
    """
    found = written(shard_nodes(sequences, conversations, turns), "trie")
    parts = found.where("shard IS NOT NULL")
    open_nodes = written(_joined(parts), "open-trie")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "key"]
    of_parent = open_nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("open_parent"))
    closed = split_join(found.where("shard IS NULL").drop("key"), of_parent, ["parent_key"], "left")
    closed = closed.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "open_parent"))
    closed = closed.withColumn("key", F.lit(None).cast("binary")).select(*names)
    opened = split_join(open_nodes, of_parent, ["parent_key"], "left").withColumn("parent_conv_id", F.col("open_parent"))
    opened = opened.withColumn("ends", F.lit(None).cast("array<long>")).select(*names)
    lists = parts.where(F.size("ends") > 0).select("key", F.col("shard").alias("part"), "ends")
    return closed.unionByName(opened), lists


def list_digests(lists: DataFrame) -> DataFrame:
    """(key, ends_sha256): the SHA-256 of each key's ids in decimal, joined by commas.

    The parts of a key stream through one hash in order; a task holds one part at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (batch.column("key")[k].as_py(), batch.column("ends")[k].as_py())
            for batch in batches
            for k in range(batch.num_rows)
        )
        for key, parts in groupby(rows, key=lambda r: r[0]):
            digest = hashlib.sha256()
            for number, (_, ends) in enumerate(parts):
                digest.update(b"," * bool(number) + ",".join(map(str, ends)).encode())
            yield pa.RecordBatch.from_pydict({"key": [key], "ends_sha256": [digest.hexdigest()]})

    dealt = lists.repartition("key").sortWithinPartitions("key", "part")
    return dealt.mapInArrow(run, "key binary, ends_sha256 string")


def with_digests(nodes: DataFrame, lists: DataFrame) -> DataFrame:
    """``nodes`` with ``ends_sha256`` (of the empty text where nothing ends) for list and key."""
    at_once = F.sha2(F.array_join(F.expr("transform(ends, i -> CAST(i AS STRING))"), ","), 256)
    joined = nodes.join(list_digests(lists), "key", "left")
    nothing = F.sha2(F.lit(""), 256)
    return joined.withColumn("ends_sha256", F.coalesce("ends_sha256", at_once, nothing)).drop("ends", "key")
