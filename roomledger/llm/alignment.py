"""Alignment of two tokenizers, with the document count of each linked pair of tokens.

Two tokens are linked where their byte ranges overlap. Their ends cut a text into segments,
and each segment is one link, so a document's links come from two sorted arrays of ends.

Counting is external. A run holds the pairs of some documents, dealt by radix of the first id
to buckets; a bucket of a run is sorted by (first id, second id), delta coded in zstd blocks.
Equal pairs of a run are merged before they are sent, so a pair that every document holds
travels once a run. A heap of block heads merges the runs of a bucket, a bounded number at a
time, and adds up their counts. The merged order is by first id, so the highest count of each
first id is known as soon as its pairs have passed, and the counts are streamed back to the
runs, whose documents add up their contributions.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator, Sequence
from heapq import heapify, heappop, heappush
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.llm.bytebpe import byte_encoder
from roomledger.llm.common import whole_texts, written

RUN_DOCUMENTS = 4096
RUN_BYTES = 8 << 20  # of text
PORTION_BYTES = 1 << 20  # of text whose links are made at once
LONG_TEXT = 1 << 18  # letters of a text above which it is encoded in parts
BLOCK_PAIRS = 4096
FAN_IN = 64
MERGED_AT_ONCE = 1 << 16
BUCKETS = 64  # at least; as many as the session has shuffle partitions

SIDE_BITS = 16  # of the second id in a pair's key


# Tokens


class Pair:
    """Both encoders, and the bytes and the decimal text of each id."""

    def __init__(self, first_path: str, second_path: str):
        import sentencepiece

        self.first = byte_encoder(first_path)
        self.second = sentencepiece.SentencePieceProcessor(model_file=second_path)
        n = max(self.first.token_bytes) + 1
        self.first_bytes = [self.first.token_bytes.get(i, b"") for i in range(n)]
        self.second_bytes = []
        for i in range(self.second.get_piece_size()):
            piece = self.second.id_to_piece(i)
            if self.second.is_byte(i):
                self.second_bytes.append(bytes([int(piece[3:5], 16)]))
            else:
                self.second_bytes.append(piece.replace("▁", " ").encode())
        if len(self.second_bytes) > 1 << SIDE_BITS or n > 1 << SIDE_BITS:
            raise ValueError("ids must fit into 16 bits")
        self.first_length = np.array(list(map(len, self.first_bytes)), np.int64)
        self.second_length = np.array(list(map(len, self.second_bytes)), np.int64)
        marks = ("", ",", "|", ";")
        self.said = [f"{i}{m}" for i in range(max(n, len(self.second_bytes))) for m in marks]
        #: whether a text may be cut before a blank: no piece goes on over one
        self.may_cut = not any(
            "▁" in self.second.id_to_piece(i).lstrip("▁") for i in range(len(self.second_bytes))
        )

    def _second_ids(self, text: str) -> list[int]:
        """The library's ids; a long text goes in parts, cut at blanks between two words.

        The library puts a blank before a text, which stands for the one at which it was cut.
        """
        if len(text) <= LONG_TEXT or not self.may_cut:
            return self.second.encode(text, num_threads=1) if text else []
        found: list[int] = []
        begin = 0
        while begin < len(text):
            end = text.find(" ", begin + LONG_TEXT)
            while end > 0 and text[end - 1] == " ":
                end = text.find(" ", end + 1)
            if end < 0 or end + 1 >= len(text):
                end = len(text)
            found.extend(self.second.encode(text[begin:end], num_threads=1))
            begin = end + 1
        return found

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both sides; none where a side's bytes are not those of blank and text."""
        none = np.empty(0, np.int64)
        if not text:
            return none, none
        whole = " " + text
        first = self.first.encode(whole, special=False)
        second = self._second_ids(text)
        plain = whole.encode("utf-8", "replace")
        if b"".join(map(self.first_bytes.__getitem__, first.tolist())) != plain:
            return none, none
        if b"".join(map(self.second_bytes.__getitem__, second)) != plain:
            return none, none
        return first.astype(np.int64), np.array(second, np.int64)

    def groups(self, first: np.ndarray, second: np.ndarray) -> tuple[int, str]:
        """How many groups the common ends make, and their ids as ``a1,a2|b1;a3|b2``."""
        a = np.cumsum(self.first_length[first])
        b = np.cumsum(self.second_length[second])
        common = np.intersect1d(a, b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, a), np.searchsorted(common, b)
        n = len(a) + len(b)
        place_a = np.arange(len(a)) + np.searchsorted(group_b, group_a)  # second ids of earlier groups
        place_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")
        text = np.empty(n, np.int64)
        # 1: another of the same side and group follows, 2: the other side, 3: another group
        text[place_a] = first * 4 + np.where(np.append(np.diff(group_a) == 0, False), 1, 2)
        text[place_b] = second * 4 + np.where(np.append(np.diff(group_b) == 0, False), 1, 3)
        text[-1] -= 3
        return len(common), "".join(map(self.said.__getitem__, text.tolist()))

    def links(self, firsts: Sequence[np.ndarray], seconds: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, pair key, how often) of all linked pairs, by document and key.

        A key is the first id, then the second in the lower 16 bits. Links are made for a
        bounded portion of the text at a time, cut where tokens of both sides end.
        """
        sizes = [int(self.first_length[f].sum()) for f in firsts]
        first = np.concatenate([*firsts, np.empty(0, np.int64)])
        second = np.concatenate([*seconds, np.empty(0, np.int64)])
        a, b = np.cumsum(self.first_length[first]), np.cumsum(self.second_length[second])
        document_ends = np.cumsum(np.array(sizes, np.int64))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        at_a = at_b = 0
        while at_a < len(a):
            begin = a[at_a - 1] if at_a else 0
            to_a = int(np.searchsorted(a, begin + PORTION_BYTES))
            if to_a < len(a):  # up to the next end of both
                while True:
                    some = a[to_a : to_a + 10_000]
                    k = np.flatnonzero(b[np.minimum(np.searchsorted(b, some), len(b) - 1)] == some)
                    if len(k):
                        to_a += int(k[0]) + 1
                        break
                    to_a += len(some)
            else:
                to_a = len(a)
            to_b = int(np.searchsorted(b, a[to_a - 1], "right"))
            ends_a, ends_b = a[at_a:to_a], b[at_b:to_b]
            ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")  # merges two sorted halves
            ends = ends[np.append(np.diff(ends) != 0, True)]
            key = first[at_a:to_a][np.searchsorted(ends_a, ends)] << SIDE_BITS
            key |= second[at_b:to_b][np.searchsorted(ends_b, ends)]
            record = np.searchsorted(document_ends, ends) << 2 * SIDE_BITS | key
            found.append(np.unique(record, return_counts=True))
            at_a, at_b = to_a, to_b
        if not found:
            none = np.empty(0, np.int64)
            return none, none, none
        records, place = np.unique(np.concatenate([r for r, _ in found]), return_inverse=True)
        often = np.zeros(len(records), np.int64)
        np.add.at(often, place, np.concatenate([n for _, n in found]))
        return records >> 2 * SIDE_BITS, records & ((1 << 2 * SIDE_BITS) - 1), often


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair_of(first_path: str, second_path: str) -> Pair:
    """One for each pair of paths and Python worker."""
    if (first_path, second_path) not in _PAIRS:
        _PAIRS[first_path, second_path] = Pair(first_path, second_path)
    return _PAIRS[first_path, second_path]


# Runs


def _planes(values: np.ndarray) -> bytes:
    """Non-negative integers as planes of bytes, which zstd packs better than whole numbers."""
    return values.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _values(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view("<i8").ravel()


def packed(*columns: np.ndarray) -> bytes:
    """Columns of equal length as one zstd frame."""
    return zstandard.ZstdCompressor(level=1).compress(struct.pack("<I", len(columns)) + b"".join(map(_planes, columns)))


def unpacked(frame: bytes) -> list[np.ndarray]:
    content = zstandard.ZstdDecompressor().decompress(frame)
    (n,) = struct.unpack_from("<I", content)
    size = (len(content) - 4) // n
    return [_values(content[4 + k * size : 4 + (k + 1) * size]) for k in range(n)]


BLOCK_HEAD = struct.Struct("<qI")  # first key, bytes of the frame


def run_of(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and their counts as blocks, each a head and a zstd frame of key steps."""
    parts = []
    for at in range(0, len(keys), BLOCK_PAIRS):
        some = keys[at : at + BLOCK_PAIRS]
        frame = packed(np.diff(some, prepend=some[:1]), counts[at : at + BLOCK_PAIRS])
        parts += [BLOCK_HEAD.pack(int(some[0]), len(frame)), frame]
    return b"".join(parts)


class RunReader:
    """Reads a run block by block."""

    def __init__(self, run: bytes):
        self.run, self.at = memoryview(run), 0

    def head(self) -> int | None:
        """First key of the next block; None at the end."""
        return BLOCK_HEAD.unpack_from(self.run, self.at)[0] if self.at < len(self.run) else None

    def block(self) -> tuple[np.ndarray, np.ndarray]:
        first, size = BLOCK_HEAD.unpack_from(self.run, self.at)
        begin = self.at + BLOCK_HEAD.size
        self.at = begin + size
        steps, counts = unpacked(bytes(self.run[begin : self.at]))
        return np.cumsum(steps) + first, counts


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, with the sum of its counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    begins = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[begins], np.add.reduceat(counts, begins) if len(begins) else counts


def merged(runs: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """K-way merge of runs: sorted parts of (key, sum of counts), no key in two of them.

    The heap holds the first key of each run's next block. Keys below the smallest of them
    cannot come again, so they are added up and leave.
    """
    readers = [RunReader(r) for r in runs]
    heap = [(r.head(), i) for i, r in enumerate(readers) if r.head() is not None]
    heapify(heap)
    keys, counts, held = [], [], 0
    while heap:
        _, i = heappop(heap)
        k, n = readers[i].block()
        keys.append(k)
        counts.append(n)
        held += len(k)
        then = readers[i].head()
        if then is not None:
            heappush(heap, (then, i))
        if heap and held < MERGED_AT_ONCE:
            continue
        k, n = summed(np.concatenate(keys), np.concatenate(counts))
        done = int(np.searchsorted(k, heap[0][0])) if heap else len(k)
        if done:
            yield k[:done], n[:done]
        keys, counts, held = [k[done:]], [n[done:]], len(k) - done


def merged_run(runs: Sequence[bytes]) -> bytes:
    return b"".join(run_of(k, n) for k, n in merged(runs))


def with_highest(parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of (key, count) in order to those of (key, count, 1 if the first id's highest).

    The pairs of the last first id wait for the next part, at most one for each second id.
    """
    none = np.empty(0, np.int64)

    def marked(keys, counts):
        begins = np.flatnonzero(np.diff(keys >> SIDE_BITS, prepend=-1))
        highest = np.maximum.reduceat(counts, begins)
        sizes = np.diff(np.append(begins, len(keys)))
        return keys, counts, (counts == np.repeat(highest, sizes)).astype(np.int64)

    keys, counts = none, none
    for k, n in parts:
        keys, counts = np.concatenate([keys, k]), np.concatenate([counts, n])
        cut = int(np.searchsorted(keys, keys[-1] >> SIDE_BITS << SIDE_BITS))
        if cut:
            yield marked(keys[:cut], counts[:cut])
            keys, counts = keys[cut:], counts[cut:]
    if len(keys):
        yield marked(keys, counts)


# On Spark

RUN_COLUMNS = "n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>"


def encoded_runs(docs: DataFrame, first_path: str, second_path: str, buckets: int = BUCKETS, run_documents: int = RUN_DOCUMENTS) -> DataFrame:
    """A row for each run of documents: their own figures, pair runs by bucket, and records.

    ``headers`` has (bucket, run of the pairs with the number of documents that hold them),
    ``records`` the pairs of each document as places in the pairs of all headers.
    """
    texts = whole_texts(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(first_path, second_path)
        number = TaskContext.get().partitionId() << 32
        ids, texts_now, size = [], [], 0

        def out() -> pa.RecordBatch:
            nonlocal number
            encoded = [pair.encode(t) for t in texts_now]
            firsts, seconds = [f for f, _ in encoded], [s for _, s in encoded]
            document, key, often = pair.links(firsts, seconds)
            own, place, holders = np.unique(key, return_inverse=True, return_counts=True)
            bucket = (own >> SIDE_BITS) % buckets
            order = np.argsort(bucket, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            place = rank[place]
            by_place = np.lexsort((place, document))
            document, place, often = document[by_place], place[by_place], often[by_place]
            n_records = np.bincount(document, minlength=len(ids))
            n_links = np.zeros(len(ids), np.int64)
            np.add.at(n_links, document, often)
            step = np.diff(place, prepend=0)
            fresh = np.diff(document, prepend=-1) != 0
            step[fresh] = place[fresh]
            headers = []
            for b in np.unique(bucket).tolist():
                mine = order[bucket[order] == b]
                headers.append({"bucket": b, "pairs": run_of(own[mine], holders[mine])})
            spoken = [pair.groups(f, s) if len(f) else (0, "") for f, s in encoded]
            row = {
                "run": [number],
                "doc_id": [ids],
                "n_a": [[len(f) for f in firsts]],
                "n_b": [[len(s) for s in seconds]],
                "n_groups": [[n for n, _ in spoken]],
                "n_links": [n_links.tolist()],
                "groups_sha256": [[hashlib.sha256(t.encode()).hexdigest() if t else "" for _, t in spoken]],
                "headers": [headers],
                "records": [packed(step, often)],
                "n_records": [n_records.tolist()],
            }
            number += 1
            return pa.RecordBatch.from_pydict(row, schema)

        schema = None
        for batch in batches:
            if schema is None:
                longs = pa.list_(pa.int64())
                header = pa.list_(pa.struct([("bucket", pa.int32()), ("pairs", pa.binary())]))
                schema = pa.schema(
                    [("run", pa.int64()), ("doc_id", pa.list_(batch.schema.field("doc_id").type)), ("n_a", longs), ("n_b", longs), ("n_groups", longs), ("n_links", longs),
                     ("groups_sha256", pa.list_(pa.string())), ("headers", header), ("records", pa.binary()), ("n_records", longs)]
                )
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids.append(doc_id)
                texts_now.append(text)
                size += len(text)
                if len(ids) >= run_documents or size >= RUN_BYTES:
                    yield out()
                    ids, texts_now, size = [], [], 0
        if ids:
            yield out()

    return texts.mapInArrow(
        run,
        f"run long, doc_id array<{kind}>, {RUN_COLUMNS},"
        " headers array<struct<bucket: int, pairs: binary>>, records binary, n_records array<long>",
    )


def _column_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield tuple(batch.column(c)[k].as_py() for c in range(batch.num_columns))


def pair_counts(headers: DataFrame, buckets: int = BUCKETS, fan_in: int = FAN_IN) -> DataFrame:
    """(bucket, run, pairs) of headers to (bucket, part, table) of all pairs.

    A table is a zstd frame of (key, documents that hold it, 1 if no pair of its first id has
    more). Runs are merged as they come, ``fan_in`` at a time, into one that is merged on with
    the next; a task holds the runs of one bucket that wait, and a bucket's merged run, which
    is bounded by the two vocabularies.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in groupby(_column_rows(batches), key=lambda r: r[0]):
            waiting: list[bytes] = []
            for _, pairs in rows:
                waiting.append(pairs)
                if len(waiting) == fan_in:
                    waiting = [merged_run(waiting)]
            for part, found in enumerate(with_highest(merged(waiting))):
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "part": pa.array([part], pa.int64()), "table": [packed(*found)]})

    dealt = headers.select("bucket", "pairs").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "bucket int, part long, table binary")


def answers(headers: DataFrame, counts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(run, bucket, answer): count and mark of each pair of a header, in its order.

    The tables of a bucket come first in its task, then the headers stream past them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in groupby(_column_rows(batches), key=lambda r: r[0]):
            tables: list[list[np.ndarray]] = []
            known: list[np.ndarray] | None = None
            for _, number, is_header, content in rows:
                if not is_header:
                    tables.append(unpacked(content))
                    continue
                if known is None:
                    known = [np.concatenate(c) for c in zip(*tables)]
                    tables = []
                keys = np.concatenate([k for k, _ in merged([content])])
                at = np.searchsorted(known[0], keys)
                yield pa.RecordBatch.from_pydict(
                    {"run": pa.array([number], pa.int64()), "bucket": pa.array([bucket], pa.int32()), "answer": [packed(known[1][at], known[2][at])]}
                )

    tables = counts.select("bucket", F.col("part").alias("number"), F.lit(False).alias("is_header"), F.col("table").alias("content"))
    asked = headers.select("bucket", F.col("run").alias("number"), F.lit(True).alias("is_header"), F.col("pairs").alias("content"))
    dealt = tables.unionByName(asked).repartition(buckets, "bucket").sortWithinPartitions("bucket", "is_header", "number")
    return dealt.mapInArrow(run, "run long, bucket int, answer binary")


def align(
    docs: DataFrame, first_path: str, second_path: str, buckets: int | None = None, run_documents: int = RUN_DOCUMENTS
) -> DataFrame:
    """For each row of ``docs`` (doc_id, text) its tokens, groups, links and their counts.

    ``first_path`` is a byte-level tokenizers file, ``second_path`` a sentencepiece model.
    ``n_best`` counts the links whose pair is held by as many documents as any pair of its
    first id, ``count_sum`` adds up the pairs' numbers of documents over all links.

    Null and empty texts, and texts that a side does not give back byte by byte, have no
    tokens: zeros and an empty hash. Each row is a document of its own, so repeated rows count
    as often as they occur; ties of the highest count are all best. Very long texts are encoded
    in parts and linked in portions. Other columns are left out; an empty table gives no rows.
    """
    if buckets is None:
        buckets = max(BUCKETS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    runs = written(encoded_runs(docs, first_path, second_path, buckets, run_documents), "runs")
    headers = runs.select("run", F.explode("headers").alias("h")).select("run", "h.bucket", "h.pairs")
    counts = written(pair_counts(headers, buckets), "counts")
    found = answers(headers, counts, buckets).groupBy("run").agg(F.sort_array(F.collect_list(F.struct("bucket", "answer"))).alias("answers"))
    rows = runs.drop("headers").join(found, "run", "left")
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(whole.num_rows):
                row = {n: whole.column(n)[k] for n in whole.schema.names}
                step, often = unpacked(row["records"].as_py())
                sizes = np.array(row["n_records"].as_py(), np.int64)
                ends = np.cumsum(sizes)
                begins = ends - sizes
                place = np.cumsum(step)
                if len(step):  # each document begins anew
                    before = np.concatenate(([0], place))[begins]
                    place -= np.repeat(before, sizes)
                parts = [unpacked(a["answer"]) for a in row["answers"].as_py() or []]
                sums = []
                for which in (1, 0):
                    value = np.concatenate([p[which] for p in parts])[place] * often if parts else often
                    total = np.concatenate(([0], np.cumsum(value)))
                    sums.append(pa.array(total[ends] - total[begins], pa.int64()))
                own = {n: row[n].values for n in names if n in row}
                own |= {"n_best": sums[0], "count_sum": sums[1]}
                yield pa.RecordBatch.from_arrays([own[n] for n in names], names)

    longs = ", ".join(f"{n} long" for n in names[1:-1])
    return rows.mapInArrow(run, f"doc_id {kind}, {longs}, groups_sha256 string")
