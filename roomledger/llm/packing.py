"""Hierarchical packing of tokenized documents into windows of several lengths.

Documents are routed to the smallest of several tiers (window lengths) that holds them; what
exceeds the longest window is cut off it in whole windows. Each tier is packed by itself, best
fit in decreasing order. The gaps of long windows are filled from shorter tiers, at last with
a part of a document, so that a window is full. Windows of one tier form slots of the longest
length, and equally many slots form a step group.

Each task packs the rows of its partition, a bounded buffer at a time; nothing is shuffled.
What does not fill a window waits for the next buffer. At the end of a partition the rest is
laid out in full windows as far as it goes, and one window is padded.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Callable, Iterator, Sequence
from sys import getsizeof

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.llm.common import whole_texts

TIERS = (256, 512, 1024, 2048)
BUFFER_TOKENS = 1 << 20
SLOTS_PER_STEP = 8
# Bytes of a worker's caches, what a dictionary needs for an entry included, and the bytes of the
# longest word that they keep. Texts without blanks are a single word.
CACHED_WORD_BYTES = 208 << 20
CACHED_LETTER_BYTES = 96 << 20
ENTRY_BYTES = 100
LONGEST_KEPT = 64
END_ID = 1

PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier long, step_group long"


# Tokens


class WordEncoder:
    """Token ids of texts as little-endian 32-bit integers, by a cache of words.

    For tokenizers that drop white space, lower the case and mark the end of words: the ids of
    a text are those of its words, one after the other. Most words are letters and then
    perhaps punctuation; the letters of many new words are encoded together, since a token
    that ends a word shows where the next begins. Any other word is encoded by itself.
    """

    PUNCTUATION = ".,!*$%&#;:?"
    LATIN = "\u0250"  # below it, letters keep their form and their class in any version of Unicode

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words: dict[bytes, bytes] = {}
        self.letters: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.word_bytes = self.letter_bytes = 0
        #: words of the text at hand that are too long to be kept
        self.long_words: dict[bytes, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn_letters(self, runs: list[str]) -> None:
        for at in range(0, len(runs), 500):
            part = runs[at : at + 500]
            ids = self._ids(" ".join(part))
            begin = 0
            for run, end in zip(part, (np.flatnonzero(self.ends[ids]) + 1).tolist(), strict=True):
                self.letters[run] = ids[begin:end].tobytes()
                self.letter_bytes += ENTRY_BYTES + getsizeof(run) + getsizeof(self.letters[run])
                begin = end

    def _keep(self, word: bytes, ids: bytes) -> None:
        self.words[word] = ids
        self.word_bytes += ENTRY_BYTES + getsizeof(word) + getsizeof(ids)

    def _learn(self, words: list[bytes]) -> None:
        parts = {}
        for word in words:
            text = word.decode("utf-8", "replace")
            if len(word) > LONGEST_KEPT:
                self.long_words[word] = self._ids(text).tobytes()
                continue
            run = text.rstrip(self.PUNCTUATION)
            low = run.lower()
            if low.isalpha() and run.isalpha() and max(run) < self.LATIN:
                parts[word] = low, text[len(run) :]
            else:
                self._keep(word, self._ids(text).tobytes())
        self._learn_letters(sorted({low for low, _ in parts.values()}.difference(self.letters)))
        for word, (low, mark) in parts.items():
            if mark not in self.marks:
                self.marks[mark] = self._ids(mark).tobytes()
                self.letter_bytes += ENTRY_BYTES + getsizeof(mark) + getsizeof(self.marks[mark])
            self._keep(word, self.letters[low] + self.marks[mark])

    def encode(self, text: str) -> bytes:
        words = text.encode("utf-8", "replace").split()
        if self.word_bytes > CACHED_WORD_BYTES:
            self.words.clear()
            self.word_bytes = 0
        if self.letter_bytes > CACHED_LETTER_BYTES:
            self.letters.clear()
            self.marks.clear()
            self.letter_bytes = 0
        self.long_words.clear()
        new = set(words).difference(self.words)
        if new:
            self._learn(sorted(new))
        if self.long_words:
            return b"".join([self.words[w] if len(w) <= LONGEST_KEPT else self.long_words[w] for w in words])
        return b"".join(map(self.words.__getitem__, words))


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """One encoder for each path and Python worker, so that tasks share its cache."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


# Windows

# A piece is (length, number of the document in the buffer, start in the document).
Piece = tuple[int, int, int]


class Packer:
    """Packs pieces into windows; ``emit(tier, pieces)`` gets each window that is done."""

    def __init__(self, emit: Callable[[int, list[Piece]], None], tiers: Sequence[int] = TIERS):
        self.tiers = tuple(sorted(tiers))
        self.longest = self.tiers[-1]
        self.emit = emit
        self.waiting: dict[int, list[Piece]] = {t: [] for t in self.tiers}

    def tier_of(self, length: int) -> int:
        return next(t for t in self.tiers if length <= t)

    def add(self, document: int, length: int) -> None:
        at = 0
        while length - at >= self.longest:
            self.emit(self.longest, [(self.longest, document, at)])
            at += self.longest
        if at < length:
            self._wait((length - at, document, at))

    def _wait(self, piece: Piece) -> None:
        self.waiting[self.tier_of(piece[0])].append(piece)

    def flush(self) -> None:
        """Pack what waits; pieces of windows that cannot be filled go on waiting."""
        pools = {t: sorted(p) for t, p in self.waiting.items()}
        self.waiting = {t: [] for t in self.tiers}
        for tier in reversed(self.tiers):
            shorter = [t for t in reversed(self.tiers) if t <= tier]
            pool = pools[tier]
            while pool:
                window, gap = [pool.pop()], tier
                gap -= window[0][0]
                for source in shorter:
                    while gap and pools[source] and (k := bisect_right(pools[source], (gap + 1,))):
                        piece = pools[source].pop(k - 1)
                        window.append(piece)
                        gap -= piece[0]
                if gap:
                    # whatever is left is longer than the gap: a part of the shortest fills it
                    source = next((t for t in self.tiers if t <= tier and pools[t]), None)
                    if source is None:
                        for piece in window:
                            self._wait(piece)
                        continue
                    length, document, start = pools[source].pop(0)
                    window.append((gap, document, start))
                    rest = (length - gap, document, start + gap)
                    insort(pools[self.tier_of(rest[0])], rest)
                self.emit(tier, window)

    def finish(self) -> None:
        """Lay out the rest in full windows, longest first, and what is over in a last one."""
        self.flush()
        rest = sorted((p for pool in self.waiting.values() for p in pool), reverse=True)
        self.waiting = {t: [] for t in self.tiers}
        total = sum(p[0] for p in rest)
        while total:
            tier = next((t for t in reversed(self.tiers) if t <= total), self.longest)
            window, room = [], tier
            while rest and room:
                length, document, start = rest.pop()
                taken = min(length, room)
                window.append((taken, document, start))
                if taken < length:
                    rest.append((length - taken, document, start + taken))
                room -= taken
            self.emit(tier, window)
            total -= sum(p[0] for p in window)


def pack(docs: DataFrame, tokenizer_path: str, tiers: Sequence[int] = TIERS) -> DataFrame:
    """A row for each piece of each document (doc_id, text): where its ids lie.

    The ids of a document are those of the tokenizer without special tokens, then the end id
    1, so that an empty or null text is one token. A very long text is held whole as ids, and a
    worker's cache of words is bounded in bytes, whatever the script. ``sequence_id`` numbers the windows (tasks
    have ranges of their own), ``tier`` is a window's length, ``step_group`` numbers groups of
    ``SLOTS_PER_STEP`` times the longest length. Repeated rows are packed as often as they
    occur; other columns are left out. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer_path)
        base = TaskContext.get().partitionId() << 36
        end = np.array([END_ID], "<u4").tobytes()
        held: dict[int, tuple[object, bytes]] = {}  # by number: doc_id, ids
        open_tokens = number = sequences = slots = 0
        in_slot = dict.fromkeys(tiers, 0)
        slot_of = dict.fromkeys(tiers, 0)
        rows: list[tuple] = []

        def emit(tier: int, window: list[Piece]) -> None:
            nonlocal sequences, slots
            if not in_slot[tier]:
                slot_of[tier] = slots
                slots += 1
            in_slot[tier] = (in_slot[tier] + tier) % packer.longest
            offset = 0
            for length, document, start in window:
                doc_id, ids = held[document]
                crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
                rows.append(
                    (doc_id, start, length, crc, len(ids) // 4, base + sequences, offset, tier,
                     base + slot_of[tier] // SLOTS_PER_STEP)
                )
                offset += length
            sequences += 1

        packer = Packer(emit, tiers)

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows))
            rows.clear()
            arrays = [pa.array(columns[0], schema_type), *(pa.array(c, pa.int64()) for c in columns[1:])]
            return pa.RecordBatch.from_arrays(arrays, names)

        def forget() -> None:
            waiting = {p[1] for pool in packer.waiting.values() for p in pool}
            for document in [d for d in held if d not in waiting]:
                del held[document]

        for batch in batches:
            schema_type = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encoder.encode(text or "") + end
                held[number] = (doc_id, ids)
                packer.add(number, len(ids) // 4)
                number += 1
                open_tokens += len(ids) // 4
                if open_tokens >= BUFFER_TOKENS:
                    packer.flush()
                    forget()
                    open_tokens = 0
                    if rows:
                        yield out()
        packer.finish()
        if rows:
            yield out()

    texts = whole_texts(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {PIECES}"
    names = ["doc_id", *(x.split()[0] for x in PIECES.split(", "))]
    return texts.mapInArrow(run, schema)


def padding(pieces: DataFrame) -> DataFrame:
    """(tokens, padded) of packed pieces: what the windows hold and what fills them up."""
    windows = pieces.groupBy("sequence_id", "tier").agg(F.sum("length").alias("length"))
    return windows.agg(F.sum("length").alias("tokens"), F.sum(F.col("tier") - F.col("length")).alias("padded"))
