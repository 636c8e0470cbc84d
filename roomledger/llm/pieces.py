"""SentencePiece encoding for merge-type vocabularies, by an agenda of symbol pairs.

A text starts as its characters. The agenda holds the adjacent pairs that make a piece of the
vocabulary, best score first and of equal ones the leftmost; the first of the agenda is merged
and its new neighbours enter, until the agenda is empty. Characters outside the vocabulary
become their bytes.

No merge crosses a place where two characters meet that no piece holds side by side. A text is
cut there into units, and equal units are encoded once per Python worker and cache. In each
Arrow batch the units that are new are encoded and decoded by the library too.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush
from sys import getsizeof

import pyarrow as pa
from pyspark.sql import DataFrame

# Bytes of a worker's caches, what a dictionary needs for an entry included, and the letters of
# the longest unit that they keep. Texts without blanks are one unit a line.
CACHED_UNIT_BYTES = 176 << 20
CACHED_RUN_BYTES = 96 << 20
ENTRY_BYTES = 100
LONGEST_KEPT = 64
SPACE = "▁"
PUNCTUATION = ".,!*$%&#;:?"


class PieceEncoder:
    """Encodes as the library does for the model at ``path``: BPE, blanks marked, byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib = self.library
        self.ids: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        scores: dict[str, float] = {}
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                self.ids[piece], scores[piece] = i, lib.get_score(i)
        order = {score: r for r, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.ranks = {piece: order[score] for piece, score in scores.items()}
        self.side_by_side = {a + b for piece in self.ids for a, b in zip(piece, piece[1:])}
        if any(p[1] == SPACE != p[0] for p in self.side_by_side):
            raise ValueError("this vocabulary has pieces that go over a blank")
        met = set("".join(self.side_by_side))
        #: characters that never merge and come often between words
        alone = "".join(c for c in "\n\t\r" if c not in met)
        if not alone:
            raise ValueError("this vocabulary has no character that stands alone")
        self.alone = alone[0]
        self.unit_pattern = re.compile(f"[{alone}]|{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+")
        #: ids in decimal, parted by blanks
        self.runs: dict[str, str] = {}
        self.units: dict[str, str] = {}
        self.run_bytes = self.unit_bytes = 0
        #: units of the texts at hand that are too long to be kept; whether one of them is odd
        self.long_units: dict[str, str] = {}
        self.long_odd = False
        #: units that the library decodes to something else than their own text
        self.odd_units: set[str] = set()

    # One run of characters that may merge

    def merge(self, run: str) -> tuple[int, ...]:
        """Ids of a run of characters by the agenda of adjacent pairs.

        An entry of the agenda is a number: the rank of the pair's score, then the place of
        its left symbol. It is stale if the symbols there make another pair by now.
        """
        rank = self.ranks.get
        symbols: list[str] = list(run)
        n = len(symbols)
        agenda = []
        for i in range(n - 1):
            r = rank(run[i : i + 2])
            if r is not None:
                agenda.append(r << 32 | i)
        if agenda:
            heapify(agenda)
            before, after = list(range(-1, n - 1)), list(range(1, n + 1))
            symbols.append("")
        while agenda:
            entry = heappop(agenda)
            left = entry & 0xFFFFFFFF
            right = after[left]
            pair = symbols[left] + symbols[right] if symbols[left] else ""
            if rank(pair) != entry >> 32:
                continue
            symbols[left], symbols[right] = pair, ""
            then = after[left] = after[right]
            if then < n:
                before[then] = left
                r = rank(pair + symbols[then])
                if r is not None:
                    heappush(agenda, r << 32 | left)
            earlier = before[left]
            if earlier >= 0:
                r = rank(symbols[earlier] + pair)
                if r is not None:
                    heappush(agenda, r << 32 | earlier)
        found: list[int] = []
        for symbol in symbols:
            if symbol:
                known = self.ids.get(symbol)
                if known is None:
                    found.extend(self.bytes[b] for b in symbol.encode("utf-8", "replace"))
                else:
                    found.append(known)
        return tuple(found)

    # Units

    def _run_ids(self, run: str) -> str:
        ids = self.runs.get(run)
        if ids is None:
            ids = " ".join(map(str, self.merge(run)))
            if len(run) <= LONGEST_KEPT:
                self.runs[run] = ids
                self.run_bytes += ENTRY_BYTES + getsizeof(run) + getsizeof(ids)
        return ids

    def _unit_ids(self, unit: str) -> str:
        """Of the letters and of the punctuation after them, where no piece joins the two."""
        word = unit.rstrip(PUNCTUATION)
        at = len(word)
        if 0 < at < len(unit) and unit[at - 1 : at + 1] not in self.side_by_side:
            return f"{self._run_ids(word)} {self._run_ids(unit[at:])}"
        return self._run_ids(unit)

    def split(self, text: str) -> list[str]:
        return self.unit_pattern.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def learn(self, units: set[str]) -> None:
        """Encode units and check them against the library; a difference is an error.

        Units that the library does not decode to their own text are remembered as odd.
        """
        if self.run_bytes > CACHED_RUN_BYTES:
            self.runs.clear()
            self.run_bytes = 0
        new = sorted(units)
        ids = [self._unit_ids(u) for u in new]
        # the library puts a blank before a text; where a unit has none, a lone character parts them
        plain = [len(u) > 1 and u[0] == SPACE for u in new]
        asked = [u[1:] if p else self.alone + u for u, p in zip(new, plain)]
        skipped = len(self.library.encode(self.alone))
        found = self.library.encode(asked, num_threads=1)
        said = self.library.decode(found, num_threads=1)
        for unit, own, p, other, text, back in zip(new, ids, plain, found, asked, said, strict=True):
            if own != " ".join(map(str, other if p else other[skipped:])):
                raise ValueError(f"{unit!r}: {own} but the library gives {other}")
            odd = back != text.replace(SPACE, " ")
            if len(unit) <= LONGEST_KEPT:
                self.units[unit] = own
                self.unit_bytes += ENTRY_BYTES + getsizeof(unit) + getsizeof(own) + odd * ENTRY_BYTES
                if odd:
                    self.odd_units.add(unit)
            else:
                self.long_units[unit] = own
                self.long_odd |= odd

    def prepare(self, texts: Sequence[str]) -> list[list[str]]:
        """The units of each text, all of them known until the next call."""
        split = [self.split(t) for t in texts]
        if self.unit_bytes > CACHED_UNIT_BYTES:
            self.units.clear()
            self.odd_units.clear()
            self.unit_bytes = 0
        self.long_units.clear()
        self.long_odd = False
        new = set().union(*split).difference(self.units)
        if new:
            self.learn(new)
        return split

    def ids_of(self, units: Sequence[str]) -> str:
        """Decimal ids, parted by blanks, of the units of a prepared text."""
        if self.long_units:
            return " ".join([self.units.get(u) or self.long_units[u] for u in units])
        return " ".join(map(self.units.__getitem__, units))

    def decode(self, text: str, units: Sequence[str], ids: list[int]) -> str:
        """What the library's decode gives for the ids of a prepared text.

        It has decoded every unit by itself. Where each came out as it was, blanks being blanks
        and none of them at the beginning, the whole does too.
        """
        plain = text[:1] not in ("", " ") and SPACE not in text and not self.long_odd
        if plain and self.odd_units.isdisjoint(units):
            return text
        return self.library.decode(ids)

    def encode(self, text: str) -> list[int]:
        return list(map(int, self.ids_of(self.prepare([text])[0]).split()))


_ENCODERS: dict[str, PieceEncoder] = {}


def piece_encoder(path: str) -> PieceEncoder:
    """One encoder for each path and Python worker, so that tasks share its cache."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


TEXTS_AT_ONCE = 200


def round_trip(docs: DataFrame, model_path: str, end: bool = True, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` of each row of ``docs``, and its text encoded and decoded.

    ``n_tokens`` counts all ids (the end id too), ``ids_sha256`` is the hash of the decimal
    ids joined by a blank, ``decoded_sha256`` that of the text that the library's decode(ids)
    gives. A null or empty text has the end id only. Of very long texts the units are encoded one
    by one; a worker's caches are bounded in bytes, whatever the script. Rows are encoded one by one: repeated
    rows give repeated results, other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(model_path)
        last = [str(encoder.library.eos_id())] if end else []
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                texts = [t or "" for t in batch.column("text").to_pylist()]
                n, ids_sha, decoded_sha = [], [], []
                for k, (text, units) in enumerate(zip(texts, encoder.prepare(texts))):
                    written = " ".join(filter(None, [encoder.ids_of(units), *last]))
                    ids = list(map(int, written.split()))
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(written.encode()).hexdigest())
                    decoded = encoder.decode(text, units, ids)
                    if not k and decoded != encoder.library.decode(ids):
                        raise ValueError(f"{text!r} is decoded differently by the library")
                    decoded_sha.append(hashlib.sha256(decoded.encode("utf-8", "replace")).hexdigest())
                arrays = [*map(batch.column, carry), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, [*carry, "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(*dict.fromkeys([*carry, "text"]))
    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carry]
    return rows.mapInArrow(run, ", ".join([*kinds, "n_tokens long, ids_sha256 string, decoded_sha256 string"]))
