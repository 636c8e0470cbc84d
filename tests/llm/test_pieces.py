import hashlib
import random
import sys

import pytest
import sentencepiece
from conftest_llm import ODD_ROWS

from roomledger.llm import pieces
from roomledger.llm.queries import PIECE_MODEL

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
ODD_TEXTS = ["", " ", "  ", " a  b ", "\n", "\n\n a\t\tb\r\n", "don't ▁x▁▁y", "<s> </s> <unk> <0x0A>", "İ É ﬁ Å １２３ 日本語 😀😀", "a\x00b\x1c", "    code\n    x", "==" * 50, "ab" * 3000, " \n \n", "a.\n,b", "...!?", "é"]


@pytest.fixture(scope="module")
def encoder():
    return pieces.PieceEncoder(PIECE_MODEL)


def test_ids_equal_the_library(encoder):
    draw = random.Random(2)
    parts = ["th", "er", "ing", " ", "  ", "\n", ".", ",", "É", "ß", "x", "12", "▁", "語", "\t", "http://", "'s"]
    texts = ["".join(draw.choices(parts, k=draw.randrange(80))) for _ in range(400)]
    for text in [*texts, *ODD_TEXTS]:
        assert encoder.encode(text) == LIBRARY.encode(text), text


def test_agenda_equals_repeated_best_merges(encoder):
    """Brute force: merge the leftmost pair of the best score, again and again."""

    def slow(run):
        symbols = list(run)
        while True:
            pairs = [(encoder.ranks[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in encoder.ranks]
            if not pairs:
                break
            _, i = min(pairs)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        return tuple(x for s in symbols for x in ([encoder.ids[s]] if s in encoder.ids else [encoder.bytes[b] for b in s.encode()]))

    draw = random.Random(4)
    for _ in range(500):
        run = "▁" + "".join(draw.choices("thering aeosß", k=draw.randrange(1, 25))).replace(" ", "")
        assert encoder.merge(run) == slow(run)


def test_a_wrong_id_is_found(encoder):
    other = pieces.PieceEncoder(PIECE_MODEL)
    other.ids["▁the"] = 5
    with pytest.raises(ValueError):
        other.encode("the")


def test_small_caches_give_the_same(monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_UNIT_BYTES", 400)
    monkeypatch.setattr(pieces, "CACHED_RUN_BYTES", 400)
    other = pieces.PieceEncoder(PIECE_MODEL)
    for text in ["one two three four", "five, six. one", "two"]:
        assert other.encode(text) == LIBRARY.encode(text)


def test_round_trip(spark, documents):
    rows = [*ODD_ROWS, (10, "w " * 60_000), *((20 + i, t) for i, t in enumerate(ODD_TEXTS))]
    got = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in pieces.round_trip(documents(rows), PIECE_MODEL).collect()}
    want = set()
    for doc_id, text in rows:
        ids = LIBRARY.encode(text or "", add_eos=True)
        joined, decoded = " ".join(map(str, ids)), LIBRARY.decode(ids)
        want.add((doc_id, len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == want
    assert pieces.round_trip(documents([]), PIECE_MODEL).count() == 0


def test_caches_are_bounded_in_bytes_for_texts_without_blanks(monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_UNIT_BYTES", 300_000)
    monkeypatch.setattr(pieces, "CACHED_RUN_BYTES", 200_000)
    encoder = pieces.PieceEncoder(PIECE_MODEL)
    draw = random.Random(4)
    for k in range(60):
        long = "".join(draw.choices("日本語文字列", k=9000)) + f" end{k}"
        short = " ".join("".join(draw.choices("abcdefgh", k=7)) for _ in range(300))
        for text in (long, short):
            assert encoder.encode(text) == LIBRARY.encode(text)
        held = sum(sys.getsizeof(x) for d in (encoder.units, encoder.runs) for kv in d.items() for x in kv)
        assert held < 700_000 and max(map(len, [*encoder.units, *encoder.runs])) <= pieces.LONGEST_KEPT
        assert len(encoder.long_units) <= 1


def test_decoded_texts_equal_the_library(encoder):
    draw = random.Random(6)
    parts = ["th", "er", " ", "  ", "\n", ".", "É", "▁", "語", "\t", "<0x41>", "😀", "\x00", "�"]
    texts = ["".join(draw.choices(parts, k=draw.randrange(1, 40))) for _ in range(400)] + ODD_TEXTS
    for text, units in zip(texts, encoder.prepare(texts)):
        ids = LIBRARY.encode(text)
        assert encoder.decode(text, units, ids) == LIBRARY.decode(ids), text
