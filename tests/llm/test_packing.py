import random
import sys
import zlib
from collections import defaultdict

import numpy as np
from conftest_llm import ODD_ROWS
from tokenizers import Tokenizer

from roomledger.llm import packing
from roomledger.llm.queries import PACKING_TOKENIZER

TOKENIZER = Tokenizer.from_file(PACKING_TOKENIZER)


def slow_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, pieces):
    """Each id of each row lies in one piece, windows have no gap, little is padded."""
    of_doc = defaultdict(list)
    windows = defaultdict(list)
    for p in pieces:
        of_doc[p["doc_id"]].append(p)
        windows[p["sequence_id"]].append(p)
    for doc_id in {i for i, _ in rows}:
        copies = [slow_ids(t) for i, t in rows if i == doc_id]
        own = sorted(of_doc[doc_id], key=lambda p: p["start"])
        assert sum(p["length"] for p in own) == sum(map(len, copies))
        for p in own:
            ids = next(c for c in copies if len(c) == p["doc_tokens"])
            part = np.array(ids[p["start"] : p["start"] + p["length"]], "<u4")
            assert zlib.crc32(part.tobytes()) == p["ids_crc32"]
            assert len(part) == p["length"]
        if len(copies) == 1:
            at = 0
            for p in own:
                assert p["start"] == at
                at += p["length"]
    for window in windows.values():
        at = 0
        for p in sorted(window, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
        assert {p["tier"] for p in window} == {window[0]["tier"]} and at <= window[0]["tier"]
    return windows


def test_pieces_cover_all_ids(spark, documents):
    draw = random.Random(3)
    words = ["Hello", "the", "Straße,", "don't", "x<|endoftext|>y", "***", "日本", "thereoring.", "İx", "42nd"]
    rows = [(i, " ".join(draw.choices(words, k=draw.choice([0, 1, 5, 60, 300, 900, 4000])))) for i in range(150)]
    windows = check(rows, packing.pack(documents(rows).coalesce(2), PACKING_TOKENIZER).collect())
    padded = [w for w in windows.values() if sum(p["length"] for p in w) not in (256, 512, 1024, 2048)]
    assert len(padded) <= 2  # the last of each task


def test_odd_rows(spark, documents):
    check(ODD_ROWS, packing.pack(documents(ODD_ROWS), PACKING_TOKENIZER).collect())
    assert packing.pack(documents([]), PACKING_TOKENIZER).count() == 0


def test_very_long_text(spark, documents):
    check([(1, "word " * 200_000)], packing.pack(documents([(1, "word " * 200_000)]), PACKING_TOKENIZER).collect())


def test_encoder_equals_the_library():
    encoder = packing.WordEncoder(PACKING_TOKENIZER)
    texts = ["fool... İx. ǅa, ΑΣ. aé. ň", "a\x1cb\x85c\x00d", "İ É ﬁ Å １２３ 12!?a", "<| |> <|endoftext|>.", "'s 'S it's. I'LL!", "´ ́ x", "ab" * 5000]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == slow_ids(text)[:-1]


def test_a_small_cache_gives_the_same(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORD_BYTES", 400)
    encoder = packing.WordEncoder(PACKING_TOKENIZER)
    for text in ["a bb cc dd ee", "ff gg a, bb.", "hh"]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == slow_ids(text)[:-1]


def test_steps_are_balanced(spark, documents):
    rows = [(i, "some words " * (i % 400)) for i in range(600)]
    pieces = packing.pack(documents(rows).coalesce(1), PACKING_TOKENIZER).collect()
    tokens = defaultdict(int)
    for p in pieces:
        tokens[p["step_group"]] += p["length"]
    full = packing.SLOTS_PER_STEP * 2048
    # all but the last groups are full, but for slots of the shorter tiers that were not filled
    assert sum(t == full for t in tokens.values()) >= len(tokens) - 4
    assert max(tokens.values()) <= full


def test_padding_sums_up(spark, documents):
    pieces = packing.pack(documents([(1, "a b"), (2, "c")]).coalesce(1), PACKING_TOKENIZER)
    total = packing.padding(pieces).first()
    assert (total["tokens"], total["padded"]) == (5, 2043)


def test_caches_are_bounded_in_bytes_for_texts_without_blanks(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORD_BYTES", 300_000)
    monkeypatch.setattr(packing, "CACHED_LETTER_BYTES", 200_000)
    encoder = packing.WordEncoder(PACKING_TOKENIZER)
    draw = random.Random(4)
    for k in range(60):
        long = "".join(draw.choices("日本語文字列", k=9000)) + f" end{k}"
        short = " ".join("".join(draw.choices("abcdefgh", k=7)) for _ in range(300))
        for text in (long, short, "a" * 500 + "!"):
            assert encoder.encode(text) == np.array(slow_ids(text)[:-1], "<u4").tobytes()
        held = sum(sys.getsizeof(x) for d in (encoder.words, encoder.letters) for kv in d.items() for x in kv)
        assert held < 700_000 and max(map(len, encoder.words), default=0) <= packing.LONGEST_KEPT
        assert len(encoder.long_words) <= 1
