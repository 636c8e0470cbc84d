import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from conftest_llm import ODD_ROWS
from tokenizers import Tokenizer

from roomledger.llm import alignment, bytebpe
from roomledger.llm.queries import BYTE_TOKENIZER, PIECE_MODEL, op13_token_alignment

ODD_TEXTS = ["x", "  a  b ", "d <|endoftext|> </s> f", "▁x", "日本語 😀 １２", "a\n\n b\t c", "x" * 1500 + " y", "<0x41>", "é é ﬁ"]
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def ranges(tokens):
    found, at = [], 0
    for i, b in tokens:
        found.append((i, at, at + len(b)))
        at += len(b)
    return found


def brute_force(rows):
    library = Tokenizer.from_file(BYTE_TOKENIZER)
    library.encode_special_tokens = True
    other = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    letter = bytebpe.byte_letters()

    def piece(i):
        said = other.id_to_piece(i)
        return bytes([int(said[3:5], 16)]) if other.is_byte(i) else said.replace("▁", " ").encode()

    documents = []
    for i, text in rows:
        a = b = []
        if text:
            whole = " " + text
            a = [(t, bytes(letter[c] for c in library.id_to_token(t))) for t in library.encode(whole, add_special_tokens=False).ids]
            b = [(t, piece(t)) for t in other.encode(text)]
            if any(b"".join(x for _, x in side) != whole.encode() for side in (a, b)):
                a = b = []
        documents.append((i, ranges(a), ranges(b)))
    links = [[(x, y) for x, s, e in a for y, t, u in b if s < u and t < e] for _, a, b in documents]
    count = Counter(pair for own in links for pair in set(own))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (i, a, b), own in zip(documents, links):
        groups, at = [], 0
        for end in sorted({e for *_, e in a} & {e for *_, e in b}):
            groups.append("|".join(",".join(str(t) for t, s, e in side if at <= s and e <= end) for side in (a, b)))
            at = end
        said = ";".join(groups)
        digest = hashlib.sha256(said.encode()).hexdigest() if said else ""
        out.append((i, len(a), len(b), len(groups), len(own), sum(count[p] == best[p[0]] for p in own), sum(count[p] for p in own), digest))
    return sorted(out, key=str)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("buckets, run_documents", [(None, 4096), (5, 3)])
def test_equals_brute_force(spark, documents, buckets, run_documents):
    given = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(25).collect() if len(r.text) < 4000]
    rows = [*given, *ODD_ROWS, *((100 + k, t) for k, t in enumerate(ODD_TEXTS))]
    found = alignment.align(documents(rows), BYTE_TOKENIZER, PIECE_MODEL, buckets, run_documents)
    assert sorted_rows(found) == brute_force(rows)


def test_a_third_of_the_rows_are_copies(documents):
    rows = [(i, "the same text, again") for i in range(40)] + [(100 + i, f"text {i} of its own") for i in range(80)]
    found = alignment.align(documents(rows), BYTE_TOKENIZER, PIECE_MODEL, 4, 10)
    assert sorted_rows(found) == brute_force(rows)


def test_very_long_texts_are_encoded_and_linked_in_parts(monkeypatch):
    pair = alignment.Pair(BYTE_TOKENIZER, PIECE_MODEL)
    draw = random.Random(5)
    text = "".join(draw.choices(["th", "er", "ing", " ", "  ", "   ", "\n", ".", "é", "日"], k=60_000))
    first, second = pair.encode(text)
    links = pair.links([first], [second])
    monkeypatch.setattr(alignment, "LONG_TEXT", 1000)
    monkeypatch.setattr(alignment, "PORTION_BYTES", 5000)
    parts = pair.encode(text)
    assert len(first) > 10_000
    assert all(np.array_equal(x, y) for x, y in zip((first, second), parts))
    assert all(np.array_equal(x, y) for x, y in zip(links, pair.links([first], [second])))
    without_blank = pair.encode("日" * 5000)
    assert [len(x) > 0 for x in without_blank] == [True, True]


def test_runs_are_merged_by_a_heap_of_blocks(monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_PAIRS", 7)
    monkeypatch.setattr(alignment, "MERGED_AT_ONCE", 20)
    draw = random.Random(1)
    runs, expected = [], Counter()
    for _ in range(30):
        own = {draw.randrange(40) << 16 | draw.randrange(30): draw.randrange(1, 50) for _ in range(draw.randrange(120))}
        expected.update(own)
        keys = np.array(sorted(own), np.int64)
        runs.append(alignment.run_of(keys, np.array([own[k] for k in keys.tolist()], np.int64)))
    parts = list(alignment.merged(runs))
    assert len(parts) > 5
    assert [x for k, n in parts for x in zip(k.tolist(), n.tolist())] == sorted(expected.items())
    highest = defaultdict(int)
    for k, n in expected.items():
        highest[k >> 16] = max(highest[k >> 16], n)
    marked = [x for p in alignment.with_highest(iter(parts)) for x in zip(*(c.tolist() for c in p))]
    assert marked == [(k, n, int(n == highest[k >> 16])) for k, n in sorted(expected.items())]
    assert alignment.merged_run([]) == b"" and list(alignment.merged([b""])) == []


def test_quick_encoder_equals_the_library():
    encoder = bytebpe.ByteEncoder(BYTE_TOKENIZER)
    draw = random.Random(3)
    parts = ["th", "er", "'s", " ", "  ", "\n", ".", "É", "ß", "12", "²", "語", "\t", " ", "\u0085", "\x1c", "<|endoftext|>", "😀", "a" * 700]
    for _ in range(400):
        text = "".join(draw.choices(parts, k=draw.randrange(60)))
        for special in (True, False):
            assert np.array_equal(encoder.encode(text, special), encoder._by_library(text, special)), text
    assert bytebpe.long_run("a " + "b" * 2000) and bytebpe.long_run(" " * 2000) and not bytebpe.long_run("word " * 900)


def test_empty_table(documents):
    assert alignment.align(documents([]), BYTE_TOKENIZER, PIECE_MODEL).collect() == []


def test_query_has_a_row_for_each_document(spark, sf_dir):
    found = op13_token_alignment(spark, sf_dir).toPandas()
    assert list(found.columns) == COLUMNS
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert (found.n_best <= found.n_links).all() and (found.count_sum >= found.n_links).all()
    assert (found.n_links == found.n_a + found.n_b - found.n_groups).all()
