"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.llm import (
    alignment,
    anomaly,
    ctw,
    genetic,
    hnsw,
    packing,
    pieces,
    quality,
    simhash,
    toxicity,
    trie,
    urls,
    warc,
)
from roomledger.llm.common import read, remainder

TOXICITY_CUT = 0.5
QUALITY_CUT = quality.CUT_SCORE
SHINGLE_WORDS = 3
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
PACKING_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def toxicity_held_out() -> Column:
    return remainder("doc_id", 5) == 0


def quality_held_out() -> Column:
    return remainder("doc_id", 4) == 2


# The rules of the url filter, (verdict, host and path).
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
WARC_DATE = "2024-01-01T00:00:00Z"
WARC_HEADERS = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8"]


def op1_host_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"), URL_RULES)


def op2_isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = anomaly.fit(docs, read(spark, sf_dir, "labels"))
    return anomaly.judge(docs, model)


def op3_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(read(spark, sf_dir, "documents"), PIECE_MODEL)


def op4_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(read(spark, sf_dir, "documents"), remainder("doc_id", 7) == 2)


def op5_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = simhash.fingerprints(read(spark, sf_dir, "documents"), SHINGLE_WORDS)
    grouped = simhash.near_groups(prints)
    return grouped.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op6_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), PACKING_TOKENIZER)


def op7_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.responses(read(spark, sf_dir, "pages"), WARC_DATE, WARC_HEADERS)
    return warc.derivatives(found)


def op8_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"), quality_held_out())
    return quality.score(docs, model).select(
        "doc_id",
        quality_held_out().alias("held_out"),
        F.col("quality").alias("score"),
        (F.col("quality") >= QUALITY_CUT).cast("int").alias("predicted"),
    )


def op9_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), toxicity_held_out())
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity_held_out().alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= TOXICITY_CUT).cast("int").alias("predicted"),
    )


def op10_hnsw_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = hnsw.usable(read(spark, sf_dir, "embeddings"))
    return hnsw.nearest(table, table.where("vec_id % 100 = 0"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences = trie.with_shared_heads(trie.turn_sequences(read(spark, sf_dir, "conversations")))
    nodes, lists = trie.prefix_trie(sequences)
    return trie.with_digests(nodes, lists)


def op12_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genetic.pack(read(spark, sf_dir, "documents"), BYTE_TOKENIZER)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"), BYTE_TOKENIZER, PIECE_MODEL)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_host_words": op1_host_words,
    "op2_isolation_forest": op2_isolation_forest,
    "op3_piece_round_trip": op3_piece_round_trip,
    "op4_context_tree": op4_context_tree,
    "op5_simhash_anchors": op5_simhash_anchors,
    "op6_hierarchical_packing": op6_hierarchical_packing,
    "op7_warc_derivatives": op7_warc_derivatives,
    "op8_bradley_terry": op8_bradley_terry,
    "op9_toxicity_grammar": op9_toxicity_grammar,
    "op10_hnsw_shards": op10_hnsw_shards,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_genetic_packing": op12_genetic_packing,
    "op13_token_alignment": op13_token_alignment,
}


def _urn(text: str) -> str:
    h = f"md5({text})"
    parts = ", ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"'<urn:uuid:' || concat_ws('-', {parts}) || '>'"


def _warc_sql() -> str:
    """The records of the pages in SQL; a line end is chr(13) || chr(10)."""
    line = "chr(13) || chr(10)"
    head = f" || {line} || ".join([*(f"'{h}'" for h in WARC_HEADERS), "''"]) + f" || {line}"
    text = "payload"
    for pattern, to in (
        (r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->|<head[^>]*>.*?</head>", "' '"),
        (r"(?i)</?(p|div|br|li|ul|ol|h[1-6]|tr|table|nav|article|section|footer|header|body|html)\b[^>]*>", "chr(10)"),
        (r"<[^>]*>", "''"),
    ):
        text = f"regexp_replace({text}, '{pattern}', {to}, 'g')"
    keys, signs = (", ".join("'" + x.replace("'", "''") + "'" for x in xs) for xs in zip(*warc.ENTITIES.items()))
    name = f"regexp_extract(p, '{warc.ENTITY}', 1)"
    code = f"(CASE WHEN {name} LIKE '#x%' OR {name} LIKE '#X%' THEN TRY_CAST('0x' || substr({name}, 3) AS INTEGER) WHEN {name} LIKE '#%' THEN TRY_CAST(substr({name}, 2) AS INTEGER) END)"
    known = f"({code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 1114111) AND {code} <> 65279"
    sign = f"COALESCE(map_extract(MAP([{keys}], [{signs}]), {name})[1], CASE WHEN {code} = 160 THEN ' ' WHEN {known} THEN chr({code}) END)"
    part = f"CASE WHEN i = 1 THEN p WHEN {sign} IS NULL THEN '&' || p ELSE {sign} || substr(p, length({name}) + 2) END"
    text = f"array_to_string(list_transform(string_split({text}, '&'), lambda p, i: {part}), '')"
    text = f"regexp_replace({text}, '[ \\t\\r]+', ' ', 'g')"
    text = f"regexp_replace({text}, ' ?\\n[ \\n]*', chr(10), 'g')"
    fields = {
        "sourceContentLength": "CAST(strlen(source) AS VARCHAR)",
        "sourceContentType": "'application/http; msgtype=response'",
        "sourceBlockDigest": "'sha256:' || sha256(source)",
        "payloadLength": "CAST(strlen(payload) AS VARCHAR)",
        "title": r"trim(regexp_replace(regexp_extract(payload, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g'), ' ')",
        "language": r"""regexp_extract(payload, '(?i)<html[^>]*\blang="([^"]*)"', 1)""",
        "outlinks": r"CAST(len(regexp_extract_all(payload, '(?i)<a\s[^>]*href=')) AS VARCHAR)",
    }
    block = " || ".join([f"'{k}: ' || {v} || {line}" for k, v in fields.items()] + [f"'sourceHeader: {h}' || {line}" for h in WARC_HEADERS])
    ends = "chr(10)"
    response = _urn(f"concat_ws({ends}, 'response', COALESCE(CAST(page_id AS VARCHAR), ''), COALESCE(url, ''), '{WARC_DATE}')")
    own = _urn(f"concat_ws({ends}, record_type, refers_to)")
    return f"""
WITH replies AS (
  SELECT page_id, COALESCE(url, '') AS target_uri, COALESCE(html, '') AS payload, {response} AS refers_to,
         {head} || COALESCE(html, '') AS source
  FROM pages),
made AS (
  SELECT *, 'metadata' AS record_type, 'application/warc-fields' AS content_type, {block} AS block FROM replies
  UNION ALL
  SELECT *, 'conversion' AS record_type, 'text/plain' AS content_type, trim({text}, ' ' || chr(10)) AS block FROM replies)
SELECT page_id, record_type, {own} AS record_id, '{WARC_DATE}' AS date, target_uri, refers_to,
       target_uri AS refers_to_target_uri, '{WARC_DATE}' AS refers_to_date,
       'sha256:' || sha256(payload) AS payload_digest, 'sha256:' || sha256(block) AS block_digest,
       content_type, CAST(strlen(block) AS BIGINT) AS content_length, block
FROM made"""


def _trie_sql() -> str:
    """Every prefix of every rebuilt conversation, grouped; CRC-32 bit by bit."""
    bit = "lambda x, _: xor(x >> 1, (x & 1) * 3988292384)"
    byte = f"lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), {bit})"
    digits = "list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    crc = f"xor(list_reduce(list_prepend(4294967295, {digits}), {byte}), 4294967295)"
    return f"""
WITH own AS (
  SELECT conv_id, list({{'role': COALESCE(role, ''), 'text': COALESCE(text, '')}} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
headed AS (SELECT *, CAST({crc} % 6 AS BIGINT) AS h FROM own),
rebuilt AS (
  SELECT c.conv_id, COALESCE(b.turns[1:c.h], []) || c.turns[c.h + 1:len(c.turns)] AS turns
  FROM headed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
members AS (
  SELECT conv_id, d AS depth, turns[1:d] AS path, len(turns) = d AS over
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE over) AS ends
  FROM members GROUP BY path, depth),
children AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (
  SELECT n.*, COALESCE(n_children, 0) AS n_children,
         CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(n.path[depth].text) END AS saved
  FROM nodes n LEFT JOIN children c ON c.path = n.path),
sums AS (
  SELECT path[1:a] AS path, a AS depth, sum(CAST(n_children = 0 AS BIGINT)) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM counted) GROUP BY 1, 2)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
       sha256(COALESCE(n.ends, '')) AS ends_sha256
FROM counted n JOIN sums s ON s.depth = n.depth AND s.path = n.path
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]"""


# The other operators fit models, hash with XXH64, tokenize or search a graph; SQL cannot say
# that, so the tests compare them with brute force.
ORACLE_SQL: dict[str, str] = {"op7_warc_derivatives": _warc_sql(), "op11_prefix_trie": _trie_sql()}
