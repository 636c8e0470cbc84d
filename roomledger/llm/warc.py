"""WARC derivatives: metadata and plain-text conversion records of responses.

A record is a row: its type, its id, its named header fields and its block. Each response
gives a metadata record (application/warc-fields: size, digests, title, language, number of
links, the headers of the reply) and a conversion record (its text). Both refer to the response by its id and carry its
target, its date and its digests. Ids are derived from the response's id, so that a run that is
repeated gives the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Named fields in the order in which they are written.
FIELDS = [
    ("WARC-Type", "record_type"),
    ("WARC-Record-ID", "record_id"),
    ("WARC-Date", "date"),
    ("WARC-Target-URI", "target_uri"),
    ("WARC-Refers-To", "refers_to"),
    ("WARC-Refers-To-Target-URI", "refers_to_target_uri"),
    ("WARC-Refers-To-Date", "refers_to_date"),
    ("WARC-Payload-Digest", "payload_digest"),
    ("WARC-Block-Digest", "block_digest"),
    ("Content-Type", "content_type"),
]
VERSION = "WARC/1.1"
LINE = "\r\n"
END_OF_RECORD = LINE * 2
#: The named entities of HTML 4 and that of the apostrophe; the hard blank is a blank.
ENTITIES = {**{name: chr(code) for name, code in name2codepoint.items()}, "apos": "'", "nbsp": " "}
ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
RECORD = "record_type string, record_id string, date string, target_uri string, refers_to string, refers_to_target_uri string, refers_to_date string, payload_digest string, block_digest string, content_type string, content_length long, block string"


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(F.encode(text, "UTF-8"), 256))


def record_id(*parts: Column) -> Column:
    """An urn of the form of an UUID, from the hash of what identifies the record."""
    known = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    h = F.md5(F.encode(F.concat_ws("\n", *known), "UTF-8"))
    groups = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *groups), F.lit(">"))


def responses(pages: DataFrame, date: str, headers: Sequence[str]) -> DataFrame:
    """Response records of (page_id, url, html), with page_id and the payload besides.

    The block is the head of a reply, from ``headers``, and the page. A null page is an empty
    payload; a null url is an empty target. Rows that are equal get equal ids.
    """
    head = LINE.join([*headers, ""]) + LINE
    payload = F.coalesce("html", F.lit(""))
    target = F.coalesce("url", F.lit(""))
    block = F.concat(F.lit(head), payload)
    return pages.select(
        "page_id",
        F.lit("response").alias("record_type"),
        record_id(F.lit("response"), F.col("page_id"), F.col("url"), F.lit(date)).alias("record_id"),
        F.lit(date).alias("date"),
        target.alias("target_uri"),
        digest(payload).alias("payload_digest"),
        digest(block).alias("block_digest"),
        F.lit("application/http; msgtype=response").alias("content_type"),
        F.octet_length(block).cast("long").alias("content_length"),
        block.alias("block"),
        payload.alias("payload"),
    )


# The content of a page


def decoded(text: Column) -> Column:
    """``ENTITIES`` and numeric references replaced, in one pass; others stay as they are.

    So do those without a semicolon, and the numbers of no character (0, halves of pairs,
    beyond U+10FFFF) and of the byte order mark.
    """
    table = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])

    def after_sign(part: Column, place: Column) -> Column:
        name = F.regexp_extract(part, ENTITY, 1)
        number = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 6), 16, 10)).when(name.startswith("#"), F.substring(name, 2, 7))
        code = number.try_cast("int")
        character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        known = (code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)) & (code != 0xFEFF)
        sign = F.coalesce(table[name], F.when(code == 160, " ").when(known, character))
        rest = F.substring(part, F.length(name) + 2, F.length(part))
        return F.when(place == 0, part).when(sign.isNotNull(), F.concat(sign, rest)).otherwise(F.concat(F.lit("&"), part))

    return F.array_join(F.transform(F.split(text, "&"), after_sign), "")


def plain_text(payload: Column) -> Column:
    """The text of a page: without scripts, styles, comments and tags, a line for each block.

    Entities are replaced (``decoded``); runs of blanks become one, empty lines go. A very long
    page is handled whole, as one value.
    """
    text = F.regexp_replace(payload, r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->|<head[^>]*>.*?</head>", " ")
    text = F.regexp_replace(text, r"(?i)</?(p|div|br|li|ul|ol|h[1-6]|tr|table|nav|article|section|footer|header|body|html)\b[^>]*>", "\n")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    text = decoded(text)
    text = F.regexp_replace(text, r"[ \t\r]+", " ")
    text = F.regexp_replace(text, r" ?\n[ \n]*", "\n")
    return F.trim(text, F.lit(" \n"))


def title(payload: Column) -> Column:
    found = F.regexp_extract(payload, r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.trim(F.regexp_replace(found, r"\s+", " "))


def language(payload: Column) -> Column:
    return F.regexp_extract(payload, r'(?i)<html[^>]*\blang="([^"]*)"', 1)


def n_links(payload: Column) -> Column:
    return F.regexp_count(payload, F.lit(r"(?i)<a\s[^>]*href="))


def derivatives(found: DataFrame) -> DataFrame:
    """A metadata and a conversion record for each response, in one pass over the table.

    ``found`` is as ``responses`` gives it. Every response has both records, also one whose
    text is empty. ``payload_digest`` of a record is that of the response; ``block_digest`` is
    that of the record's own block.
    """
    payload = F.col("payload")
    fields = F.concat(
        *[
            F.concat(F.lit(name + ": "), value.cast("string"), F.lit(LINE))
            for name, value in (
                ("sourceContentLength", F.col("content_length")),
                ("sourceContentType", F.col("content_type")),
                ("sourceBlockDigest", F.col("block_digest")),
                ("payloadLength", F.octet_length(payload)),
                ("title", title(payload)),
                ("language", language(payload)),
                ("outlinks", n_links(payload)),
            )
        ]
    )
    head = F.substring_index("block", LINE * 2, 1)
    headers = F.concat(F.lit("sourceHeader: "), F.replace(head, F.lit(LINE), F.lit(f"{LINE}sourceHeader: ")), F.lit(LINE))
    fields = F.concat(fields, headers)
    kinds = F.array(
        F.struct(F.lit("metadata").alias("kind"), F.lit("application/warc-fields").alias("type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("kind"), F.lit("text/plain").alias("type"), plain_text(payload).alias("block")),
    )
    rows = found.withColumn("own", F.explode(kinds))
    block = F.col("own.block")
    return rows.select(
        "page_id",
        F.col("own.kind").alias("record_type"),
        record_id(F.col("own.kind"), F.col("record_id")).alias("record_id"),
        "date",
        "target_uri",
        F.col("record_id").alias("refers_to"),
        F.col("target_uri").alias("refers_to_target_uri"),
        F.col("date").alias("refers_to_date"),
        "payload_digest",
        digest(block).alias("block_digest"),
        F.col("own.type").alias("content_type"),
        F.octet_length(block).cast("long").alias("content_length"),
        block.alias("block"),
    )


# Files


def serialized(records: DataFrame) -> Column:
    """A record as text, without the two line ends after it; fields that are null are left out."""
    named = [
        F.when(F.col(column).isNotNull(), F.concat(F.lit(f"{name}: "), F.col(column)))
        for name, column in FIELDS
        if column in records.columns
    ]
    length = F.concat(F.lit("Content-Length: "), F.col("content_length").cast("string"))
    return F.concat(F.concat_ws(LINE, F.lit(VERSION), *named, length), F.lit(LINE * 2), F.col("block"))


def write(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """WARC files, one for each partition of ``records``."""
    lines = records.select(serialized(records).alias("value"))
    lines.write.option("lineSep", END_OF_RECORD).option("compression", compression).text(path)
