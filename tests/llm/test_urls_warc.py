import gzip
import hashlib
import html
import math
import random
import re
import sys
from itertools import product
from pathlib import Path

import duckdb
from pyspark.sql import functions as F

from roomledger.llm import urls, warc
from roomledger.llm.queries import ORACLE_SQL, URL_RULES, WARC_DATE, WARC_HEADERS, op1_host_words, op7_warc_derivatives

PAGES = "page_id long, url string, html string, host string, block string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", "clash") for i, u, h in rows], PAGES)


# Urls


def slow_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    cut = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[:cut]


def slow_rule(host, path):
    fitting = []
    for verdict, text in URL_RULES:
        name, _, rest = text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fitting.append((len(text), text, verdict))
    return max(fitting)[1:] if fitting else (None, None)


ODD_URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/1", "x://a.com", "http://a.com/?q=://b.net/es/",
    "http://example.com/en", "http://notexample.com/en/1", "http://www.example.com/en/", "http://m.www.example.com/en/x",
    "ftp://Ü.net/es/\nx", "http://net/es/", "http://a.net/fr/?x#y", "http://h.org#/en/", "http://h.org?a/b", "://com/",
]


def test_rules_equal_brute_force(spark):
    rows = [(i, u, None) for i, u in enumerate(ODD_URLS)] + [(0, ODD_URLS[0], "<p>x")]
    got = urls.judge(pages(spark, rows), URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        url = ODD_URLS[r["page_id"]]
        assert (r["host"], r["path"]) == slow_parts(url), url
        rule, verdict = slow_rule(r["host"], r["path"])
        assert r["rule"] == rule, url
        assert r["verdict"] == (verdict or ("block" if r["block_probability"] >= 0.5 else "allow"))
        if not r["host"]:
            assert r["verdict"] == "allow" and r["host_words"] == []


def test_spam_names_are_blocked(spark):
    names = ["cheappills", "free-bets", "casinowin", "spam-farm", "adultx", "dailynews", "citylibrary", "ththth", "wikidocs"]
    rows = [(i, f"http://blog.{n}.example.org/de/{i}", "<p>the daily news of the city</p>") for i, n in enumerate(names)]
    got = {r["page_id"]: r for r in urls.judge(pages(spark, rows), URL_RULES).collect()}
    assert [got[i]["verdict"] for i in range(9)] == ["block"] * 5 + ["allow"] * 4
    assert got[0]["host_words"] == ["blog", "cheap", "pills", "example", "org"]
    assert got[5]["host_words"][1:3] == ["daily", "news"]


LEARNED_BAD = "zorbo plinq gratta vexil drumba kwizz sloty pokko".split()
LEARNED_GOOD = "meadow anvil harbour lantern willow copper saddle orchard".split()


def test_words_outside_the_seeds_are_learned(spark):
    """Hosts of words that no labelled name holds, written without a gap, are judged right."""
    bad_seeds, good_seeds = ["cheap pills", "casino win", "poker slots"], ["daily news", "city library", "garden club"]
    text = "<p>" + " ".join([*LEARNED_BAD, *LEARNED_GOOD, "cheap pills casino poker slots daily news city library garden club"] * 20)
    known = [(w + s.split()[0] + s.split()[1], bad) for ws, ss, bad in ((LEARNED_BAD, bad_seeds, True), (LEARNED_GOOD, good_seeds, False)) for w in ws for s in ss]
    unseen = [(a + b, bad) for ws, bad in ((LEARNED_BAD, True), (LEARNED_GOOD, False)) for a in ws for b in ws if a < b]
    rows = [(i, f"http://{n}.example.org/", text) for i, (n, _) in enumerate(known + unseen)]
    rows += [(9999, f"http://{unseen[0][0]}.example.org/", text)] * 50  # pages of one host teach once
    got = {r["page_id"]: r for r in urls.judge(pages(spark, rows), [], bad_seeds, good_seeds).collect()}
    for i, (name, bad) in enumerate(known + unseen):
        assert got[i]["verdict"] == ("block" if bad else "allow"), name
        assert "".join(got[i]["host_words"]) == name + "exampleorg"
        assert len(got[i]["host_words"]) == (5 if i < len(known) else 4), got[i]
    undecided = {r["page_id"]: r["verdict"] for r in urls.judge(pages(spark, rows), [], ["x y"], ["v w"]).collect()}
    assert set(undecided.values()) == {"allow"}  # seeds that meet nothing teach nothing


def test_weights_equal_brute_force(spark):
    draw = random.Random(4)
    seeds = urls.seed_counts(["bad worse", "ill"], ["good better"])
    vocabulary = ["bad", "worse", "ill", "good", "better", "u", "v", "w", "x", "en"]
    names = [(f"h{draw.randrange(12)}", [draw.choice(vocabulary) for _ in range(draw.randrange(5))]) for _ in range(60)]
    got = {r["word"]: r["weight"] for r in urls.learned_weights(spark.createDataFrame(names, "host string, words array<string>"), seeds).collect()}
    own = urls.word_weights(seeds)
    shares = {}
    for host, words in names:
        p = 1 / (1 + math.exp(-(sum(own.get(w, 0) for w in words) + math.log(0.25))))
        if p >= urls.TEACHES_BLOCK or p <= urls.TEACHES_ALLOW:
            for w in set(words) - {"en"}:
                shares.setdefault((host, w), []).append(float(p >= urls.TEACHES_BLOCK))
    counts = {w: [0.0, 0.0] for w in {*seeds, *(w for _, w in shares)}}
    for (_, w), xs in shares.items():
        counts[w][0] += sum(xs) / len(xs)
        counts[w][1] += 1 - sum(xs) / len(xs)
    taught = [sum(c[i] for c in counts.values()) for i in (0, 1)]
    given = [sum(n[i] for n in seeds.values()) for i in (0, 1)]
    low = min(taught[i] + given[i] for i in (0, 1))
    scales = [low / (taught[i] + given[i]) for i in (0, 1)]
    ends = [taught[i] * scales[i] + given[i] + len(seeds) for i in (0, 1)]
    assert got.keys() == counts.keys() and len(got) > len(seeds)
    for w, c in counts.items():
        bad, good = (c[i] * scales[i] + seeds.get(w, (0, 0))[i] + 1 for i in (0, 1))
        assert math.isclose(got[w], math.log(bad / ends[0]) - math.log(good / ends[1]), abs_tol=1e-9)


def test_long_host_and_text(spark):
    rows = [(1, "http://" + "cheappills" * 400 + ".org/" + "casino-" * 3000, "<p>" + "word " * 200_000), (2, "http://a.org/", None)]
    got = {r["page_id"]: r for r in urls.judge(pages(spark, rows), []).collect()}
    assert got[1]["verdict"] == "block" and got[1]["host_words"] == ["cheap", "pills"] * 400 + ["org"]
    assert got[2]["verdict"] == "allow"


def test_viterbi_equals_all_cuts():
    draw = random.Random(6)
    for _ in range(200):
        n = draw.randrange(1, 9)
        known = [(i, k, float(draw.randrange(1, 50))) for i in range(n) for k in range(1, n - i + 1) if draw.random() < 0.4]
        counts = {(i, k): c for i, k, c in known}

        def value(cuts):
            return sum(
                (math.log(counts[a, b - a]) if (a, b - a) in counts else math.log(10) * (1 - (b - a))) - math.log(1000)
                for a, b in cuts
            )

        best = -math.inf
        for marks in product([0, 1], repeat=n - 1):
            ends = [i + 1 for i, m in enumerate(marks) if m] + [n]
            best = max(best, value(list(zip([0, *ends], ends))))
        cuts = urls.split_name(n, known, 1000)
        assert cuts[0][0] == 0 and cuts[-1][1] == n and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))
        assert math.isclose(value(cuts), best, abs_tol=1e-9)


def test_whole_table_of_urls(spark, sf_dir):
    rows = op1_host_words(spark, sf_dir).collect()
    assert len(rows) == 250
    spam = ("spam-farm", "cheap-pills", "free-bets", "ads-track", "casino-win", "adult-x")
    for r in rows:
        rule, verdict = slow_rule(r["host"], r["path"])
        assert r["rule"] == rule
        assert r["verdict"] == (verdict or ("block" if any(s in r["host"] for s in spam) else "allow"))


def test_empty_pages(spark):
    assert urls.judge(pages(spark, []), URL_RULES).count() == 0
    found = warc.responses(pages(spark, []), WARC_DATE, WARC_HEADERS)
    assert warc.derivatives(found).count() == 0


# WARC


def parse(raw):
    """Records of a file: (fields, block), reading blocks by their length."""
    at, found = 0, []
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(x.split(": ", 1) for x in lines[1:])
        begin = end + 4
        stop = begin + int(fields["Content-Length"])
        assert raw[stop : stop + 4] == b"\r\n\r\n"
        found.append((fields, raw[begin:stop]))
        at = stop + 4
    return found


ROWS = [
    (1, "http://a.org/1", '<html lang="de"><head><title> A\n b </title></head><body><h1>Ä &amp;lt; b</h1><p>x <b>y</b><br>z</p><a href="/q">q</a><script>no()</script></body></html>'),
    (2, None, None), (3, "http://a.org/3", ""), (4, "http://a.org/4", "no tags &lt;p&gt;"), (4, "http://a.org/4", "no tags &lt;p&gt;"),
    (None, "http://a.org/5", "<p>" * 20_000 + "long"),
]


def test_files_round_trip(spark, tmp_path):
    found = warc.responses(pages(spark, ROWS), WARC_DATE, WARC_HEADERS)
    made = warc.derivatives(found)
    columns = [c for c in made.columns if c in found.columns]
    both = found.select(*columns, F.lit(None).cast("string").alias("refers_to"), F.lit(None).cast("string").alias("refers_to_target_uri"), F.lit(None).cast("string").alias("refers_to_date")).unionByName(made)
    warc.write(both, str(tmp_path / "out"))
    records = [r for f in Path(tmp_path / "out").glob("part-*") for r in parse(gzip.decompress(f.read_bytes()))]
    assert len(records) == 3 * len(ROWS)
    sources = {f["WARC-Record-ID"]: (f, b) for f, b in records if f["WARC-Type"] == "response"}
    assert len(sources) == len(ROWS) - 1  # equal rows have equal ids
    for fields, block in records:
        assert fields["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
        if fields["WARC-Type"] == "response":
            payload = block.split(b"\r\n\r\n", 1)[1]
            assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(payload).hexdigest()
            assert "WARC-Refers-To" not in fields
        else:
            source, source_block = sources[fields["WARC-Refers-To"]]
            for name in ("WARC-Target-URI", "WARC-Date", "WARC-Payload-Digest"):
                assert fields[name] == source[name]
        if fields["WARC-Type"] == "metadata":
            own = dict(x.split(": ", 1) for x in block.decode().split("\r\n") if x)
            assert int(own["sourceContentLength"]) == len(source_block)
            assert own["sourceBlockDigest"] == source["WARC-Block-Digest"]
            assert b"sourceHeader: HTTP/1.1 200 OK\r\n" in block


def test_text_and_metadata(spark):
    found = warc.responses(pages(spark, ROWS), WARC_DATE, WARC_HEADERS)
    rows = {(r["page_id"], r["record_type"]): r for r in warc.derivatives(found).collect()}
    assert rows[1, "conversion"]["block"] == "Ä &lt; b\nx y\nz\nq"
    assert "title: A b\r\nlanguage: de\r\noutlinks: 1\r\n" in rows[1, "metadata"]["block"]
    assert rows[2, "conversion"]["block"] == "" and rows[2, "conversion"]["target_uri"] == ""
    assert rows[4, "conversion"]["block"] == "no tags <p>"
    assert rows[None, "conversion"]["block"] == "long"


def test_entities_equal_the_standard_library(spark):
    texts = [
        "a &copy; b &middot;c &#169;&#xA9;&#Xa9; &eacute;&Eacute; &euro;&#8364; &#128512;", "&amp;lt; &amp;amp;#65;",
        "&", "&&amp;&", "&unknown; &copy &lt", "x&apos;y&#39;z", "", "&nbsp;|&#160;", "&thetasym;&Theta;&theta;",
    ]
    left = ["&#0;", "&#xD800;", "&#1114112;", "&#xFEFF;", "&#99999999;", "&#;"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *left])], "i int, t string")
    got = [r[0] for r in rows.orderBy("i").select(warc.decoded(F.col("t"))).collect()]
    assert got[: len(texts)] == [
        re.sub(r"&#?\w+;", lambda m: html.unescape(m[0]), t).replace("\xa0", " ") for t in texts
    ]
    assert got[len(texts) :] == left
    alone = duckdb.connect()
    alone.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    alone.executemany("INSERT INTO pages VALUES (?, 'u', ?)", [(i, t) for i, t in enumerate([*texts, *left])])
    own = f"SELECT block FROM ({ORACLE_SQL['op7_warc_derivatives']}) WHERE record_type = 'conversion' ORDER BY page_id"
    clean = rows.orderBy("i").select(warc.plain_text(F.col("t"))).collect()
    assert [r[0] for r in alone.execute(own).fetchall()] == [r[0] for r in clean]


def test_records_equal_sql(spark, sf_dir):
    sys.path.insert(0, str(Path(__file__).parents[1]))
    from oracle_check import connect, differences

    assert differences(op7_warc_derivatives(spark, sf_dir), connect(sf_dir), ORACLE_SQL["op7_warc_derivatives"]) is None


def test_whole_table_of_pages(spark, sf_dir):
    rows = op7_warc_derivatives(spark, sf_dir).collect()
    assert len(rows) == 500
    assert len({r["record_id"] for r in rows}) == 500
    assert all("<p>" not in r["block"] and "track(" not in r["block"] for r in rows)
