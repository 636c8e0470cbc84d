"""URL filter: host and path rules, then naive Bayes on the words of host and path.

Host names are often words without a gap. A unigram model of the words of all pages (and of
the labelled examples) splits them by the Viterbi algorithm. A page does not count the words of
its own host, which it often names: each host would be a word. A multinomial naive Bayes model
then weighs the words of the host and the tokens of the path. Labelled names are its seeds; the
hosts that they decide teach it the other words.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.llm.common import written
from roomledger.operators.joins import split_join

LONGEST_WORD = 20
#: Share of the corpus that each word of the labelled names stands for.
NAME_WEIGHT = 1e-5
BLOCK_PRIOR = 0.2
#: Labelled names of each class count so often; with it a few words decide.
NAME_COPIES = 6
#: A host whose words in the labelled names give it this probability or more teaches the model
#: what is blocked, one at or below the other what is allowed; hosts between them teach nothing.
TEACHES_BLOCK, TEACHES_ALLOW = 0.5, 0.05

# The labelled names that the model is fitted on.
BLOCKED_NAMES = """
cheap pills online pharmacy; buy viagra cialis; casino win jackpot; free casino bets;
online poker slots; sports bets bonus; adult x video; xxx porn tube; sex cams live;
hot singles dating; escort girls; spam link farm; article spam; ads track click;
pop ads tracker; banner ads; ad server track; payday loans fast; quick cash loan;
get rich money; crypto doubler; replica watches cheap; cheap designer bags; win free prize;
free iphone winner; warez crack keygen; torrent crack download; diet pills miracle;
weight loss pills; lottery win; gambling bets; hack cheats; fake followers; clickbait traffic
""".split(";")
ALLOWED_NAMES = """
daily news; city library; school science; open docs; health wiki; travel blog; music forum;
research archive; weather map; public data; university press; free encyclopedia; history journal;
garden club; food recipes; book review; football team; local market; art museum; film festival;
about contact; article page; help support; software project; code review; math course;
photo gallery; online course; video lecture; live concert; win rate chess; cash flow report;
train track map; farm shop; bonus chapter; loan library; market watch; game review
""".split(";")
#: These stand in names of either kind and count nothing.
COMMON_WORDS = "www m blog home index html example site page en de fr es com net org".split()


# Parts of an url


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both are empty if the url is null or has no ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    known = F.coalesce(url, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(known, pattern, 1), upper, lower)
    return host, F.regexp_extract(known, pattern, 2)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]], verdict: bool) -> Column:
    """The longest rule that fits, or its verdict; null if none fits.

    A rule is (verdict, text); its text is a host and the beginning of a path. It fits the
    host and its subdomains. Of equally long ones the first in the order of texts counts.
    """
    found = F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(decision if verdict else text)).otherwise(found)
    return found


# Words


_TAGS = re.compile(r"(?s)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
_WORDS = re.compile(r"[^\W\d_]+")


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()

    def out():
        kept = {w: n for w, n in counts.items() if len(w) <= LONGEST_WORD}
        counts.clear()
        return pa.RecordBatch.from_arrays([pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            text = html.unescape(_TAGS.sub(" ", source or "")).lower()
            own = set(_WORDS.findall(host))
            counts.update(w for w in _WORDS.findall(text) if w not in own)
        if len(counts) > 300_000:
            yield out()
    if counts:
        yield out()


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n): how often a word stands in the texts of the pages of other hosts.

    A page does not count the runs of letters of its own host. Words of more than ``LONGEST_WORD`` letters are left out: no part of a host that is looked
    up is longer.
    """
    host, _ = host_and_path(F.col("url"))
    counted = pages.select(host.alias("host"), "html").mapInArrow(_count_words, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def split_name(length: int, known: Sequence[tuple[int, int, float]], total: float) -> list[tuple[int, int]]:
    """The most probable cut of a name into (begin, end) by the Viterbi algorithm.

    ``known`` has (begin, length, count) of the words in it. An unknown word of ``k`` letters
    has the probability ``10 / (total * 10 ** k)``. Of equal cuts that with the longer last
    word wins.
    """
    words = {(i, i + n): c for i, n, c in known}
    best = [0.0] + [-math.inf] * length
    begin = [0] * (length + 1)
    log_total = math.log(max(total, 1.0))
    for end in range(1, length + 1):
        for at in range(max(0, end - LONGEST_WORD), end):
            count = words.get((at, end), 0.0)
            cost = math.log(count) if count > 0 else math.log(10) * (1 - (end - at))
            value = best[at] + cost - log_total
            if value > best[end] + 1e-12:
                best[end], begin[end] = value, at
    cuts = []
    while length:
        cuts.append((begin[length], length))
        length = begin[length]
    return cuts[::-1]


def host_words(hosts: DataFrame, counts: DataFrame, extra: dict[str, float], total: float) -> DataFrame:
    """(host, words) of different hosts: the runs of letters, each cut into words.

    Candidates are the parts of up to 20 letters of each host, joined with ``counts``.
    ``extra`` adds to the counts of a bounded list of words.
    """
    parts = (
        hosts.select("host", F.explode(F.sequence(F.lit(1), F.length("host"))).alias("i"))
        .select("host", "i", F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("host") - F.col("i") + 1))).alias("k"))
        .select("host", "i", "k", F.substring("host", F.col("i"), F.col("k")).alias("word"))
        .where(F.col("word").rlike(r"^\p{L}+$"))
    )
    known = (
        parts.join(counts, "word")
        .groupBy("host")
        .agg(F.collect_list(F.struct("i", "k", "n")).alias("known"))  # at most 20 for each letter
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for host, found in zip(batch.column("host").to_pylist(), batch.column("known").to_pylist()):
                counted = {(x["i"] - 1, x["k"]): float(x["n"]) for x in found or ()}
                words = []
                for run_ in _WORDS.finditer(host):
                    begin, end = run_.span()
                    inside = dict()
                    for i in range(begin, end):
                        for k in range(1, min(LONGEST_WORD, end - i) + 1):
                            n = counted.get((i, k), 0.0) + extra.get(host[i : i + k], 0.0)
                            if n:
                                inside[i - begin, k] = n
                    cuts = split_name(end - begin, [(i, k, n) for (i, k), n in inside.items()], total)
                    words.extend(host[begin + a : begin + b] for a, b in cuts)
                out.append(words)
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(out, pa.list_(pa.string()))], ["host", "words"])

    return hosts.join(known, "host", "left").mapInArrow(run, "host string, words array<string>")


# Naive Bayes


def seed_counts(blocked: Sequence[str] = BLOCKED_NAMES, allowed: Sequence[str] = ALLOWED_NAMES) -> dict[str, tuple[int, int]]:
    """Word: how often it stands in the blocked and in the allowed names; no common words."""
    bad, good = (Counter(w for name in names for w in name.split()) for names in (blocked, allowed))
    return {w: (bad[w] * NAME_COPIES, good[w] * NAME_COPIES) for w in sorted({*bad, *good} - {*COMMON_WORDS})}


def _log_odds(bad, good, all_bad, all_good, log=math.log):
    return log((bad + 1) / all_bad) - log((good + 1) / all_good)


def word_weights(seeds: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Log-odds of a word of the labelled names, multinomial with one more of each word."""
    all_bad, all_good = (sum(n[i] for n in seeds.values()) + len(seeds) for i in (0, 1))
    return {w: _log_odds(*n, all_bad, all_good) for w, n in seeds.items()}


def _sum_of(words: Column, weights: dict[str, float]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    return F.aggregate(words, F.lit(0.0), lambda total, w: total + F.coalesce(table[w], F.lit(0.0)))


def probability(odds: Column) -> Column:
    return 1 / (1 + F.exp(-(odds + F.lit(math.log(BLOCK_PRIOR / (1 - BLOCK_PRIOR))))))


def learned_weights(names: DataFrame, seeds: dict[str, tuple[int, int]]) -> DataFrame:
    """(word, weight) of the seeds and of all words of the names that the seeds decide.

    ``names`` has (host, words). A host gives a word one count however many pages it has,
    shared between the classes if its pages are decided differently; so no host with many
    pages outweighs the others. The counts of the larger class are scaled to the total of the
    smaller one: a word seen once then weighs little, whichever class is rare.
    """
    p = probability(_sum_of(F.col("words"), word_weights(seeds)))
    blocked = F.when(p >= TEACHES_BLOCK, 1.0).when(p <= TEACHES_ALLOW, 0.0)
    taught = names.select("host", "words", blocked.alias("blocked")).where("blocked IS NOT NULL")
    taught = taught.select("host", "blocked", F.explode(F.array_distinct("words")).alias("word")).where(~F.col("word").isin(COMMON_WORDS))
    taught = taught.groupBy("host", "word").agg(F.avg("blocked").alias("bad"))
    taught = written(taught.groupBy("word").agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")), "taught")
    sums = taught.agg(F.coalesce(F.sum("bad"), F.lit(0.0)), F.coalesce(F.sum("good"), F.lit(0.0))).first()
    given = [sum(n[i] for n in seeds.values()) for i in (0, 1)]
    totals = [max(1.0, s + g) for s, g in zip(sums, given)]
    scales = [min(totals) / t for t in totals]
    all_bad, all_good = (s * x + g + len(seeds) for s, x, g in zip(sums, scales, given))
    rows = [(w, float(bad), float(good)) for w, (bad, good) in seeds.items()]
    own = names.sparkSession.createDataFrame(rows, "word string, bad double, good double")
    scaled = taught.select("word", (F.col("bad") * scales[0]).alias("bad"), (F.col("good") * scales[1]).alias("good"))
    both = own.unionByName(scaled).groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    return both.select("word", _log_odds(F.col("bad"), F.col("good"), all_bad, all_good, F.log).alias("weight"))


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str]], blocked: Sequence[str] = BLOCKED_NAMES, allowed: Sequence[str] = ALLOWED_NAMES
) -> DataFrame:
    """A row for each row of ``pages`` (page_id, url, html).

    Columns: page_id, host, path, rule, verdict, host_words, block_probability. The verdict is
    that of the rule, else block if the model gives it a probability of one half or more. A
    null url, or one without ``://``, has no rule and no words and is allowed. A word that
    stands neither in a labelled name nor in a name that these decide counts nothing. Rules
    teach nothing: they are the will of the user and say little about words. Repeated rows
    give repeated results and teach nothing more; other columns are left out. A null or empty
    page text adds no words; a text or host of any length is read whole. Of equally probable
    cuts of a host that with the longer last word wins.
    """
    host, path = host_and_path(F.col("url"))
    tokens = F.filter(F.split(F.lower(path), r"[^\p{L}]+"), lambda t: t != "")
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), F.array_join(tokens, " ").alias("path_words"))
    seeds = seed_counts(blocked, allowed)
    counts = written(word_counts(pages), "words")
    in_all = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    given = max(1.0, in_all * NAME_WEIGHT)
    extra = dict.fromkeys([*seeds, *COMMON_WORDS], given)
    found = rows.select("host", "path_words").distinct()
    cut = host_words(found.select("host").where("host <> ''").distinct(), counts, extra, in_all + given * len(extra))
    none = F.array().cast("array<string>")
    names = split_join(found, cut.withColumnRenamed("words", "host_words"), ["host"], "left")
    names = names.withColumn("host_words", F.coalesce("host_words", none))
    of_path = F.filter(F.split("path_words", " "), lambda t: t != "")
    names = written(names.withColumn("words", F.concat("host_words", of_path)), "names")
    weights = learned_weights(names, seeds)
    single = names.select("host", "path_words", "host_words", F.explode_outer("words").alias("word"))
    scored = (
        split_join(single, weights, ["word"], "left")
        .groupBy("host", "path_words")
        .agg(F.first("host_words").alias("host_words"), F.round(F.coalesce(F.sum("weight"), F.lit(0.0)), 9).alias("odds"))
    )
    joined = split_join(rows, scored, ["host", "path_words"]).withColumn("block_probability", probability(F.col("odds")))
    by_rule = rule_for(F.col("host"), F.col("path"), rules, verdict=True)
    by_model = F.when(F.col("block_probability") >= 0.5, "block").otherwise("allow")
    return joined.select(
        "page_id",
        "host",
        "path",
        rule_for(F.col("host"), F.col("path"), rules, verdict=False).alias("rule"),
        F.coalesce(by_rule, by_model).alias("verdict"),
        "host_words",
        "block_probability",
    )
