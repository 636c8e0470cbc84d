"""Quality and toxicity: held-out accuracy, parts against brute force, odd rows."""

import math
import random
import zlib

import numpy as np
import pytest
from conftest_llm import ODD_ROWS
from pyspark.sql import functions as F

from roomledger.llm import anomaly, quality, toxicity
from roomledger.llm.common import fit_logistic, labelled_sample, read, remainder
from roomledger.llm.queries import op2_isolation_forest, op8_bradley_terry, op9_toxicity_grammar

LABELS = "doc_id long, quality int, toxic int"


def accuracy(rows, labels, column):
    pairs = [(r["predicted"], labels[r["doc_id"]][column]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good = [p for p, y in pairs if y == 1]
    bad = [p for p, y in pairs if y == 0]
    return sum(good) / len(good), 1 - sum(bad) / len(bad)


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return {r["doc_id"]: r for r in read(spark, sf_dir, "labels").collect()}


def test_quality_held_out(spark, sf_dir, labels):
    rows = op8_bradley_terry(spark, sf_dir).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    kept, rejected = accuracy(rows, labels, "quality")
    assert kept > 0.97 and rejected > 0.9


def test_toxicity_held_out(spark, sf_dir, labels):
    rows = op9_toxicity_grammar(spark, sf_dir).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    found, clean = accuracy(rows, labels, "toxic")
    # a third of the few toxic rows here have no word that others share
    assert found > 0.6 and clean > 0.99


def test_rules_with_forest(spark, sf_dir, labels):
    rows = op2_isolation_forest(spark, sf_dir).collect()
    assert len(rows) == 1000
    judged = [(r["kept"], r["base_failed"], labels[r["doc_id"]]["quality"]) for r in rows if r["doc_id"] in labels]
    assert all(kept for kept, failed, y in judged if y == 1 and not failed)
    assert not any(kept for kept, _, y in judged if y == 0)


# Bradley-Terry


def test_pairs_are_ranked():
    draw = np.random.default_rng(0)
    x = np.zeros((300, quality.N_FEATURES))
    x[:, 3] = draw.uniform(0, 1, 300)
    good = x[:, 3] < 0.4
    model = quality.fit_pairs(x, good)
    strengths = np.array([model.strength(r) for r in x])
    assert strengths[good].min() > strengths[~good].max()
    assert ((strengths >= model.cut) == good).all()


def test_a_repeated_bad_row_leaves_the_good_ones(spark):
    """One labelled bad id stands more often in the documents than the limit allows rows."""
    bad = "# $ % & " * 20
    rows = [(i, f"word{i} and other words in a row {i}", 1) for i in range(20)] + [(100 + i, bad + "x" * i, 0) for i in range(5)]
    table = spark.createDataFrame([(i, y, 0) for i, _, y in rows], LABELS)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows + rows[-1:] * 200], "doc_id long, text string")
    once = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    model = quality.fit(docs, table, F.lit(False), limit=100)
    assert all((model.score(t) >= 0.7) == (y == 1) for _, t, y in rows)
    assert np.array_equal(model.weights, quality.fit(once, table, F.lit(False), limit=100).weights)


def test_all_pairs_count():
    """Loss, slope and curvature from the nodes are those of all pairs; so is the optimum."""
    draw = np.random.default_rng(4)
    z = draw.normal(size=(60, 4))
    z[0] *= 30
    good = z[:, 0] + draw.normal(size=60) > 0
    pairs = (z[good][:, None] - z[~good]).reshape(-1, 4)
    weight = 60 / len(pairs)
    for w in (np.zeros(4), draw.normal(size=4) * 4):
        sums = {}
        quality._add(sums, z, good, w)
        loss, slope, curvature = quality._pair_loss(sums, w)
        p = 1 / (1 + np.exp(pairs @ w))
        assert loss == pytest.approx(weight * np.logaddexp(0, -pairs @ w).sum() + w @ w / 2, rel=1e-7)
        assert np.allclose(slope, w - weight * pairs.T @ p, rtol=1e-6, atol=1e-6)
        assert np.allclose(curvature, weight * (pairs * (p * (1 - p))[:, None]).T @ pairs + np.eye(4), rtol=1e-6, atol=1e-4)
    made = fit_logistic(pairs / z.std(axis=0), np.ones(len(pairs)), np.full(len(pairs), weight), 1.0)
    assert np.allclose(quality.fit_pairs(z, good).weights, made, atol=1e-4)


def test_fit_of_a_table_equals_that_of_arrays(spark, sf_dir, labels):
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"), remainder("doc_id", 4) == 2)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    learnt = [i for i in labels if i in texts and zlib.crc32(str(i).encode()) % 4 != 2]
    x = np.array([quality.features(texts[i] or "") for i in learnt])
    here = quality.fit_pairs(x, np.array([labels[i]["quality"] == 1 for i in learnt]))
    assert np.allclose(model.weights, here.weights, atol=1e-5)
    assert model.cut == pytest.approx(here.cut, abs=1e-4)


def test_best_quantile_equals_a_search_of_all_rows(spark):
    draw = np.random.default_rng(6)
    strength = np.round(draw.normal(size=3000), 2)
    good = strength + draw.normal(size=3000) / 2 > 0
    table = spark.createDataFrame(list(zip(strength.tolist(), good.tolist())), "strength double, good boolean")
    cuts = np.unique(np.quantile(strength, np.arange(quality.QUANTILES) / quality.QUANTILES))
    gain = [2 * (strength[good] >= c).mean() + (strength[~good] < c).mean() for c in cuts]
    best = np.flatnonzero(np.array(gain) >= max(gain) - 1e-12)
    keys = quality._quantile_keys(table, 3000)
    assert quality._best_quantile(keys, int(good.sum()), int((~good).sum())) == pytest.approx(cuts[best[len(best) // 2]])


def test_every_labelled_document_teaches(spark):
    """The bad ones are those that a sample of 20,000 would leave out."""
    ids = spark.range(20_100).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    drawn = labelled_sample(ids, "quality", F.lit(False), 20_000).select("doc_id", "label")
    table = ids.join(drawn, "doc_id", "left").select("doc_id", F.coalesce("label", F.lit(0.0)).cast("int").alias("quality"))
    text = F.when(F.col("quality") == 1, F.concat(F.lit("some words in a row "), F.col("doc_id"))).otherwise(F.lit("# $ % & " * 9))
    docs = table.select("doc_id", text.alias("text"))
    model = quality.fit(docs, table, F.lit(False))
    assert model.score("# $ % & " * 9) < 0.7 <= model.score("some words in a row 7")


def test_newton_equals_gradient_descent():
    draw = np.random.default_rng(1)
    x, y = draw.normal(size=(200, 3)), (draw.uniform(size=200) < 0.4).astype(float)
    w = fit_logistic(x, y, np.ones(200), 1.0)
    slow = np.zeros(3)
    for _ in range(4000):
        slow -= 0.01 * (x.T @ (1 / (1 + np.exp(-x @ slow)) - y) + slow)
    assert np.allclose(w, slow, atol=1e-4)


def test_no_labels(spark, documents):
    docs = documents(ODD_ROWS)
    for labels in ([], [(4, 1, 0)], [(99, 0, 1), (4, None, None)]):
        table = spark.createDataFrame(labels, LABELS)
        scored = quality.score(docs, quality.fit(docs, table, F.lit(False))).collect()
        assert len(scored) == len(ODD_ROWS) and all(r["quality"] >= 0.7 for r in scored)
        scored = toxicity.score(docs, toxicity.fit(docs, table, F.lit(False))).collect()
        assert len(scored) == len(ODD_ROWS) and all(r["toxicity"] < 0.5 for r in scored)
        model = anomaly.fit(docs, table)
        rows = anomaly.judge(docs, model).collect()
        assert len(rows) == len(ODD_ROWS) and not any(r["kept"] for r in rows)


def test_empty_tables(spark, documents):
    docs, table = documents([]), spark.createDataFrame([(1, 1, 0), (2, 0, 1)], LABELS)
    assert quality.score(docs, quality.fit(docs, table, F.lit(False))).count() == 0
    assert toxicity.score(docs, toxicity.fit(docs, table, F.lit(False))).count() == 0
    assert anomaly.judge(docs, anomaly.fit(docs, table)).count() == 0


def test_sample_is_bounded_and_held_out(spark):
    table = spark.createDataFrame([(i, i % 2, 0) for i in range(500)] + [(7, 0, 0)], LABELS)
    rows = labelled_sample(table, "quality", remainder("doc_id", 4) == 2, 50).collect()
    assert len(rows) == 50 and len({r["doc_id"] for r in rows}) == 50
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 for r in rows)


# The grammar


def kinds(text, learned=None):
    return sorted(k for k, _ in toxicity.clause_matches(text, toxicity.lexicon(learned or {})))


def test_matched_clauses():
    t = toxicity
    assert kinds("Nothing here, you see.") == []
    assert kinds("What an idiot.") == [t.INSULT]
    assert kinds("You are an idiot. And more") == [t.INSULT | t.AIMED]
    assert kinds("This is not stupid") == [t.INSULT | t.NEGATED]
    assert kinds("not at all or ever a thing so stupid") == [t.INSULT]  # out of the scope
    assert kinds("She said he was a moron") == [t.INSULT | t.REPORTED]
    assert kinds("I will hurt you") == [t.THREAT | t.AIMED]
    assert kinds("not. stupid") == [t.INSULT]  # a clause ends the scope
    assert kinds("idiot! moron?") == [t.INSULT, t.INSULT]
    assert kinds("Veququelle ja", {"vequ".encode(): 5.0}) == [t.INSULT]
    assert kinds("IDIOT%%%") == [t.INSULT]


def test_matched_phrases():
    t = toxicity
    assert kinds("You are a waste of space") == [t.INSULT | t.AIMED]
    assert kinds("This is not a waste of space") == [t.INSULT | t.NEGATED]
    assert kinds("He said: nothing. I will hunt you down") == [t.THREAT | t.AIMED]
    assert kinds("He said I will hunt you down") == [t.THREAT | t.REPORTED | t.AIMED]
    assert kinds("waste of. space") == [] and kinds("a waste of time and space") == []
    assert kinds("son of a son of a BITCH!") == [t.INSULT]
    assert kinds("waste of waste of space, hunt hunt you down") == [t.INSULT, t.THREAT | t.AIMED]
    model = t.Model(t.lexicon({}), t.given_weights())
    assert model.score("I will hunt you down") > 0.5 > model.score("I will not hunt you down")
    assert model.score("a waste of space") > 0.5 > model.score("she said a waste of space")
    assert model.score("the space of a waste") == model.score("nothing")


def test_phrases_equal_search_at_each_word():
    draw = random.Random(9)
    words = [b"a", b"b", b"c"]
    for _ in range(300):
        phrases = {tuple(draw.choices(words, k=draw.randrange(1, 5))): (draw.choice([1, 2]), float(w)) for w in range(1, 6)}
        made = toxicity.phrase_transducer(phrases)
        text, state = draw.choices([*words, b"x"], k=12), 0
        for i, word in enumerate(text):
            state = made.arcs[state].get(word, 0)
            ending = [found for p, found in phrases.items() if tuple(text[max(0, i + 1 - len(p)) : i + 1]) == p]
            assert made.ends[state] == max(ending, key=lambda x: x[1], default=None)


def test_long_text(spark):
    model = toxicity.Model(toxicity.lexicon({}), toxicity.given_weights())
    calm = "the river runs. " * 400_000
    docs = spark.createDataFrame([(1, calm), (2, calm + "You are a waste of space, idiot"), (3, "x" * 5_000_000)], "doc_id long, text string")
    got = {r["doc_id"]: r["toxicity"] for r in toxicity.score(docs, model).collect()}
    assert got[2] > 0.5 > got[1] == got[3] == model.score("")


def test_composition_equals_the_cascade():
    """Every string of symbols up to length 5 through both."""
    from itertools import product

    parts = [toxicity.negation(), toxicity.reported_speech(), toxicity.target()]
    base = [toxicity.OTHER, toxicity.INSULT, toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT]
    for length in range(1, 6):
        for symbols in product(base, repeat=length):
            states, out = [0, 0, 0], []
            for s in symbols:
                for k, part in enumerate(parts):
                    states[k], s = part.arcs[states[k]][s]
                out.append(s)
            state, got = 0, []
            for s in symbols:
                state, s = toxicity.GRAMMAR.arcs[state][s]
                got.append(s)
            assert got == out and state & 1 == states[2]


def test_stems_need_different_contexts(spark):
    """Words of a text that is copied often are no insults; a stem in many places is."""
    copied = [(i, "zorn blick ferne lampe", 1) for i in range(40)]
    spread = [(100 + i, f"wort{i} gräml{'ab' * (i % 5)}x und", 1) for i in range(40)]
    clean = [(200 + i, f"wort{i} und anderes mehr", 0) for i in range(200)]
    rows = [(i, t, y) for i, t, y in copied + spread + clean]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    table = spark.createDataFrame([(i, 1, y) for i, _, y in rows], LABELS)
    model = toxicity.fit(docs, table, F.lit(False))
    assert [s.decode() for s in model.lexicon.stems.get(6, {})] == ["gräml"]
    assert model.lexicon.look_up("lampe".encode())[0] == toxicity.OTHER


def test_reported_insults_count_less():
    model = toxicity.Model(toxicity.lexicon({}), toxicity.given_weights())
    plain, reported, negated, aimed = map(model.score, ("what an idiot", "he said what an idiot", "not an idiot", "you idiot"))
    assert aimed > plain > max(reported, negated)


# The forest


def slow_counts(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, duplicates = set(), 0
    for x in lines:
        duplicates += x in seen
        seen.add(x)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), duplicates, len(covered)]


def test_counts_equal_brute_force():
    import random

    draw = random.Random(8)
    for _ in range(200):
        text = "".join(draw.choices(["a", "b", "É", " ", " ", "\n", "#", "|", "\t", "\x0b", "\x1c", " "], k=draw.randrange(80)))
        assert anomaly.counts(text)[:5] == slow_counts(text), text
    assert anomaly.counts("x y " * 5000)[4] == 10_000


def test_isolated_rows_have_short_paths():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(2000, 4))
    x[:20] += 9
    forest = anomaly.grow(x)
    scores = forest.score(x)
    assert scores[:20].min() > np.quantile(scores[20:], 0.99)
    assert math.isclose(anomaly.mean_path(256), 10.244, abs_tol=0.01)


def test_threshold_keeps_good_rows():
    scores = np.array([0.1, 0.2, 0.3, 0.7, 0.8])
    good = np.array([True, True, True, False, False])
    assert anomaly.threshold(scores, good) == pytest.approx(0.5)
    assert anomaly.threshold(scores, ~good, 0.0) > 0.8


def test_forest_sees_what_no_rule_names(spark):
    """Long words and few different ones, with no symbol, capital, bar or repeated line."""
    draw = np.random.default_rng(5)
    letters = list("abcdefghijklmnopqrst")

    def text(size, different):
        words = ["".join(draw.choice(letters, size + int(draw.integers(3)))) for _ in range(different)]
        return " ".join(draw.choice(words, 120))

    rows = [(i, text(4, 90), 1) for i in range(300)] + [(1000 + i, text(10, 25), 0) for i in range(4)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    table = spark.createDataFrame([(i, y, 0) for i, _, y in rows if i % 2], LABELS)
    got = anomaly.judge(docs, anomaly.fit(docs, table)).collect()
    assert not any(r["base_failed"] for r in got)
    assert len({r["anomaly"] for r in got if r["doc_id"] < 1000}) > 100
    assert {r["doc_id"] for r in got if not r["kept"]} == {1000 + i for i in range(4)}


def test_copies_of_a_row_do_not_fill_the_forest(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i * k}" for k in range(60)), 1) for i in range(20)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows + rows[:1] * 500], "doc_id long, text string")
    table = spark.createDataFrame([(i, y, 0) for i, _, y in rows], LABELS)
    grown, grow = [], anomaly.grow
    monkeypatch.setattr(anomaly, "grow", lambda x: grown.append(len(x)) or grow(x))
    anomaly.fit(docs, table)
    assert grown == [20]


def test_forest_and_threshold_take_every_document(spark, monkeypatch):
    """More documents than the trees had places for, more labels than a sample would take."""
    seen, ranges = [], anomaly._ranges
    monkeypatch.setattr(anomaly, "_ranges", lambda *a: seen.append(list(ranges(*a))) or seen[-1])
    monkeypatch.setattr(anomaly, "GOOD_ROWS_LOST", 0.1)
    monkeypatch.setattr(anomaly, "grow", lambda x, grow=anomaly.grow: grow(x, 2, 4))
    monkeypatch.setattr(labelled_sample, "__defaults__", (5,))
    texts = [(i, " ".join(f"{i * j % 101}x{'y' * (i % 7)}" for j in range(60 + i % 40))) for i in range(1, 101)]
    docs = spark.createDataFrame([*texts, (None, "some words"), *texts[:3]], "doc_id long, text string")
    table = spark.createDataFrame([(i, int(i % 9 > 0), 0) for i, _ in texts], LABELS)
    model = anomaly.fit(docs, table)
    rows = np.array([anomaly.counts(t) for t in [*(t for _, t in texts), "some words"]], float)
    low, high = np.quantile(anomaly.statistics(rows), anomaly.SCALE_RANGE, axis=0, method="inverted_cdf")
    assert np.allclose(model.scale, np.maximum(high - low, anomaly.LEAST_SCALE))
    # each row stands in one of the two trees, the copies as one row
    assert [at for at, *_ in seen[0]] == [0, 1] and sum(n for _, n, *_ in seen[0]) == 101
    assert not any(anomaly.base_failed(r) for r in rows[:-1])
    scores = model.score(rows[:-1])
    good = np.array([i % 9 > 0 for i, _ in texts])
    assert model.threshold == pytest.approx(anomaly.threshold(scores, good, 0.1))


def test_forest_of_a_table_equals_that_of_arrays(spark):
    draw = np.random.default_rng(3)
    x, numbers = draw.normal(size=(500, anomaly.N_STATISTICS)), draw.integers(0, 1 << 40, 500)
    table = spark.createDataFrame([(int(k), r.tolist()) for k, r in zip(numbers, x)], "number long, s array<double>")
    rows = anomaly.Rows(table, 500, np.ones(anomaly.N_STATISTICS))
    forest = anomaly.grow(x, trees=4, rows=40)
    for shares in (1, 3):
        there = anomaly._ranges(rows, forest, None, shares, 4)
        here = anomaly._ranges(x, forest, numbers, shares, 4)
        for a, b in zip(there, here, strict=True):
            assert a[:2] == b[:2] and np.array_equal(a[2], b[2]) and np.array_equal(a[3], b[3])
