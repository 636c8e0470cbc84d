"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses. A lexical transducer maps words to symbols: insults with a weight,
threats, targets, negations, reporting verbs. Its insults are given words and stems that it
learns from labelled rows. A transducer of phrases follows insults and threats of several words
and puts their symbol out with the last word. The symbols pass through the composition of three transducers that
follow negation, reported speech and target. A clause is a match if an insult or a threat comes
out; the kind of the match (negated, reported, aimed at somebody) decides what its weight
counts. A logistic model on these counts, fitted on labelled rows around given weights, gives
the score of the text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.llm.common import LABEL_SAMPLE, fit_logistic, labelled_sample

# The given words of the grammar.
INSULTS = """
idiot idiots moron morons stupid dumb loser losers trash scum pathetic worthless disgusting
clown clowns fool foolish imbecile cretin jerk scumbag dumbass asshole bastard
idiota imbécil estúpido tonto idiote imbécile débile stupide dumm dummkopf trottel
""".split()
THREATS = """
kill hurt destroy stab shoot strangle beat töten schlagen umbringen tuer frapper matar golpear
""".split()
TARGETS = """
you your yours yourself du dich dir ihr euch dein tu toi vous votre tú usted ustedes
""".split()
NEGATIONS = """
not no never isn't aren't don't nor without nicht kein keine nie pas jamais sans nunca jamás sin
""".split()
REPORTS = """
said says say called calls claimed wrote told quoted sagte sagt nannte schrieb dit disait écrit
dijo dice llamó escribió
""".split()
INSULT_PHRASES = """
waste of space; piece of garbage; piece of shit; sack of shit; son of a bitch; good for nothing;
hijo de puta; fils de pute; pedazo de mierda; stück scheiße; sale con
""".split(";")
THREAT_PHRASES = """
hunt you down; beat you up; cut you up; watch your back; break your neck; break your legs;
burn in hell; rot in hell; put a bullet; wring your neck; mach dich fertig; te voy a partir;
vais te crever
""".split(";")
GIVEN_WEIGHT = 4.0
#: A phrase says more than a word; a threat counts half as much as an insult (``given_weights``).
INSULT_PHRASE_WEIGHT, THREAT_PHRASE_WEIGHT = 6.0, 8.0

# Stems that are learned: lengths of their beginnings, and what they must show.
STEM_LENGTHS = range(3, 9)
LEAST_PURITY = 0.9
LEAST_CONTEXTS = 5
LEAST_EVIDENCE = 18.0  # nats by which the toxic share departs from that of all rows
MOST_STEMS = 20_000

CLAUSE_ENDS = b'.,;:!?\n"()[]'
SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum() and chr(b) != "'")
TABLE = bytes(
    10 if b in CLAUSE_ENDS else 32 if b in SEPARATORS else b for b in range(256)
)

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
NEGATED, REPORTED = 8, 16  # marks on an insult or a threat
AIMED = 32
KINDS = [
    base | negated | reported | aimed
    for base in (INSULT, THREAT)
    for negated in (0, NEGATED)
    for reported in (0, REPORTED)
    for aimed in (0, AIMED)
]
NEGATION_SCOPE = 4


# Transducers


@dataclass(frozen=True)
class Transducer:
    """``arcs[state][symbol]`` is (next state, symbol that comes out); the start is 0."""

    arcs: list[dict[int, tuple[int, int]]]


def _is_match(symbol: int) -> bool:
    return symbol & 7 in (INSULT, THREAT)


SYMBOLS = [OTHER, TARGET, NEGATION, REPORT] + [
    base | marks for base in (INSULT, THREAT) for marks in (0, NEGATED, REPORTED, NEGATED | REPORTED)
]


def negation() -> Transducer:
    """Marks the matches among the words after a negation."""
    arcs = []
    for left in range(NEGATION_SCOPE + 1):
        row = {}
        for s in SYMBOLS:
            after = NEGATION_SCOPE if s == NEGATION else max(0, left - 1)
            row[s] = (after, s | NEGATED if left and _is_match(s) else s)
        arcs.append(row)
    return Transducer(arcs)


def reported_speech() -> Transducer:
    """Marks the matches after a reporting verb."""
    return Transducer(
        [
            {s: (int(bool(on) or s == REPORT), s | REPORTED if on and _is_match(s) else s) for s in SYMBOLS}
            for on in (0, 1)
        ]
    )


def target() -> Transducer:
    """Its state is 1 once somebody is addressed."""
    return Transducer([{s: (int(bool(on) or s == TARGET), s) for s in SYMBOLS} for on in (0, 1)])


def compose(first: Transducer, second: Transducer) -> Transducer:
    """What comes out of ``first`` goes into ``second``; the states are pairs."""
    size = len(second.arcs)
    arcs = []
    for a in range(len(first.arcs)):
        for b in range(size):
            row = {}
            for s in SYMBOLS:
                to_a, middle = first.arcs[a][s]
                to_b, out = second.arcs[b][middle]
                row[s] = (to_a * size + to_b, out)
            arcs.append(row)
    return Transducer(arcs)


GRAMMAR = compose(compose(negation(), reported_speech()), target())


@dataclass(frozen=True)
class Phrases:
    """A transducer over words: ``arcs[state][word]`` is the next state, 0 for any other word.

    A state stands for the longest beginning of a phrase that the last words spell.
    ``ends[state]`` is (symbol, weight) if a phrase ends there, also inside a longer one.
    """

    arcs: list[dict[bytes, int]]
    ends: list[tuple[int, float] | None]
    words: list[frozenset[bytes]]

    def possible(self, words: set[bytes]) -> bool:
        """Whether all words of some phrase are there."""
        return any(own <= words for own in self.words)


def phrase_transducer(phrases: dict[tuple[bytes, ...], tuple[int, float]]) -> Phrases:
    """The phrases as one automaton; of phrases that end at one word the heaviest counts."""
    children: list[dict[bytes, int]] = [{}]
    ends: list[tuple[int, float] | None] = [None]
    for phrase, found in phrases.items():
        state = 0
        for word in phrase:
            if word not in children[state]:
                children[state][word] = len(children)
                children.append({})
                ends.append(None)
            state = children[state][word]
        ends[state] = found
    arcs: list[dict[bytes, int]] = [dict(children[0])] + [{} for _ in children[1:]]
    level = [(state, 0) for state in children[0].values()]  # a state, and that of its longest end
    while level:
        below = []
        for state, end in level:
            arcs[state] = {**arcs[end], **children[state]}
            ends[state] = max(filter(None, (ends[state], ends[end])), key=lambda x: x[1], default=None)
            below.extend((child, arcs[end].get(word, 0)) for word, child in children[state].items())
        level = below
    return Phrases(arcs, ends, [frozenset(p) for p in phrases])


# The lexical transducer


@dataclass
class Lexicon:
    """Words to symbols and weights; ``stems`` by length, whole words by themselves."""

    words: dict[bytes, tuple[int, float]] = field(default_factory=dict)
    stems: dict[int, dict[bytes, float]] = field(default_factory=dict)
    phrases: Phrases = field(default_factory=lambda: phrase_transducer({}))

    def look_up(self, word: bytes) -> tuple[int, float]:
        found = self.words.get(word)
        if found is not None:
            return found
        for length, stems in self.stems.items():
            weight = stems.get(word[:length])
            if weight is not None and len(word) >= length:
                return INSULT, weight
        return OTHER, 0.0


def _normal(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass").translate(TABLE)


def lexicon(learned: dict[bytes, float]) -> Lexicon:
    """The given words and phrases and the learned stems; a stem that ends in a blank is a whole word."""
    given_phrases = (
        (INSULT, INSULT_PHRASE_WEIGHT, INSULT_PHRASES), (THREAT, THREAT_PHRASE_WEIGHT, THREAT_PHRASES),
    )
    own = Lexicon(phrases=phrase_transducer({tuple(_normal(p).split()): (s, w) for s, w, ps in given_phrases for p in ps}))
    for symbol, given in (
        (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS), (INSULT, INSULTS),
    ):
        for word in given:
            own.words[word.encode()] = (symbol, GIVEN_WEIGHT if symbol == INSULT else 1.0)
    for stem, weight in learned.items():
        if stem.endswith(b" "):
            own.words.setdefault(stem[:-1], (INSULT, weight))
        else:
            own.stems.setdefault(len(stem), {})[stem] = weight
    return own


def _beginnings(word: bytes) -> Iterator[bytes]:
    for length in STEM_LENGTHS:
        if length >= len(word):
            break
        if length == len(word) or word[length] & 0xC0 != 0x80:  # not inside a character
            yield word[:length]
    yield word + b" "


def _count_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each beginning among toxic and among clean texts, and what stands before it.

    ``before`` has a bit for each of 64 classes of preceding words in toxic texts. Copies of a
    text add no new ones, so a text that is copied often does not make its words insults.
    """
    most = 400_000
    counts: dict[bytes, list[int]] = {}

    def out():
        keys = list(counts)
        n = np.array([counts[k] for k in keys], np.uint64).view(np.int64).reshape(-1, 3)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), *(pa.array(n[:, i]) for i in range(3))],
            ["stem", "toxic", "clean", "before"],
        )

    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            words = _normal(text or "").split()
            stems: dict[bytes, int] = {}
            previous = b""
            for word in words:
                if len(word) <= 40:
                    bit = 1 << (xxhash.xxh32_intdigest(previous) % 64) if label else 0
                    stems[word] = stems.get(word, 0) | bit
                previous = word
            seen: dict[bytes, int] = {}
            for word, bits in stems.items():
                for stem in _beginnings(word):
                    seen[stem] = seen.get(stem, 0) | bits
            for stem, bits in seen.items():
                row = counts.get(stem)
                if row is None:
                    row = counts[stem] = [0, 0, 0]
                row[0 if label else 1] += 1
                row[2] |= bits
            if len(counts) > most:
                yield out()
                counts.clear()
    if counts:
        yield out()


def choose_stems(rows: Sequence[tuple[bytes, int, int]], toxic: int, clean: int) -> dict[bytes, float]:
    """The beginnings that mark toxic texts: of nested ones the shortest that is not implied."""
    base = toxic / max(1, toxic + clean)
    if not 0 < base < 1:
        return {}
    strong: dict[bytes, tuple[int, int]] = {}
    for stem, t, c in rows:
        share = min(t / (t + c), 1 - 1e-9)
        gain = share * math.log(share / base) + (1 - share) * math.log((1 - share) / (1 - base))
        if share >= LEAST_PURITY and share > base and (t + c) * gain >= LEAST_EVIDENCE:
            strong[stem] = (t, c)
    extended: dict[bytes, int] = {}
    for stem, (t, _) in strong.items():
        for length in range(1, len(stem)):
            begin = stem[:length]
            extended[begin] = max(extended.get(begin, 0), t)
    chosen: dict[bytes, float] = {}
    for stem in sorted(strong, key=lambda s: (len(s), s)):
        t, c = strong[stem]
        if extended.get(stem, 0) >= 0.95 * t or any(stem[:n] in chosen for n in range(1, len(stem))):
            continue
        chosen[stem] = math.log((t + 0.5) / toxic) - math.log((c + 0.5) / clean)
    return chosen


# Scores


def clause_matches(text: str, own: Lexicon) -> list[tuple[int, float]]:
    """(kind, weight) of each matched clause; of several matches in one the heaviest counts.

    The last word of a phrase gives the symbol of the phrase, the words before it their own.
    """
    plain = _normal(text)
    look = own.look_up
    known = {}
    words = set(plain.split())
    for word in words:
        symbol, weight = look(word)
        if symbol != OTHER:
            known[word] = (symbol, weight)
    phrases = own.phrases if own.phrases.possible(words) else None
    if phrases is None and not any(s in (INSULT, THREAT) for s, _ in known.values()):
        return []
    found = []
    arcs = GRAMMAR.arcs
    for clause in plain.split(b"\n"):
        state, phrase, matches = 0, 0, []
        for word in clause.split():
            symbol, weight = known.get(word, (OTHER, 0.0))
            if phrases is not None:
                phrase = phrases.arcs[phrase].get(word, 0)
                symbol, weight = phrases.ends[phrase] or (symbol, weight)
            state, out = arcs[state][symbol]
            if _is_match(out):
                matches.append((weight, out))
        if matches:
            weight, out = max(matches)
            found.append((out | AIMED * (state & 1), weight))
    return found


def features(text: str, own: Lexicon) -> np.ndarray:
    """For each kind the sum of the clauses' weights, damped; at the end a constant."""
    sums = dict.fromkeys(KINDS, 0.0)
    for kind, weight in clause_matches(text, own):
        sums[kind] += weight
    return np.array([*(min(v, 8.0) + math.log1p(max(0.0, v - 8.0)) for v in sums.values()), 1.0])


def given_weights() -> np.ndarray:
    """Around these the weights are fitted: what is negated or reported counts less."""
    own = []
    for kind in KINDS:
        weight = 1.0 if kind & 7 == INSULT else 0.5
        weight *= 0.6 if kind & NEGATED else 1.0
        weight *= 0.6 if kind & REPORTED else 1.0
        own.append(weight * (1.3 if kind & AIMED else 1.0))
    return np.array([*own, -4.0])


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    weights: np.ndarray

    def score(self, text: str) -> float:
        z = float(features(text, self.lexicon) @ self.weights)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, limit: int = LABEL_SAMPLE) -> Model:
    """Learn stems and weights from at most ``limit`` labelled rows that are not held out.

    Stems come from words of at most 40 bytes; of those that mark toxic rows the ``MOST_STEMS``
    most frequent are looked at, ties by their bytes. ``labels`` has doc_id and toxic. Without rows of both classes only the given words and
    weights hold.
    """
    sample = labelled_sample(labels, "toxic", held_out, limit)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "label")
    sizes = {r["label"] > 0: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    if not toxic or not clean:
        return Model(lexicon({}), given_weights())
    rows = (
        texts.mapInArrow(_count_stems, "stem binary, toxic long, clean long, before long")
        .groupBy("stem")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_or("before").alias("before"))
        .where((F.bit_count("before") >= LEAST_CONTEXTS) & (F.col("toxic") >= LEAST_PURITY * (F.col("toxic") + F.col("clean"))))
        .orderBy(F.desc("toxic"), "stem")
        .limit(MOST_STEMS)
        .select("stem", "toxic", "clean")
        .collect()
    )
    own = lexicon(choose_stems([(bytes(s), t, c) for s, t, c in rows], toxic, clean))

    def measure(batches):
        for batch in batches:
            x = [features(t or "", own).tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("label")], ["x", "label"])

    kinds = texts.mapInArrow(measure, "x array<double>, label double")
    points = kinds.groupBy("x", "label").agg(F.count(F.lit(1)).cast("double").alias("n")).collect()
    x = np.array([p["x"] for p in points])
    y = np.array([p["label"] for p in points])
    weight = np.array([p["n"] for p in points])
    return Model(own, fit_logistic(x, y, weight, penalty=2.0, prior=given_weights()))


def score(docs: DataFrame, model: Model, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` of each row and its ``toxicity`` (0 to 1).

    A null or empty text has no matched clause and gets the score of such texts. Rows are
    scored one by one: repeated rows give repeated results, other columns are left out. A text
    of any length is read whole, and its sums are damped, so that length alone decides nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            arrays = [
                *map(batch.column, carry),
                pa.array([model.score(t) for t in texts], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, [*carry, "toxicity"])

    rows = docs.select(*dict.fromkeys([*carry, "text"]))
    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carry]
    return rows.mapInArrow(run, ", ".join([*kinds, "toxicity double"]))
