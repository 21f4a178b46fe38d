"""Toxicity by a weighted finite-state pattern grammar.

The grammar is a cascade of small transducers over the words of a clause, composed into one
machine.  A lexical transducer turns words into classes (insult, threat, target, negation,
reported speech, other) with a weight; the negation, reported-speech and target
transducers each keep a memory (of some words; reported speech to the end of its clause) and
rescale the weight of the insults and threats that follow (or, for targets, come just before).  A clause's score is the weight of
its path; isolated words do not score by themselves, and a negated, reported or
untargeted one scores less.

The lexicon is a fixed seed list plus word stems learned from labelled texts: for each
stem, how many labelled texts of either kind hold a word that begins with it (counted by Spark
over the sample).  The weight of a stem is its log-likelihood ratio; a stem is kept if the
association is beyond chance (a G-test).  It is a threat if its texts are toxic where a target
follows it rather than elsewhere (a G-test as well), else an insult.  How far negation, report
and targets change a weight is learned next, by a logistic regression on the weights that the
strongest clause of a text has in each of these states.  The strongest and the summed clause scores and
the number of scored clauses of a text give, by logistic regression on the part of
the sample that the lexicon has not seen, the score of a text.

The lexicon and the regression are fitted on at most ``SAMPLE`` labelled texts, drawn by seeded
hash; every text is scored, on the whole of it.

Defined cases: null text is empty text and gets the score of a text without any match;
without usable labels the seed list and default coefficients serve; labels of an id that
has several take the largest; repeated rows get equal scores.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import LETTERS, crc_mod, row_sums, small_batches, table, tidy
from marquee.llm.quality import labelled

SAMPLE, STEMS, SHORTEST, LONGEST, MIN_G = 15_000, 3000, 3, 8, 25.0
#: Texts whose stems are counted at once in a task.
COUNTED = 50
#: Weight of a seed word that the labels do not speak about.
SEED_WEIGHT = 3.0
THRESHOLD = 0.3
#: Points at which the effect of the strongest clause may change its slope.
HINGES = (0.0, 1.0, 2.0, 3.0, 4.5)

# Seed words of the grammar's classes (en, de, fr, es).
INSULTS = """idiot idiots moron morons stupid dumb pathetic worthless loser losers scum trash clown
disgusting vermin filth bastard imbecile dummkopf trottel abschaum arschloch imbécile ordure
crétin estúpido idiota basura imbécil""".split()
THREATS = "kill hurt destroy murder burn beat töten umbringen tuer détruire matar destruir".split()
TARGETS = """you your yours they them their he him she her people are is du dich ihr euch sie er sind ist
tu te toi vous ils elle es sont tú ti él ella ellos usted son""".split()
NEGATIONS = "not never neither nor isn aren don nicht kein keine nie jamais aucun nunca tampoco".split()
REPORTS = """said says saying reported claimed wrote quoted quote alleged sagte schrieb behauptete
déclaré écrit dijo afirmó escribió""".split()

OTHER, INSULT, THREAT, TARGET, NEG, REPORT = range(6)
_CLAUSE = re.compile(r"[.!?;:\n|]+")


# -- transducers ------------------------------------------------------------------------

@dataclass(frozen=True)
class Transducer:
    """Deterministic and total: ``step(state, symbol)`` gives the next state, the scale of the
    symbol's weight, and a weight of its own."""
    start: object
    step: object

    def __rshift__(self, other: "Transducer") -> "Transducer":
        """Composition: both read the symbol, scales multiply and weights add."""
        def step(state, symbol):
            a, sa, wa = self.step(state[0], symbol)
            b, sb, wb = other.step(state[1], symbol)
            return (a, b), sa * sb, wa * sb + wb
        return Transducer((self.start, other.start), step)


def _memory(opens: int, length: int | None, scale: float) -> Transducer:
    """For ``length`` words after an ``opens`` symbol (None: to the end of the clause), scale
    insults and threats by ``scale``."""
    def step(left, symbol):
        now = scale if left else 1.0
        if symbol == opens:
            nxt = length or 1
        else:
            nxt = left if length is None else max(0, left - 1)
        return nxt, now if symbol in (INSULT, THREAT) else 1.0, 0.0
    return Transducer(0, step)


def _spoken_to(length: int, insult: float, threat: float) -> Transducer:
    """A target soon after an insult adds to it; a threat before a target is a threat to it."""
    def step(state, symbol):
        kind, left = state
        if symbol in (INSULT, THREAT):
            return (symbol, length), 1.0, 0.0
        if symbol == TARGET and left:
            return (OTHER, 0), 1.0, insult if kind == INSULT else threat
        return (kind if left > 1 else OTHER, max(0, left - 1)), 1.0, 0.0
    return Transducer((OTHER, 0), step)


def compiled(machine: Transducer) -> tuple[list[list[int]], list[list[float]], list[list[float]]]:
    """All reachable states as tables: next state, scale and weight by symbol."""
    number, todo = {machine.start: 0}, [machine.start]
    nxt, scale, weight = [], [], []
    while todo:
        state = todo.pop(0)
        rows = [machine.step(state, s) for s in range(6)]
        for s, _, _ in rows:
            if s not in number:
                number[s] = len(number)
                todo.append(s)
        nxt.append([number[r[0]] for r in rows])
        scale.append([r[1] for r in rows])
        weight.append([r[2] for r in rows])
    return nxt, scale, weight


class Scales(NamedTuple):
    """What negation, reported speech and a target before an insult or threat make of its weight,
    and what a target after one adds.  The defaults serve without labels, or for states that too
    few texts show."""
    negated: float = 0.4
    reported: float = 0.5
    targeted: float = 1.2
    insult_to: float = 0.5
    threat_to: float = 1.0


#: Words that a negation, a target before, and an insult or threat before a target reach.
NEG_REACH, TARGET_REACH, TO_REACH = 3, 4, 3


@lru_cache(maxsize=8)
def grammar_of(scales: Scales) -> tuple[list[list[int]], list[list[float]], list[list[float]]]:
    """Negated within some words, reported to the end of the clause, addressed."""
    return compiled(_memory(NEG, NEG_REACH, scales.negated) >> _memory(REPORT, None, scales.reported)
                    >> _memory(TARGET, TARGET_REACH, scales.targeted)
                    >> _spoken_to(TO_REACH, scales.insult_to, scales.threat_to))


#: The same machine with scales that only mark the states, to read them off a path: the exponents
#: of 2, 8 and 32 in a scale, and the parts 1 and 1,000 of a weight.
MARKS = Scales(2.0, 8.0, 32.0, 1.0, 1000.0)
_CLASS = {w: c for c, ws in ((TARGET, TARGETS), (NEG, NEGATIONS), (REPORT, REPORTS)) for w in ws}


STATES = ("plain", "negated", "reported", "targeted", "insult_to", "threat_to")


class Grammar:
    """The composed machine with a lexicon: stems (or, ending in a blank, whole words) to
    (class, weight)."""

    def __init__(self, lexicon: dict[str, tuple[int, float]], scales: Scales = Scales()) -> None:
        self.lexicon = lexicon
        self.machine = grammar_of(scales)
        self.longest = max(map(len, lexicon), default=0)
        self.finder = ahocorasick.Automaton()
        for stem in lexicon:
            self.finder.add_word(stem.rstrip(), len(stem.rstrip()))
        if lexicon:
            self.finder.make_automaton()

    def word(self, w: str) -> tuple[int, float]:
        """Class and weight: of the entries that the word begins with, the heaviest."""
        best = self.lexicon.get(w + " ")
        for k in range(SHORTEST, min(len(w), self.longest) + 1):
            hit = self.lexicon.get(w[:k])
            if hit and (best is None or hit[1] > best[1]):
                best = hit
        return best or (_CLASS.get(w, OTHER), 0.0)

    def clause(self, words: list[str]) -> float:
        nxt, scale, weight = self.machine
        state, total = 0, 0.0
        for w in words:
            symbol, own = self.word(w)
            total += own * scale[state][symbol] + weight[state][symbol]
            state = nxt[state][symbol]
        return total

    def states(self, words: list[str]) -> list[float]:
        """What a clause holds by state: weights that are plain, negated, reported (and not
        negated), targeted (and neither), and how many insults and threats have a target after."""
        nxt, scale, weight = grammar_of(MARKS)
        state, out = 0, [0.0] * len(STATES)
        for w in words:
            symbol, own = self.word(w)
            mark, to = int(scale[state][symbol]), int(weight[state][symbol])
            # the product of the marks: its exponent has 1 for negated, 3 reported, 5 targeted
            at = {1: 1, 3: 2, 4: 1, 5: 3, 6: 1, 8: 2, 9: 1}.get(mark.bit_length() - 1, 0)
            out[at] += own
            out[4] += to % 1000
            out[5] += to // 1000
            state = nxt[state][symbol]
        return out

    def strongest(self, text: str | None) -> list[float]:
        """The states of the clause of the largest plain sum of weights; zeros without any."""
        best, most = [0.0] * len(STATES), 0.0
        for words in self._hit(text):
            found = sum(self.word(w)[1] for w in words)
            if found > most:
                best, most = self.states(words), found
        return best

    def clauses(self, text: str | None) -> list[float]:
        """Scores, if above 0, of the clauses in which a lexicon entry begins a word."""
        return [s for s in map(self.clause, self._hit(text)) if s > 0]

    def _hit(self, text: str | None) -> Iterator[list[str]]:
        """The words of the clauses in which a lexicon entry begins a word."""
        if not text or not self.lexicon:
            return
        low = text.lower()
        starts = []
        for end, size in self.finder.iter(low):
            at = end - size + 1
            if at == 0 or not low[at - 1].isalpha():
                starts.append(at)
        if not starts:
            return
        k = begin = 0
        bounds = [m.span() for m in _CLAUSE.finditer(low)] + [(len(low), len(low))]
        for stop, after in bounds:
            if k < len(starts) and starts[k] < stop:
                while k < len(starts) and starts[k] < stop:
                    k += 1
                yield LETTERS.findall(low[begin:stop])
            begin = after

    def features(self, text: str | None) -> list[float]:
        s = self.clauses(text)
        best = max(s, default=0.0)
        return [*(max(0.0, best - at) for at in HINGES), math.log1p(sum(s)), math.log1p(len(s)),
                math.log1p(sum(s) / (1 + len(text) / 500)) if s else 0.0]


# -- learning ---------------------------------------------------------------------------

def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for at in range(0, len(b), COUNTED):
            yield b.iloc[at:at + COUNTED]


def _count_stems(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts of either label that hold a word with the stem (whole words end in a blank), and
    those of them in which a target follows such a word."""
    for b in _slices(batches):
        counts = tuple(Counter() for _ in range(4))     # clean, toxic, the same with a target
        for text, y in zip(b["text"], b["y"]):
            low = (text or "").lower()
            counts[int(y > 0)].update(_stems(set(LETTERS.findall(low))))
            addressed = set()
            for clause in _CLAUSE.split(low):
                words = LETTERS.findall(clause)
                for i, w in enumerate(words):
                    if _CLASS.get(w) == TARGET:
                        addressed.update(words[max(0, i - TO_REACH):i])
            counts[2 + int(y > 0)].update(_stems(addressed))
        keys = list(counts[0].keys() | counts[1].keys())
        yield pd.DataFrame({name: [c[k] for k in keys] for name, c in zip(
            ("clean", "toxic", "clean_to", "toxic_to"), counts)}).assign(stem=keys)


def _stems(words: set[str]) -> set[str]:
    return ({w[:k] for w in words for k in range(SHORTEST, min(len(w), LONGEST) + 1)}
            | {w + " " for w in words})


COUNTS = "clean long, toxic long, clean_to long, toxic_to long, stem string"


def _g(a: Column, b: Column, c: Column, d: Column) -> Column:
    """G-test statistic of the table (a, b), (c, d)."""
    n = a + b + c + d

    def part(seen: Column, row: Column, col: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen * n / (row * col))).otherwise(0.0)

    return 2 * (part(a, a + b, a + c) + part(b, a + b, b + d) + part(c, c + d, a + c)
                + part(d, c + d, b + d))


def learn_lexicon(rows: DataFrame) -> dict[str, tuple[int, float]]:
    """``rows``: text, y.  Seed words and the ``STEMS`` strongest learned stems."""
    n = {int(r.y > 0): r.n for r in rows.groupBy((F.col("y") > 0).cast("int").alias("y"))
         .agg(F.count("*").alias("n")).collect()}
    seeds = {w + " ": (INSULT, SEED_WEIGHT) for w in INSULTS}
    seeds |= {w + " ": (THREAT, SEED_WEIGHT / 2) for w in THREATS}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return seeds
    t, c = F.col("toxic"), F.col("clean")
    to, c_to = F.col("toxic_to"), F.col("clean_to")
    both = t + c
    g = _g(t, c, n1 - t, n0 - c)
    threat = (to * c > c_to * t) & (_g(to, c_to, t - to, c - c_to) >= MIN_G)
    ratio = F.log((t + 0.5) / (n1 + 1)) - F.log((c + 0.5) / (n0 + 1))
    counted = (rows.select("text", "y").mapInPandas(_count_stems, COUNTS).groupBy("stem")
               .agg(*[F.sum(k).alias(k) for k in ("clean", "toxic", "clean_to", "toxic_to")]))
    seed_words = F.col("stem").isin(list(seeds))
    found = counted.filter(((t >= 3) & (both < n1 + n0) & (ratio > 1.5)) | seed_words).select(
        "stem", g.alias("g"), ratio.alias("w"), threat.alias("threat"))
    top = found.filter(F.col("g") >= MIN_G).orderBy(F.desc("g"), "stem").limit(STEMS).collect()
    out = dict(seeds)
    for r in found.filter(seed_words).collect():           # what the labels say of seed words
        kind = out[r.stem][0]
        out[r.stem] = (kind, max(0.0, r.w))
    learned = {r.stem: r.w for r in top}
    threats = {r.stem for r in top if r.threat}
    for stem, w in learned.items():
        # a longer stem that says no more than a shorter one is left out
        if all(learned.get(stem[:k], -1.0) < w - 0.05 for k in range(SHORTEST, len(stem))):
            out[stem] = (THREAT if stem in threats else out.get(stem, (INSULT,))[0], w)
    return {k: v for k, v in out.items() if v[1] > 0}


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients (the last is the intercept) by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty,
                               x.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


#: Texts that must show a state for its scale to be learned, and the largest scale or addition.
SHOWN, LARGEST = 30, 2.0


def fit_scales(x: np.ndarray, y: np.ndarray) -> Scales:
    """``x``: states of each text's strongest clause.  A scale is the logistic coefficient of its
    state against that of plain weights, within [0, ``LARGEST``]."""
    default = Scales()
    if not len(y) or y.min() == y.max():
        return default
    w = logistic(x, y, ridge=1.0)
    if w[0] <= 0:
        return default
    shown = (x != 0).sum(axis=0)
    return Scales(*[d if shown[i] < SHOWN else float(np.clip(w[i] / w[0], 0.0, LARGEST))
                    for i, d in enumerate(default, start=1)])


#: Coefficients that serve without labels: one insult of seed weight is about even.
DEFAULT = np.array([0.5, *[0.0] * (len(HINGES) - 1), 1.0, 0.5, 0.5, -4.0])


def train(docs: DataFrame, labels: DataFrame, label: Column, keep: Column, id_: str = "doc_id",
          text: str = "text", sample: int = SAMPLE, scales: Scales | None = None) -> dict:
    """``scales``: given ones, or None to learn them."""
    small_batches(docs.sparkSession)
    rows = labelled(docs, id_, text, labels, label, keep, sample)
    part = F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(3))
    lexicon = learn_lexicon(rows.filter(part > 0))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def seen(features) -> tuple[np.ndarray, np.ndarray]:
        got = (rows.filter(part == 0).select("y", features("text").alias("x"),
                                             F.xxhash64("id").alias("h"))
               .orderBy("h", "y").limit(sample).collect())      # at most ``sample`` short vectors
        return np.array([r.x for r in got]), np.array([float(r.y > 0) for r in got])

    if scales is None:
        scales = fit_scales(*seen(_described(shared, lambda g: g.strongest, Scales())))
    x, y = seen(_described(shared, lambda g: g.features, scales))
    model = {"lexicon": lexicon, "scales": scales, "w": DEFAULT}
    return model if not len(y) or y.min() == y.max() else model | {"w": logistic(x, y)}


def _described(lexicon, of, scales: Scales):
    @F.pandas_udf("array<double>")
    def describe(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = of(Grammar(lexicon.value, scales))
        for texts in batches:
            yield pd.Series([features(t) for t in texts], dtype=object)
    return describe


def toxicity_score(docs: DataFrame, text: Column, model: dict) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        grammar = Grammar(m["lexicon"], m["scales"])
        for texts in batches:
            x = np.array([grammar.features(t) for t in texts]).reshape(-1, len(m["w"]) - 1)
            z = row_sums(x * m["w"][:-1]) + m["w"][-1]
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))
    return score(text)


def held_out(id_: str = "doc_id") -> Column:
    return F.coalesce(crc_mod(id_, 4) == 2, F.lit(False))


@tidy
def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """All documents; labels of ids with crc32 mod 4 = 2 are held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels, F.col("toxic"), ~held_out())
    return docs.select("doc_id", held_out().alias("held_out"),
                       toxicity_score(docs, F.col("text"), model).alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))
