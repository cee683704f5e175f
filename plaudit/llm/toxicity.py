"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insult, threat, target, negation, reported speech, other. Four
small transducers read the symbols of a clause: one matches insults and threats and
emits the word's weight, the others change it where a target stands in the clause
(up), or a negation shortly before or a verb of saying (down). They are composed
once into one machine whose states are their states' product; a clause scores the
sum of its matches, a text by its best clause and its sum over all clauses, through a
logistic curve.

The insult lexicon is learned: words, and beginnings of words for inflected forms,
whose odds of standing in a text labelled toxic are surely high (lower confidence
bound). At most ``SAMPLE_ROWS`` labelled rows outside the held-out fold are used, two
thirds for the lexicon and one third for the curve, texts that share their smallest
word hash once; at most ``LEXICON`` entries are kept. All rows are scored, over
their whole texts. An automaton finds the entries, so only clauses with a match are
read word by word.

Null texts score like empty ones: by the curve's value for no match. Without labels of both
kinds the score is the smoothed share of label 1. Repeated rows score alike;
an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from plaudit.llm.common import held_out
from plaudit.llm.quality import labelled_sample

COPY_HASHES = 8
SAMPLE_ROWS = 12_000
LEXICON = 2_000
LEAST_EVIDENCE = 1.3
BEGINNINGS = (4, 5, 6, 7)
OTHER, TARGET, NEGATION, REPORT, INSULT, THREAT = range(6)
# Function words of the four languages, by symbol.
WORDS = {
    TARGET: "you your yours u he she they them du dich dir dein ihr euch tu toi vous ton te usted ustedes vosotros",
    NEGATION: "not never no neither nor nicht kein keine nie niemals ne pas jamais non nunca ni",
    REPORT: "said says say called quoted reported told wrote sagte sagt nannte schrieb dit disait dijo dice",
    THREAT: "kill murder strangle töten umbringen tuer matar asesinar",
}
THREAT_WEIGHT = 1.0
_CLAUSE_END = re.compile(r"[.!?;:|\n]+")
_WORD = re.compile(r"[^\W\d_]+")


class Transducer:
    """``arcs[state][symbol] = (next state, log factor)``; state 0 begins a clause."""

    def __init__(self, arcs: list[list[tuple[int, float]]]):
        self.arcs = arcs

    def compose(self, other: Transducer) -> Transducer:
        """Both machines read the same symbols; their factors multiply."""
        m = len(other.arcs)
        return Transducer(
            [
                [(a * m + b, x + y) for (a, x), (b, y) in zip(mine, theirs, strict=True)]
                for mine in self.arcs
                for theirs in other.arcs
            ]
        )


def _remember(symbol: int, factor: float, matched=(INSULT, THREAT), base: float = 0.0) -> Transducer:
    """From ``symbol`` to the end of the clause, matches get ``factor``."""
    row = lambda state, x: [(1 if s == symbol else state, x if s in matched else 0.0) for s in range(6)]
    return Transducer([row(0, base), row(1, factor)])


def _recent(symbol: int, factor: float, reach: int = 3) -> Transducer:
    """For ``reach`` words after ``symbol``, matches get ``factor``."""
    arcs = []
    for left in range(reach + 1):
        x = factor if left else 0.0
        arcs.append(
            [(reach if s == symbol else max(left - 1, 0), x if s in (INSULT, THREAT) else 0.0) for s in range(6)]
        )
    return Transducer(arcs)


def grammar() -> Transducer:
    insult = _remember(TARGET, 0.4, (INSULT,))
    threat = _remember(TARGET, 0.6, (THREAT,), base=-3.0)  # a threat needs a target
    return insult.compose(threat).compose(_recent(NEGATION, -0.7)).compose(_remember(REPORT, -0.7))


class Scorer:
    """The lexicon's automaton and the composed machine."""

    def __init__(self, lexicon: tuple[tuple[str, float], ...]):
        import ahocorasick

        self.machine = grammar().arcs
        self.symbol = {w: s for s, words in WORDS.items() for w in words.split()}
        self.weight = dict(lexicon)
        self.automaton = ahocorasick.Automaton()
        for unit in [*self.weight, *WORDS[THREAT].split()]:
            self.automaton.add_word(unit.rstrip("*"), len(unit.rstrip("*")))
        if len(self.automaton):
            self.automaton.make_automaton()

    def read(self, word: str) -> tuple[int, float]:
        """A word's symbol and weight."""
        best = self.weight.get(word, 0.0)
        for n in BEGINNINGS:
            if n <= len(word):
                best = max(best, self.weight.get(word[:n] + "*", 0.0))
        if best > 0:
            return INSULT, best
        s = self.symbol.get(word, OTHER)
        return s, THREAT_WEIGHT if s == THREAT else 0.0

    def clause(self, text: str) -> float:
        state, total = 0, 0.0
        for word in _WORD.findall(text):
            symbol, weight = self.read(word)
            state, factor = self.machine[state][symbol]
            if weight:
                total += weight * float(np.exp(factor))
        return total

    def features(self, text: str | None) -> tuple[float, float]:
        """The best clause's score, and the logarithm of all clauses' sum."""
        low = (text or "").lower()
        spans: list[tuple[int, int]] = []
        if low and len(self.automaton):
            for end, n in self.automaton.iter(low):
                start = end - n + 1
                if (start and low[start - 1].isalpha()) or (spans and start < spans[-1][1]):
                    continue
                stop = _CLAUSE_END.search(low, end + 1)
                begin = max(low.rfind(c, 0, start) for c in ".!?;:|\n") + 1
                spans.append((begin, stop.start() if stop else len(low)))
        scores = [self.clause(low[a:b]) for a, b in spans]
        return max(scores, default=0.0), float(np.log1p(sum(scores)))


@lru_cache(maxsize=4)
def scorer(lexicon: tuple[tuple[str, float], ...]) -> Scorer:
    return Scorer(lexicon)


def _units(text: Column) -> Column:
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}{3,}+"), F.lit(0)))

    def beginnings(n: int) -> Column:
        long = F.filter(words, lambda w: F.length(w) >= n)
        return F.transform(long, lambda w: F.concat(F.substr(w, F.lit(1), F.lit(n)), F.lit("*")))

    return F.array_distinct(F.concat(words, *[beginnings(n) for n in BEGINNINGS]))


def learn_lexicon(sample: DataFrame, entries: int = LEXICON) -> tuple[tuple[str, float], ...]:
    """Units and the lower bounds of their log odds of toxic texts, the surest first."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,}+"), F.lit(0))
    hashes = F.array_sort(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))))
    # Copies count once: texts whose ``COPY_HASHES`` smallest word hashes agree.
    sample = sample.withColumn("__sig", F.slice(hashes, 1, COPY_HASHES)).where(F.size("__sig") > 0)
    sample = sample.groupBy("__sig", "__label").agg(F.min_by("text", F.struct("__id", F.xxhash64("text"))).alias("text"))
    rows = sample.select("__label", F.explode(_units(F.col("text"))).alias("unit"))
    total = sample.agg(F.sum("__label"), F.count(F.lit(1))).first()
    ones, zeros = total[0] or 0, (total[1] or 0) - (total[0] or 0)
    if not ones or not zeros:
        return ()
    counts = rows.groupBy("unit").agg(F.sum("__label").alias("a"), F.sum(1 - F.col("__label")).alias("b"))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / b) + float(np.log((zeros + 1) / (ones + 1)))
    sure = odds - 1.64 * F.sqrt(1 / a + 1 / b)
    best = counts.where("a >= 3").select("unit", sure.alias("sure")).where(F.col("sure") >= LEAST_EVIDENCE)
    found = best.orderBy(F.desc("sure"), "unit").limit(entries).toPandas()
    return tuple(zip(found["unit"].tolist(), found["sure"].astype(float).tolist(), strict=True))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 40) -> np.ndarray:
    """Logistic regression with intercept; few rows, few columns."""
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(z.shape[1])
    w[0] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(h, z.T @ (y - p) - ridge * w)
        w = w + np.clip(step, -2, 2)
    return w


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS):
    """The lexicon and the curve's coefficients."""
    sample = labelled_sample(docs, labels, label, rows)
    third = F.pmod(F.xxhash64("__id", F.lit(3)), F.lit(3)) == 0
    lexicon = learn_lexicon(sample.where(~third))

    @pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        s = scorer(lexicon)
        return texts.map(lambda t: list(s.features(t)))

    # Ids may repeat: in one order, so that reruns fit the same rows.
    rest = sample.where(third).orderBy("__id", F.xxhash64("text")).limit(rows)
    rest = rest.select("__label", features("text").alias("x")).toPandas()
    y = rest["__label"].to_numpy(np.float64)
    x = np.array(rest["x"].tolist(), dtype=np.float64).reshape(len(rest), 2)
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return lexicon, np.array([np.log(share / (1 - share)), 0.0, 0.0])
    return lexicon, fit_curve(x, y)


def toxicity_score(model, text: Column) -> Column:
    lexicon, curve = model

    @pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        s = scorer(lexicon)
        x = np.array([s.features(t) for t in texts], dtype=np.float64).reshape(len(texts), 2)
        return pd.Series(1 / (1 + np.exp(-np.clip(curve[0] + x @ curve[1:], -30, 30))))

    return score(text)


def classify_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    model = fit_toxicity(docs, labels)
    scored = docs.select("doc_id", toxicity_score(model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
