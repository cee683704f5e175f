"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes ``len(FEATURES)`` numbers (length, letter case, symbols,
repetition, compressibility, ...). Cyclic boosting fits, feature by feature in
turn, a shallow tree of three leaves on the binned residuals and adds it, scaled
down, to that feature's lookup table; then pairs of features get tables of their
own from four-leaf trees on a coarse grid. Scoring bins the features and adds
up table entries, batch by batch (Lou, Caruana et al., 2012 and 2013).

The model is fitted on at most ``SAMPLE_ROWS`` labelled rows outside the held-out
fold, chosen by a hash of the id; features, bins and tables are bounded, so the
model is a few kilobytes. All rows are scored, over their whole texts.

A null text scores like an empty one; both have defined features. With no
labelled row, or labels of one kind only, the score is the smoothed share of label 1.
Repeated rows score alike, ids may repeat, other columns pass through.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from plaudit.llm.common import held_out

SAMPLE_ROWS = 20_000
FEATURES = (
    "log_chars", "token_chars", "upper_share", "digit_share", "symbol_share", "stop_share", "shout_share",
    "bar_share", "line_share", "non_ascii_share", "distinct_share", "twin_share", "top_word_share",
    "same_line_share", "squeeze", "entropy", "sentence_words", "marked_tokens",
)
_STOPS, _SHOUTS, _SYMBOLS = b".,;:", b"!?", b"#$%&*+/<=>@[\\]^_`{}~"
_MARKED = re.compile(r"[^\w\s.,;:'\"!?()|-]{2,}(?=\s|$)|!!(?=\s|$)")


def text_features(text: str | None) -> list[float]:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    n = max(len(raw), 1)
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256, np.int64)
    upper, lower = int(hist[65:91].sum()), int(hist[97:123].sum())
    some = lambda chars: int(sum(hist[c] for c in chars))
    words = text.split()
    m = max(len(words), 1)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    share = hist[hist > 0] / n
    return [
        float(np.log1p(len(text))),
        sum(map(len, words)) / m,
        upper / max(upper + lower, 1),
        int(hist[48:58].sum()) / n,
        some(_SYMBOLS) / n,
        some(_STOPS) / n,
        some(_SHOUTS) / n,
        int(hist[124]) / n,
        len(lines) / m,
        int(hist[128:].sum()) / n,
        len(counts) / m**0.75,
        sum(map(str.__eq__, words, words[1:])) / m,
        max(counts.values(), default=0) / m,
        1 - len(set(lines)) / max(len(lines), 1),
        len(zlib.compress(raw, 1)) / n,
        float(-(share * np.log2(share)).sum()) if raw else 0.0,
        m / (int(hist[46]) + 1),
        len(_MARKED.findall(text)) / m,
    ]


class AdditiveModel:
    """Lookup tables per feature and per pair of features, and an intercept."""

    def __init__(self, bins: int = 48, grid: int = 12, pairs: int = 8, rounds: int = 150, rate: float = 0.15):
        self.bins, self.grid, self.n_pairs, self.rounds, self.rate = bins, grid, pairs, rounds, rate
        self.intercept, self.edges, self.tables = 0.0, [], []
        self.coarse, self.pairs, self.pair_tables = [], [], []

    @staticmethod
    def _cuts(x: np.ndarray, n: int) -> np.ndarray:
        return np.unique(np.quantile(x, np.linspace(0, 1, n + 1)[1:-1]))

    @staticmethod
    def _binned(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]

    @staticmethod
    def _leaf(g, h):
        return g / (h + 1.0)

    def _tree(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Two greedy splits of the ordered bins: a value for each bin."""
        out, spans = np.zeros(len(g)), [(0, len(g))]
        for _ in range(2):
            best = None
            for k, (a, b) in enumerate(spans):
                if b - a < 2:
                    continue
                cg, ch = np.cumsum(g[a:b]), np.cumsum(h[a:b])
                lg, lh, rg, rh = cg[:-1], ch[:-1], cg[-1] - cg[:-1], ch[-1] - ch[:-1]
                gain = lg**2 / (lh + 1) + rg**2 / (rh + 1) - cg[-1] ** 2 / (ch[-1] + 1)
                i = int(np.argmax(gain))
                if best is None or gain[i] > best[0]:
                    best = (gain[i], k, a + i + 1)
            if best is None or best[0] <= 1e-9:
                break
            a, b = spans.pop(best[1])
            spans += [(a, best[2]), (best[2], b)]
        for a, b in spans:
            out[a:b] = self._leaf(g[a:b].sum(), h[a:b].sum())
        return out

    def _quadrants(self, g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
        """The best cross of one cut per feature: gain and a value for each cell."""
        cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
        tg, th = cg[-1, -1], ch[-1, -1]
        a, b = cg[:-1, :-1], ch[:-1, :-1]
        parts = [
            (a, b),
            (cg[:-1, -1:] - a, ch[:-1, -1:] - b),
            (cg[-1:, :-1] - a, ch[-1:, :-1] - b),
            (tg - cg[:-1, -1:] - cg[-1:, :-1] + a, th - ch[:-1, -1:] - ch[-1:, :-1] + b),
        ]
        if a.size == 0:
            return 0.0, np.zeros_like(g)
        gain = sum(x**2 / (y + 1) for x, y in parts)
        i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
        leaf = [self._leaf(x[i, j], y[i, j]) for x, y in parts]
        out = np.empty_like(g)
        out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = leaf
        return float(gain[i, j]), out

    def fit(self, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        share = (y.sum() + 1) / (len(y) + 2)
        self.intercept = float(np.log(share / (1 - share)))
        if len(y) == 0 or y.min() == y.max():
            return self
        self.edges = [self._cuts(x[:, j], self.bins) for j in range(x.shape[1])]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        binned, f = self._binned(x, self.edges), np.full(len(y), self.intercept)

        def residual():
            p = 1 / (1 + np.exp(-f))
            return y - p, np.maximum(p * (1 - p), 1e-6)

        for _ in range(self.rounds):
            for j, b in enumerate(binned):
                g, h = residual()
                n = len(self.tables[j])
                step = self.rate * self._tree(np.bincount(b, g, n), np.bincount(b, h, n))
                self.tables[j] += step
                f += step[b]
        self.coarse = [self._cuts(x[:, j], self.grid) for j in range(x.shape[1])]
        cells = self._binned(x, self.coarse)

        def grid(i, j, g, h):
            shape = (len(self.coarse[i]) + 1, len(self.coarse[j]) + 1)
            flat = cells[i] * shape[1] + cells[j]
            size = shape[0] * shape[1]
            return flat, np.bincount(flat, g, size).reshape(shape), np.bincount(flat, h, size).reshape(shape)

        g, h = residual()
        every = [(i, j) for i in range(x.shape[1]) for j in range(i)]
        self.pairs = sorted(every, key=lambda p: -self._quadrants(*grid(*p, g, h)[1:])[0])[: self.n_pairs]
        self.pair_tables = [np.zeros((len(self.coarse[i]) + 1, len(self.coarse[j]) + 1)) for i, j in self.pairs]
        for _ in range(self.rounds // 3):
            for k, (i, j) in enumerate(self.pairs):
                g, h = residual()
                flat, gg, hh = grid(i, j, g, h)
                step = self.rate * self._quadrants(gg, hh)[1]
                self.pair_tables[k] += step
                f += step.ravel()[flat]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.intercept)
        for table, b in zip(self.tables, self._binned(x, self.edges), strict=True):
            f += table[b]
        if self.pairs:
            cells = self._binned(x, self.coarse)
            for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
                f += table[cells[i], cells[j]]
        return 1 / (1 + np.exp(-np.clip(f, -30, 30)))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, key: str = "doc_id") -> DataFrame:
    """Texts and labels of at most ``rows`` labelled documents outside the
    held-out fold; the ids (not the texts) are what travels."""
    chosen = (
        labels.where(~held_out(F.col(key)) & F.col(label).isin(0, 1))
        .select(F.col(key).alias("__id"), F.col(label).cast("int").alias("__label"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(rows)
    )
    texts = docs.select(F.col(key).alias("__key"), "text")
    return texts.join(F.broadcast(chosen), F.col("__key") == F.col("__id")).select("__label", "__id", "text")


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> AdditiveModel:
    @pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return texts.map(text_features)

    sample = labelled_sample(docs, labels, label, rows)
    found = sample.select("__id", "__label", features("text").alias("x")).limit(2 * rows).toPandas()
    found = found.sort_values("__id", kind="stable")
    x = np.array(found["x"].tolist(), dtype=np.float64).reshape(len(found), len(FEATURES))
    return AdditiveModel().fit(x, found["__label"].to_numpy(np.float64))


def quality_score(model: AdditiveModel, text: Column) -> Column:
    @pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype="float64")
        return pd.Series(model.score(np.array([text_features(t) for t in texts], dtype=np.float64)))

    return score(text)


def classify_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    model = fit_quality(docs, labels)
    scored = docs.select("doc_id", quality_score(model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
