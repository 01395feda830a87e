"""Quality classifier: a generalised additive model with pairwise interactions.

The features of a text are rates that do not depend on its words or language. Each is cut into
bins; the model is a table of additions per feature and, for the pairs that explain most of what
is left, a table over two features. The tables are learnt by cyclic boosting: round after round
every feature in turn gets a shallow tree over its bins, fitted to the gradient of the log loss,
with a small step. A score is the sum of the looked-up additions.

Labels are a table of any size; the model is fitted on the ``SAMPLE`` of its rows that come first
in the order of a hash, a documented bound. Features and scores are computed for every row.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contact_mart.llm.common import prepare

# Labelled rows that the model is fitted on, at most.
SAMPLE = 20_000
BINS, PAIR_BINS, ROUNDS, RATE, PAIRS = 32, 8, 120, 0.1, 6
FEATURES = (
    "words", "word_length", "distinct", "repeats", "upper", "symbols", "bars", "marks", "digits", "stops",
    "line_words", "dup_lines", "wide",
)
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&<>"


def features(text: str | None) -> list[float]:
    """Rates over the whole text; all 0 for a null, empty or blank one."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    words = raw.split()
    n = len(words)
    if n == 0:
        return [0.0] * len(FEATURES)
    size = len(raw)
    chars = sum(map(len, words))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    without = lambda drop: size - len(raw.translate(None, drop))
    return [
        float(np.log1p(n)),
        chars / n,
        len(set(words)) / n**0.5,
        sum(map(operator.eq, words, words[1:])) / n,
        without(_UPPER) / chars,
        without(_SYMBOLS) / chars,
        raw.count(b"|") / n,
        raw.count(b"!") / n,
        without(_DIGITS) / chars,
        raw.count(b".") / n,
        n / len(lines),
        1 - len(set(lines)) / len(lines),
        (size - len(text)) / chars,
    ]


@dataclass(frozen=True)
class AdditiveModel:
    base: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_cuts: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for k, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            total += table[np.searchsorted(cuts, x[:, k], "right")]
        coarse = [np.searchsorted(cuts, x[:, k], "right") for k, cuts in enumerate(self.pair_cuts)]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) if len(column) else np.zeros(0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Additions per bin of a tree of at most 2 ** depth leaves over the ordered bins."""
    out = np.full(len(g), g.sum() / (h.sum() + 1.0))
    if depth and len(g) > 1:
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
        at = int(gains.argmax()) + 1
        if gains[at - 1] > 1e-6:
            out[:at], out[at:] = _shallow_tree(g[:at], h[:at], depth - 1), _shallow_tree(g[at:], h[at:], depth - 1)
    return out


def _cross_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Additions of the best tree that cuts one feature once and each side once by the other, and its gain."""
    best, where = -1.0, None
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    for i in range(g.shape[0] - 1):
        gain, cuts = 0.0, []
        for low, high in ((-1, i), (i, g.shape[0] - 1)):
            rg = cg[high] - (cg[low] if low >= 0 else 0)
            rh = ch[high] - (ch[low] if low >= 0 else 0)
            gains = _gain(rg, rh) + _gain(rg[-1] - rg, rh[-1] - rh)
            cuts.append(int(gains.argmax()))
            gain += gains.max()
        if gain > best:
            best, where = gain, (i, *cuts)
    out = np.zeros_like(g)
    if where is None:
        return out, 0.0
    for rows, cut in ((slice(0, where[0] + 1), where[1]), (slice(where[0] + 1, None), where[2])):
        for columns in (slice(0, cut + 1), slice(cut + 1, None)):
            out[rows, columns] = g[rows, columns].sum() / (h[rows, columns].sum() + 1.0)
    return out, best - _gain(g.sum(), h.sum())


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """The model of rows of features and labels 0 or 1. Without rows every score is 0.5; with one label alone the
    scores lie on its side."""
    rate = (y.sum() + 0.5) / (len(y) + 1.0)
    base = float(np.log(rate / (1 - rate)))
    cuts, coarse = [_cuts(c, BINS) for c in x.T], [_cuts(c, PAIR_BINS) for c in x.T]
    bins = [np.searchsorted(c, v, "right") for c, v in zip(cuts, x.T)]
    wide = [np.searchsorted(c, v, "right") for c, v in zip(coarse, x.T)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    total = np.full(len(y), base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS if len(y) else 0):
        for k, table in enumerate(tables):
            g, h = slopes()
            step = RATE * _shallow_tree(np.bincount(bins[k], g, len(table)), np.bincount(bins[k], h, len(table)))
            table += step
            total += step[bins[k]]

    def histogram(i: int, j: int, values: np.ndarray) -> np.ndarray:
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        return np.bincount(wide[i] * shape[1] + wide[j], values, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    gains = {(i, j): _cross_tree(histogram(i, j, g), histogram(i, j, h))[1] for i, j in combinations(range(x.shape[1]), 2)}
    pairs = sorted(gains, key=lambda p: (-gains[p], p))[: PAIRS if len(y) else 0]
    pair_tables = [np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for i, j in pairs]
    for _ in range(ROUNDS // 2 if len(y) else 0):
        for (i, j), table in zip(pairs, pair_tables):
            g, h = slopes()
            step = RATE * _cross_tree(histogram(i, j, g), histogram(i, j, h))[0]
            table += step
            total += step[wide[i], wide[j]]
    return AdditiveModel(base, cuts, tables, pairs, coarse, pair_tables)


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; a null id is in fold 0, which is held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)), F.lit(0).cast("long"))


def _measured(text: str) -> Column:
    @F.pandas_udf("array<double>")
    def measure(texts: pd.Series) -> pd.Series:
        return texts.map(features, na_action=None)

    return measure(F.col(text))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> AdditiveModel:
    """The model of the labelled rows outside fold 0, of which at most ``sample``, the first in the order of a hash of
    the id, are looked up and reach the driver as features. Null labels are left out."""
    known = labels.where(F.col(label).isNotNull() & (fold("doc_id") != 0)).select(
        F.col("doc_id").alias("__id"), F.col(label).cast("double").alias("__y")
    )
    chosen = known.orderBy(F.xxhash64("__id"), "__id", "__y").limit(sample)
    # The broadcast side has at most ``sample`` rows of two numbers. An id that many rows share must not fill the driver.
    found = docs.select(F.col(doc_id).alias("__doc"), F.col(text).alias("__text")).join(F.broadcast(chosen), F.col("__doc") == F.col("__id"))
    rows = found.limit(2 * sample).select("__id", "__y", _measured("__text").alias("__x")).toPandas()
    rows["__key"] = [(i, y, *x) for i, y, x in zip(rows["__id"], rows["__y"], rows["__x"])]
    rows = rows.sort_values("__key", kind="stable")
    x = np.array(rows["__x"].tolist(), float).reshape(-1, len(FEATURES))
    return fit(x, rows["__y"].to_numpy(float))


def score(docs: DataFrame, model: AdditiveModel, text: str = "text") -> Column:
    """The score of a text. The model, some kilobytes of tables, goes to every task."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series(sent.value.score(np.array([features(t) for t in part], float).reshape(-1, len(FEATURES))))

    return scores(F.col(text))


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with held_out, score, predicted. Columns of these names are replaced, others are kept.

    The model is fitted on the texts of labelled rows outside fold 0, then every row is scored in one pass without an
    exchange. Null and empty texts have the features 0 and a score like any other. Rows are independent. Without
    labels every score is 0.5.
    """
    prepare(docs.sparkSession)
    model = train(docs, labels, doc_id, text)
    scored = docs.withColumns({"held_out": fold(doc_id) == 0, "score": score(docs, model, text)})
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
