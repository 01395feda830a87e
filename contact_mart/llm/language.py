"""Language identification by multilingual mixture inference.

A text is a mixture of languages. Its units are its words (long runs of letters are cut), and a
unit's likelihood in a language is the product of its byte n-gram probabilities there, tempered as
the n-grams overlap. Expectation-maximisation estimates the share of each language in the text.
The languages are then taken in the order of their shares: one, two, three and so on are fitted on
their own, as long as the log-likelihood less a penalty for each further language grows.

The n-gram counts are those of all learnt texts, summed over the tasks; what is sent around is one
table of languages x buckets, at most ``TABLE`` numbers whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contact_mart.llm.common import prepare

ORDERS = (3, 4)
# Numbers in the table of log-probabilities, at most: with more languages each has fewer buckets.
TABLE = 1 << 23
MOST_BITS, LEAST_BITS = 15, 10
MOST_LANGUAGES = TABLE // (len(ORDERS) << LEAST_BITS)
SMOOTHING = 0.5
# Longest unit in bytes (a power of 2), and what the log-likelihood of a unit is multiplied by and may differ between languages.
LONGEST, TEMPER, WIDEST = 32, 0.5, 60.0
ROUNDS = 12
# Log-likelihood that a further language must add, times the logarithm of the number of units.
PENALTY = 1.5
# The same for each unit: a set grows by a language that explains about a hundredth of the text, not by noise.
NOISE = 0.01
TINY = np.float32(1e-30)
# Numbers that are worked on at once; a longer text goes piece by piece.
BLOCK = 1 << 19
# Units of a long text that are held before equal ones become one.
MANY = 1 << 18
# Languages whose counts one task holds before it hands them on.
HELD = 64
_SPACE = np.uint8(32)
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def canonical(text: str) -> np.ndarray:
    """UTF-8 bytes of the lower-cased text; what is not a letter is a single space, with one at each end."""
    words = f" {text.lower()} ".encode("utf-8", "surrogatepass").translate(_LETTERS).split()
    return np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8) if words else np.full(1, _SPACE)


def units_of(raw: np.ndarray) -> np.ndarray:
    """Number of the unit of every byte: a unit begins at each space and goes on for ``LONGEST`` bytes at most."""
    at = np.arange(len(raw), dtype=np.int32)
    begun = np.maximum.accumulate(np.where(raw == _SPACE, at, np.int32(0)))
    return np.cumsum(((at - begun) & (LONGEST - 1)) == 0, dtype=np.int32) - np.int32(1)


def grams(raw: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order the bucket and the place of every n-gram that lies within a word and the spaces around it."""
    inner = raw != _SPACE
    out = []
    code, inside = raw.astype(np.uint32), np.ones(len(raw), bool)
    for width in range(2, max(ORDERS) + 1):
        n = max(len(raw) - width + 1, 0)
        code = (code[:n] << np.uint32(8)) | raw[width - 1 :]
        if width > 2:
            inside = inside[:n] & inner[width - 2 : n + width - 2]
        if width in ORDERS:
            place = np.flatnonzero(inside[:n])
            bucket = (code[place] * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)
            out.append((bucket.astype(np.int32) + np.int32(ORDERS.index(width) << bits), place))
    return out


@dataclass(frozen=True)
class Languages:
    """Log-probability of each bucket in each language, a column each."""

    names: list[str]
    bits: int
    table: np.ndarray

    @classmethod
    def of_counts(cls, names: list[str], bits: int, counts: np.ndarray) -> Languages:
        """``counts``: orders x buckets x languages."""
        smooth = counts + SMOOTHING
        table = np.log(smooth / smooth.sum(axis=1, keepdims=True))
        return cls(names, bits, table.reshape(-1, len(names)).astype(np.float32))

    def units(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Likelihood of each unit in each language, the best one 1, and the unit of every byte.

        Every unit that holds a space or a letter after one has an n-gram; one that has none is equal in all."""
        unit = units_of(raw)
        total = np.zeros((int(unit[-1]) + 1, len(self.names)), np.float32)
        for bucket, place in grams(raw, self.bits):
            if len(place):
                of = unit[place]
                first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
                total[of[first]] += np.add.reduceat(self.table[bucket], first, axis=0)
        total *= np.float32(TEMPER)
        total -= total.max(axis=1, keepdims=True)
        return np.exp(np.maximum(total, -WIDEST)), unit


def _pieces(raw: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The bytes in pieces that end and begin with a space where one is near; a run without spaces is cut as it is."""
    while len(raw) > size:
        spaces = np.flatnonzero(raw[size // 2 : size] == _SPACE)
        cut = size // 2 + int(spaces[-1]) if len(spaces) else size - 1
        yield raw[: cut + 1]
        raw = raw[cut:]
    yield raw


def weigh(rows: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows as one, with the sum of their weights."""
    distinct, place = np.unique(rows, axis=0, return_inverse=True)
    return distinct, np.bincount(place.ravel(), weight, len(distinct)).astype(np.float32)


def estimate(rows: np.ndarray, weight: np.ndarray, first: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the allowed languages in each text, and its log-likelihood, by expectation-maximisation.

    The rows of text d begin at ``first[d]``; every text has a row."""
    sizes, ones = np.diff(np.append(first, len(rows))), np.ones(rows.shape[1], np.float32)
    total = np.add.reduceat(weight, first, dtype=float)[:, None]
    share = allowed / allowed.sum(axis=1, keepdims=True)
    alone = (allowed.sum(axis=1) == 1).all()
    for _ in range(0 if alone else ROUNDS):
        # The best likelihood of a unit is 1, the least exp(-WIDEST): the sums stay above 0 in single precision.
        part = np.repeat(share.astype(np.float32), sizes, axis=0) * rows
        part *= (weight / np.maximum(part @ ones, TINY))[:, None]
        share = np.add.reduceat(part, first, axis=0) / total
    mixed = np.maximum(np.repeat(share.astype(np.float32), sizes, axis=0) * rows @ ones, TINY)
    return share, np.add.reduceat(weight * np.log(mixed), first, dtype=float)


def select(rows: np.ndarray, weight: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares within the chosen set of languages of each text, and its shares with all languages allowed."""
    n_docs, n_languages = len(first), rows.shape[1]
    whole, _ = estimate(rows, weight, first, np.ones((n_docs, n_languages), bool))
    order = np.argsort(-whole, axis=1, kind="stable")
    sizes = np.diff(np.append(first, len(rows)))
    n_units = np.add.reduceat(weight, first, dtype=float)
    cost = PENALTY * np.log1p(n_units) + NOISE * n_units
    best = np.zeros_like(whole)
    reached = np.full(n_docs, -np.inf)
    open_ = np.arange(n_docs)
    for k in range(1, n_languages + 1):
        taken = np.repeat(np.isin(np.arange(n_docs), open_), sizes)
        own = sizes[open_]
        begins = np.cumsum(own) - own
        allowed = np.zeros((len(open_), n_languages), bool)
        np.put_along_axis(allowed, order[open_, :k], True, axis=1)
        share, fit = estimate(rows[taken], weight[taken], begins, allowed)
        value = fit - (k - 1) * cost[open_]
        better = value > reached[open_]
        open_ = open_[better]
        best[open_], reached[open_] = share[better], value[better]
        if not len(open_):
            break
    return best, whole


def _long(model: Languages, raw: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Units of a long text piece by piece; equal ones become one whenever the rows held have doubled."""
    rows, weight, most = [], [], MANY
    for piece in _pieces(raw, size):
        rows.append(model.units(piece)[0])
        weight.append(np.ones(len(rows[-1]), np.float32))
        if sum(map(len, rows)) > most:
            distinct, count = weigh(np.concatenate(rows), np.concatenate(weight))
            rows, weight, most = [distinct], [count], max(MANY, 2 * len(distinct))
    return np.concatenate(rows), np.concatenate(weight)


def infer(model: Languages, texts: list[str]) -> list[tuple[str | None, float, list[tuple[str, float]]]]:
    """Language with the largest share, its score, and the chosen set with its shares, of each text.

    A text without a letter, or no language learnt: no language, 0 and an empty set."""
    out: list = [(None, 0.0, [])] * len(texts)
    if not model.names:
        return out
    size = max(BLOCK // len(model.names), 1 << 12)
    held, lengths, places = [], [], []

    def settle(parts: list[tuple[np.ndarray, np.ndarray]], which: list[int]) -> None:
        rows = np.concatenate([r for r, _ in parts])
        weight = np.concatenate([w for _, w in parts])
        counts = np.array([len(r) for r, _ in parts])
        best, whole = select(rows, weight, np.cumsum(counts) - counts)
        for d, place in enumerate(which):
            chosen = [k for k in np.argsort(-best[d], kind="stable") if best[d, k] > 0]
            n, top = float(parts[d][1].sum()), chosen[0]
            score = (whole[d, top] * n + SMOOTHING) / (n + SMOOTHING * len(model.names))
            out[place] = (model.names[top], float(score), [(model.names[k], float(best[d, k])) for k in chosen])

    def short() -> None:
        """All held texts at once."""
        rows, unit = model.units(np.concatenate(held))
        parts = [(r, np.ones(len(r), np.float32)) for r in np.split(rows, unit[np.cumsum(lengths)[:-1]])]
        settle(parts, places)
        held.clear(), lengths.clear(), places.clear()

    for place, text in enumerate(texts):
        raw = canonical(text)
        if len(raw) < 3:
            continue
        if len(raw) > size:
            settle([_long(model, raw, size)], [place])
            continue
        held.append(raw)
        lengths.append(len(raw))
        places.append(place)
        if sum(lengths) > size:
            short()
    if held:
        short()
    return out


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4; a null id is in fold 2, which is held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)), F.lit(2).cast("long"))


def _counted(names: list[str], bits: int):
    number = {name: k for k, name in enumerate(names)}
    width = len(ORDERS) << bits

    def handed_on(counts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for k, own in counts.items():
            found = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array(found + k * width), pa.array(own[found])], ["cell", "n"])
        counts.clear()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = counts.setdefault(number[lang], np.zeros(width, np.int64))
                for piece in _pieces(canonical(text.as_py() or ""), BLOCK):
                    for bucket, _ in grams(piece, bits):
                        own += np.bincount(bucket, minlength=width)
                if len(counts) > HELD:
                    yield from handed_on(counts)
        yield from handed_on(counts)

    return count


def train(docs: DataFrame, text: str = "text", lang: str = "lang", bits: int = MOST_BITS) -> Languages:
    """N-gram counts of all the given texts with a language.

    The driver gets one number for each language and bucket, ``TABLE`` at most. More than ``MOST_LANGUAGES`` languages
    are refused. Null languages are left out; a null text adds nothing but its language is known."""
    known = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    names = [r[0] for r in known.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()]
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    names.sort()
    while bits > LEAST_BITS and len(names) * (len(ORDERS) << bits) > TABLE:
        bits -= 1
    cells = known.mapInArrow(_counted(names, bits), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(names), len(ORDERS), 1 << bits))
    counts.reshape(-1)[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy(float)
    return Languages.of_counts(names, bits, counts.transpose(1, 2, 0)) if names else Languages([], bits, np.zeros((0, 0), np.float32))


def predict(docs: DataFrame, model: Languages, text: str = "text") -> Column:
    """Struct of lang_pred, score and languages (the chosen set as name:share, by share)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, languages string")
    def predicted(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = infer(sent.value, [t or "" for t in part])
            yield pd.DataFrame(
                {
                    "lang_pred": [f[0] for f in found],
                    "score": [f[1] for f in found],
                    "languages": [",".join(f"{name}:{share:.3f}" for name, share in f[2]) for f in found],
                }
            )

    return predicted(F.when(F.col(text).rlike(r"\p{L}"), F.col(text)))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with held_out, lang_pred, score, languages. Columns of these names are replaced, others are kept.

    The model learns from texts with a language outside fold 2; then every row is predicted in one pass without an
    exchange. Null texts and texts without a letter get ``und``, 0 and no languages, and so does every text if no
    language was learnt. Rows are independent, so repeated rows get equal results; of languages with equal shares the
    first by name leads. Very long texts go piece by piece, equal units as one."""
    prepare(docs.sparkSession)
    model = train(docs.where(fold(doc_id) != 2), text, lang)
    found = docs.withColumns({"held_out": fold(doc_id) == 2, "__found": predict(docs, model, text)})
    return found.withColumns(
        {
            "lang_pred": F.coalesce("__found.lang_pred", F.lit("und")),
            "score": F.col("__found.score"),
            "languages": F.col("__found.languages"),
        }
    ).drop("__found")
