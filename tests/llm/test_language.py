"""Language identification: against plain loops, on the held-out texts, and on mixtures of known parts."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from contact_mart.llm import language
from contact_mart.llm.queries import QUERIES

from .conftest import SF

SENTENCES = {
    "da": "der er en mand i huset og han ser på havet som ligger stille under den lyse himmel",
    "it": "il mare è calmo e la casa sulla collina guarda la valle dove passa il fiume lento",
    "pl": "w małym domu nad rzeką mieszka stary człowiek który codziennie patrzy na góry",
}


def _pieces_of(text):
    """Units of a text, each with its n-grams, by plain string work."""
    letters = [c if 97 <= c <= 122 or c >= 128 else 32 for c in text.lower().encode()]
    units = []
    for word in bytes(letters).split():
        padded = b" " + word + b" "
        own = {}
        for order in language.ORDERS:
            for i in range(len(padded) - order + 1):
                gram = padded[i : i + order]
                if b" " not in gram[1:-1]:
                    own.setdefault(i // language.LONGEST, []).append((order, gram))
        units += [own.get(k, []) for k in range((len(padded) - 2) // language.LONGEST + 1)]
    return units


def _plain_model(texts):
    counts = {lang: {} for lang in texts}
    for lang, text in texts.items():
        for unit in _pieces_of(text):
            for gram in unit:
                counts[lang][gram] = counts[lang].get(gram, 0) + 1
    n = 1 << language.MOST_BITS

    def logp(lang, gram):
        total = sum(c for (order, _), c in counts[lang].items() if order == gram[0])
        return math.log((counts[lang].get(gram, 0) + language.SMOOTHING) / (total + n * language.SMOOTHING))

    return logp


def _plain_shares(units, langs, logp):
    """Shares by expectation-maximisation over all ``langs``, and the log-likelihood of the units."""
    rows = []
    for unit in units:
        own = [language.TEMPER * sum(logp(lang, g) for g in unit) for lang in sorted(SENTENCES)]
        rows.append({lang: math.exp(x - max(own)) for lang, x in zip(sorted(SENTENCES), own)})
    share = {lang: 1 / len(langs) for lang in langs}
    for _ in range(language.ROUNDS if len(langs) > 1 else 0):
        new = dict.fromkeys(langs, 0.0)
        for row in rows:
            total = sum(share[lang] * row[lang] for lang in langs)
            for lang in langs:
                new[lang] += share[lang] * row[lang] / total
        share = {lang: x / len(rows) for lang, x in new.items()}
    return share, sum(math.log(sum(share[lang] * row[lang] for lang in langs)) for row in rows)


def _plain(text, logp):
    units = _pieces_of(text)
    whole, _ = _plain_shares(units, sorted(SENTENCES), logp)
    order = sorted(whole, key=lambda lang: -whole[lang])
    best, reached = None, -math.inf
    for k in range(1, len(order) + 1):
        share, fit = _plain_shares(units, order[:k], logp)
        value = fit - (k - 1) * (language.PENALTY * math.log1p(len(units)) + language.NOISE * len(units))
        if value <= reached:
            break
        best, reached = share, value
    return best


@pytest.fixture(scope="module")
def model(spark):
    rows = [(k, text, lang) for k, (lang, text) in enumerate(SENTENCES.items())]
    return language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_mixtures_equal_plain_loops(model):
    logp = _plain_model(SENTENCES)
    words = {lang: text.split() for lang, text in SENTENCES.items()}
    texts = list(SENTENCES.values()) + [
        " ".join(words["da"] + words["it"]), " ".join(words["pl"][:5] + words["it"] + words["da"][:9]), "huset", "xq zz",
        "mare " + "k" * 100 + " er", "Il MARE, la casa! 12 og 13 han ser på havet", " ".join(words["it"][:3] + words["pl"]),
    ]
    sizes = set()
    for text, (lang, score, chosen) in zip(texts, language.infer(model, texts)):
        wanted = _plain(text, logp)
        assert dict(chosen).keys() == wanted.keys(), text
        assert all(share == pytest.approx(wanted[name], abs=2e-3) for name, share in chosen)
        assert wanted[lang] == pytest.approx(max(wanted.values()), abs=2e-3) and 0 <= score <= 1
        sizes.add(len(chosen))
    assert {1, 2} <= sizes


def test_a_text_is_the_same_alone_and_among_others_and_in_pieces(model, monkeypatch):
    texts = [*SENTENCES.values(), "", "12", " ".join(SENTENCES.values()) * 30, "k" * 5000]
    together = language.infer(model, texts)
    monkeypatch.setattr(language, "BLOCK", 1 << 13)
    monkeypatch.setattr(language, "MANY", 50)
    for text, one in zip(texts, together):
        again = language.infer(model, [text])[0]
        assert again[0] == one[0] and [x for x, _ in again[2]] == [x for x, _ in one[2]]
        assert again[1] == pytest.approx(one[1], abs=0.03)


def test_held_out_texts_and_labels_are_not_learnt(spark, corpus):
    got = {r["doc_id"]: r for r in QUERIES["op11_language"](spark, corpus).collect()}
    texts = spark.read.parquet(f"{corpus}/documents.parquet").select("doc_id", "text", "lang").collect()
    assert len(got) == len(texts)
    right = held = 0
    for doc, text, lang in texts:
        r = got[doc]
        assert r["held_out"] == (zlib.crc32(str(doc).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (text is None or not any(c.isalpha() for c in text))
        if r["held_out"] and lang is not None:
            held += 1
            right += r["lang_pred"] == lang
    assert held > 30 and right / held >= 0.95


def test_held_out_languages_change_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    other = docs.withColumn("lang", F.when(language.fold() == 2, "xx").otherwise(F.col("lang"))).withColumn("score", F.lit("?"))
    read = lambda df: {r["doc_id"]: (r["lang_pred"], round(r["score"], 9)) for r in language.identify(df).collect()}
    assert read(docs) == read(other)


def test_without_languages_all_is_undetermined(spark):
    docs = spark.createDataFrame([(1, "a text", None), (None, None, None), (3, "", None)], "doc_id long, text string, lang string")
    assert {(r["lang_pred"], r["score"], r["languages"]) for r in language.identify(docs).collect()} == {("und", 0.0, "")}


def test_many_languages_have_fewer_buckets(spark):
    docs = spark.range(600).selectExpr("id doc_id", "concat('w', id, ' word') text", "concat('l', lpad(id, 3, '0')) lang")
    model = language.train(docs)
    assert len(model.names) == 600 and model.table.size <= language.TABLE
    assert np.isfinite(model.table).all()
