"""The field on long neighbourhoods and its sample."""

from __future__ import annotations

import random

from contact_mart.llm import pii


def test_dense_numbers_are_decoded_once():
    """A neighbourhood of thousands of tokens is one; no span is found twice or split, wherever it stands."""
    model = pii.SemiMarkov({(pii.KINDS.index("phone"), "tokens=3"): 9.0})
    for shift in range(8):
        text = "n " * shift + " ".join(f"7{k % 10} 555 {k:04d}" for k in range(1500))
        assert len(list(pii.places(text))) == 1
        _, spans = pii.find(text, model)
        assert len(spans) == len(set(spans)) and len(spans) >= 1499
        ends = sorted((a, b) for _, a, b in spans)
        assert all(b <= c for (_, b), (c, _) in zip(ends, ends[1:]))


def test_rare_types_are_learnt_beside_dense_texts(spark):
    """Tables of numbers in a hot source leave room for a few secrets and cards elsewhere, also in long neighbourhoods."""
    rng = random.Random(3)
    table = lambda: " ".join(f"a {rng.randrange(10**6)} b c d" for _ in range(80))
    rows = [(k, "hot", " . ".join(table() for _ in range(3))) for k in range(700)]
    secret = lambda: f"token = {rng.randrange(16**20):020x}"
    rows += [(k, "rare", " ".join(map(str, range(200))) + f" set {secret()} and 4111 1111 1111 1111 end " + " ".join(map(str, range(200)))) for k in range(1000, 1012)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    model = pii.train(docs)
    for kind in ("secret", "card"):
        assert max(w for (k, _), w in model.weights.items() if k == pii.KINDS.index(kind)) > 0
    cases = pii.sample(docs)
    assert all(len(tokens) <= pii.PLACE_TOKENS for _, tokens, _ in cases)
    assert sum(any(k == "card" for k, _, _ in gold) for _, _, gold in cases) == 12
