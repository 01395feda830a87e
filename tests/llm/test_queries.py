"""The queries against brute force, on the smallest tables with hard rows added."""

from __future__ import annotations

import pytest

from contact_mart.llm.queries import QUERIES

from . import brute
from .test_edges import OTHER_ROWS

OP2 = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
OP8 = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def same(got, wanted):
    got, wanted = sorted(got, key=repr), sorted(wanted, key=repr)
    assert [(g, w) for g, w in zip(got, wanted) if g != w][:3] == []
    assert len(got) == len(wanted)


def test_personal_data(spark, corpus, doc_rows, rows):
    result = QUERIES["op1_pii"](spark, corpus)
    columns = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    same(rows(result, *columns), brute.personal_data(doc_rows))
    texts = dict(doc_rows)
    added = 0
    for doc, spans, n in rows(result, "doc_id", "spans", "n_added"):
        found = [s.split(":") for s in spans.split(",") if s]
        order = ["email", "ip", "card", "phone", "secret"]
        assert found == sorted(found, key=lambda s: (order.index(s[0]), int(s[1])))
        base = [s for s in found if s[0] != "secret"]
        assert brute.sha(",".join(map(":".join, base))) == brute.personal_data([(doc, texts[doc])])[0][5] or n > len(found) - len(base)
        added += n
    assert added > 0


def test_passages(spark, corpus, doc_rows, rows):
    """Every run of 55 words that two documents share is in a passage; every passage is similar."""
    texts = {doc: brute.words((text or "").translate(brute.LOWER)) for doc, text in doc_rows}
    got = rows(QUERIES["op4_substring_dedup"](spark, corpus))
    names = QUERIES["op4_substring_dedup"](spark, corpus).columns
    for row in got:
        r = dict(zip(names, row))
        assert r["of_doc"] < r["doc_id"] and r["similarity"] >= 0.75 and r["end_word"] - r["start_word"] >= 50
        if r["similarity"] == 1:
            assert texts[r["doc_id"]][r["start_word"] : r["end_word"]] == texts[r["of_doc"]][r["of_start"] : r["of_end"]]
    first, wanted = {}, set()
    for doc in sorted(texts):
        w = texts[doc]
        for i in range(len(w) - 54):
            holder = first.setdefault(tuple(w[i : i + 55]), doc)
            if holder != doc:
                wanted.add(doc)
    assert wanted <= {r[0] for r in got}


def test_mixing(spark, corpus, doc_rows, rows):
    got = rows(QUERIES["op7_mixing"](spark, corpus), "doc_id", "probability", "kept")
    assert len(got) == len(doc_rows)
    assert all(0 <= p <= 1 for _, p, _ in got)


def test_decontamination(spark, corpus, doc_rows, rows):
    items = [tuple(r) for r in spark.read.parquet(f"{corpus}/benchmark.parquet").select("item_id", "text").collect()]
    got = rows(QUERIES["op2_decontamination"](spark, corpus), *OP2)
    same(got, brute.contaminated(doc_rows, items))
    assert sum(r[5] for r in got) > 40


def test_near_dedup(spark, corpus, doc_rows, rows):
    got = rows(QUERIES["op3_near_dedup"](spark, corpus), "doc_id", "n_shingles", "component_id", "kept")
    same(got, brute.near_components(doc_rows))


def test_token_counts(spark, corpus, doc_rows, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = []
    for doc, text in doc_rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        wanted.append((doc, len((text or "").encode()), n, n > 512))
    same(rows(QUERIES["op5_token_counts"](spark, corpus), "doc_id", "n_bytes", "n_tokens", "over_limit"), wanted)


def test_warc(spark, corpus, rows):
    pages = [tuple(r) for r in spark.read.parquet(f"{corpus}/pages.parquet").select("page_id", "html").collect()]
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    same(rows(QUERIES["op6_warc"](spark, corpus), *columns), brute.archives(pages))


def test_quality_rules(spark, corpus, doc_rows, rows):
    result = QUERIES["op8_quality_rules"](spark, corpus)
    same(rows(result, *OP8), brute.quality(doc_rows))
    assert all(not r[1] for r in rows(result, "base_failed", "kept") if r[0])


def test_line_dedup(spark, corpus, doc_rows, rows):
    got = rows(QUERIES["op9_line_dedup"](spark, corpus), "doc_id", "n_lines", "n_dropped", "kept_sha256")
    same(got, brute.line_dedup(doc_rows))


def test_quality_classifier(spark, corpus, doc_rows, rows):
    import zlib

    got = {r[0]: r for r in rows(QUERIES["op10_quality_classifier"](spark, corpus), "doc_id", "held_out", "score", "predicted")}
    assert len(got) == len(doc_rows)
    for doc, held_out, score, predicted in got.values():
        assert held_out == (zlib.crc32(str(doc).encode()) % 5 == 0)
        assert 0 <= score <= 1 and predicted == int(score >= 0.3)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in OTHER_ROWS])
def test_queries_keep_every_row(spark, name):
    sf = "/root/testdata/sf0.001"
    result = QUERIES[name](spark, sf)
    source = "pages" if "page_id" in result.columns else "documents"
    assert result.count() == spark.read.parquet(f"{sf}/{source}.parquet").count()


def test_passages_are_of_documents(spark):
    """Each passage is of two documents of the table, the smaller one second, and lies within their words."""
    sf = "/root/testdata/sf0.001"
    sizes = {r[0]: len(brute.words(r[1] or "")) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op4_substring_dedup"](spark, sf).collect()
    assert got
    for r in got:
        assert r["of_doc"] < r["doc_id"] and r["start_word"] >= 0 and r["end_word"] <= sizes[r["doc_id"]] and r["of_end"] <= sizes[r["of_doc"]]
