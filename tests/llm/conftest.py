from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"


def hard_texts() -> list[str | None]:
    """Nulls, empty and blank texts, copies, near copies, long runs, other scripts, shared lines and passages."""
    rng = random.Random(7)
    base = [f"w{rng.randrange(900)}" for _ in range(120)]
    texts: list[str | None] = [None, "", " ", "\n", " \n\t\n", "one", "One two", "a\nb\nA\nb ", "x " * 3000, "y" * 40_000]
    texts += [" ".join(base), " ".join(base).upper(), "  ".join(base) + "\n"]
    for n in range(30):
        copy = list(base)
        for _ in range(n % 9):
            copy[rng.randrange(120)] = f"z{rng.randrange(99)}"
        texts.append(" ".join(copy))
    line = "A line that stands in a great many places"
    texts += [f"{line}\nown text number {k}\n\t{line.upper()} \nshort\n{line}" for k in range(40)]
    texts += ["Straße ÉCOLE İstanbul ΑΣ ﬁn 東京 都     \x1c\x85 x", "été ÉTÉ Été " * 5, "😀 á " * 30]
    texts += ["mail a.b@c.de, b@d.org x@y 1.2.3.4 999.1.1.1 4111 1111 1111 1111 +1 (555) 123-4567 " * 2, "1" * 5000, "." * 5000]
    texts += ["<|endoftext|> a<|endoftext|><|endoftext|>b <|endoftext", "it's we'll I'M  \n\n  x   ", "　   ab\r\n\r\n c"]
    return texts


@pytest.fixture(scope="session")
def corpus(spark, tmp_path_factory):
    """A folder with the smallest tables and, under other ids, the hard rows; extra columns with clashing names."""
    from pyspark.sql import functions as F

    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = hard_texts()
    items = [(9001, "A line that stands in a great many places own text number 3"), (9002, "One TWO"), (9003, None), (9004, "..."),
             (9005, "one two"), (9006, "own text number 7"), (9007, "été ÉTÉ Été été ÉTÉ Été été ÉTÉ Été été ÉTÉ")]
    hard = spark.createDataFrame([(100_000 + k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    more = [F.lit(None).cast("string").alias("lang"), F.lit("hot").alias("source"), F.lit(1).cast("long").alias("n_chars")]
    clash = {c: F.lit(-1) for c in ("n_words", "n_lines", "kept", "token", "hash", "component_id", "place", "n_tokens")}
    docs.unionByName(hard.select("doc_id", "text", *more)).withColumns(clash).repartition(5).write.parquet(f"{folder}/documents.parquet")
    bench.unionByName(spark.createDataFrame(items, "item_id long, text string")).withColumn("n", F.lit("?")).write.parquet(f"{folder}/benchmark.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").withColumn("score", F.lit(0)).write.parquet(f"{folder}/labels.parquet")
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    own = [(10_000 + k, None if k % 2 else "http://x/\r\ny", t) for k, t in enumerate(texts)]
    own += [(20_000, "u", "é" * 200_000), (20_001, "u", "é" * 200_000), (20_002, "u", "x" * (64 << 10))]
    own_pages = spark.createDataFrame(own, "page_id long, url string, html string")
    pages.unionByName(own_pages).withColumn("record", F.lit("?")).repartition(3).write.parquet(f"{folder}/pages.parquet")
    return folder


@pytest.fixture(scope="session")
def doc_rows(spark, corpus):
    return [tuple(r) for r in spark.read.parquet(f"{corpus}/documents.parquet").select("doc_id", "text").collect()]
