"""Benchmark decontamination as a prefix-filtered set join. Built-in functions only.

The sets are the windows of the benchmark: ten consecutive words of an item, or the whole of
a shorter item, seen as sets of five-word shingles. A text can hold a window only if it holds
all of its shingles, so one of them, the rarest in the corpus, is the prefix that has to be
joined. A text's shingle meets the prefix shingles, its place gives the only place where the
window could start, the bounds (not before the first word, not past the last) drop what cannot
fit, and the words of the text are compared with those of the window.

The texts are cut into shingles once. Shingles that no item has are dropped before anything
moves; what is left is written down and gives the corpus counts and the candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contact_mart.llm.common import Tables, let, lower_ascii, prepare

WINDOW = 10
# Rows, of about 100 bytes, of the benchmark side of a join that are sent to all tasks.
SENT_ROWS = 500_000
SHINGLE = 5
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _word_hashes(words: Column) -> Column:
    # lower() is coarser than A-Z alone for other scripts; the comparison of words decides.
    return F.transform(words, lambda w: F.xxhash64(F.lower(w)))


def _shingles(hashes: Column, size: int) -> Column:
    return F.when(F.size(hashes) < size, F.array().cast("array<bigint>")).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.size(hashes) - size), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(size)])
        )
    )


def _tokens(words: Column, size: int) -> Column:
    return let(_word_hashes(words), lambda hashes: _shingles(hashes, size))


def windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item, window (its words joined by blanks), n (its words). Items without words have none."""
    words = benchmark.select(F.col(item_id).cast("string").alias("item"), _words(lower_ascii(F.col(text))).alias("words"))
    cut = words.where(F.size("words") > 0).select(
        "item",
        F.explode(
            F.when(F.size("words") <= WINDOW, F.array("words")).otherwise(
                F.transform(
                    F.sequence(F.lit(1), F.size("words") - WINDOW + 1), lambda i: F.slice("words", i, F.lit(WINDOW))
                )
            )
        ).alias("w"),
    )
    return cut.select("item", F.array_join("w", " ").alias("window"), F.size("w").alias("n")).distinct()


def _sent(rows: DataFrame) -> DataFrame:
    """The table sent to all tasks if it has SENT_ROWS rows at most; a larger one is joined by exchange."""
    return F.broadcast(rows) if rows.count() <= SENT_ROWS else rows


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, tables: Tables | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row per row of ``docs``: the id, __hash (of its text), n_words, n_hit, n_items, items (sorted array of texts).

    n_hit counts the words inside any occurrence of a window, n_items the items that have one.
    A null or empty text has no words and no hits, a null or empty item no windows; an empty
    benchmark hits nothing. Items with the same window are all named; null item ids are not
    counted. Repeated rows get the same result each; columns other than the two named are not read.
    """
    spark = prepare(docs.sparkSession)
    tables = tables or Tables(spark)
    held = tables.put(windows(benchmark), "windows")
    distinct = held.select("window", "n").distinct()
    shingled = distinct.select(
        "window", "n", F.least(F.lit(SHINGLE), F.col("n")).alias("size"), F.split("window", " ").alias("w")
    )
    sizes = sorted(r["size"] for r in shingled.select("size").distinct().collect())  # at most SHINGLE values
    parts = None
    for size in sizes:
        part = shingled.where(F.col("size") == size).select(
            "window", "n", F.posexplode(_tokens(F.col("w"), size)).alias("offset", "token")
        )
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        parts = shingled.select("window", "n", F.lit(0).alias("offset"), F.lit(0).cast("long").alias("token"))
    tokens = tables.put(parts, "tokens")

    # One row per document (place 0) and one per shingle that the benchmark has.
    words = docs.select(
        F.col(doc_id).alias("doc"), F.xxhash64(text).alias("hash"), _words(F.col(text)).alias("words")
    ).select("doc", "hash", F.size("words").alias("n_words"), _word_hashes(F.col("words")).alias("h"))
    own = [_shingles(F.col("h"), size) for size in (sizes or [SHINGLE])]
    places = None
    for k, shingles in enumerate(own):
        head = F.array(F.lit(0).cast("long")) if k == 0 else None
        listed = F.concat(head, shingles) if k == 0 else shingles
        part = words.select("doc", "hash", "n_words", F.posexplode(listed).alias("place", "token"))
        part = part if k == 0 else part.withColumn("place", F.col("place") + 1)
        places = part if places is None else places.unionByName(part)
    wanted = _sent(tables.put(tokens.select("token").distinct().withColumn("known", F.lit(True)), "wanted"))
    hits = tables.put(
        places.join(wanted, "token", "left").where("known or place = 0").select("doc", "hash", "n_words", "place", "token"),
        "hits",
    )
    found = hits.where("place > 0")
    counts = found.groupBy("token").agg(F.count("*").alias("frequency"))

    # Prefix: the rarest shingle. A window of which any shingle is nowhere is in no text.
    prefix = (
        tokens.join(counts, "token", "left")
        .groupBy("window", "n")
        .agg(
            F.min(F.struct("frequency", "token", "offset")).alias("rarest"),
            F.count_if(F.col("frequency").isNull()).alias("missing"),
        )
        .where("missing = 0")
        .select("window", "n", "rarest.token", "rarest.offset")
    )
    prefix = _sent(tables.put(prefix, "prefix"))
    candidates = (
        found.join(prefix, "token")
        .withColumn("start", F.col("place") - 1 - F.col("offset"))
        .where("start >= 0 and start + n <= n_words")
        .groupBy("doc", "hash")
        .agg(F.collect_set(F.struct("start", "n", "window")).alias("places"))
        .select(F.col("doc").alias("__doc"), F.col("hash").alias("__hash"), "places")
    )
    texts = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    checked = texts.join(
        candidates, F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("hash") == F.col("__hash"))
    )
    same = let(
        _words(lower_ascii(F.col("text"))),
        lambda words: F.filter("places", lambda c: F.array_join(F.slice(words, c["start"] + 1, c["n"]), " ") == c["window"]),
    )
    verified = tables.put(
        checked.select("doc", "hash", same.alias("places")).where(F.size("places") > 0).dropDuplicates(["doc", "hash"]),
        "verified",
    )
    covered = F.array_distinct(
        F.flatten(F.transform("places", lambda c: F.sequence(c["start"], c["start"] + c["n"] - 1)))
    )
    n_hit = verified.select(F.col("doc").alias("__doc"), F.col("hash").alias("__h"), F.size(covered).alias("n_hit"))
    items = (
        verified.select("doc", "hash", F.explode(F.array_distinct(F.transform("places", lambda c: c["window"]))).alias("window"))
        .join(held.where("item is not null"), "window")
        .groupBy("doc", "hash")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
        .select(F.col("doc").alias("__doc2"), F.col("hash").alias("__h2"), "items")
    )
    every = hits.where("place = 0")
    joined = every.join(n_hit, F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("hash") == F.col("__h")), "left").join(
        items, F.col("doc").eqNullSafe(F.col("__doc2")) & (F.col("hash") == F.col("__h2")), "left"
    )
    none = F.array().cast("array<string>")
    return joined.select(
        F.col("doc").alias(doc_id),
        F.col("hash").alias("__hash"),
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"),
    )
