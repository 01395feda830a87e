"""MinHash near-dedup with sequential Bayesian verification.

1. Every text becomes its set of distinct five-word shingles: a digest of the set, its size, and a signature of 128
   min-hashes. Texts with the same set are one class, represented by its smallest document.
2. The signature is cut into 32 bands of four; classes that agree on a band share a bucket.
3. Candidates are compared signature batch by signature batch. After each batch the posterior of the similarity, from a
   uniform prior, decides: a pair goes as soon as the probability that it reaches the threshold is under ``MISS``.
4. What is left is confirmed on the whole shingle sets.

Candidates come in passes, so that a bucket of n classes does not cost n * n comparisons. The first compares every
class of a bucket with the smallest one; the confirmed links give components. The next one takes the buckets whose classes
are in different components still and compares them with their most linked class, which is the original where copies
were made of it. The last one compares what is left: all pairs of such a bucket that are in different components, since
links inside one would add nothing. They are tested and confirmed where they meet, so no table of pairs is made.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contact_mart.llm.common import Tables, mixed, prepare, shingle_hashes, texts_of
from contact_mart.llm.components import components

HASHES, BANDS, BATCH = 128, 32, 16
# Probability with which a pair of at least the threshold may be dropped by its signature.
MISS = 1e-6
BLOCK, BLOCK_BYTES, MOST_CLUSTERED = 512, 16 << 20, 8192
# Passes in which a bucket is compared with its most linked class before the residual pass, which takes all that is left.
STARS = 1
_RNG = np.random.default_rng(20240501)
_A = (_RNG.integers(0, 1 << 31, HASHES, np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, HASHES, np.uint32)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Smallest value of each hash function over the shingles, computed a bounded piece at a time."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, np.uint32(0xFFFFFFFF))
    for at in range(0, len(x), 1024):
        part = _A[:, None] * x[None, at : at + 1024]
        part += _B[:, None]
        # Fold the good high bits down before the order is taken.
        part ^= part >> np.uint32(15)
        np.minimum(out, part.min(axis=1), out=out)
    return out


def least_matches(per_cent: int, miss: float = MISS) -> np.ndarray:
    """For n compared hashes, a multiple of BATCH: matches below which a pair is dropped.

    With a uniform prior, P(similarity >= t | m of n match) is the chance of m or fewer hits in n + 1 tries of chance t.
    """
    t, least = per_cent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, 0
        while m <= n:
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if total >= miss:
                break
            m += 1
        least.append(m)
    return np.array(least)


def plausible(left: np.ndarray, right: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Rows of two signature matrices that no batch rules out."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), np.int64)
    for k, needed in enumerate(least):
        at = slice(k * BATCH, (k + 1) * BATCH)
        matches[alive] += (left[alive, at] == right[alive, at]).sum(1)
        alive = alive[matches[alive] >= needed]
    return alive


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, n_shingles, digest (of the set; null without words), sketch (the signature's bytes)."""
    schema = pa.schema([("doc", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("sketch", pa.binary())])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, sketches = [], [], []
            for value in batch["text"]:
                shingles = np.unique(shingle_hashes(value.as_py()))
                sizes.append(len(shingles))
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                sketches.append(signature(shingles).tobytes() if len(shingles) else None)
            arrays = [batch["doc"], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    return rows.mapInArrow(sketch, "doc long, n_shingles long, digest binary, sketch binary")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(-1, HASHES)


def _bands(classes: DataFrame) -> DataFrame:
    """bucket, node: a row per band."""
    salt = (np.arange(BANDS, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            halves = _matrix(batch["sketch"]).reshape(len(batch), BANDS, -1).view(np.uint64)
            bucket = mixed(mixed(halves[:, :, 0] + salt) + halves[:, :, 1])
            yield pd.DataFrame({"bucket": bucket.view(np.int64).ravel(), "node": np.repeat(batch["node"].to_numpy(), BANDS)})

    return classes.select("node", "sketch").mapInPandas(cut, "bucket long, node long")


def _probable(pairs: DataFrame, classes: DataFrame, per_cent: int) -> DataFrame:
    """Pairs (a, b) that the sequential test leaves."""
    left = classes.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
    right = classes.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"))
    least = least_matches(per_cent)

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = plausible(_matrix(batch["sketch_a"]), _matrix(batch["sketch_b"]), least)
            yield batch[["a", "b"]].iloc[keep]

    return pairs.join(right, "b").join(left, "a").mapInPandas(test, "a long, b long")


def _cross_links(residual: DataFrame, classes: DataFrame, docs: DataFrame, per_cent: int, tables: Tables) -> DataFrame:
    """Confirmed links between classes of residual buckets (bucket, node, component, n) in different components.

    Buckets that share classes form a cluster, of which every class is sent once; a cluster of more than MOST_CLUSTERED
    classes is taken bucket by bucket. A group of up to BLOCK classes and BLOCK_BYTES of text is one; a larger one is
    dealt into blocks, and every two blocks meet in a task. The task tests signatures, then whole sets, and counts
    what it links as one component from there on. Only links leave it."""
    spokes = residual.join(residual.groupBy("bucket").agg(F.min("node").alias("hub")), "bucket")
    clusters = tables.put(components(spokes.select(F.col("hub").alias("a"), F.col("node").alias("b")), tables, "clusters"), "clusters")
    sizes = clusters.groupBy(F.col("component").alias("cluster")).agg(F.count("*").alias("in_cluster"))
    of_node = clusters.withColumnRenamed("component", "cluster").join(sizes, "cluster")
    member = residual.join(of_node, "node").select(
        F.when(F.col("in_cluster") <= MOST_CLUSTERED, F.struct(F.lit(0).alias("kind"), F.col("cluster").alias("id")))
        .otherwise(F.struct(F.lit(1).alias("kind"), F.col("bucket").alias("id"))).alias("group"),
        "node", "component",
    ).distinct()
    texts = texts_of(docs, residual.select(F.col("node").alias("doc")), tables, "last")
    texts = texts.select(F.col("doc").alias("node"), "text").dropDuplicates(["node"])
    member = tables.put(member.join(texts.select("node", F.octet_length("text").alias("bytes")), "node"), "members")
    blocks = member.groupBy("group").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("blocks")
    )
    own = member.join(blocks, "group").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    full = own.join(classes.select("node", "sketch"), "node").join(texts, "node")
    dealt = full.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.col("group.kind").alias("kind"), F.col("group.id").alias("id"), F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"), "block", "node", "component", "sketch", "text",
    )
    key = ["kind", "id", "i", "j"]
    dealt = dealt.repartition(*key).sortWithinPartitions(*key, "component", "node")
    least = least_matches(per_cent)

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        sketches, node = _matrix(part["sketch"]), part["node"].to_numpy()
        component, block = part["component"].to_numpy().copy(), part["block"].to_numpy()
        sets: list[np.ndarray | None] = [None] * len(part)
        texts, single, out = part["text"].tolist(), part["i"].iloc[0] == part["j"].iloc[0], []

        def of(k: int) -> np.ndarray:
            if sets[k] is None:
                sets[k] = np.unique(shingle_hashes(texts[k]))
            return sets[k]

        for k in range(len(part) - 1):
            others = np.arange(k + 1, len(part))
            others = others[(component[others] != component[k]) & (single | (block[others] != block[k]))]
            if not len(others):
                continue
            keep = others[plausible(np.broadcast_to(sketches[k], (len(others), HASHES)), sketches[others], least)]
            for o in keep.tolist():
                if component[o] != component[k] and linked(of(k), of(o), per_cent):
                    out.append((min(node[k], node[o]), max(node[k], node[o])))
                    component[component == component[o]] = component[k]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        at = None
        for batch in batches:
            for group, part in batch.groupby(key, sort=False):
                if group != at and held:
                    yield compare(pd.concat(held))
                    held = []
                at = group
                held.append(part)
        if held:
            yield compare(pd.concat(held))

    return dealt.mapInPandas(stream, "a long, b long")


def linked(one: np.ndarray, two: np.ndarray, per_cent: int) -> bool:
    """Two sets of distinct sorted shingles reach the threshold."""
    if 100 * min(len(one), len(two)) < per_cent * max(len(one), len(two)):
        return False
    common = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * common >= per_cent * (len(one) + len(two) - common)


def _confirmed(pairs: DataFrame, docs: DataFrame, per_cent: int, tables: Tables, name: str) -> DataFrame:
    """Pairs whose whole shingle sets reach the threshold. The texts of their documents are written down once, so that
    the others' texts move once at most."""
    nodes = pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc")))
    texts = texts_of(docs, nodes, tables, name)
    left = texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b"))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, one = None, None
        for batch in batches:
            keep = []
            for k, (ta, tb) in enumerate(zip(batch["text_a"], batch["text_b"])):
                ta = ta.as_py()
                if one is None or ta != text:
                    text, one = ta, np.unique(shingle_hashes(ta))
                two = np.unique(shingle_hashes(tb.as_py()))
                if linked(one, two, per_cent):
                    keep.append(k)
            yield pa.RecordBatch.from_arrays([batch["a"].take(pa.array(keep, pa.int64())), batch["b"].take(pa.array(keep, pa.int64()))], ["a", "b"])

    return pairs.join(right, "b").join(left, "a").mapInArrow(confirm, "a long, b long")


def _residual(shared: DataFrame, united: DataFrame) -> DataFrame:
    """bucket, node, component, n: the rows of buckets whose classes are not all in one component."""
    placed = shared.join(united, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    split = (
        placed.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
        .where("low < high")
        .select("bucket", "n")
    )
    return placed.join(split, "bucket")


def near_duplicates(
    docs: DataFrame, per_cent: int = 75, tables: Tables | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row per row of ``docs``: the id, n_shingles, component_id (smallest linked document), kept.

    A null, empty or blank text has no shingles and is linked with nothing; so is a row without an id, which is kept
    and has no component. Rows with the same id are one document. Equal sets are linked whatever their number. Columns
    other than the two named are not read.
    """
    spark = prepare(docs.sparkSession)
    tables = tables or Tables(spark)
    rows = tables.put(signatures(docs, doc_id, text), "signatures")
    linked = rows.where("digest is not null and doc is not null")
    # The smallest document of each set; a document of two sets (an id twice) ties its classes together.
    classes = tables.put(
        linked.groupBy("digest").agg(F.min("doc").alias("node"), F.max("doc").alias("last"), F.any_value("sketch").alias("sketch")),
        "classes",
    )
    nodes = classes.select("node", "sketch").dropDuplicates(["node"])
    texts = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))

    buckets = _bands(nodes)
    hubs = buckets.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1")
    shared = tables.put(buckets.join(hubs, "bucket"), "buckets")
    first = shared.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    tested = tables.put(_probable(first, nodes, per_cent), "pairs-1")
    same_id = linked.join(classes.select("digest", "node"), "digest").where("doc <> node").select(F.col("node").alias("a"), F.col("doc").alias("b"))
    twice = linked.groupBy("doc").agg(F.count_distinct("digest").alias("n")).where("n > 1").select(F.col("doc").alias("b"))
    ties = same_id.join(twice, "b", "left_semi").select("a", "b")
    links = tables.put(_confirmed(tested, texts, per_cent, tables, "1").unionByName(ties), "links-1")
    united = tables.put(components(links, tables, "components-1"), "united-1")
    for k in range(2, 2 + STARS):
        residual = tables.put(_residual(shared, united), f"residual-{k}")
        ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
        degrees = ends.groupBy("node").agg(F.count("*").alias("links"))
        ranked = residual.join(degrees, "node", "left").select("bucket", "node", "component", F.coalesce("links", F.lit(0)).alias("links"))
        hubs = ranked.groupBy("bucket").agg(F.max(F.struct("links", (-F.col("node")).alias("minus"), "component")).alias("hub"))
        star = ranked.join(hubs, "bucket").where(F.col("component") != F.col("hub.component"))
        pairs = star.select(F.least("node", -F.col("hub.minus")).alias("a"), F.greatest("node", -F.col("hub.minus")).alias("b")).distinct()
        new = tables.put(_probable(pairs.join(tested, ["a", "b"], "left_anti"), nodes, per_cent), f"pairs-{k}")
        tested = tested.unionByName(new)
        found = tables.put(_confirmed(new, texts, per_cent, tables, str(k)), f"links-{k}")
        links = links.unionByName(found)
        united = tables.put(components(found, tables, f"components-{k}", united), f"united-{k}")
    residual = tables.put(_residual(shared, united), "residual-last")
    whole = components(_cross_links(residual, nodes, texts, per_cent, tables), tables, "last", united)
    of_class = (
        classes.join(whole, "node", "left")
        .select("digest", F.coalesce("component", "node").alias("__component"))
    )
    result = rows.join(of_class, "digest", "left")
    component = F.coalesce(F.when(F.col("doc").isNotNull(), F.col("__component")), F.col("doc"))
    return result.select(
        F.col("doc").alias(doc_id),
        "n_shingles",
        component.alias("component_id"),
        F.col("doc").eqNullSafe(component).alias("kept"),
    )
