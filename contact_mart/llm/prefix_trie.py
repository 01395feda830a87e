"""Prefix trie of rebuilt conversations by composable fingerprints.

A rebuilt conversation is the head of its base conversation followed by its own turns after as many.
Turns stay where they are stored; what is put together are fingerprints. The fingerprint of a
sequence is a pair (B ** length, sum of element * B ** elements behind it), which is a monoid: the
pair of a concatenation is (p1 * p2, s1 * p2 + s2). So every prefix of every conversation comes from
one scan whose parts are joined by that product, and the prefixes of a rebuilt conversation come
symbolically: with own prefixes F, base prefixes G, head length h and its length in the base g, the
prefix that ends with the own turn k is F(k) + (G(g) - F(h)) * B ** (k - h). No rebuilt text exists.

Nodes are groups of equal (depth, fingerprint). Every path row names its stored turn by a hash of its
content, and a group is verified by those: the hashes tell all stored turns apart, and the members
of each group have one and the same last turn and parent group, so by induction equal sequences.
Otherwise another seed is tried; a result is exact.

Sums over subtrees need no walk down the trie. Each node belongs to its smallest member, whose own
nodes are the lower end of its path; a conversation adds the sum over its own nodes to all nodes on
its path, and a node takes off what its owner has above it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contact_mart.llm.common import Tables, mixed, prepare

# Odd multipliers, and what the elements of each lane are mixed with.
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
SALTS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))
INVERSES = tuple(np.uint64(pow(int(b), -1, 1 << 64)) for b in BASES)
HEAD_SPAN, FAMILY = 9, 5
MOST_HEAD = HEAD_SPAN - 1
# Bytes of joined ids that one row holds.
BLOCK = 1 << 16
KEY = ["depth", "f1", "f2"]


def power(base: np.uint64, exponent: np.ndarray) -> np.ndarray:
    """``base ** exponent`` modulo 2 ** 64."""
    out, square, left = np.ones(len(exponent), np.uint64), base, exponent.astype(np.uint64)
    while left.any():
        out = np.where(left & np.uint64(1), out * square, out)
        left >>= np.uint64(1)
        square = np.uint64(int(square) ** 2 & 0xFFFFFFFFFFFFFFFF)
    return out


def element(x: np.ndarray, lane: int) -> np.ndarray:
    """What a turn with the content hash ``x`` adds in a lane."""
    return mixed(x.view(np.uint64) ^ SALTS[lane])


def compose(first: tuple[int, int, int], then: tuple[int, int, int]) -> tuple[int, int, int]:
    """Length and both lanes of one sequence followed by another."""
    n, m = first[0], then[0]
    lanes = [(s * pow(int(b), m, 1 << 64) + t) & 0xFFFFFFFFFFFFFFFF for s, t, b in zip(first[1:], then[1:], BASES)]
    return (n + m, *lanes)


def prefixes(x: np.ndarray, begins: np.ndarray, carried: list[np.uint64]) -> list[np.ndarray]:
    """For both lanes the fingerprint of every prefix of the sequences that begin at ``begins`` (the first at 0); the first
    one goes on from what is carried."""
    at = np.arange(len(x))
    run = np.cumsum(np.isin(at, begins)) - 1
    place = (at - begins[run] + 1).astype(np.uint64)
    out = []
    for lane, (base, inverse) in enumerate(zip(BASES, INVERSES)):
        ahead = power(base, place)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(element(x, lane) * power(inverse, place))))
        start = sums[begins[run]] - np.where(run == 0, carried[lane], np.uint64(0))
        out.append((sums[1:] - start) * ahead)
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and prefix fingerprint of every row within its conversation, as far as this task has it."""
    conv, place, carried = None, 0, [np.uint64(0), np.uint64(0)]
    for batch in batches:
        if not batch.num_rows:
            continue
        own, x = (batch.column(k).to_numpy() for k in (1, 2))
        new = np.concatenate(([conv is None or own[0] != conv], own[1:] != own[:-1]))
        if new[0]:
            place, carried = 0, [np.uint64(0), np.uint64(0)]
        begins = np.flatnonzero(new) if new[0] else np.concatenate(([0], np.flatnonzero(new)))
        lanes = prefixes(x, begins, carried)
        run = np.searchsorted(begins, np.arange(len(x)), "right") - 1
        places = np.arange(len(x)) - begins[run] + 1 + np.where(run == 0, place, 0)
        conv, place, carried = own[-1], int(places[-1]), [lane[-1] for lane in lanes]
        columns = [*batch.columns, pa.array(places), *(pa.array(lane.view(np.int64)) for lane in lanes)]
        yield pa.RecordBatch.from_arrays(columns, ["part", "conv_id", "x", "size", "place", "f1", "f2"])


def _unsigned(value: int) -> int:
    return value & 0xFFFFFFFFFFFFFFFF


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns f1, f2 with ``by * B ** over`` of their lane added; the columns d1, d2, over go."""
    for batch in batches:
        names = batch.schema.names
        over = batch.column(names.index("over")).to_numpy()
        columns = dict(zip(names, batch.columns))
        for lane, base in enumerate(BASES):
            f, d = (columns[f"{c}{lane + 1}"].to_numpy().view(np.uint64) for c in "fd")
            columns[f"f{lane + 1}"] = pa.array((f + d * power(base, over)).view(np.int64))
        for name in ("d1", "d2", "over"):
            del columns[name]
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _with_parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """p1, p2: the fingerprints without the last turn."""
    for batch in _moved(batches):
        names = batch.schema.names
        x = batch.column(names.index("x")).to_numpy()
        own = [batch.column(names.index(f"f{lane + 1}")).to_numpy().view(np.uint64) for lane in (0, 1)]
        parents = [((f - element(x, lane)) * INVERSES[lane]).view(np.int64) for lane, f in enumerate(own)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, parents)], [*names, "p1", "p2"])


def head_length(conv_id: Column) -> Column:
    return F.pmod(F.crc32(conv_id.cast("string")), F.lit(HEAD_SPAN))


def _base(conv_id: Column) -> Column:
    return conv_id - conv_id % FAMILY


def stored_turns(conversations: DataFrame, seed: int = 0) -> DataFrame:
    """conv_id, turn, role, text, x, size: nulls as empty strings, a hash of the content and the text's bytes."""
    empty = F.lit("")
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
    )
    return rows.withColumns({"x": F.xxhash64(F.lit(seed), "role", "text"), "size": F.octet_length("text").cast("long")})


def tells_apart(turns: DataFrame) -> bool:
    """Whether no two different contents of turns have the same hash. Equal contents are one before they move."""
    contents = turns.groupBy("x", "role", "text").agg(F.lit(1).alias("one"))
    return not contents.groupBy("x").count().where("count > 1").limit(1).collect()


def scanned(turns: DataFrame, tables: Tables) -> DataFrame:
    """conv_id, place, x, size, f1, f2 of every stored turn: its place from 1 and the fingerprint up to it.

    The order is by turn (nulls first), role and text. The rows are dealt by ranges of (conversation, order), so a
    conversation of any length is spread over tasks; what the parts of a cut conversation before a part come to is
    worked out from one row for each part of it, two a task at most."""
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    rows = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select(F.spark_partition_id().cast("long").alias("part"), "conv_id", "x", "size")
    found = tables.put(rows.mapInArrow(_scan, "part long, conv_id long, x long, size long, place long, f1 long, f2 long"), "scan")
    ends = found.groupBy("part").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high"))
    cut = ends.select("part", F.explode(F.array_distinct(F.array("low", "high"))).alias("conv_id"))
    cut = cut.groupBy("conv_id").count().where("count > 1").select("conv_id")
    parts = found.join(cut, "conv_id", "left_semi").groupBy("conv_id", "part").agg(
        F.max("place").alias("n"), F.max_by("f1", "place").alias("f1"), F.max_by("f2", "place").alias("f2")
    )
    carried, before = [], {}
    for conv, part, n, f1, f2 in sorted(map(tuple, parts.collect())):
        done = before.get(conv, (0, 0, 0))
        carried.append((conv, part, done[0], _signed(done[1]), _signed(done[2])))
        before[conv] = compose(done, (n, _unsigned(f1), _unsigned(f2)))
    if not carried:
        return found.drop("part")
    names = "conv_id long, part long, passed long, d1 long, d2 long"
    known = found.sparkSession.createDataFrame(carried, names)
    zero = F.lit(0).cast("long")
    joined = found.join(known, ["conv_id", "part"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("passed", zero)).alias("place"), "x", "size", "f1", "f2",
        F.coalesce("d1", zero).alias("d1"), F.coalesce("d2", zero).alias("d2"), F.col("place").alias("over"),
    )
    return tables.put(joined.mapInArrow(_moved, "conv_id long, place long, x long, size long, f1 long, f2 long"), "scan-joined")


def _minus(a: str, b: str) -> Column:
    """Difference modulo 2 ** 64 of two long columns: by halves, as the result may not fit."""
    low = F.col(a).bitwiseAND(F.lit(0xFFFFFFFF)) - F.col(b).bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftright(a, 32) - F.shiftright(b, 32) + F.shiftright(low, 32)
    return F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(F.lit(0xFFFFFFFF)))


def rebuilt(found: DataFrame, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations (conv_id, length) and their paths: conv_id, depth, x, size, last, source, place, f1, f2, p1,
    p2 for every prefix. source and place are the stored turn that the prefix ends with."""
    turn = F.struct("place", "x", "size", "f1", "f2")
    known = found.groupBy("conv_id").agg(
        F.max("place").alias("n"), F.sort_array(F.collect_list(F.when(F.col("place") <= MOST_HEAD, turn))).alias("first")
    )
    known = tables.put(known, "conversations")
    bases = known.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("first").alias("of_base"))
    zero = F.lit(0).cast("long")
    h = F.col("h")
    joint = known.withColumns({"base": _base(F.col("conv_id")), "h": head_length(F.col("conv_id"))}).join(bases, "base", "left")
    joint = joint.withColumn("head", F.slice(F.coalesce("of_base", F.array().cast(known.schema["first"].dataType)), 1, h.cast("int")))
    for lane in ("f1", "f2"):
        joint = joint.withColumns({
            f"g_{lane}": F.coalesce(F.get("head", F.size("head") - 1)[lane], zero),
            f"h_{lane}": F.when((h > 0) & (F.col("n") > h), F.get("first", (h - 1).cast("int"))[lane]).otherwise(zero),
        })
    joint = joint.select(
        "conv_id", "base", "h", F.size("head").cast("long").alias("g"), "head", "n",
        (F.size("head") + F.greatest(F.col("n") - h, zero)).alias("length"),
        _minus("g_f1", "h_f1").alias("d1"), _minus("g_f2", "h_f2").alias("d2"),
    )
    joint = tables.put(joint, "joint")
    behind = found.where(F.col("place") > head_length(F.col("conv_id"))).join(joint.drop("head"), "conv_id")
    own = behind.select(
        "conv_id", (F.col("g") + F.col("place") - h).alias("depth"), "x", "size", (F.col("place") == F.col("n")).alias("last"),
        F.col("conv_id").alias("source"), "place", "f1", "f2", "d1", "d2", (F.col("place") - h).alias("over"),
    )
    heads = joint.select("conv_id", "base", "length", F.explode("head").alias("t")).select(
        "conv_id", F.col("t.place").alias("depth"), "t.x", "t.size", (F.col("t.place") == F.col("length")).alias("last"),
        F.col("base").alias("source"), "t.place", "t.f1", "t.f2", zero.alias("d1"), zero.alias("d2"), zero.alias("over"),
    )
    paths = own.unionByName(heads).mapInArrow(
        _with_parents,
        "conv_id long, depth long, x long, size long, last boolean, source long, place long, f1 long, f2 long, p1 long, p2 long",
    )
    return joint.select("conv_id", "length"), tables.put(paths, "paths")


def groups(paths: DataFrame) -> DataFrame:
    """Nodes but for the root: their smallest member, members, members that end there, and whether they are verified."""
    same = [F.min(c) == F.max(c) for c in ("x", "p1", "p2")]
    return paths.groupBy(*KEY).agg(
        F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("last").cast("long")).alias("n_ends"),
        F.max("size").alias("size"), F.max("p1").alias("p1"), F.max("p2").alias("p2"), (same[0] & same[1] & same[2]).alias("verified"),
    )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, id) in order as rows (key, first id, ids joined by commas), of ``BLOCK`` bytes about."""
    key, ids, size, out = None, [], 0, []

    def rows() -> pa.RecordBatch:
        columns = [pa.array(c, k) for c, k in zip(zip(*out), [pa.int64()] * 4 + [pa.string()])]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, [*KEY, "first", "ids"])

    for batch in batches:
        for *own, conv in zip(*(column.to_pylist() for column in batch.columns)):
            if own != key or size > BLOCK:
                if ids:
                    out.append((*key, int(ids[0]), ",".join(ids)))
                key, ids, size = own, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if len(out) > 1000:
            yield rows()
    if ids:
        out.append((*key, int(ids[0]), ",".join(ids)))
    if out:
        yield rows()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, first id, joined ids) in order as one SHA-256 for each key, block after block."""
    key, digest, out = None, None, []

    def rows() -> pa.RecordBatch:
        columns = [pa.array(c, k) for c, k in zip(zip(*out), [pa.int64()] * 3 + [pa.string()])]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, [*KEY, "ends_sha256"])

    for batch in batches:
        for *own, _, ids in zip(*(column.to_pylist() for column in batch.columns)):
            if own != key:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = own, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if len(out) > 1000:
            yield rows()
    if key is not None:
        out.append((*key, digest.hexdigest()))
    if out:
        yield rows()


def ends(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """depth, f1, f2, ends_sha256 of the nodes at which conversations end.

    The ids are put in order and joined in tasks that each have a range of them, also of one node; the hash of a node,
    which has to go in order, then reads blocks of joined ids."""
    zero = F.lit(0).cast("long")
    none = convs.where("length = 0").select(zero.alias("depth"), zero.alias("f1"), zero.alias("f2"), "conv_id")
    rows = paths.where("last").select(*KEY, "conv_id").unionByName(none)
    rows = rows.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    blocks = rows.mapInArrow(_joined, "depth long, f1 long, f2 long, first long, ids string")
    blocks = blocks.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return blocks.mapInArrow(_hashed, "depth long, f1 long, f2 long, ends_sha256 string")


def summed(nodes: DataFrame, paths: DataFrame, hashes: DataFrame) -> DataFrame:
    """Nodes with n_children, n_leaves, saved_tokens and ends_sha256: what reaches a node from its children, its members and
    its ends meets in one grouping, summed before it moves."""
    leaf, saved = F.when(F.col("n_ends") == F.col("n_convs"), 1).otherwise(0).cast("long"), (F.col("n_convs") - 1) * F.col("size")
    valued = nodes.withColumns({"leaf": leaf, "saved": saved})
    chain = valued.groupBy("owner").agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saving"))
    above = Window.partitionBy("owner").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    # A node with one member has one leaf below and saves nothing, so only shared nodes look at their owner's chain.
    shared = valued.where("n_convs > 1").select(
        *KEY, (-F.coalesce(F.sum("leaf").over(above), F.lit(0))).alias("leaves"), (-F.coalesce(F.sum("saved").over(above), F.lit(0))).alias("saving")
    )
    below = paths.select("conv_id", *KEY).join(chain.withColumnRenamed("owner", "conv_id"), "conv_id").select(*KEY, "leaves", "saving")
    children = nodes.where("depth > 1").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2"), F.lit(1).cast("long").alias("children"))
    parts = nodes.select(*KEY, "owner", "p1", "p2", "n_convs")
    for more in (shared, below, children, hashes.where("depth > 0")):
        parts = parts.unionByName(more, allowMissingColumns=True)
    one = F.max("n_convs") == 1
    return parts.groupBy(*KEY).agg(
        *(F.max(c).alias(c) for c in ("owner", "p1", "p2", "n_convs")),
        F.coalesce(F.sum("children"), F.lit(0)).alias("n_children"),
        F.when(one, 1).otherwise(F.sum("leaves")).cast("long").alias("n_leaves"),
        F.when(one, 0).otherwise(F.sum("saving")).cast("long").alias("saved_tokens"),
        F.max("ends_sha256").alias("ends_sha256"),
    )


def trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: a row per node.

    Rows without a conv_id belong to no conversation and are left out. Null roles and texts are empty. Rows of one turn
    are ordered by role and text; equal rows are as many turns. Other columns are not looked at. An empty table has no
    node, not even a root. Texts move twice, to be ordered and to be told apart; after that turns are a few numbers."""
    spark = prepare(conversations.sparkSession)
    seed = 0
    while True:
        tables = Tables(spark)
        turns = stored_turns(conversations, seed)
        if tells_apart(turns):
            found = scanned(turns, tables)
            convs, paths = rebuilt(found, tables)
            nodes = tables.put(groups(paths), "nodes")
            if not nodes.where("not verified").limit(1).collect():
                break
        seed += 1
    hashes = tables.put(ends(paths, convs), "ends")
    full = tables.put(summed(nodes, paths, hashes), "full")
    empty = F.lit(hashlib.sha256().hexdigest())
    zero = F.lit(0).cast("long")
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    below = nodes.agg(
        F.sum((F.col("depth") == 1).cast("long")).alias("n_children"),
        F.sum((F.col("n_ends") == F.col("n_convs")).cast("long")).alias("n_leaves"),
        F.sum((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
    )
    ended = hashes.where("depth = 0").agg(F.max("ends_sha256").alias("ends_sha256"))
    root = top.crossJoin(below).crossJoin(ended).where("n_convs > 0").select(
        "conv_id", zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", zero).alias("n_children"), F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce("saved_tokens", zero).alias("saved_tokens"), F.coalesce("ends_sha256", empty).alias("ends_sha256"),
    )
    first = top.select(F.col("conv_id").alias("parent_conv_id"))
    parents = nodes.select(F.col("depth") + 1, "f1", "f2", "owner").toDF("depth", "p1", "p2", "parent_conv_id")
    deep = full.where("depth > 1").join(parents, ["depth", "p1", "p2"])
    named = deep.unionByName(full.where("depth = 1").crossJoin(first))
    return root.unionByName(
        named.select(
            F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", empty).alias("ends_sha256"),
        )
    )
