"""The prefix trie against one built from whole rebuilt conversations."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from contact_mart.llm import prefix_trie as pt
from contact_mart.llm.common import Tables
from contact_mart.llm.queries import QUERIES

from .conftest import SF

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(own)] for c, own in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = turns.get(base, [])[:h] + own[h:]
    return out


def plain_trie(rows):
    sequences = rebuilt(rows)
    members = {}
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    children, leaves, saved = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, own in members.items():
        value = (len(own) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += value
    out = []
    for node, own in members.items():
        ended = ",".join(map(str, sorted(c for c in own if len(sequences[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ended.encode()).hexdigest()
        out.append((min(own), len(node), parent, len(own), children.get(node, 0), leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def hard_rows():
    rng = random.Random(4)
    said = [(r, t) for r in ("user", "assistant", None) for t in ("Yes.", "", None, "Été", "No " * 40)]
    rows = []
    for conv in range(500):
        for k in range(rng.randrange(1, 14)):
            rows.append((conv, rng.choice([None, k, k, k, 3]), *(said[rng.randrange(2)] if rng.random() < 0.8 else rng.choice(said))))
    # Hot: copies of one conversation, a common first turn, one conversation with a third of all rows, absent bases.
    for conv in range(1000, 1400):
        rows += [(conv, k, "user", f"Copy {k}") for k in range(3)] + ([(conv, 9, "user", f"Own {conv}")] if conv % 3 == 0 else [])
    rows += [(2000, k, "user", f"Long {k % 50}") for k in range(300)] + [(2003, k, "user", f"Long {k % 50}") for k in range(250)]
    rows += [(c, 0, "user", "Alone") for c in range(3000, 3300, 7)] + [(c, 0, "user", "Minus") for c in range(-12, 0)]
    rows += [(None, 1, "user", "Nobody"), (None, None, None, None), (700, 1, "user", "twice"), (700, 1, "user", "twice")]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("trie"))
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()] + hard_rows()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame.selectExpr("*", "1 depth", "2 x", "'?' place", "3 f1", "0 size").repartition(6).write.parquet(f"{path}/conversations.parquet")
    return path, rows


def test_query_equals_plain(spark, folder, rows):
    got, wanted = rows(QUERIES["op13_prefix_trie"](spark, folder[0]), *COLUMNS), plain_trie(folder[1])
    assert [(g, w) for g, w in zip(got, wanted) if g != w][:3] == [] and len(got) == len(wanted)


def test_given_tables(spark, rows):
    table = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect()]
    assert rows(QUERIES["op13_prefix_trie"](spark, "/root/testdata/sf0.01"), *COLUMNS) == plain_trie(table)


def test_a_long_conversation_is_scanned_in_parts(spark):
    """The parts' products give the places and the fingerprints of one scan; no part has most of the rows."""
    long = spark.range(3000).selectExpr("2000L conv_id", "id turn", "'user' role", "concat('Long ', id % 50) text")
    turns = pt.stored_turns(spark.read.parquet(f"{SF}/conversations.parquet").unionByName(long))
    tables = Tables(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = pt.scanned(turns, tables).where("conv_id = 2000").orderBy("place").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r["place"] for r in found] == list(range(1, 3001))
    x = np.array([r["x"] for r in found])
    for lane in (0, 1):
        f = np.uint64(0)
        with np.errstate(over="ignore"):
            for r, e in zip(found, pt.element(x, lane)):
                f = f * pt.BASES[lane] + e
                assert int(f) == r[f"f{lane + 1}"] % (1 << 64)
    parts = spark.read.parquet(tables._paths["scan"]).where("conv_id = 2000").groupBy("part").count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 2500


def test_products_compose():
    rng = np.random.default_rng(2)
    x = rng.integers(-(1 << 63), 1 << 63, 30)
    whole = pt.prefixes(x, np.array([0]), [np.uint64(0)] * 2)
    head = (12, *(int(lane[11]) for lane in whole))
    tail = pt.prefixes(x[12:], np.array([0]), [np.uint64(0)] * 2)
    assert pt.compose(head, (18, *(int(lane[-1]) for lane in tail))) == (30, *(int(lane[-1]) for lane in whole))
    carried = pt.prefixes(x[12:], np.array([0]), [lane[11] for lane in whole])
    assert all((c == w[12:]).all() for c, w in zip(carried, whole))


def test_equal_fingerprints_of_different_turns_lead_to_another_seed(spark, folder, rows, monkeypatch):
    """Hashes of one bit at first: contents and then prefixes collide, and the result stays right."""
    hashed, tried = pt.stored_turns, []

    def poor(conversations, seed=0):
        tried.append(seed)
        turns = hashed(conversations, seed)
        return turns.withColumn("x", F.col("x").bitwiseAND(F.lit(1))) if seed == 0 else turns

    monkeypatch.setattr(pt, "stored_turns", poor)
    few = spark.read.parquet(f"{SF}/conversations.parquet")
    assert rows(pt.trie(few), *COLUMNS) == plain_trie([tuple(r) for r in few.collect()])
    assert tried == [0, 1]


def test_groups_of_colliding_fingerprints_are_not_verified(spark):
    names = "conv_id long, depth long, x long, size long, last boolean, f1 long, f2 long, p1 long, p2 long"
    fine = [(1, 1, 5, 2, True, 8, 8, 0, 0), (2, 1, 5, 2, True, 8, 8, 0, 0)]
    assert pt.groups(spark.createDataFrame(fine, names)).where("not verified").count() == 0
    for other in ((2, 1, 6, 2, True, 8, 8, 0, 0), (2, 1, 5, 2, True, 8, 8, 1, 0), (2, 1, 5, 2, True, 8, 8, 0, 1)):
        assert pt.groups(spark.createDataFrame([fine[0], other], names)).where("not verified").count() == 1


def test_empty_table_and_rows_without_ids_have_no_node(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    assert pt.trie(table.where("false")).collect() == []
    assert pt.trie(table.withColumn("conv_id", F.lit(None).cast("long"))).collect() == []


def test_turnless_conversations_are_in_the_root(spark, rows):
    table = [(c, 0, "user", "a") for c in (1, 2, 3, 6)]
    frame = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    got = rows(pt.trie(frame), *COLUMNS)
    assert got == plain_trie(table) and got[0][3] == 4
