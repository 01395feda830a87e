"""Conversation repair against Viterbi on whole strings, and that against trying all edits."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from contact_mart.llm import conversation_repair as cr
from contact_mart.llm.queries import QUERIES

from .conftest import SF

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SPACE = " \t\n\x0b\x0c\r"


def faults_of(rows):
    out, seen = [], set()
    for role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "none" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def legal(initials):
    return re.fullmatch(r"(s?(ua)+)?", initials) is not None


def price(edit, fault):
    return {"K": 0, "R": 1, "D": 2, "I": 5}[edit] + (5 if fault == "truncated" and edit in "KR" else 0)


def every_way(rows):
    """Cheapest, then least, of all edits with up to two insertions at each place; rows that must go are deleted."""
    faults = faults_of(rows)
    best = None
    options = [("D",) if f in ("blank", "duplicate") else ("K", "Ru", "Ra", "D") for f in faults]
    inserts = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    for chosen in itertools.product(*options):
        for put in itertools.product(inserts, repeat=len(rows) + 1):
            lines, audit, cost = [], "", 0
            for k in range(len(rows) + 1):
                for by in put[k]:
                    lines.append(("user" if by == "u" else "assistant", ""))
                    audit, cost = audit + "I", cost + 5
                if k < len(rows):
                    edit = chosen[k][0]
                    audit, cost = audit + edit, cost + price(edit, faults[k])
                    if edit == "K":
                        lines.append(rows[k])
                    elif edit == "R":
                        lines.append(("user" if chosen[k] == "Ru" else "assistant", rows[k][1]))
            initials = "".join(r[:1] for r, _ in lines)
            if all(r for r, _ in lines) and legal(initials) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
    return best


def whole_strings(rows):
    """The same by dynamic programming over (initial of the last line), each survivor with its whole string and lines."""
    follow = {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}

    def inserted(states):
        for _ in range(3):
            for last, (cost, audit, lines) in list(states.items()):
                for by in follow[last]:
                    if by != "s":
                        new = (cost + 5, audit + "I", (*lines, ("user" if by == "u" else "assistant", "")))
                        if by not in states or new[:2] < states[by][:2]:
                            states[by] = new
        return states

    states = inserted({"": (0, "", ())})
    for (role, text), fault in zip(rows, faults_of(rows)):
        new = {}
        for last, (cost, audit, lines) in states.items():
            ways = [("D", last, lines)]
            if fault not in ("blank", "duplicate"):
                if role[:1] in follow[last]:
                    ways.append(("K", role[:1], (*lines, (role, text))))
                ways += [("R", by, (*lines, ("user" if by == "u" else "assistant", text))) for by in follow[last] if by != "s"]
            for edit, state, more in ways:
                own = (cost + price(edit, fault), audit + edit, more)
                if state not in new or own[:2] < new[state][:2]:
                    new[state] = own
        states = inserted(new)
    return min((states[s] for s in ("", "a") if s in states), key=lambda x: x[:2])


def summary(conv, rows):
    """rows: turn, role, text."""
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    rows = sorted(rows, key=key)
    lines = [r[1:] for r in rows]
    found = faults_of(lines)
    turns = {r[0] for r in rows if r[0] is not None}
    initials = [r[:1] for r, _ in lines]
    cost, audit, left = whole_strings(lines)
    return (
        conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(found.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest(),
    )


def damaged(rows):
    """rows: conv, turn, role, text; by conversation what is left."""
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 1:
            text = ""
        elif fate == 2:
            text = re.sub(r"[.!?]", "", text)
        elif fate == 4:
            role = "user"
        if fate:
            own += [(turn, role, text)] * (2 if fate == 3 else 1)
    return out


def decoded(rows):
    edits = []
    decoder = cr.Survivors(lambda edit, place, role: edits.append((edit, place, role)), digest=True)
    most = 0
    for place, ((role, text), fault) in enumerate(zip(rows, faults_of(rows)), 1):
        decoder.push(place, role, text, fault)
        if place % 50 == 0:
            most = max(most, decoder.unresolved())
    cost, digest = decoder.finish()
    return cost, edits, digest, most


TEXTS = ("Yes.", "No", "", "Why?", "\t\n", "Go on!", "and")
ROLES = ("user", "assistant", "system", "tool", " ", "", "user", "assistant")


def test_whole_strings_equal_every_way():
    rng = random.Random(3)
    for n in range(60):
        rows = [(rng.choice(ROLES), rng.choice(TEXTS)) for _ in range(n % 3 + (n % 20 == 0))]
        got, wanted = whole_strings(rows), every_way(rows)
        assert (got[0], got[1], list(got[2])) == (wanted[0], wanted[1], list(wanted[2])), rows


def test_survivors_equal_whole_strings():
    rng = random.Random(5)
    for n in range(1500):
        few = rng.sample(ROLES, rng.randrange(1, 5))
        rows = [(rng.choice(few), rng.choice(TEXTS[:4] if n % 3 else ("a.", "b.", "c", "d?")) + ("" if n % 2 else str(rng.randrange(9)) + ".")) for _ in range(rng.randrange(14))]
        cost, edits, digest, _ = decoded(rows)
        wanted = whole_strings(rows)
        assert (cost, "".join(e for e, _, _ in edits)) == wanted[:2], rows
        lines = []
        for edit, place, role in edits:
            if edit != "D":
                lines.append((role or rows[place - 1][0], "" if edit == "I" else rows[place - 1][1]))
        assert tuple(lines) == wanted[2]
        assert digest == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()


def test_memory_stays_bounded_where_survivors_meet():
    rng = random.Random(9)
    rows = []
    for k in range(20_000):
        role = ("user", "assistant")[k % 2] if rng.random() > 0.1 else rng.choice(ROLES)
        rows.append((role, f"Turn {k}" + ("." if rng.random() > 0.05 else "")))
    assert decoded(rows)[3] < 200


def test_one_role_only_stays_unresolved_and_right():
    """Whether the first row stays is known at the end alone."""
    for n in (500, 501):
        rows = [("user", f"Turn {k}.") for k in range(n)]
        cost, edits, _, most = decoded(rows)
        assert (cost, "".join(e for e, _, _ in edits)) == whole_strings(rows)[:2]
        assert most <= 4 * n + 1


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest table, and hard conversations with extra columns."""
    rng = random.Random(11)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    for conv in range(1000, 1400):
        for _ in range(rng.randrange(1, 12)):
            rows.append((conv, rng.choice([None, 0, 1, 2, 3, 5, 8, 9]), rng.choice([*ROLES, None]), rng.choice([*TEXTS, None, "été.", "x" * 500])))
    rows += [(None, k, "user", f"Of nobody {k}.") for k in range(5)] + [(None, None, None, None)]
    rows += [(2000, k, ("user", "assistant")[k % 2], f"Long {k}.") for k in range(3000)] + [(-7, 1, "user", "Hi."), (-7, 1, "user", "Hi.")]
    rows += [(conv, 0, "user", "Alone.") for conv in range(3000, 3200)]
    path = str(tmp_path_factory.mktemp("conversations"))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame.selectExpr("*", "1 cost", "'?' audit", "true present", "2 fate").repartition(5).write.parquet(f"{path}/conversations.parquet")
    return path, rows


def test_query_equals_plain(spark, folder, rows):
    path, table = folder
    wanted = sorted((summary(conv, own) for conv, own in damaged(table).items()), key=repr)
    got = rows(QUERIES["op12_conversation_repair"](spark, path), *COLUMNS)
    assert [(g, w) for g, w in zip(got, wanted) if g != w][:3] == [] and len(got) == len(wanted)
    assert sum(g[7] == "" for g in got) > 3


def test_edits_and_repaired_rows(spark, folder, rows):
    path, table = folder
    frame = cr.damage(spark.read.parquet(f"{path}/conversations.parquet"))
    wanted = {}
    for conv, own in damaged(table).items():
        own = sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        wanted[conv] = whole_strings([r[1:] for r in own])
    audits, lines = {}, {}
    for conv, _, edit in sorted(rows(cr.edits(frame, present="present"), "conv_id", "step", "edit"), key=lambda r: (r[0] or 0, r[1])):
        audits[conv] = audits.get(conv, "") + edit
    for conv, _, role, text in sorted(rows(cr.repaired(frame, present="present"), "conv_id", "step", "role", "text"), key=lambda r: (r[0] or 0, r[1])):
        lines.setdefault(conv, []).append((role, text))
    assert audits == {c: w[1] for c, w in wanted.items() if w[1]}
    assert lines == {c: list(w[2]) for c, w in wanted.items() if w[2]}


def test_one_exchange_and_no_rows(spark, folder):
    plan = cr.repair(cr.damage(spark.read.parquet(f"{folder[0]}/conversations.parquet")), present="present")._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange") == 1
    empty = spark.read.parquet(f"{SF}/conversations.parquet").where("false")
    assert cr.repair(empty).collect() == [] and cr.edits(empty).collect() == []
