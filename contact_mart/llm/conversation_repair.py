"""Repair of conversations by Viterbi decoding with coalescing survivors.

A repaired conversation has role initials ``(s?(ua)+)?``. Its rows, in the order of their turns, are
kept (0), given the role user or assistant (1) or deleted (2); empty user or assistant turns are
inserted (5). Blank rows and repeats have to be deleted, truncated rows that stay cost 5 more. The
cheapest edits win, and of equally cheap ones the least string of edits D, I, K, R.

The automaton has four states, so after each row there are at most four survivors. They are leaves of
a tree of back pointers with reference counts: a node goes when no survivor descends from it, and as
soon as all survivors share an ancestor its edits are handed out. A survivor ends where another one
is cheaper whatever follows. Ties are settled on the complete
strings of edits that are not handed out yet: survivors have edited the same rows, so none is the
beginning of another, and their order, kept as a rank, decides for all that is appended later.

The rows of a conversation go through one task in order, as its hash has to; a task holds the tree of
what is unresolved, without texts, and one running hash for each survivor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contact_mart.llm.common import SPACES, prepare

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
UNFINISHED = 5
FAULTS = ("none", "blank", "duplicate", "truncated")
# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
# What a turn by the user or the assistant leads to, and who it is by; there is one of them in each state.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
# What a survivor in one state pays more, at most, to do what one in another state does from then on: it inserts a turn
# (5) or two at the end (10) and deletes a system turn that the other keeps (2).
EXTRA = {
    START: {SYSTEM: 0, USER: 5, ASSISTANT: 0},
    SYSTEM: {START: 10, USER: 5, ASSISTANT: 10},
    USER: {START: 7, SYSTEM: 5, ASSISTANT: 5},
    ASSISTANT: {START: 2, SYSTEM: 0, USER: 5},
}
LEGAL = {"su", "ua", "au"}
# Rows that a task hands out at once.
ROWS = 4096


def _kept(state: int, initial: str) -> int | None:
    if initial == "s":
        return SYSTEM if state == START else None
    if initial in ("u", "a") and NEXT[state] == (USER if initial == "u" else ASSISTANT):
        return NEXT[state]
    return None


def _steps(initial: str, fault: str) -> list[list[tuple[int, int, str]]]:
    """For each state after the row, the best way from each state before it: (state before, cost, edits)."""
    ways: dict[tuple[int, int], tuple[int, str]] = {}
    for before in range(4):
        state = before
        # A third insertion in a row leads to a state that one or two lead to.
        for n in range(3):
            tail, cost = INSERT * n, COST[INSERT] * n
            goals = [(DELETE, state)]
            if fault not in ("blank", "duplicate"):
                goals += [(KEEP, _kept(state, initial)), (REROLE, NEXT[state])]
            for edit, after in goals:
                if after is not None:
                    price = cost + COST[edit] + (UNFINISHED if fault == "truncated" and edit != DELETE else 0)
                    ways[before, after] = min(ways.get((before, after), (price, tail + edit)), (price, tail + edit))
            state = NEXT[state]
    return [[(b, *ways[b, after]) for b in range(4) if (b, after) in ways] for after in range(4)]


STEPS = {(i, f): _steps(i, f) for i in ("s", "u", "a", "") for f in FAULTS}


class Node:
    """One row's edits of a survivor: those of ``parent``, then insertions and the edit of row ``place``."""

    __slots__ = ("parent", "state", "edits", "place", "refs", "children")

    def __init__(self, parent: Node | None, state: int, edits: str, place: int):
        self.parent, self.state, self.edits, self.place = parent, state, edits, place
        self.refs = 0
        self.children: list[Node] = []
        if parent is not None:
            parent.refs += 1
            parent.children.append(self)


def _let_go(node: Node) -> None:
    """One reference less; a node without any leaves the tree, and so may its ancestors."""
    node.refs -= 1
    while node.refs == 0 and node.parent is not None:
        parent, node.parent = node.parent, None
        parent.children.remove(node)
        parent.refs -= 1
        node = parent


class Survivors:
    """Decoder of one conversation. ``out`` gets (edit, place of its row or None, role or None) once it is certain.

    ``digest``: also carry the SHA-256 of the repaired ``role:text`` lines for each survivor."""

    def __init__(self, out: Callable[[str, int | None, str | None], None], digest: bool = False):
        self.out = out
        self.root = Node(None, START, "", 0)
        self.root.refs = 1
        # By state: cost, rank among the survivors, node, running hash.
        self.alive: dict[int, tuple] = {START: (0, 0, self.root, hashlib.sha256() if digest else None)}

    def _added(self, state: int, edits: str, role: str | None, text: str | None, digest):
        """The hash after the edits; what is inserted or given a role follows from the state before."""
        if digest is None:
            return None
        if edits == DELETE:
            return digest
        digest = digest.copy()
        for edit in edits:
            if edit == DELETE:
                continue
            own = role if edit == KEEP else ROLE[NEXT[state]]
            line = f"{own}:{'' if edit == INSERT else text}"
            digest.update((line if state == START else "\n" + line).encode("utf-8", "surrogatepass"))
            state = (_kept(state, own[:1]) if edit == KEEP else NEXT[state])
        return digest

    def push(self, place: int, role: str, text: str | None, fault: str) -> None:
        initial = role[:1] if role[:1] in ("s", "u", "a") else ""
        before, new = self.alive, {}
        for after, ways in enumerate(STEPS[initial, fault]):
            found = [(before[b][0] + cost, before[b][1], edits, b) for b, cost, edits in ways if b in before]
            if found:
                new[after] = min(found)
        # A survivor that another one beats whatever follows ends here, so that the others can meet.
        lost = {s for s in new for t in new if s != t and new[t][0] + EXTRA[t][s] < new[s][0]}
        new = {s: found for s, found in new.items() if s not in lost}
        # Strings of edits compare as their survivors before do, and by what is added if they come from the same one.
        ranks = {after: k for k, after in enumerate(sorted(new, key=lambda s: new[s][1:3]))}
        self.alive = {}
        for after, (cost, _, edits, b) in new.items():
            node = Node(before[b][2], b, edits, place)
            node.refs += 1
            self.alive[after] = (cost, ranks[after], node, self._added(b, edits, role, text, before[b][3]))
        for held in before.values():
            _let_go(held[2])
        self._settle()

    def _settle(self) -> None:
        """Hand out what all survivors share."""
        while self.root.refs == 1 and self.root.children:
            node = self.root.children[0]
            self._hand_out(node.state, node.edits, node.place)
            node.parent = None
            self.root = node

    def _hand_out(self, state: int, edits: str, place: int | None) -> None:
        for edit in edits:
            if edit == DELETE or edit == KEEP:
                self.out(edit, place, None)
            else:
                self.out(edit, None if edit == INSERT else place, ROLE[NEXT[state]])
                state = NEXT[state]

    def unresolved(self) -> int:
        """Nodes in the tree."""
        n, left = 0, [self.root]
        while left:
            node = left.pop()
            n += 1
            left += node.children
        return n

    def finish(self) -> tuple[int, str | None]:
        """Hand out the rest; the cost and the hash of the cheapest edits."""
        found = []
        for state, (cost, rank, _, _) in self.alive.items():
            at = state
            for n in range(3):
                if at in ENDS:
                    found.append((cost + COST[INSERT] * n, rank, INSERT * n, state))
                at = NEXT[at]
        cost, _, edits, state = min(found)
        _, _, node, digest = self.alive[state]
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            self._hand_out(node.state, node.edits, node.place)
        self._hand_out(state, edits, None)
        digest = self._added(state, edits, None, None, digest)
        return cost, digest.hexdigest() if digest is not None else None


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


_NOBODY = object()


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    names = ["conv_id", "step", "edit", "place", "role"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]

    def batch() -> pa.RecordBatch:
        columns = [pa.array(c, k) for c, k in zip(zip(*held), kinds)]
        held.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    conv, decoder, place, step = _NOBODY, None, 0, 0

    def out(edit: str, at: int | None, role: str | None) -> None:
        nonlocal step
        step += 1
        held.append((conv, step, edit, at, role))

    for own, _, role, _, fault, present in _rows(batches):
        if decoder is None or own != conv:
            if decoder is not None:
                decoder.finish()
            conv, decoder, place, step = own, Survivors(out), 0, 0
        if present:
            place += 1
            decoder.push(place, role, None, FAULTS[fault])
        if len(held) >= ROWS:
            yield batch()
    if decoder is not None:
        decoder.finish()
    if held:
        yield batch()


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "gaps", *FAULTS[1:], "illegal", "cost", "audit", "repaired_sha256"]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    held: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        columns = [pa.array(c, k) for c, k in zip(zip(*held), kinds)]
        held.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    conv, decoder = _NOBODY, None
    audit: list[str] = []
    counts: dict[str, int] = {}
    first = last = previous = None
    turns = illegal = place = 0

    def closed() -> None:
        nonlocal size
        cost, digest = decoder.finish()
        gaps = last - first + 1 - turns if turns else 0
        held.append((conv, gaps, *(counts.get(f, 0) for f in FAULTS[1:]), illegal, cost, "".join(audit), digest))
        size += len(held[-1][7])

    for own, turn, role, text, fault, present in _rows(batches):
        if decoder is None or own != conv:
            if decoder is not None:
                closed()
                if len(held) >= ROWS or size > 1 << 22:
                    size = 0
                    yield batch()
            conv, audit, counts, first, last, previous, turns, illegal, place = own, [], {}, None, None, None, 0, 0, 0
            decoder = Survivors(lambda edit, at, by, audit=audit: audit.append(edit), digest=True)
        if present:
            place += 1
            name = FAULTS[fault]
            counts[name] = counts.get(name, 0) + 1
            if turn is not None and turn != last:
                first, last, turns = turn if first is None else first, turn, turns + 1
            if previous is not None and previous + role[:1] not in LEGAL:
                illegal += 1
            previous = role[:1]
            decoder.push(place, role, text, name)
    if decoder is not None:
        closed()
        yield batch()


def in_order(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None) -> DataFrame:
    """conv_id, turn, role, text, fault, present: each conversation's rows together and in order, in one exchange.

    Order: turn, nulls first, then role and text. ``present``: a flag of rows; where it is not true, a row only says
    that its conversation exists. Null roles and texts are one space, so blank. Repeats and the order come from the
    partitioning by conversation, without another exchange."""
    space = F.lit(" ")
    here = F.lit(True) if present is None else F.coalesce(F.col(present), F.lit(False))
    rows = conversations.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.when(here, F.coalesce(F.col(role), space)).alias("role"), F.when(here, F.coalesce(F.col(text), space)).alias("text"),
        here.alias("present"),
    ).repartition("conv_id")
    end = F.right(F.btrim("text", F.lit(SPACES)), F.lit(1))
    earlier = F.row_number().over(Window.partitionBy("conv_id", "present", "role", "text").orderBy(F.col("turn").asc_nulls_first()))
    fault = F.when(end == "", 1).when(earlier > 1, 2).when(~end.isin(".", "!", "?"), 3).otherwise(0)
    rows = rows.withColumn("fault", F.when(F.col("present"), fault))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    return rows.select("conv_id", "turn", "role", "text", "fault", "present").sortWithinPartitions(*order)


def edits(conversations: DataFrame, **columns: str) -> DataFrame:
    """conv_id, step, edit, place, role: the cheapest edits of each conversation, in the order of ``step``.

    ``place`` is the row edited, counted from 1 in the order of ``in_order``; null for an insertion. ``role`` is the one
    that R and I give. A conversation without rows has no edits."""
    prepare(conversations.sparkSession)
    rows = in_order(conversations, **columns).withColumn("text", F.lit(None).cast("string"))
    return rows.mapInArrow(_edits, "conv_id long, step long, edit string, place long, role string")


def repaired(conversations: DataFrame, **columns: str) -> DataFrame:
    """conv_id, step, turn, role, text: the rows that stay, with their new roles, and the inserted ones with an empty
    text and no turn."""
    prepare(conversations.sparkSession)
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = in_order(conversations, **columns).where("present")
    rows = rows.select(F.col("conv_id").alias("__conv"), "turn", F.col("role").alias("__role"), "text", F.row_number().over(order).alias("__place"))
    same = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("place") == F.col("__place"))
    found = edits(conversations, **columns).where(F.col("edit") != DELETE).join(rows, same, "left")
    return found.select(
        "conv_id", "step", "turn", F.coalesce("role", "__role").alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )


def repair(conversations: DataFrame, **columns: str) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: a row per conversation.

    Rows without an id are one conversation. A row's first fault counts: blank, then a repeat of role and text, then an
    end other than ``.!?``. Rows of one turn are ordered by role and text; equal rows are repeats. A conversation whose
    rows are all absent has zeros, an empty audit and the hash of the empty string. Other columns are not looked at."""
    prepare(conversations.sparkSession)
    return in_order(conversations, **columns).mapInArrow(
        _summaries,
        "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string",
    )


def damage(conversations: DataFrame) -> DataFrame:
    """Faults put into conv_id, turn, role, text by crc32(conv_id:turn) modulo 20, nulls as one space: 0 takes the row
    away (present is false), 1 empties the text, 2 takes its ``.!?`` away, 3 repeats the row, 4 makes it the user's."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fate = F.pmod(F.crc32(F.concat(named[0], F.lit(":"), named[1])), F.lit(20))
    rows = conversations.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("fate") != 0).alias("present"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
