"""Reversible line dedup: exact reference tables behind sharded cuckoo filters.

Three tables hold the state. ``refs`` has a row for every long line of every document: the
128-bit hash of its key, the document, the place of the line. ``counts`` has for every key
how many documents hold it, and the smallest of them. ``filters`` has a cuckoo filter per
shard of keys, of the keys that two or more documents hold; it answers "surely not
repeated" from 16 bits a key. A lookup asks the filter of its shard first and joins only
what passes with the exact counts, so a false positive costs time, never a line.

Documents that come or go are counted by themselves, and their counts are added to or taken
from those of their keys; other lines are not looked at, but for those of keys that lose
their owner. The filters take the keys that become repeated and give up those that no
longer are, without a rebuild.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contact_mart.llm.common import SPACES, Tables, lower_ascii, mixed, prepare

SLOTS = 4
# Filters of up to so many bytes in all are sent to the tasks that read refs; larger ones go by shard.
FILTER_BYTES = 32 << 20
# Changes after which the parts of refs are written as one table again.
COMPACT = 8


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; 0 is an empty slot. Keys that find no slot are kept whole in ``spare``."""

    def __init__(self, capacity: int):
        buckets = 1 << max(1, int(np.ceil(np.log2(max(capacity, 1) / (SLOTS * 0.85) + 1))))
        self.slots = np.zeros((buckets, SLOTS), np.uint16)
        self.spare: list[int] = []

    @classmethod
    def load(cls, slots: bytes, spare: bytes) -> CuckooFilter:
        self = cls.__new__(cls)
        self.slots = np.frombuffer(slots, np.uint16).reshape(-1, SLOTS).copy()
        self.spare = np.frombuffer(spare, np.uint64).tolist()
        return self

    def dump(self) -> tuple[bytes, bytes]:
        return self.slots.tobytes(), np.array(self.spare, np.uint64).tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = mixed(keys.astype(np.uint64))
        prints = np.maximum(h >> np.uint64(48), np.uint64(1)).astype(np.uint16)
        mask = np.uint64(len(self.slots) - 1)
        first = h & mask
        return prints, first, first ^ (mixed(prints.astype(np.uint64)) & mask)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(keys)
        found = (self.slots[first] == prints[:, None]).any(1) | (self.slots[second] == prints[:, None]).any(1)
        return found | np.isin(keys.astype(np.uint64), np.array(self.spare, np.uint64)) if self.spare else found

    def add(self, keys: np.ndarray) -> None:
        for key, mark, *places in zip(keys.astype(np.uint64).tolist(), *map(np.ndarray.tolist, self._places(keys))):
            self._insert(key, mark, places)

    def _insert(self, key: int, mark: int, places: list[int]) -> None:
        for place in places:
            free = np.flatnonzero(self.slots[place] == 0)
            if len(free):
                self.slots[place, free[0]] = mark
                return
        path, place, moving = [], places[0], mark
        for step in range(200):
            slot = (step * 7 + moving) % SLOTS
            path.append((place, slot))
            moving, self.slots[place, slot] = int(self.slots[place, slot]), moving
            mask = len(self.slots) - 1
            place ^= int(mixed(np.array([moving], np.uint64))[0]) & mask
            free = np.flatnonzero(self.slots[place] == 0)
            if len(free):
                self.slots[place, free[0]] = moving
                return
        for place, slot in reversed(path):  # undo, so that no other key loses its mark
            moving, self.slots[place, slot] = int(self.slots[place, slot]), moving
        self.spare.append(key)

    def remove(self, keys: np.ndarray) -> None:
        """Take out keys that were added before."""
        for key, mark, *places in zip(keys.astype(np.uint64).tolist(), *map(np.ndarray.tolist, self._places(keys))):
            if key in self.spare:
                self.spare.remove(key)
                continue
            for place in places:
                held = np.flatnonzero(self.slots[place] == mark)
                if len(held):
                    self.slots[place, held[0]] = 0
                    break


def line_key(line: Column) -> Column:
    """The line without whitespace at its ends, A-Z lower-cased. One look at each character, however long a run is."""
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def line_refs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 10) -> DataFrame:
    """A row per line whose key has ``least`` code points or more: key (two longs), document, text hash, place."""
    lines = docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).alias("doc"),
        F.xxhash64(text).alias("text_hash"),
        F.posexplode(F.split(F.col(text), "\n", -1)).alias("place", "line"),
    )
    keys = lines.where(F.length("line") >= least).withColumn("key", line_key(F.col("line"))).where(F.length("key") >= least)
    return keys.select(
        F.xxhash64("key").alias("hi"), F.xxhash64(F.lit(7), "key").alias("lo"), "doc", "text_hash", "place"
    )


@dataclass
class LineIndex:
    """State of the dedup, in written tables. ``refs``: the lines of all documents. ``counts``: for each key how many
    documents hold it and the smallest of them: hi, lo, n_docs, owner. ``filters``: a cuckoo filter per shard of the keys
    that two documents or more hold."""

    tables: Tables
    refs: list[DataFrame]
    counts: DataFrame
    filters: DataFrame
    shards: int
    version: int = 0

    @classmethod
    def build(cls, docs: DataFrame, tables: Tables, keys_per_shard: int = 50_000, **columns) -> LineIndex:
        refs = tables.put(line_refs(docs, **columns), "refs-0")
        counts = tables.put(_counts(refs), "counts-0")
        shards = max(1, -(-counts.where("n_docs > 1").count() // keys_per_shard))
        filters = tables.put(_filters(counts.where("n_docs > 1"), shards, keys_per_shard * 2), "filters-0")
        return cls(tables, [refs], counts, filters, shards)

    @property
    def all_refs(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.refs)

    def insert(self, docs: DataFrame, **columns) -> LineIndex:
        """The index with the documents added: their lines are counted and the counts added to those of their keys.

        Ids that are in the index already are refused."""
        refs = self.tables.put(line_refs(docs, **columns), f"refs-{self.version + 1}")
        known = self.all_refs.select("doc").join(refs.select("doc").distinct(), "doc", "left_semi").limit(1).collect()
        if known:
            raise ValueError(f"document {known[0][0]} is in the index")
        return self._next([*self.refs, refs], _counts(refs), None)

    def delete(self, ids: DataFrame) -> LineIndex:
        """The index without the documents whose ids are in the column ``doc_id``: the counts of their keys go down, and
        keys that lose their owner look for the next one among their lines."""
        gone = self.tables.put(ids.select(F.col("doc_id").alias("doc")).distinct(), f"gone-{self.version + 1}")
        lost = self.tables.put(_counts(self.all_refs.join(gone, "doc", "left_semi")), f"lost-{self.version + 1}")
        left = [part.join(gone, "doc", "left_anti") for part in self.refs]
        return self._next(left, lost.withColumn("n_docs", -F.col("n_docs")), reduce(DataFrame.unionByName, left))

    def _next(self, refs: list[DataFrame], deltas: DataFrame, left: DataFrame | None) -> LineIndex:
        """The counts with the changes of some keys added, and the filters without the keys that cease to be repeated and
        with those that begin to be. Keys that no document holds any more go."""
        v = self.version + 1
        if v % COMPACT == 0:
            refs = [self.tables.put(reduce(DataFrame.unionByName, refs), f"refs-all-{v}")]
        deltas = self.tables.put(deltas, f"deltas-{v}")
        change = deltas.select("hi", "lo", F.col("n_docs").alias("by"), F.col("owner").alias("of"))
        touched = self.counts.join(change, ["hi", "lo"], "full_outer").select(
            "hi", "lo", F.coalesce("n_docs", F.lit(0)).alias("was"), (F.coalesce("n_docs", F.lit(0)) + F.coalesce("by", F.lit(0))).alias("n_docs"),
            F.when(F.coalesce("by", F.lit(0)) >= 0, F.least("owner", "of")).otherwise(F.when(F.col("of") > F.col("owner"), F.col("owner"))).alias("owner"),
        ).where("n_docs > 0")
        if left is not None:
            # Only keys whose owner went look at lines, and only at their own.
            orphans = self.tables.put(touched.where("owner is null").select("hi", "lo"), f"orphans-{v}")
            heirs = left.join(orphans, ["hi", "lo"], "left_semi").groupBy("hi", "lo").agg(F.min("doc").alias("heir"))
            touched = touched.join(heirs, ["hi", "lo"], "left").withColumn("owner", F.coalesce("owner", "heir")).drop("heir")
        state = self.tables.put(touched, f"state-{v}")
        counts = state.select("hi", "lo", "n_docs", "owner")
        begun = state.where("was < 2 and n_docs > 1").select("hi", F.lit(1).alias("sign"))
        # Keys without documents are not in the state any more: they are the changed ones that had two or more.
        ceased = self.counts.where("n_docs > 1").join(deltas, ["hi", "lo"], "left_semi").join(
            counts.where("n_docs > 1"), ["hi", "lo"], "left_anti"
        ).select("hi", F.lit(-1).alias("sign"))
        changes = ceased.unionByName(begun).withColumn("shard", F.pmod("hi", F.lit(self.shards)))

        def changed(_key, held: pd.DataFrame, moves: pd.DataFrame) -> pd.DataFrame:
            shard = int(held["shard"].iloc[0])
            cuckoo = CuckooFilter.load(held["slots"].iloc[0], held["spare"].iloc[0])
            cuckoo.remove(moves.loc[moves["sign"] < 0, "hi"].to_numpy())
            cuckoo.add(moves.loc[moves["sign"] > 0, "hi"].to_numpy())
            return pd.DataFrame([(shard, *cuckoo.dump())], columns=["shard", "slots", "spare"])

        filters = (
            self.filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(changed, self.filters.schema)
        )
        return LineIndex(self.tables, refs, counts, self.tables.put(filters, f"filters-{v}"), self.shards, v)

    def dropped(self) -> DataFrame:
        """doc, text_hash, places: the lines that go, from every document but the smallest that holds the key."""
        candidates = self._screened()
        repeated = self.counts.where("n_docs > 1").select("hi", "lo", "owner")
        found = candidates.join(repeated, ["hi", "lo"]).where("doc > owner")
        return found.groupBy("doc", "text_hash").agg(F.collect_set("place").alias("places"))

    def _screened(self) -> DataFrame:
        """Refs that pass the filter of their shard."""
        size = self.filters.agg(F.sum(F.octet_length("slots") + F.octet_length("spare"))).first()[0] or 0
        if size > FILTER_BYTES:
            return self._screened_by_shard()
        held = {r["shard"]: (r["slots"], r["spare"]) for r in self.filters.toLocalIterator()}  # under FILTER_BYTES
        sent, shards = self.filters.sparkSession.sparkContext.broadcast(held), self.shards

        def screen(batches):
            cuckoos = {shard: CuckooFilter.load(*parts) for shard, parts in sent.value.items()}
            for batch in batches:
                hi = batch["hi"].to_numpy()
                shard, keep = hi % shards, np.zeros(len(hi), bool)
                for s in np.unique(shard).tolist():
                    if s in cuckoos:
                        rows = np.flatnonzero(shard == s)
                        keep[rows] = cuckoos[s].contains(hi[rows])
                yield batch[keep]

        refs = self.all_refs
        return refs.mapInPandas(screen, refs.schema)

    def _screened_by_shard(self) -> DataFrame:
        """The same with each filter joined to the rows of its shard, a partial filter of the size of one shard a row."""
        refs = self.all_refs
        slot_of = refs.withColumn("shard", F.pmod("hi", F.lit(self.shards)))
        # No nulls in the long columns: pandas would make them floats, which cannot hold 64-bit hashes.
        with_head = self.filters.select(
            "shard", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt"), F.lit(0).alias("kind"), "slots", "spare",
            *[F.lit(0).cast(t).alias(c) for c, t in refs.dtypes],
        )
        rows = slot_of.select(
            "shard", F.pmod(F.xxhash64("doc"), F.lit(16)).cast("int").alias("salt"), F.lit(1).alias("kind"),
            F.lit(None).cast("binary").alias("slots"), F.lit(None).cast("binary").alias("spare"), *refs.columns,
        )
        parts = with_head.unionByName(rows).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")

        def screen(batches):
            cuckoo, at = None, None
            for batch in batches:
                for (shard, salt), part in batch.groupby(["shard", "salt"], sort=False):
                    if (shard, salt) != at:
                        cuckoo, at = None, (shard, salt)
                    heads = part[part["kind"] == 0]
                    if len(heads):
                        cuckoo = CuckooFilter.load(heads["slots"].iloc[0], heads["spare"].iloc[0])
                    rest = part[part["kind"] == 1]
                    if cuckoo is not None and len(rest):
                        kept = rest[cuckoo.contains(rest["hi"].to_numpy().astype(np.int64))]
                        yield kept[["hi", "lo", "doc", "text_hash", "place"]].astype("int64")

        return parts.mapInPandas(screen, "hi long, lo long, doc long, text_hash long, place long").withColumn(
            "place", F.col("place").cast("int")
        )


def _counts(refs: DataFrame) -> DataFrame:
    """hi, lo, n_docs, owner. A document counts once for a key; its lines are merged before the exchange, and so are the
    counts of a key, so that a key on every page moves one row a task."""
    held = refs.groupBy("hi", "lo", "doc").agg(F.lit(1).alias("one"))
    return held.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc").alias("owner"))


def _filters(repeated: DataFrame, shards: int, capacity: int) -> DataFrame:
    def build(part: pd.DataFrame) -> pd.DataFrame:
        cuckoo = CuckooFilter(max(capacity, len(part)))
        cuckoo.add(part["hi"].to_numpy())
        return pd.DataFrame([(int(part["shard"].iloc[0]), *cuckoo.dump())], columns=["shard", "slots", "spare"])

    # Every shard has a row, also one without keys, so that later keys find their filter.
    keys = repeated.select(F.pmod("hi", F.lit(shards)).alias("shard"), "hi")
    empty = CuckooFilter(capacity).dump()
    filled = keys.groupBy("shard").applyInPandas(build, "shard long, slots binary, spare binary")
    every = repeated.sparkSession.range(shards).withColumnRenamed("id", "shard").join(filled, "shard", "left")
    return every.select(
        "shard", F.coalesce("slots", F.lit(empty[0])).alias("slots"), F.coalesce("spare", F.lit(empty[1])).alias("spare")
    )


def dedup_lines(docs: DataFrame, tables: Tables | None = None, doc_id: str = "doc_id", text: str = "text", least: int = 10) -> DataFrame:
    """``docs`` with ``text`` replaced by the lines that stay, and n_lines, n_dropped.

    A null or empty text is one empty line and stays "". Rows of one doc_id are one document;
    rows without an id keep all their lines. Repeated rows lose the same lines. Columns named
    n_lines or n_dropped are replaced, others are kept.
    """
    prepare(docs.sparkSession)
    tables = tables or Tables(docs.sparkSession)
    index = LineIndex.build(docs, tables, doc_id=doc_id, text=text, least=least)
    gone = index.dropped().select(
        F.col("doc").alias("__doc"), F.col("text_hash").alias("__hash"), F.col("places").alias("__gone")
    )
    joined = docs.withColumn("__text", F.coalesce(F.col(text), F.lit(""))).join(
        gone, (F.col(doc_id) == F.col("__doc")) & (F.xxhash64(text) == F.col("__hash")), "left"
    )
    lines = joined.withColumn("__lines", F.split("__text", "\n", -1))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
    return lines.withColumns(
        {
            text: F.when(F.col("__gone").isNull(), F.col("__text")).otherwise(
                F.array_join(F.transform(kept, lambda i: F.col("__lines")[i]), "\n")
            ),
            "n_lines": F.size("__lines").cast("long"),
            "n_dropped": F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long"),
        }
    ).drop("__doc", "__hash", "__gone", "__text", "__lines")
