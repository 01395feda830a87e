"""Pruning of sources that have no window column by the keys of the window.

An incremental run needs few rows of sources such as sessions, surveys or quality marks, but knows them only
by their keys. The keys of the window go into a blocked Bloom filter, which is tested while the source is
scanned: rows that cannot be needed leave before the first exchange, so what is shuffled follows the window
and not the history. A row that passes by chance is harmless, as the join behind it is exact.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contact_mart.session import Workspace
from contact_mart.sources.catalog import Sources

# A block has 512 words of 64 bits. Of 16 bits a key, three probes in one block let about one stranger in a hundred pass.
WORDS, WORD_BITS, BITS_PER_KEY, PROBES = 512, 64, 16, 3
BLOCK_BITS = WORDS * WORD_BITS
# Most blocks that are sent to the tasks: 64 MB. More keys are joined by exchange.
MOST_BLOCKS = 1 << 14


def _probes(key: Column) -> list[Column]:
    """Bits of a key within its block, from 15 bits each of a second hash."""
    other = F.xxhash64(key, F.lit(1))
    return [F.shiftrightunsigned(other, 15 * k).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for k in range(PROBES)]


class KeySet:
    """The distinct non-null keys of a frame with one column, written down once."""

    def __init__(self, keys: DataFrame, ws: Workspace, name: str = "keys"):
        value = F.col(keys.columns[0]).cast("string").alias("key")
        self.keys = ws.stage(keys.select(value).where(F.col("key").isNotNull()).distinct(), name)
        self.blocks = max(1, -(-self.keys.count() * BITS_PER_KEY // BLOCK_BITS))
        self.bits = ws.stage(self._bits(), f"{name}-bits") if self.blocks <= MOST_BLOCKS else None

    def _block(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.blocks))

    def _bits(self) -> DataFrame:
        """block, words: the bits of the filter. Bits are merged before they move; a block has all its words."""
        key = F.col("key")
        set_ = self.keys.select(self._block(key).alias("block"), F.explode(F.array(*_probes(key))).alias("bit"))
        words = set_.select(
            "block", F.floor(F.col("bit") / WORD_BITS).cast("int").alias("word"), F.expr(f"shiftleft(1L, bit % {WORD_BITS})").alias("bits")
        )
        spark = self.keys.sparkSession
        none = spark.range(self.blocks * WORDS).select(
            F.floor(F.col("id") / WORDS).alias("block"), (F.col("id") % WORDS).cast("int").alias("word"), F.lit(0).cast("long").alias("bits")
        )
        merged = words.unionByName(none).groupBy("block", "word").agg(F.bit_or("bits").alias("bits"))
        return merged.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"].alias("words"))

    def prune(self, df: DataFrame, column: str) -> DataFrame:
        """The rows of ``df`` whose ``column`` may be a key; all that are, and a few others.

        The filter's size is bounded, so it is sent to the tasks that scan. Beyond the bound the keys themselves are
        joined, by exchange unless they are small."""
        key = F.col(column).cast("string")
        if self.bits is None:
            return df.join(self.keys.withColumnRenamed("key", "_key"), key == F.col("_key"), "left_semi")
        tests = [F.getbit(F.get("_words", F.floor(bit / WORD_BITS).cast("int")), bit % WORD_BITS) == 1 for bit in _probes(key)]
        bits = F.broadcast(self.bits.select(F.col("block").alias("_block"), F.col("words").alias("_words")))
        present = df.where(F.col(column).isNotNull())
        return present.join(bits, self._block(key) == F.col("_block")).where(reduce(and_, tests)).select(*df.columns)


def pruned_sources(src: Sources, keys: KeySet, columns: Mapping[str, str]) -> Sources:
    """``src`` with the named sources pruned, each by the given column."""

    def load(name: str) -> DataFrame:
        return keys.prune(src[name], columns[name]) if name in columns else src[name]

    return Sources(load)
