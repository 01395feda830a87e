"""Token counts by byte-pair merging with a heap and a linked list.

A text is cut at the added special tokens, each of which is one token, and the rest into
pieces by the vocabulary's pattern. A piece starts as its bytes in a linked list; a heap
holds the adjacent pairs that the vocabulary can merge. The pair of lowest rank, leftmost
first, is popped and merged until no pair is left: the count is bytes minus merges, and no
token identifiers are produced. Entries that an earlier merge has outdated are recognised
when they are popped.

A single blank between two other characters always begins a piece, so a text is cut there first,
and the count of a stretch does not depend on what stands around it. Counts of short stretches and
pieces are kept in bounded caches of each worker.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contact_mart.llm.common import prepare

# Entries of a worker's cache; past it the cache starts anew.
CACHE_ENTRIES = 600_000
# A blank between characters that are no whitespace.
BLANK = re.compile(r"(?<=\S) (?=\S)")
UNEVEN = re.compile(r"\s\s|^\s|\s$")

# Fixed value: the pattern that byte-level vocabularies cut texts with.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    shifted = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


class Stretches(dict):
    """Tokens of a blank and the stretch of text after it; the key is without the blank."""

    def __init__(self, pieces: PieceCounts):
        super().__init__()
        self.pieces = pieces

    def __missing__(self, stretch: str) -> int:
        count = sum(map(self.pieces.__getitem__, self.pieces.find(" " + stretch)))
        if len(stretch) <= 48:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[stretch] = count
        return count


class PieceCounts(dict):
    """Tokens of a piece of text."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        ids = model["model"]["vocab"]
        self.first = [ids[letter] for letter in _byte_letters()]
        # For each left symbol: right symbol -> rank. For each rank: the merged symbol.
        self.ranks: list[dict[int, int]] = [{} for _ in range(max(ids.values()) + 1)]
        self.merged_by: list[int] = []
        for rank, pair in enumerate(model["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[ids[left]][ids[right]] = rank
            self.merged_by.append(ids[left + right])
        special = sorted((t["content"] for t in model["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.find = regex.compile(PIECES).findall
        self.stretches = Stretches(self)

    def __missing__(self, piece: str) -> int:
        count = self.merged(piece.encode("utf-8", "surrogatepass"))
        if len(piece) <= 48:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[piece] = count
        return count

    def merged(self, piece: bytes) -> int:
        """Symbols left when no adjacent pair can be merged any more."""
        ranks, merged_by, first = self.ranks, self.merged_by, self.first
        symbols = [first[b] for b in piece]
        n = count = len(symbols)
        # Entries: rank * n + place of the left symbol. A rank belongs to one pair only.
        heap = []
        for i in range(n - 1):
            rank = ranks[symbols[i]].get(symbols[i + 1])
            if rank is not None:
                heap.append(rank * n + i)
        if not heap:
            return count
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            rank, left = divmod(pop(heap), n)
            right = after[left]
            if symbols[left] < 0 or right == n or ranks[symbols[left]].get(symbols[right]) != rank:
                continue
            symbol = symbols[left] = merged_by[rank]
            symbols[right] = -1
            count -= 1
            follower = after[left] = after[right]
            if follower < n:
                before[follower] = left
                rank = ranks[symbol].get(symbols[follower])
                if rank is not None:
                    push(heap, rank * n + left)
            earlier = before[left]
            if earlier >= 0:
                rank = ranks[symbols[earlier]].get(symbol)
                if rank is not None:
                    push(heap, rank * n + earlier)
        return count

    def plain(self, text: str) -> int:
        """Tokens of a text without special tokens."""
        if not text:
            return 0
        parts = BLANK.split(text) if UNEVEN.search(text) else text.split(" ")
        head = sum(map(self.__getitem__, self.find(parts[0])))
        return head + sum(map(self.stretches.__getitem__, parts[1:]))

    def tokens(self, text: str | None) -> int:
        if not text:
            return 0
        total, start = 0, 0
        for found in self.special.finditer(text) if self.special else ():
            total += 1 + self.plain(text[start : found.start()])
            start = found.end()
        return total + self.plain(text[start:] if start else text)


@lru_cache(maxsize=2)
def piece_counts(path: str) -> PieceCounts:
    return PieceCounts(path)


def token_counts(docs: DataFrame, vocabulary: str, text: str = "text", limit: int = 512) -> DataFrame:
    """All columns of ``docs`` and n_bytes, n_tokens, over_limit.

    ``vocabulary``: path of a byte-level vocabulary file, the same on every machine. A null
    or empty text has 0 bytes and tokens. Rows are independent: repeated ones are counted
    each. A column of ``docs`` with the name of a result column is replaced.
    """
    prepare(docs.sparkSession)

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(piece_counts(vocabulary).tokens, na_action=None).astype("int64")

    tokens = count(F.col(text))
    size = F.coalesce(F.octet_length(F.col(text)).cast("long"), F.lit(0).cast("long"))
    return docs.withColumns({"n_bytes": size, "n_tokens": tokens}).withColumn("over_limit", F.col("n_tokens") > limit)
