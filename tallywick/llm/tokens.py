"""Byte-level BPE encoding of a whole corpus, with a rank queue made of hierarchical bitmaps."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
import regex as re
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the public pre-token pattern of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pre-tokens remembered by a Python worker, and the longest that is.
CACHE, CACHE_LENGTH = 200_000, 40


class BitmapQueue:
    """The set of ranks in use, as three levels of 64-bit words: a bit of a level says that a word of the level below isn't zero."""

    def __init__(self, size: int):
        self.levels = []
        while True:
            size = (size + 63) // 64
            self.levels.append([0] * size)
            if size == 1:
                break

    def add(self, rank: int) -> None:
        for words in self.levels:
            at = rank >> 6
            old = words[at]
            words[at] = old | (1 << (rank & 63))
            if old:
                return
            rank = at

    def discard(self, rank: int) -> None:
        for words in self.levels:
            at = rank >> 6
            words[at] &= ~(1 << (rank & 63))
            if words[at]:
                return
            rank = at

    def first(self) -> int:
        """The smallest rank, or -1: the lowest set bit from the top level down."""
        at = 0
        for words in reversed(self.levels):
            word = words[at]
            if not word:
                return -1
            at = (at << 6) | ((word & -word).bit_length() - 1)
        return at


class BytePairEncoder:
    """ranks: token bytes to id, where a smaller id merges first (the .tiktoken form)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.byte = [ranks[bytes([b])] for b in range(256)]
        self.size = max(ranks.values()) + 1
        self.pairs: dict[tuple[int, int], int] = {}
        self.queue = BitmapQueue(self.size)
        self.ranks = ranks
        self.words = [b""] * self.size
        for token, rank in ranks.items():
            self.words[rank] = token
        self.split = re.compile(PATTERN)
        self.cache: dict[str, list[int]] = {}

    @classmethod
    def load(cls, path: str) -> "BytePairEncoder":
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})

    def _rank(self, left: int, right: int) -> int:
        """The id that two neighbours merge into, or -1."""
        pair = (left, right)
        found = self.pairs.get(pair)
        if found is None:
            found = self.ranks.get(self.words[left] + self.words[right], -1)
            if len(self.pairs) < 1_000_000:
                self.pairs[pair] = found
        return found

    def merge(self, data: bytes) -> list[int]:
        """The ids of one pre-token. Each bucket holds the positions of pairs of its rank; within a rank the leftmost pair merges first."""
        n = len(data)
        ids = [self.byte[b] for b in data]
        if n == 1:
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        buckets: dict[int, list[int]] = {}
        queue, rank_of = self.queue, self._rank

        def note(at: int) -> int:
            rank = rank_of(ids[at], ids[after[at]])
            if rank < 0:
                return self.size
            if rank in buckets:
                buckets[rank].append(at)
            else:
                buckets[rank] = [at]
                queue.add(rank)
            return rank

        for i in range(n - 1):
            note(i)
        while (rank := queue.first()) >= 0:
            places = buckets.pop(rank)
            queue.discard(rank)
            places.sort()
            for i, at in enumerate(places):
                right = after[at]
                # Stale: the position is merged away, or one of the two is another token by now.
                if ids[at] < 0 or right >= n or rank_of(ids[at], ids[right]) != rank:
                    continue
                ids[at], ids[right] = rank, -1
                after[at] = after[right]
                least = self.size
                if after[at] < n:
                    before[after[at]] = at
                    least = note(at)
                if before[at] >= 0:
                    least = min(least, note(before[at]))
                if least <= rank:  # rare: a token that also arises in another way goes first, then the rest of this bucket
                    if i + 1 < len(places):
                        if rank in buckets:
                            buckets[rank] += places[i + 1 :]
                        else:
                            buckets[rank] = places[i + 1 :]
                            queue.add(rank)
                    break
        return [x for x in ids if x >= 0]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        cache, merge = self.cache, self.merge
        for piece in self.split.findall(text):
            found = cache.get(piece)
            if found is None:
                found = merge(piece.encode("utf-8", "replace"))
                if len(piece) <= CACHE_LENGTH:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[piece] = found
            out += found
        return out


_encoders: dict[str, BytePairEncoder] = {}


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as cores: texts cost far more CPU than bytes, so that a few large files would leave most cores idle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores * 3)


def encode_corpus(docs: DataFrame, id_column: str, text_column: str, vocabulary: str) -> DataFrame:
    """One row per row of docs: the id column and `ids`, array<int>, of the text by the .tiktoken vocabulary at the path `vocabulary`.

    Null and empty texts give an empty list; strings that look like special tokens are ordinary text. Texts are taken
    whole, however long; the rank queue keeps a pre-token of n bytes at about n steps. The path must exist on all executors.
    """
    rows = docs.select(F.col(id_column).alias("doc"), F.col(text_column).alias("text"))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if vocabulary not in _encoders:
            _encoders[vocabulary] = BytePairEncoder.load(vocabulary)
        one = _encoders[vocabulary].encode
        for pdf in batches:
            yield pd.DataFrame({"doc": pdf["doc"], "ids": [one(t) if t else [] for t in pdf["text"]]})

    kind = rows.schema["doc"].dataType.simpleString()
    return spread(rows).mapInPandas(encode, f"doc {kind}, ids array<int>").withColumnRenamed("doc", id_column)
