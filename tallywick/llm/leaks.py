"""Held-out items in a corpus: a prefix-filtered set join on shingles, verified exactly.

Words are compared as a reader sees them. As a word may be broken, spaced or marked up inside, texts become streams of
letters and digits, and shingles are stretches of a fixed number of them that begin where a word of the item does. A
window of an item (12 words) is the set of the shingles inside it; a document with the window has all of them, so the
necessary prefix is one shingle: the rarest in the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialise
from .text import stream, streams
from .tokens import spread

#: Letters and digits of a shingle; some four to five words. Windows of fewer letters have one shingle, all of it.
SHINGLE = 20
#: The filter of the items' shingles that the corpus is read with: bits per shingle, places per shingle, and bits at most (64 MB). With more than 16 million shingles more of the corpus passes it, which the exact joins after it remove.
FILTER_BITS, PLACES, MOST_BITS = 32, 8, 1 << 29
#: Letters that are hashed at once.
CHUNK = 2_000_000

_POWER, _OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of each stretch of q characters (as numbers), as signed numbers: stretches of 1, 2, 4, ... are put together, so that the steps follow log q."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    mix = lambda a, b: (x := (a * _POWER ^ b) * _OTHER) ^ (x >> np.uint64(29))
    with np.errstate(over="ignore"):
        part, size, out, done = (codes.astype(np.uint64) + np.uint64(1)) * _OTHER, 1, None, 0
        while True:
            if q & size:
                out = part[:n].copy() if out is None else mix(out, part[done : done + n])
                done += size
            if done == q:
                return out.view(np.int64)
            part, size = mix(part[:-size], part[size:]), size * 2


def letters(flow: str) -> np.ndarray:
    return np.frombuffer(flow.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def item_windows(items: DataFrame, words: int, q: int = SHINGLE) -> DataFrame:
    """items(item, text) to (item, window, text, q, shingles): each window of `words` words as a stream, with its shingles (hash, offset). Cut in tasks, so that any number of items, and items of any length, are taken."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for item, text in zip(pdf["item"], pdf["text"]):
                flow, marks = stream(text)
                starts = np.append(np.flatnonzero(np.frombuffer(marks.encode(), dtype=np.uint8) == ord("1")), len(flow))
                hashes = {}
                for first in range(0, len(starts) - words, 5000):
                    out = []
                    for k in range(first, min(first + 5000, len(starts) - words)):
                        a, b = int(starts[k]), int(starts[k + words])
                        size = min(q, b - a)
                        if size not in hashes:
                            hashes[size] = shingle_hashes(letters(flow), size)
                        own = [int(s) for s in starts[k : k + words] if s + size <= b]
                        out.append((item, k, flow[a:b], size, [{"hash": int(hashes[size][s]), "offset": s - a} for s in own]))
                    yield pd.DataFrame(out, columns=["item", "window", "text", "q", "shingles"])

    kind = items.schema["item"].dataType.simpleString()
    return spread(items).mapInPandas(cut, f"item {kind}, window int, text string, q int, shingles array<struct<hash:bigint,offset:int>>")


def shingle_filter(hashes: DataFrame) -> np.ndarray:
    """A Bloom filter of the column hash as 64-bit words, at most MOST_BITS, whatever the number of hashes."""
    n = hashes.count()
    size = 1 << min(max(10, (max(n, 1) * FILTER_BITS - 1).bit_length()), MOST_BITS.bit_length() - 1)
    a, b = f"(hash & {size - 1}L)", f"((shiftrightunsigned(hash, 32) | 1L) & {size - 1}L)"
    places = F.explode(F.array(*[F.expr(f"({a} + {k}L * {b}) & {size - 1}L") for k in range(PLACES)]))
    bits = hashes.select(places.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("bits")).toArrow()
    out = np.zeros(size // 64, dtype=np.uint64)
    out[bits["w"].to_numpy()] = bits["bits"].to_numpy().view(np.uint64)
    return out


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The positions whose hash the filter has; nearly all others drop out at the first or second place."""
    at, last = np.arange(len(hashes)), np.int64(len(bits) * 64 - 1)
    a, b = hashes & last, ((hashes.view(np.uint64) >> np.uint64(32)).view(np.int64) | 1) & last
    for k in range(PLACES):
        p = (a + k * b) & last
        hit = (bits[p >> 6] >> (p & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
        at, a, b = at[hit], a[hit], b[hit]
    return at


def find_hits(docs: DataFrame, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """Documents with shingles that pass the filter: doc, flow, marks, hits (hash, at). One pass over all texts, in full, whatever the number of items; a text that can be read in two ways gives a row for each."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value

        def hits(part: list[tuple]) -> pd.DataFrame:
            """All texts of the part as one row of letters; shingles over two texts are left out."""
            ends = np.cumsum([len(flow) for _, flow, _ in part])
            codes = letters("".join(flow for _, flow, _ in part))
            found: dict[int, list[dict]] = {}
            for q in sizes:
                hashes = shingle_hashes(codes, q)
                at = passes(known, hashes)
                own = np.searchsorted(ends, at, side="right")
                inside = at + q <= ends[own] if len(at) else np.zeros(0, dtype=bool)
                for i, d in zip(at[inside].tolist(), own[inside].tolist()):
                    found.setdefault(d, []).append({"hash": int(hashes[i]), "at": i - int(ends[d] - len(part[d][1]))})
            return pd.DataFrame([(*part[d], h) for d, h in sorted(found.items())], columns=["doc", "flow", "marks", "hits"])

        part: list[tuple] = []
        size = 0
        for pdf in batches:
            for doc, text in zip(pdf["doc"], pdf["text"]):
                for flow, marks in streams(text) if text else []:
                    part.append((doc, flow, marks))
                    size += len(flow)
                if size >= CHUNK:
                    yield hits(part)
                    part, size = [], 0
        if part:
            yield hits(part)

    kind = docs.schema["doc"].dataType.simpleString()
    return spread(docs).mapInPandas(scan, f"doc {kind}, flow string, marks string, hits array<struct<hash:bigint,at:int>>")


def leaked_items(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, words: int = 12, q: int = SHINGLE) -> DataFrame:
    """Distinct (doc_id, item_id): the document holds at least `words` consecutive words of the item, as a reader sees them.

    Null and empty texts hold nothing; items with fewer words than that leak nowhere; rows without an id are left out.
    Repeated ids count once. The items' windows are cut in tasks and stored; the corpus is read once with a filter of all
    their shingles of bounded size; the rest are joins by hash partitions, of which only the windows' prefixes meet the hits.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    own = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).filter("item is not null and text is not null")
    windows = materialise(item_windows(own, words, q), "windows")
    sizes = sorted(r["q"] for r in windows.select("q").distinct().collect())  # q at most
    if not sizes:
        return spark.createDataFrame([], f"{doc_id} {rows.schema['doc'].dataType.simpleString()}, {item_id} {own.schema['item'].dataType.simpleString()}")
    shingles = windows.select("item", "window", F.explode("shingles").alias("s")).select("item", "window", "s.hash", "s.offset")
    bits = shingle_filter(shingles.select("hash").distinct())
    hit_docs = materialise(find_hits(rows.filter("doc is not null"), bits, sizes), "hits")
    hits = hit_docs.select("doc", F.length("flow").alias("length"), F.explode("hits").alias("h")).select("doc", "length", "h.hash", "h.at")
    # Rarity: in how many documents of the whole corpus a shingle is. A window with a shingle that is in none is in none.
    rarity = hits.select("hash", "doc").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("docs"))
    ranked = shingles.join(rarity, "hash", "left").groupBy("item", "window").agg(F.min(F.struct(F.coalesce("docs", F.lit(0)).alias("docs"), "hash", "offset")).alias("p")).filter("p.docs > 0")
    prefix = ranked.select("item", "window", "p.hash", "p.offset").join(windows.select("item", "window", "text"), ["item", "window"]).select("item", "text", "hash", "offset").distinct()
    # Position and length: the window must begin and end inside the document.
    start = F.col("at") - F.col("offset")
    candidates = hits.join(prefix, "hash").filter((start >= 0) & (start + F.length("text") <= F.col("length"))).select("doc", "item", "text", start.alias("start")).distinct()
    flow = hit_docs.select("doc", "flow", "marks")
    end = F.col("start") + F.length("text") + 1
    same = (F.expr("substring(flow, start + 1, length(text))") == F.col("text")) & (F.expr("substring(marks, start + 1, 1)") == "1")
    whole = (end > F.length("flow")) | (F.col("marks").substr(end, F.lit(1)) == "1")
    done = candidates.join(flow, "doc").filter(same & whole).select("doc", "item").distinct()
    return done.select(F.col("doc").alias(doc_id), F.col("item").alias(item_id))
