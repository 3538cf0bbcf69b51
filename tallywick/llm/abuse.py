"""Abusive, hateful and sexual content: sentence scores combined by noisy-or, trained from labels of whole documents."""

from __future__ import annotations

import pickle
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import regex as re
import xxhash
from pyspark import RDD
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..storage import materialise
from .text import folded
from .tokens import spread

#: The weight in training of a document without a judgement, as most of them are ordinary ones: a few offend, but far fewer than one in ten. All of them are read; more than ORDINARY weigh as much together as so many, so that they don't drown the judgements.
UNLABELLED_WEIGHT, ORDINARY = 0.2, 4_000
#: The weight of a document without a judgement that a model which didn't see it is sure of.
FOUND_WEIGHT = 0.5
DIMENSIONS = 1 << 20
#: Characters of text that are scored at once.
CHUNK = 2_000_000
#: Sentences whose features are made at once.
SENTENCES = 20_000
KINDS = ("abuse", "hate", "sexual")

_SPLIT = re.compile(r"\s*(?:[\n\r]+\s*(?:\d{1,3}/\s+|[-*•>#]+\s+)?|(?<=[.!?…。！？؟।])[\s)\"']+|[。！？।]|\s//\s|\s\|\s|\s·\s|\s…\s|\s\.\.\.\s|;\s|<\|\w+\|>)\s*")
_LINK = re.compile(r"\b(?:https?|chain|ipfs)://\S+|\bwww\.\S+")
_NAME = re.compile(r"(?<!\w)@\w+")
_TICKER = re.compile(r"(?<!\w)\$[a-z][a-z0-9]{2,}")
_CHANNEL = re.compile(r"(?<![\w<])/[a-z][a-z0-9-]+")
_SPACED = re.compile(r"(?<!\w)\w(?:([ ._*\-~+|])\w)(?:\1\w)+(?!\w)")
_WORD = re.compile(r"[\p{L}\p{N}@$!#*%&+]+")
_GAPS = re.compile(r"[ ._*\-~+|]")
_NUMBER = re.compile(r"^[\p{N}]+$")
#: Signs that are read as letters.
_SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "+": "t", "#": "*", "%": "*", "&": "*"})
_REPEAT = re.compile(r"(.)\1+")
_VOWELS = re.compile("[aeiou*]")


#: Words of a sentence that is taken whole; longer ones, as where punctuation is missing, are taken in overlapping pieces of as many.
LONG, OVERLAP = 18, 9
#: Letters of a run without blanks that is taken whole, repeated ones and links aside; longer ones, as in scripts without blanks, are taken in overlapping pieces of as many.
RUN, RUN_OVERLAP = 60, 30


def _runs(s: str) -> list[str]:
    """s, or where it has long runs, the stretches between them and the runs' pieces."""
    out, short = [], []
    for w in s.split():
        if len(w) > RUN and len(_REPEAT.sub(r"\1", w)) > RUN and not _LINK.search(w):
            out += [" ".join(short)] if short else []
            out += [w[i : i + RUN] for i in range(0, len(w) - RUN_OVERLAP, RUN - RUN_OVERLAP)]
            short = []
        else:
            short.append(w)
    return [*out, " ".join(short)] if out and short else out or [s]


def sentences(text: str) -> list[str]:
    """The sentences, list items and lines of a text as a reader sees it."""
    out = []
    for s in (r for x in _SPLIT.split(folded(text)) if x for r in _runs(x.strip())):
        words = s.split()
        if len(words) <= LONG:
            out += [s] if s else []
        else:
            out += [" ".join(words[i : i + LONG]) for i in range(0, len(words) - OVERLAP, LONG - OVERLAP)]
    return out


def _hash(kind: str, word: str) -> int:
    return xxhash.xxh32_intdigest(kind + word)


def distinct(x: np.ndarray) -> np.ndarray:
    """The different numbers in order, by sorting, which is many times faster here than numpy's unique by hashing."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


class Words:
    """What is known of words, as flat arrays: hashes of a word as read, of its consonants (masked vowels), of its letters with the inner ones sorted (jumbled), and of its parts."""

    #: Words and parts kept at most; the rest of a run starts anew.
    KEPT, KEPT_PARTS = 300_000, 3_000_000

    def __init__(self):
        self.number: dict[str, int] = {}
        self.views, self.parts, self.start = array("Q"), array("Q"), array("q", [0])

    def add(self, word: str) -> int:
        bare = word.strip("!#*%&+$@") if not re.search(r"\w", word[1:-1] or "") else word.rstrip("!%&+")
        if _NUMBER.match(bare):
            read = "0"
        else:
            read = _REPEAT.sub(r"\1", bare.translate(_SIGNS)) if not bare.isalpha() else _REPEAT.sub(r"\1", bare)
        bones = _VOWELS.sub("", read)
        inner = read[:1] + "".join(sorted(read[1:-1])) + read[-1:]
        if read and not read.isascii():
            self.parts.extend(_hash("p", read[i : i + n]) for n in (2, 3) for i in range(len(read) - n + 1))
        elif len(read) >= 5:
            self.parts.extend(_hash("p", f"^{read}$"[i : i + 4]) for i in range(len(read) - 1))
        self.start.append(len(self.parts))
        self.views.extend((_hash("w", read), _hash("b", bones or read), _hash("i", inner)))
        found = self.number[word] = len(self.number)
        return found

    def parts_of(self, word: str) -> list[int]:
        k = self.number[word] if word in self.number else self.add(word)
        return self.parts[self.start[k] : self.start[k + 1]].tolist()

    def features(self, sentences: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The hashed features of many sentences at once, and the sentence of each, in the order of sentences: words in three views, their pairs and triples, and parts of words; each once per sentence."""
        if len(self.number) > self.KEPT or len(self.parts) > self.KEPT_PARTS:
            self.__init__()
        number, ids, counts = self.number, array("q"), np.zeros(len(sentences), dtype=np.int64)
        for k, s in enumerate(sentences):
            if "://" in s or "www." in s:
                s = _LINK.sub(" xlinkx ", s)
            if "@" in s:
                s = _NAME.sub(" xnamex ", s)
            if "$" in s:
                s = _TICKER.sub(" xtickerx ", s)
            if "/" in s:
                s = _CHANNEL.sub(" xchannelx ", s)
            s = _SPACED.sub(lambda m: _GAPS.sub("", m.group()), s)
            words = _WORD.findall(s)
            counts[k] = len(words)
            ids.extend(number[w] if w in number else self.add(w) for w in words)
        at = np.array(ids, dtype=np.int64)
        sent = np.repeat(np.arange(len(sentences), dtype=np.int64), counts)
        views = np.frombuffer(self.views, dtype=np.uint64).reshape(-1, 3)[at] if len(at) else np.zeros((0, 3), dtype=np.uint64)
        start = np.array(self.start, dtype=np.int64)
        sizes = start[at + 1] - start[at]
        ends = np.cumsum(sizes)
        parts = np.frombuffer(self.parts, dtype=np.uint64)[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[at] - ends + sizes, sizes)] if len(self.parts) else np.zeros(0, dtype=np.uint64)
        two, three = sent[:-1] == sent[1:], sent[:-2] == sent[2:]
        down, last = np.uint64(32), np.uint64(0x85EBCA77C2B2AE63)
        with np.errstate(over="ignore"):
            pairs = (views[:-1][two] * np.uint64(0x9E3779B1) + views[1:][two]) * last >> down
            skips = (views[:-2][three] * np.uint64(0xC2B2AE3D) + views[2:][three] + np.uint64(77)) * last >> down
            triples = (views[:-2, 1:][three] * np.uint64(0x9E3779B1) + views[1:-1, 1:][three] * np.uint64(0x27D4EB2F) + views[2:, 1:][three]) * last >> down
        found = np.concatenate([views.ravel(), pairs.ravel(), skips.ravel(), triples.ravel(), parts]).astype(np.int64) % DIMENSIONS
        of = np.concatenate([np.repeat(sent, 3), np.repeat(sent[:-1][two], 3), np.repeat(sent[:-2][three], 3), np.repeat(sent[:-2][three], 2), np.repeat(sent, sizes)])
        both = distinct(of * DIMENSIONS + found)
        return (both % DIMENSIONS).astype(np.int32), (both // DIMENSIONS).astype(np.int32)


_words = Words()


def features(sentence: str) -> np.ndarray:
    """The hashed features of a sentence, sorted and without repeats."""
    return _words.features([sentence])[0]


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    threshold: float

    def bag(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The sentences of texts, the text of each, and its score."""
        split, doc = split_all(texts)
        feature, sentence = _words.features(split)
        sizes = np.bincount(sentence, minlength=len(split))
        z = np.bincount(sentence, self.weights[feature], len(split)) / np.sqrt(np.maximum(sizes, 1)) + np.where(sizes > 0, self.bias, -30.0)
        return split, doc, 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def sentence_scores(self, text: str) -> tuple[list[str], np.ndarray]:
        split, _, p = self.bag([text])
        return split, p


def split_all(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The sentences of all texts in a row, and the text of each."""
    each = [sentences(t) for t in texts]
    return [s for e in each for s in e], np.repeat(np.arange(len(texts)), [len(e) for e in each])


def noisy_or(p: np.ndarray, doc: np.ndarray | None = None, n: int = 1) -> np.ndarray | float:
    """The probability that any of the sentences offends, if each does so on its own: of each of n documents, or without `doc` of the one that all are in."""
    missed = np.log1p(-np.clip(p, 0, 1 - 1e-9))
    return float(-np.expm1(missed.sum())) if doc is None else -np.expm1(np.bincount(doc, missed, n))


def labelled_documents(docs: DataFrame, doc_id: str, text: str, labels: DataFrame, label_id: str, annotator: str, category: str) -> DataFrame:
    """All judged documents: doc, text, share, the part of its annotators that call it offending, and agreed: two or more say the same.

    Case and blanks of a category make no difference; null and unknown ones are no judgement; an annotator's repeated
    rows count as one judgement, offending if any of them is.
    """
    kind = F.lower(F.trim(F.col(category)))
    votes = labels.select(F.col(label_id).alias("doc"), F.col(annotator).alias("a"), F.when(kind.isin(*KINDS), 1.0).when(kind == "none", 0.0).alias("v")).dropna(subset=["doc", "v"])
    share = votes.groupBy("doc", "a").agg(F.max("v").alias("v")).groupBy("doc").agg(F.avg("v").alias("share"), ((F.count(F.lit(1)) > 1) & (F.min("v") == F.max("v"))).alias("agreed"))
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).filter("text is not null").join(share, "doc")
    return rows.dropDuplicates(["doc"])


def unlabelled_documents(docs: DataFrame, doc_id: str, text: str, labels: DataFrame, label_id: str) -> DataFrame:
    """All documents without a judgement: doc, text."""
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).filter("text is not null and doc is not null")
    return rows.join(labels.select(F.col(label_id).alias("doc")).distinct(), "doc", "left_anti").dropDuplicates(["doc"])


#: Held-out scores under which a document looks innocent, and over which it looks offending, to a model that did not see it.
LOW, HIGH = 0.05, 0.5


@dataclass
class Rule:
    """How judgements count: `each` is the weight of a document without one; seen: sums by `seen_by` that they are reconsidered by, with the part of judgements that err, or None: as given."""

    each: float
    error: float = 0.0
    seen: np.ndarray | None = None


def given(block: dict, each: float) -> tuple[np.ndarray, np.ndarray]:
    """Labels and weights of a block's documents, as judged."""
    return (block["share"] > 0.5).astype(float), np.where(block["judged"], np.abs(block["share"] - 0.5) * 2, each)


def seen_by(block: dict, each: float) -> np.ndarray:
    """Weights of what the held-out scores in block["p"] say: pairs of hits and all, of offending and innocent judgements of two annotators, of judgements, and of documents without one; then, as numbers, documents without one that look offending, and all of these."""
    y, weight = given(block, each)
    judged, sure, high, low = block["judged"], block["judged"] & block["agreed"], block["p"] > HIGH, block["p"] < LOW
    pairs = ((low, sure & (y == 1)), (high, sure & (y == 0)), (y == 1, judged), (high, ~judged))
    return np.array([*(x for hit, of in pairs for x in (weight[hit & of].sum(), weight[of].sum())), (high & ~judged).sum(), (~judged).sum()])


def reconsidered(block: dict, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Labels and weights in the light of held-out scores block["p"], by Bayes' rule: what a judgement of one annotator still weighs if a model contradicts it (nothing, if it is a slip more likely than not), and which documents without one are taken as offending.

    How far a model is believed follows from how often it errs on judgements that two annotators agree on, and how far an
    annotator is, from how often two disagree. Counts are smoothed, so a model that few cases speak for changes little; the
    rule is the same at every size.
    """
    y, weight = given(block, rule.each)
    if rule.seen is None:
        return y, weight
    p, judged, error = block["p"], block["judged"], rule.error
    missed, alarm, share, found = ((rule.seen[k] + 1) / (rule.seen[k + 1] + 2) for k in (0, 2, 4, 6))
    offends, low, high = y == 1, p < LOW, p > HIGH
    slip = np.zeros(len(y))
    slip[judged & offends & low] = error * (1 - share) / (error * (1 - share) + (1 - error) * share * missed)
    slip[judged & ~offends & high] = error * share * (1 - missed) / (error * share * (1 - missed) + (1 - error) * (1 - share) * alarm)
    slip[judged & block["agreed"]] = 0
    new_y, new_weight = y.copy(), weight * np.where(slip > 0.5, 0, 1 - slip)
    sure_of = found * (1 - missed) / (found * (1 - missed) + (1 - found) * alarm)
    new_y[~judged & high] = float(sure_of > 0.5)
    new_weight[~judged & high] = abs(2 * sure_of - 1) * FOUND_WEIGHT / UNLABELLED_WEIGHT * rule.each
    new_weight[~judged & ~low & ~high] = 0.1 * rule.each
    return new_y, new_weight


def best_threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray, prevalence: float) -> float:
    """Where F1 comes out best on judged documents, the innocent ones weighted so that offending ones are as rare as in the corpus."""
    innocent = float((weight * (1 - y)).sum())
    w = np.where(y == 1, weight, weight * (float((weight * y).sum()) * (1 - prevalence) / prevalence / max(innocent, 1e-9)))
    order = np.argsort(-p, kind="stable")
    s, hits, all_ = p[order], np.cumsum((w * y)[order]), np.cumsum(w[order])
    last = np.append(s[1:] != s[:-1], True)
    f1 = np.where(last, 2 * hits / (all_ + max(hits[-1], 1e-9)), -1)
    at = int(np.argmax(f1))
    return float((s[at] + (s[at + 1] if at + 1 < len(s) else 0)) / 2)


def add(x: list[np.ndarray] | None, y: list[np.ndarray]) -> list[np.ndarray]:
    return y if x is None else [p + q for p, q in zip(x, y)]


class Here:
    """Blocks of documents in memory: dicts of texts and of arrays, one value a document."""

    def __init__(self, blocks: list[dict]):
        self.blocks = blocks

    def total(self, f: Callable, shared: object = None, texts: bool = False) -> list[np.ndarray] | None:
        """The sums of the arrays that f(block, shared) gives; None if there is no block. texts: whether f reads them."""
        return reduce(add, (f(b, shared) for b in self.blocks), None)

    def changed(self, f: Callable, shared: object = None) -> "Here":
        return Here([f(b, shared) for b in self.blocks])

    def listed(self, f: Callable, shared: object = None) -> list[np.ndarray]:
        return [f(b, shared) for b in self.blocks]


class Stored:
    """The same in the shared folder, read anew by each call: a task holds a few blocks at a time."""

    def __init__(self, rows: DataFrame):
        self.rows = materialise(rows, "blocks")
        self.context = rows.sparkSession.sparkContext
        self.plain = self.rows.select("rest").rdd
        self.plain = self.plain.coalesce(min(self.plain.getNumPartitions(), self.context.defaultParallelism))

    def _run(self, f: Callable, texts: bool) -> RDD:
        def blocks(rows: Iterator[Row]) -> Iterator:
            return f(pickle.loads(r.rest) | ({"texts": r.texts} if texts else {}) for r in rows)

        return (self.rows.rdd if texts else self.plain).mapPartitions(blocks)

    def total(self, f: Callable, shared: object = None, texts: bool = False) -> list[np.ndarray] | None:
        sent = self.context.broadcast(shared)

        def part(blocks: Iterator[dict]) -> Iterator[list[np.ndarray]]:
            found = reduce(add, (f(b, sent.value) for b in blocks), None)
            return iter([] if found is None else [found])

        sums = self._run(part, texts)
        # Many tasks' sums, and those of all features, are added up by tasks first, as the driver has little memory.
        found = sums.collect() if not texts and sums.getNumPartitions() <= 16 else [x for x in [sums.treeAggregate(None, lambda x, y: y if x is None else add(x, y), lambda x, y: x if y is None else add(x, y))] if x is not None]
        sent.destroy()
        return reduce(add, found, None)

    def listed(self, f: Callable, shared: object = None) -> list[np.ndarray]:
        return self._run(lambda blocks: (f(b, shared) for b in blocks), False).collect()

    def changed(self, f: Callable, shared: object = None) -> "Stored":
        sent = self.context.broadcast(shared)

        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for texts, rest in zip(pdf["texts"], pdf["rest"]):
                    new = f(pickle.loads(rest) | {"texts": list(texts)}, sent.value)
                    yield stored_block(new)

        return Stored(self.rows.mapInPandas(work, BLOCK))


BLOCK = "texts array<string>, rest binary"


def stored_block(block: dict) -> pd.DataFrame:
    return pd.DataFrame({"texts": [block["texts"]], "rest": [pickle.dumps({k: v for k, v in block.items() if k != "texts"}, protocol=5)]})


def text_key(text: str) -> int:
    """The same for equal texts, as a reader sees them."""
    return xxhash.xxh64_intdigest(folded(text))


def new_block(texts: list[str], share: np.ndarray, agreed: np.ndarray, folds: int) -> dict:
    """share: NaN for documents without a judgement."""
    judged = ~np.isnan(share)
    fold = np.array([text_key(t) % folds for t in texts], dtype=np.int64)
    return {"texts": texts, "judged": judged, "share": np.where(judged, share, 0.0).round(12), "agreed": agreed.astype(bool), "fold": fold, "p": np.zeros(len(texts))}


def found_in(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of some sentences after the other: the text of each, and their features with the sentence of each."""
    split, doc = split_all(texts)
    for k in range(0, len(split), SENTENCES):
        yield doc[k : k + SENTENCES], *_words.features(split[k : k + SENTENCES])


def pairs_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The different features of each text, and the text of each."""
    both = [doc[sentence] * DIMENSIONS + feature for doc, feature, sentence in found_in(texts)]
    pairs = distinct(np.concatenate(both)) if both else np.zeros(0, dtype=np.int64)
    return pairs % DIMENSIONS, pairs // DIMENSIONS


def judgements(block: dict, each: float) -> list[np.ndarray]:
    """Numbers of documents with and without a judgement, of those judged in part offending, those agreed on or not, and those that offend."""
    judged, share = block["judged"], block["share"]
    clash = judged & (share > 0) & (share < 1)
    return [np.array([judged.sum(), (~judged).sum(), clash.sum(), (judged & (block["agreed"] | clash)).sum(), (judged & (share > 0.5)).sum()])]


def plain_counts(block: dict, folds: int) -> list[np.ndarray]:
    """By fold and feature, the documents without a judgement that have it."""
    rest = np.flatnonzero(~block["judged"])
    feature, text = pairs_of([block["texts"][k] for k in rest])
    return [np.bincount(block["fold"][rest][text] * DIMENSIONS + feature, minlength=folds * DIMENSIONS).reshape(folds, DIMENSIONS).astype(np.int32)]


def offending_features(block: dict, rule: Rule) -> list[np.ndarray]:
    y, weight = reconsidered(block, rule)
    feature, _ = pairs_of([block["texts"][k] for k in np.flatnonzero((y == 1) & (weight > 0))])
    return [np.bincount(feature, minlength=DIMENSIONS).astype(np.int32)]


def special_sums(block: dict, shared: tuple[Rule, np.ndarray, int]) -> list[np.ndarray]:
    """By fold and place of a feature: documents, their weight, and that of offending ones, beyond what documents without a judgement count as given; then the same by fold for all documents."""
    rule, place, folds = shared
    y, weight = reconsidered(block, rule)
    judged, fold = block["judged"], block["fold"]
    docs, more = np.where(judged, weight > 0, (weight > 0) - 1.0), np.where(judged, weight, weight - rule.each)
    special = np.flatnonzero(judged | (more != 0) | (y != 0))
    feature, text = pairs_of([block["texts"][k] for k in special])
    used = place[feature] >= 0
    doc, n = special[text[used]], int(place.max()) + 1
    at = fold[doc] * n + place[feature[used]]
    by = lambda x: np.bincount(at, x[doc], folds * n).reshape(folds, n)
    all_ = lambda x: np.bincount(fold, x, folds)
    count = np.where(judged, 1.0, rule.each / UNLABELLED_WEIGHT) * (weight > 0)
    return [by(docs).astype(np.int32), by(more), by(y * weight), all_(weight), all_(y * weight), all_(count)]


def projected(block: dict, shared: tuple[Rule, np.ndarray]) -> dict:
    """The block with labels and weights, and of its sentences' features those that have a place; a document's sentences without any are one, counted as often."""
    rule, place = shared
    y, weight = reconsidered(block, rule)
    docs, features, sents, scales, times, n = [], [], [], [], [], 0
    empty = np.zeros(len(y))
    for doc, feature, sentence in found_in(block["texts"]):
        scale = 1 / np.sqrt(np.maximum(np.bincount(sentence, minlength=len(doc)), 1))
        used = place[feature] >= 0
        has = np.zeros(len(doc), dtype=bool)
        has[sentence[used]] = True
        empty += np.bincount(doc[~has], minlength=len(y))
        features.append(place[feature[used]])
        sents.append((np.cumsum(has) - 1 + n)[sentence[used]])
        docs.append(doc[has])
        scales.append(scale[has])
        times.append(np.ones(int(has.sum())))
        n += int(has.sum())
    without = np.flatnonzero(empty)
    join = lambda x, kind: np.concatenate([*x, np.zeros(0)]).astype(kind)
    bag = {"doc": join([*docs, without], np.int32), "feature": join(features, np.int32), "sentence": join(sents, np.int32), "scale": join([*scales, np.zeros(len(without))], np.float64), "times": join([*times, empty[without]], np.float64)}
    return {**block, "y": y, "weight": weight, "bag": bag}


def probabilities(bag: dict, n: int, w: np.ndarray, b: float) -> tuple[np.ndarray, np.ndarray]:
    """Of each sentence and of each of n documents."""
    z = np.bincount(bag["sentence"], w[bag["feature"]], len(bag["doc"])) * bag["scale"] + b
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    miss = np.bincount(bag["doc"], bag["times"] * np.log1p(-np.minimum(p, 1 - 1e-9)), n)
    return p, np.clip(-np.expm1(miss), 1e-9, 1 - 1e-9)


def gradient(block: dict, shared: tuple[list[int], np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """Of each model, which doesn't see the fold that it is named after: by its weights, and by its bias."""
    names, w, b = shared
    bag, y, grads, sums = block["bag"], block["y"], [], []
    doc = bag["doc"]
    for k, one in enumerate(names):
        p, q = probabilities(bag, len(y), w[k], b[k])
        # d loss / d z of a sentence: p for the documents that don't offend, p - p/q for those that do.
        g = bag["times"] * (block["weight"] * (block["fold"] != one))[doc] * (p - y[doc] * np.minimum(p / q[doc], 1.0))
        grads.append(np.bincount(bag["feature"], (g * bag["scale"])[bag["sentence"]], w.shape[1]))
        sums.append(g.sum())
    return [np.array(grads), np.array(sums)]


def held_out(block: dict, shared: tuple[list[int], np.ndarray, np.ndarray]) -> dict:
    """The block with its documents' scores by the models that didn't see them, 0 where there is none."""
    names, w, b = shared
    p = np.zeros(len(block["p"]))
    for k, one in enumerate(names):
        mine = block["fold"] == one
        p[mine] = probabilities(block["bag"], len(p), w[k], b[k])[1][mine]
    return {**{k: v for k, v in block.items() if k not in ("bag", "y", "weight")}, "p": p}


def judged_scores(block: dict, rule: Rule) -> np.ndarray:
    some = block["judged"]
    return np.array([block["p"][some], given(block, rule.each)[0][some], reconsidered(block, rule)[1][some]])


def fit(blocks: Here | Stored, rule: Rule, plain: np.ndarray, names: list[int], steps: int = 100, rate: float = 0.1, decay: float = 2e-6) -> tuple[Here | Stored, tuple, np.ndarray]:
    """Noisy-or logistic weights by gradient steps of adaptive size with momentum, over all documents in each step: one model for each name, which sees all folds but that; all in the same passes. (blocks, (names, weights, biases), features of the weights).

    Only features that speak for an offence get one: in two documents or more, and in offending ones at least twice as
    often as their share of the documents.
    """
    folds = len(plain)
    candidates = np.flatnonzero(blocks.total(offending_features, rule, texts=True)[0])
    place = np.full(DIMENSIONS, -1, dtype=np.int32)
    place[candidates] = np.arange(len(candidates))
    docs, more, bad, all_weight, all_bad, count = blocks.total(special_sums, (rule, place, folds), texts=True)
    docs, weight = docs + plain[:, candidates], more + plain[:, candidates] * rule.each
    seen = {one: [f for f in range(folds) if f != one] for one in names}
    names = [one for one in names if all_bad[seen[one]].sum() > 0]
    good = np.zeros((len(names), len(candidates)), dtype=bool)
    for k, one in enumerate(names):
        s = seen[one]
        share = bad[s].sum(0) / np.maximum(weight[s].sum(0), 1e-9)
        good[k] = (docs[s].sum(0) >= 2) & (share >= (1 - 1e-9) * 2 * all_bad[s].sum() / max(all_weight[s].sum(), 1e-9))
    any_ = good.any(axis=0)
    good, features = good[:, any_], candidates[any_]
    place[:] = -1
    place[features] = np.arange(len(features))
    blocks = blocks.changed(projected, (rule, place))
    size = np.array([count[seen[one]].sum() for one in names])
    w, b = np.zeros(good.shape), np.full(len(names), -6.5)
    mean, square = np.zeros((len(names), len(features) + 1)), np.zeros((len(names), len(features) + 1))
    for k in range(1, steps * bool(names) + 1):
        by_weight, by_bias = blocks.total(gradient, (names, w, b))
        grad = np.column_stack([(by_weight + decay * size[:, None] * w) * good, by_bias])
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        step = rate * mean / (1 - 0.9**k) / (np.sqrt(square / (1 - 0.99**k)) + 1e-9)
        w, b = w - step[:, :-1], b - 0.3 * step[:, -1]
    return blocks, (names, w, b), features


def fit_all(blocks: Here | Stored, folds: int) -> Model:
    """A model and its threshold, in three fits: on the judgements as given, with documents without one as ordinary; on what `reconsidered` makes of them in the light of models that did not see them, twice. The threshold is where the judgements, scored by models that did not see them, come out best."""
    found = blocks.total(judgements)
    judged, rest, clash, said_twice, offending = found[0] if found else np.zeros(5)
    if not offending:
        return Model(np.zeros(DIMENSIONS), -30.0, 0.5)
    rule = Rule(UNLABELLED_WEIGHT * min(1.0, ORDINARY / max(rest, 1)))
    plain = blocks.total(plain_counts, folds, texts=True)[0]
    for _ in range(2):
        blocks, models, _ = fit(blocks, rule, plain, [*range(folds)])
        blocks = blocks.changed(held_out, models)
        seen = blocks.total(one_sum, rule.each)[0]
        rule = Rule(rule.each, (clash + 0.5) / (2 * (said_twice + 5)), seen)
    prevalence = (seen[8] + 1) / (seen[9] + 2) if rest else offending / judged
    threshold = best_threshold(*np.concatenate(blocks.listed(judged_scores, rule), axis=1), prevalence)
    _, (names, w, b), features = fit(blocks, rule, plain, [folds])
    weights = np.zeros(DIMENSIONS, dtype=np.float32)
    if not names:
        return Model(weights, -6.5, threshold)
    weights[features] = w[0]
    return Model(weights, float(b[0]), threshold)


def one_sum(block: dict, each: float) -> list[np.ndarray]:
    return [seen_by(block, each)]


def train(labelled: pd.DataFrame, unlabelled: pd.DataFrame | None = None, folds: int = 3) -> Model:
    """`fit_all` on documents in memory. Equal texts are one case: their judgements are averaged."""
    rest = [] if unlabelled is None else [t for t in unlabelled["text"] if t]
    cases = labelled.assign(key=[text_key(t) for t in labelled["text"]]).groupby("key", sort=True).agg(text=("text", "first"), share=("share", "mean"), agreed=("agreed", "max")).reset_index()
    share = np.concatenate([cases["share"].to_numpy(float), np.full(len(rest), np.nan)])
    agreed = np.concatenate([cases["agreed"].to_numpy(bool), np.zeros(len(rest), dtype=bool)])
    return fit_all(Here([new_block([*cases["text"], *rest], share, agreed, folds)]), folds)


def train_in_task(labelled: DataFrame, unlabelled: DataFrame, folds: int = 3) -> Model:
    """The same over all documents of two tables of any size, in as many tasks as there are cores: each step of a fit is a pass over all blocks. The driver gets sums by feature, and the held-out scores of judged documents."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(key=np.array([text_key(t) for t in pdf["text"]], dtype=np.uint64).astype(np.int64))

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            size = pdf["text"].str.len().cumsum() // CHUNK
            for _, some in pdf.groupby(size.to_numpy(), sort=True):
                yield stored_block(new_block(some["text"].tolist(), some["share"].to_numpy(float), some["agreed"].to_numpy(bool), folds))

    judged = labelled.select("text", "share", "agreed").mapInPandas(keyed, "text string, share double, agreed boolean, key bigint")
    cases = judged.groupBy("key").agg(F.min("text").alias("text"), F.avg("share").alias("share"), F.max("agreed").alias("agreed")).drop("key")
    rest = unlabelled.filter("text != ''").select("text", F.lit(None).cast("double").alias("share"), F.lit(False).alias("agreed"))
    return fit_all(Stored(spread(cases.unionByName(rest)).mapInPandas(blocks, BLOCK)), folds)


def score_documents(docs: DataFrame, doc_id: str, text: str, model: Model, others: tuple[str, ...] = ()) -> DataFrame:
    """Each row's doc_id and `others`, score (0 to 1), offends (score at or above the threshold), and the sentence that scores most, as the reader sees it, with its score.

    Null, empty and blank texts score 0. Whole texts are read, however long; all rows come out, repeated ones as often.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(others)])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value

        def part(pdf: pd.DataFrame) -> pd.DataFrame:
            split, doc, p = m.bag([t or "" for t in pdf["text"]])
            best = np.lexsort((np.arange(len(p)), -p, doc))
            first = best[np.append(True, doc[best][1:] != doc[best][:-1])] if len(best) else best
            worst, named = np.zeros(len(pdf)), np.full(len(pdf), None, dtype=object)
            worst[doc[first]] = p[first]
            named[doc[first]] = [split[k] for k in first]
            done = pd.DataFrame({"score": noisy_or(p, doc, len(pdf)), "sentence": named, "sentence_score": worst}, index=pdf.index)
            return pd.concat([pdf.drop(columns="text"), done], axis=1)

        for pdf in batches:
            # Parts of bounded text, so that long documents don't pile up.
            size = pdf["text"].str.len().fillna(0).cumsum() // CHUNK
            for _, some in pdf.groupby(size.to_numpy(), sort=True):
                yield part(some)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    scored = spread(rows).mapInPandas(score, kinds + ", score double, sentence string, sentence_score double")
    return scored.select(F.col("doc").alias(doc_id), *[F.col(f"o{i}").alias(c) for i, c in enumerate(others)], "score", (F.col("score") >= F.lit(model.threshold)).alias("offends"), "sentence", "sentence_score")
