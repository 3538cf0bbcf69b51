import random

import pytest

from tallywick.llm import leaks
from tallywick.llm.leaks import leaked_items, shingle_hashes

WORDS = "amber bell coin drum early fresh graph host inner jar kite lamp mask node open page queue round seed tile".split()


def make(seed):
    random.seed(seed)
    say = lambda n: [random.choice(WORDS) + (str(random.randrange(99)) if random.random() < 0.2 else "") for _ in range(n)]
    items = [(k, " ".join(say(random.choice([5, 12, 40])))) for k in range(12)] + [(50, None), (51, "")]
    docs = [(0, None), (1, ""), (2, " ")]
    for d in range(3, 90):
        w, (_, t) = say(random.choice([2, 30])), random.choice(items[:12])
        part = t.split()
        n = random.choice([0, 8, 11, 12, 13, 40])
        at = random.randrange(max(1, len(part) - n + 1))
        take = part[at : at + n]
        if take and random.random() < 0.2:
            take[-1] += "x"  # another word
        if random.random() < 0.5:
            take = [x[:2] + "​" + x[2:].upper() if random.random() < 0.3 else x[:3] + "-\n" + x[3:] if len(x) > 4 and x.isalpha() and random.random() < 0.2 else f"<b>{x}</b>," for x in take]
        docs.append((d, " ".join([*w, *take, *say(3)])))
    return items, docs


def brute(items, docs):
    """Word by word, on the clean form of the texts that make() writes."""
    clean = lambda t: t.replace("​", "").replace("-\n", "").replace("<b>", "").replace("</b>", "").replace(",", "").lower().split()
    out = set()
    for d, text in docs:
        w = clean(text or "")
        have = {tuple(w[k : k + 12]) for k in range(len(w) - 11)}
        out |= {(d, i) for i, t in items if t and have & {tuple(t.split()[k : k + 12]) for k in range(len(t.split()) - 11)}}
    return out


@pytest.mark.parametrize("seed", [1, 3])
def test_against_brute_force(spark, monkeypatch, seed):
    """Also with a filter so small that much of the corpus passes it, and with small chunks."""
    if seed > 1:
        monkeypatch.setattr(leaks, "MOST_BITS", 1 << 10)
        monkeypatch.setattr(leaks, "CHUNK", 500)
    items, docs = make(seed)
    d = spark.createDataFrame([(*r, "x", "y") for r in docs + docs[:20]], "doc_id bigint, text string, item_id string, hash string")
    found = leaked_items(d, "doc_id", "text", spark.createDataFrame(items, "item_id bigint, text string"), "item_id", "text")
    rows = [tuple(r) for r in found.collect()]
    assert set(rows) == brute(items, docs) and len(rows) == len(set(rows)) and rows


def test_short_words_make_only_their_own_windows_short(spark):
    """A window of twelve one-letter words is one shingle of twelve letters; the others keep theirs."""
    items = [(1, "a b c d e f g h i j k l"), (2, "amber bell coin drum early fresh graph host inner jar kite lamp mask")]
    docs = [(1, "x a b c d e f g h i j k l y"), (2, "xa b c d e f g h i j k l"), (3, "so bell coin drum early fresh graph host inner jar kite lamp mask said")]
    windows = leaks.item_windows(spark.createDataFrame(items, "item bigint, text string"), 12).collect()
    assert sorted((r.item, r.q) for r in windows) == [(1, 12), (2, 20), (2, 20)]
    found = leaked_items(spark.createDataFrame(docs, "doc_id bigint, text string"), "doc_id", "text", spark.createDataFrame(items, "item_id bigint, text string"), "item_id", "text")
    assert sorted(map(tuple, found.collect())) == [(1, 1), (3, 2)]


def test_one_or_two_escapes_inside_a_passage(spark):
    text = "amber bell coin drum early fresh graph host inner jar kite lamp mask"
    docs = [(1, text.replace("bell coin", "bell%20coin")), (2, text.replace("coin", "co=69n")), (3, text.replace(" drum", "%2520drum").replace(" host", "%20host")), (4, "rate=20 at " + text), (5, text.replace("coin", "c=\r\noin"))]
    items = spark.createDataFrame([(9, text), (8, "rate=20 at amber bell coin drum early fresh graph host inner jar"), (7, "rate 20 at amber bell coin drum early fresh graph host inner jar")], "item_id bigint, text string")
    found = leaked_items(spark.createDataFrame(docs, "doc_id bigint, text string"), "doc_id", "text", items, "item_id", "text")
    assert sorted(map(tuple, found.collect())) == [(1, 9), (2, 9), (3, 9), (4, 7), (4, 8), (4, 9), (5, 9)]


def test_empty(spark):
    d, i = spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame([(1, "a " * 30)], "item_id bigint, text string")
    assert leaked_items(d, "doc_id", "text", i, "item_id", "text").count() == 0
    assert leaked_items(d, "doc_id", "text", i.limit(0), "item_id", "text").count() == 0


def test_hashes_of_equal_stretches_agree():
    hashes = lambda t, q: shingle_hashes(leaks.letters(t), q)
    for q in range(1, 12):
        a, b = hashes("xx" + "hello worldyy"[:q] + "z", q), hashes("hello worldyy"[:q], q)
        assert a[2] == b[0]
    a = hashes("the quick brown fox jumps over the lazy dog", 6)
    assert len(set(a.tolist())) == len(a) and len(hashes("abc", 5)) == 0
