import base64
import random

import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from tallywick.llm.tokens import PATTERN, BitmapQueue, BytePairEncoder, encode_corpus

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoders():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    hf = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    hf.encode_special_tokens = True
    return BytePairEncoder.load(PATH), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}), hf


def test_queue_is_an_ordered_set():
    random.seed(1)
    q, have = BitmapQueue(50_257), set()
    for _ in range(4000):
        x = random.randrange(50_257)
        if random.random() < 0.5:
            q.add(x)
            have.add(x)
        elif have:
            x = random.choice(sorted(have)) if random.random() < 0.8 else x
            q.discard(x)
            have.discard(x)
        assert q.first() == min(have, default=-1)


def test_same_ids_as_two_other_encoders(encoders):
    mine, tik, hf = encoders
    assert PATTERN == P.PATTERN
    random.seed(2)
    alphabets = ["ab", "aeiourstln ", "Qz#$ \n\t", "日本語の文字", "اللغة ", "🪁👩🏽‍💻é́", "<|endoftext|>"]
    texts = ["", " ", "\n\n  x", "<|endoftext|>a", "it's I'LL 1234567890123", "�​"] + ["".join(random.choice(random.choice(alphabets)) for _ in range(random.choice([3, 30, 300]))) for _ in range(150)]
    for t in texts:
        ids = mine.encode(t)
        assert ids == tik.encode_ordinary(t) == hf.encode(t, add_special_tokens=False).ids
        assert tik.decode(ids) == t


def test_very_long_pre_token(encoders):
    mine, tik, _ = encoders
    for t in ("x" * 200_000, "abracadabra" * 20_000):
        assert tik.decode(mine.encode(t)) == t
    assert mine.encode("ab" * 3000) == tik.encode_ordinary("ab" * 3000)


def test_corpus_with_nulls_repeats_and_other_columns(spark):
    docs = spark.createDataFrame([(1, None, "i"), (2, "", "i"), (3, "gm 👀", "i"), (3, "gm 👀", "i")], "doc_id bigint, text string, ids string")
    got = sorted((r.doc_id, r.ids) for r in encode_corpus(docs, "doc_id", "text", PATH).collect())
    want = BytePairEncoder.load(PATH).encode("gm 👀")
    assert got == [(1, []), (2, []), (3, want), (3, want)]
    assert encode_corpus(docs.limit(0), "doc_id", "text", PATH).count() == 0
