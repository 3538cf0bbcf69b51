import random

import numpy as np
import pandas as pd

from tallywick.llm import abuse
from tallywick.llm.abuse import features, labelled_documents, noisy_or, score_documents, sentences, train, train_in_task, unlabelled_documents

CALM = ["the {0} round closes on friday", "my rank went from 4 to 9 after the {0} update", "read the {0} notes here https://x.example/{0}", "what a filthy good riff, @{0}"]
BAD = ["you are a filthy halfwit, @{0}", "nobody wants you here @{0}, get lost", "send them all back to the {0} mud"]
NOUNS = "amber bell coin drum early fresh graph host jar kite lamp mask node page queue seed tile".split()


def make(seed, n):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        parts = [r.choice(CALM).format(r.choice(NOUNS)) for _ in range(r.randrange(1, 6))]
        bad = r.random() < 0.3
        if bad:
            parts.insert(r.randrange(len(parts) + 1), r.choice(BAD).format(r.choice(NOUNS)).replace("filthy", r.choice(["filthy", "f​ilthy", "f i l t h y", "FILTHY"])))
        rows.append((k, ". ".join(parts), float(bad)))
    return pd.DataFrame(rows, columns=["doc", "text", "share"]).assign(agreed=True)


def test_held_out_documents_and_their_sentences():
    model, test = train(make(1, 400)), make(2, 300)
    split = [model.sentence_scores(t) for t in test["text"]]
    said = np.array([noisy_or(p) >= model.threshold for _, p in split])
    truth = test["share"].to_numpy() > 0.5
    assert (said == truth).mean() > 0.97
    worst = [s[int(np.argmax(p))] for (s, p), bad in zip(split, truth) if bad]
    assert np.mean([not any(w.startswith(c.split("{")[0].strip()[:6]) for c in CALM) for w in worst]) > 0.95


def test_spellings_share_features():
    a = set(features("you are a filthy halfwit"))
    for other in ("you are a f i l t h y halfwit", "you are a fiiiilthy halfwit", "you are a f1lthy halfwit", "you are a filhty halfwit", "you are a f*lthy h#lfwit"):
        assert len(a & set(features(other))) >= 5
    assert len(features("")) == 0 and sentences("") == [] and sentences(" \n ") == []


def test_judgements_and_scores_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, "you are a filthy halfwit", "s"), (1, "you are a filthy halfwit", "s"), (2, None, "s"), (3, "", "s"), (4, " ", None)], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(1, "a", " Abuse "), (1, "a", "abuse"), (1, "b", "NONE"), (1, "c", None), (2, "a", "hate"), (9, "a", "hate")], "doc_id bigint, annotator string, category string")
    judged = labelled_documents(docs, "doc_id", "text", labels, "doc_id", "annotator", "category").toPandas()
    assert judged[["doc", "share", "agreed"]].values.tolist() == [[1, 0.5, False]]
    rows = score_documents(docs, "doc_id", "text", train(make(1, 200))).collect()
    assert len(rows) == 5 and sorted(r.doc_id for r in rows if r.offends) == [1, 1]
    assert all(r.score == 0 and r.sentence is None for r in rows if r.doc_id > 1)
    empty = train(make(1, 200).iloc[:0])
    assert not any(r.offends for r in score_documents(docs, "doc_id", "text", empty).collect())


def test_training_in_a_task_gives_the_same(spark):
    data, rest = make(1, 120), make(5, 60).drop(columns=["share", "agreed"])
    here = train(data, rest)
    there = train_in_task(spark.createDataFrame(data), spark.createDataFrame(rest))
    assert abs(here.threshold - there.threshold) < 1e-9 and np.allclose(here.weights, there.weights, atol=1e-5)


def test_a_run_without_blanks_keeps_its_last_part():
    from tallywick.llm import abuse

    for run in ("".join(chr(0x4E00 + 37 * k) for k in range(200)), "".join("abcdefghij"[k % 10] + "xyz"[k % 3] for k in range(100))):
        last = run[-3:] if not run.isascii() else f"{run}$"[-4:]
        assert abuse._hash("p", last) in abuse.Words().parts_of(run)
        pieces = abuse.sentences(f"before {run} after")
        assert pieces[0] == "before" and pieces[-1] == "after" and max(map(len, pieces)) <= abuse.RUN
        assert pieces[-2].endswith(abuse.folded(run)[-10:])
    assert abuse.sentences("see https://a.b/" + "xyzw" * 30 + " now") == ["see https://a.b/" + "xyzw" * 30 + " now"]


def test_all_documents_are_trained_on(spark):
    n = 20_500
    docs = spark.range(2 * n).selectExpr("id as doc_id", "concat('text ', id) as text")
    labels = spark.range(n).selectExpr("id as doc_id", "'a' as annotator", "if(id % 9 = 0, 'hate', 'none') as category")
    assert labelled_documents(docs, "doc_id", "text", labels, "doc_id", "annotator", "category").count() == n
    assert unlabelled_documents(docs, "doc_id", "text", labels, "doc_id").count() == n


def test_any_cut_into_blocks_gives_the_same(monkeypatch):
    """Also with more documents without a judgement than weigh in full."""
    monkeypatch.setattr(abuse, "ORDINARY", 50)
    data, rest = make(1, 120), make(5, 200)["text"].tolist()
    texts, share = [*data["text"], *rest], np.append(data["share"].to_numpy(), np.full(len(rest), np.nan))
    agreed = ~np.isnan(share)
    cuts = [0, 70, 120, 121, 200, len(texts)]
    one = abuse.fit_all(abuse.Here([abuse.new_block(texts, share, agreed, 3)]), 3)
    many = abuse.fit_all(abuse.Here([abuse.new_block(texts[a:b], share[a:b], agreed[a:b], 3) for a, b in zip(cuts, cuts[1:])]), 3)
    assert abs(one.threshold - many.threshold) < 1e-9 and np.allclose(one.weights, many.weights, atol=1e-5)
    assert (one.weights != 0).any() and noisy_or(many.sentence_scores("you are a filthy halfwit, @bell")[1]) >= many.threshold
