import random

import pytest

from tallywick.operators.topn import top_n_per_group

SCHEMA = "g string, threshold string, item bigint, score double, bucket int, rank int"


def brute(rows, n):
    best = {}
    for g, t, item, score, *_ in rows:
        if g is None or t is None or item is None or score is None or score != score:
            continue
        best[g, t, item] = max(score, best.get((g, t, item), score))
    groups = {}
    for (g, t, item), s in best.items():
        groups.setdefault((g, t), []).append((-s, item))
    return {(g, t, item, i + 1) for (g, t), x in groups.items() for i, (_, item) in enumerate(sorted(x)[:n])}


def run(spark, rows, n):
    df = top_n_per_group(spark.createDataFrame(rows, SCHEMA), ["g", "threshold"], "item", "score", n)
    return {(r.g, r.threshold, r.item, r.position) for r in df.collect()}


@pytest.mark.parametrize("n", [1, 3, 40])
def test_against_brute_force(spark, n):
    random.seed(n)
    scores = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, -3.5, 1e-300, 1e300, 2.0, 2.0]
    rows = []
    for _ in range(1500):
        g = random.choice(["hot", "hot", "hot", "a", "b", None])
        rows.append((g, random.choice(["x", "y", None]), random.choice([None, *range(60)]), random.choice([*scores, random.gauss(0, 5)]), 1, 1))
    assert run(spark, rows, n) == brute(rows, n)


def test_masses_of_equal_scores_and_repeats(spark):
    rows = [("g", "t", i % 500, 1.0, 0, 0) for i in range(2000)] + [("g", "t", 7, 1.0, 0, 0)] * 300
    assert run(spark, rows, 5) == {("g", "t", i, i + 1) for i in range(5)}


def test_thresholds_of_very_many_groups_come_by_shuffle(spark, monkeypatch):
    from tallywick import storage

    monkeypatch.setattr(storage, "BROADCAST_ROWS", 0)
    random.seed(9)
    rows = [(f"g{random.randrange(40)}", random.choice("xy"), random.randrange(30), random.gauss(0, 5), 1, 1) for _ in range(3000)]
    assert run(spark, rows, 2) == brute(rows, 2)


def test_empty_and_bad_n(spark):
    assert run(spark, [], 3) == set()
    with pytest.raises(ValueError):
        run(spark, [], 0)
