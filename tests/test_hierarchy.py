import random

import pytest
from pyspark.sql import GroupedData
from pyspark.sql import functions as F

from tallywick.operators.hierarchy import ancestors, hierarchy, paths


def brute(par, missing):
    kids = {}
    for i, p in par.items():
        if p is not None:
            kids.setdefault(p, []).append(i)
    out = {}
    for r in [i for i, p in par.items() if p is None]:
        stack, depth, order = [r], {r: 0}, []
        while stack:
            x = stack.pop()
            order.append(x)
            for k in sorted(kids.get(x, []), reverse=True):
                depth[k] = depth[x] + 1
                stack.append(k)
        size = dict.fromkeys(order, 1)
        for x in reversed(order):
            if x != r:
                size[par[x]] += size[x]
        for n, x in enumerate(order):
            out[x] = (r, missing[r], depth[x], n, size[x], "tree")
    count = lambda x: 1 + sum(map(count, kids.get(x, [])))
    for i in par:
        if i not in out:
            x, seen = par[i], {i}
            while x not in seen:
                seen.add(x)
                x = par[x]
            out[i] = (None, None, None, None, None, "cycle") if x == i else (None, None, None, None, None, "below")
    for i, v in list(out.items()):
        if v[5] == "below":
            out[i] = (None, None, None, None, count(i), "below_cycle")
    return out


def make(seed, n, chain=False):
    random.seed(seed)
    ids = list(range(-50, n - 50)) if chain else random.sample(range(-500, 6 * n), n)
    par, missing = {}, {}
    for k, i in enumerate(ids):
        r = random.random()
        missing[i] = False
        if not k or r < 0.03:
            par[i], missing[i] = None, random.random() < 0.3
        elif r < 0.05 and not chain:
            par[i] = random.choice(ids)
        elif r < 0.35:
            par[i] = ids[0]
        else:
            par[i] = ids[max(0, k - 1 - int(random.expovariate(0.3)))]
    return par, missing


def run(spark, par, missing, block):
    rows = [(i, p, missing[i], i * 3) for i, p in par.items()]
    return hierarchy(spark.createDataFrame(rows, "id bigint, parent bigint, missing boolean, extra bigint"), block)


@pytest.mark.parametrize("seed,n,block,chain", [(1, 300, 10_000, False), (2, 250, 40, False), (3, 400, 50, True)])
def test_against_brute_force(spark, seed, n, block, chain):
    par, missing = make(seed, n, chain)
    tree = run(spark, par, missing, block)
    rows = tree.collect()
    assert {r.id: (r.root, r.open_end, r.depth, r.pre, r["size"], r.kind) for r in rows} == brute(par, missing)
    assert all(r.extra == r.id * 3 and r.parent == par[r.id] for r in rows)
    got = {r.id: r.path for r in paths(tree).collect()}
    for r in rows:
        if r.kind == "tree":
            way = [r.id]
            while par[way[0]] is not None:
                way.insert(0, par[way[0]])
            assert got.pop(r.id) == way
    assert not got
    below = {r["ancestor"]: r["count"] for r in ancestors(tree).groupBy("ancestor").count().collect()}
    assert below == {r.id: r["size"] for r in rows if r.kind == "tree"}


def test_one_deep_chain_and_huge_ids(spark):
    big = 2**60
    par = {big + i: (big + i - 1 if i else None) for i in range(120)}
    rows = run(spark, par, dict.fromkeys(par, False), 20).collect()
    assert {r.id - big: (r.root - big, r.depth, r["size"]) for r in rows} == {i: (0, i, 120 - i) for i in range(120)}


def test_empty(spark):
    assert run(spark, {}, {}, 10).count() == 0


def test_random_ids_and_one_far_id_never_fill_a_block(spark, monkeypatch):
    """Parents anywhere: raked and spliced. The largest part that a task gets is bounded, also with one id far from all others."""
    sizes, apply = [], GroupedData.applyInArrow

    def noted(self, f, schema):
        parts = self._df.groupBy("block").count() if "block" in self._df.columns else self._df.agg(F.count(F.lit(1)).alias("count"))
        sizes.append(parts.agg(F.max("count")).first()[0] or 0)
        return apply(self, f, schema)

    monkeypatch.setattr(GroupedData, "applyInArrow", noted)
    random.seed(8)
    ids = random.sample(range(10**6), 220) + [2**60]
    par = {x: (None if k < 3 else ids[random.randrange(k)] if k % 3 else ids[k - 1]) for k, x in enumerate(ids)}
    par[ids[5]] = ids[200]  # perhaps a ring
    missing = dict.fromkeys(par, False)
    rows = run(spark, par, missing, 60).collect()
    assert {r.id: (r.root, r.open_end, r.depth, r.pre, r["size"], r.kind) for r in rows} == brute(par, missing)
    assert 0 < max(sizes) <= 2 * 60  # a block's nodes, and what is known of them

