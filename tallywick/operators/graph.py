"""Trust graphs: interactions to weighted edges, seeded trust scores by power iteration, rings of neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..storage import lookup, materialise

KINDS = ("likes", "recasts", "replies", "mentions", "follows")


def merge_interactions(parts: dict[str, DataFrame]) -> DataFrame:
    """One row per pair (i, j): counts of each kind, 0 where missing, `follows` null where missing. Self pairs and null ends are dropped.

    parts: a frame (i, j) per kind, one row per interaction. All are tagged and counted in one shuffle instead of being
    joined one after the other.
    """
    tagged = [df.select(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), F.lit(k).alias("kind")) for k, df in parts.items()]
    rows = tagged[0]
    for t in tagged[1:]:
        rows = rows.unionByName(t)
    count = lambda k: F.count(F.when(F.col("kind") == k, 1))
    merged = rows.filter("i is not null and j is not null and i != j").groupBy("i", "j").agg(*[count(k).alias(k) for k in KINDS[:4]], F.max(F.when(F.col("kind") == "follows", 1)).alias("follows"))
    return merged


def edge_weight(form: str) -> Column:
    """The three weight formulas, over counts of likes, replies, recasts, mentions and a follow (1 or null)."""
    f = F.coalesce("follows", F.lit(0))
    a, b = (F.col("likes") + x * F.col("replies") + y * F.col("recasts") + 12 * F.col("mentions") + f for x, y in ((6, 3), (3, 6)))
    return {"A": a, "B": b, "C": b + f * (F.col("replies") + F.col("recasts") + F.col("mentions"))}[form]


def local_trust(interactions: DataFrame, strategy: int) -> DataFrame:
    """Edges (i, j, v) of a strategy: 1 the follows; 3 by formula A; 9 and 11 by formula C (11 on a window that the caller cut)."""
    if strategy == 1:
        return interactions.filter("follows is not null").select("i", "j", F.col("follows").cast("int").alias("v"))
    v = edge_weight("A" if strategy == 3 else "C").cast("int")
    return interactions.select("i", "j", v.alias("v")).filter("v > 0")


def _prepared(edges: DataFrame, seeds: DataFrame | None, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Stored (keys, i, j, c) with row-normalised weights, and nodes (keys, n, p, dangling) with the seeds' share p."""
    e = edges.filter("i is not null and j is not null and i != j and v > 0").groupBy(*keys, "i", "j").agg(F.sum(F.col("v").cast("double")).alias("v"))
    c = materialise(e.withColumn("c", F.col("v") / F.sum("v").over(W.partitionBy(*keys, "i"))).select(*keys, "i", "j", "c"), "edges")
    nodes = c.select(*keys, F.col("i").alias("n"), F.lit(0).alias("sink")).unionByName(c.select(*keys, F.col("j").alias("n"), F.lit(1).alias("sink"))).groupBy(*keys, "n").agg(F.min("sink").alias("sink"))
    if seeds is None:
        seeded = nodes.withColumn("s", F.lit(0.0))
    else:
        once = seeds.groupBy(*keys, F.col("i").alias("n")).agg(F.sum(F.col("v").cast("double")).alias("s"))
        seeded = nodes.join(once, [*keys, "n"], "left").withColumn("s", F.coalesce("s", F.lit(0.0)))
    if keys:
        totals = seeded.groupBy(*keys).agg(F.sum("s").alias("all"), F.count(F.lit(1)).alias("size"))
        shared = seeded.join(lookup(totals, "totals"), keys)
    else:
        shared = seeded.crossJoin(F.broadcast(seeded.agg(F.sum("s").alias("all"), F.count(F.lit(1)).alias("size"))))
    p = F.when(F.col("all") > 0, F.col("s") / F.col("all")).otherwise(1.0 / F.col("size"))
    return c, materialise(shared.select(*keys, "n", p.alias("p"), (F.col("sink") == 1).alias("dangling")), "nodes")


def eigentrust(edges: DataFrame, seeds: DataFrame | None, alpha: float = 0.5, epsilon: float = 1e-6, max_iterations: int = 50, keys: tuple[str, ...] = ()) -> DataFrame:
    """Seeded trust scores (keys..., i, v): t = (1 - alpha) (C't + D p) + alpha p, D the trust held by nodes without out-edges.

    edges (keys..., i, j, v): self edges, null ends and v <= 0 are left out, repeated pairs added up. seeds (keys..., i, v):
    those not in the graph are left out, the rest is scaled to 1; none left: every node is a seed. No edges: no rows.
    `keys` names columns that tell separate graphs apart: all are solved in the same jobs, so a thousand small ones cost no
    more than one. Iterates until the summed change of each graph is below epsilon (0: exactly max_iterations steps).

    Each step joins edges with scores on the source, sums on the map side per target first, and writes its result in the
    shared folder; nothing but two sums comes to the driver.
    """
    k = list(keys)
    c, nodes = _prepared(edges, seeds, k)
    t = nodes.select(*k, "n", F.col("p").alias("t"))
    state = materialise(nodes.join(t, [*k, "n"]).select(*k, "n", "p", "dangling", "t"), "trust")
    for _ in range(max_iterations):
        flow = c.join(state.select(*k, F.col("n").alias("i"), "t"), [*k, "i"]).groupBy(*k, F.col("j").alias("n")).agg(F.sum(F.col("c") * F.col("t")).alias("in"))
        lost = state.groupBy(*k).agg(F.sum(F.when(F.col("dangling"), F.col("t")).otherwise(0.0)).alias("lost"))
        both = state.join(flow, [*k, "n"], "left")
        both = both.join(lookup(lost, "lost"), k) if k else both.crossJoin(F.broadcast(lost))
        new = (1 - alpha) * (F.coalesce("in", F.lit(0.0)) + F.col("lost") * F.col("p")) + alpha * F.col("p")
        step = materialise(both.select(*k, "n", "p", "dangling", new.alias("t"), F.abs(new - F.col("t")).alias("moved")), "trust")
        state = step
        if epsilon > 0:
            moved = step.groupBy(*k).agg(F.sum("moved").alias("moved")).agg(F.max("moved")).first()[0]
            if moved is None or moved < epsilon:
                break
    return state.select(*k, F.col("n").alias("i"), F.col("t").alias("v"))


def ranked(scores: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """scores with rank 1, 2, ... by v from high to low, equal ones by smaller i, within each combination of keys (a null is one of its own).

    Rows are cut into ranges of (keys, v, i), ranked within their range, and moved on by the sizes of the key's ranges
    before: a key of any size is spread over as many tasks as it needs.
    """
    order = [F.desc("v"), F.asc("i")]
    parts = materialise(scores.repartitionByRange(*[F.asc(k) for k in keys], *order).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = parts.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("size"))
    earlier = W.partitionBy(*keys).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    # Only a key's second and later ranges have any before them: as many rows as there are ranges, at most.
    before = sizes.withColumn("before", F.sum("size").over(earlier)).filter("before > 0").select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("part").alias("__part"), "before")
    same = F.col("part") == F.col("__part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    inside = F.row_number().over(W.partitionBy(*keys, "part").orderBy(*order))
    placed = parts.withColumn("inside", inside).join(F.broadcast(before), same, "left")
    return placed.withColumn("rank", (F.col("inside") + F.coalesce("before", F.lit(0))).cast("bigint")).select(*scores.columns, "rank")


def rings(edges: DataFrame, seeds: DataFrame, degrees: int) -> DataFrame:
    """(seed, node, degree): the nodes first reached from each seed over out-edges in 0, 1, ... degrees steps. One job per step for all seeds at once."""
    out = edges.select("i", "j").distinct()
    seen = seeds.select(F.col("i").alias("seed"), F.col("i").alias("node"), F.lit(0).alias("degree")).distinct()
    front = seen
    for d in range(1, degrees + 1):
        reached = front.join(out, front["node"] == out["i"]).select("seed", F.col("j").alias("node")).distinct()
        front = materialise(reached.join(seen, ["seed", "node"], "left_anti").withColumn("degree", F.lit(d)).select("seed", "node", "degree"), "ring")
        seen = seen.unionByName(front)
        if front.isEmpty():
            break
    return seen


def induced_edges(edges: DataFrame, members: DataFrame) -> DataFrame:
    """The edges between members (seed, node) of the same seed: (seed, i, j, v)."""
    m = members.select("seed", "node")
    near = edges.join(m.withColumnRenamed("node", "i"), "i")
    return near.join(m.withColumnRenamed("node", "j"), ["seed", "j"], "left_semi").select("seed", "i", "j", "v")


def direct_edges(edges: DataFrame, seeds: DataFrame, limit: int) -> DataFrame:
    """The `limit` heaviest out-edges of the seeds together, equal ones by i and j."""
    return edges.join(seeds.select("i").distinct(), "i", "left_semi").orderBy(F.desc("v"), "i", "j").limit(limit)


def neighbours(edges: DataFrame) -> DataFrame:
    """Each target with the sum of its edges' weights."""
    return edges.groupBy(F.col("j").alias("fid")).agg(F.sum("v").alias("trust"))


def personalised(edges: DataFrame, seeds: DataFrame, degrees: int = 2, alpha: float = 0.5, max_iterations: int = 20, epsilon: float = 1e-6) -> DataFrame:
    """(seed, i, v, degree): trust scores of each seed's neighbourhood, seeded with it alone: rings, induced edges, and one keyed power iteration for all seeds."""
    members = rings(edges, seeds, degrees)
    own = induced_edges(edges, members)
    start = members.filter("degree = 0").select("seed", F.col("node").alias("i"), F.lit(1.0).alias("v"))
    scores = eigentrust(own, start, alpha, epsilon, max_iterations, keys=("seed",))
    return scores.join(members.withColumnRenamed("node", "i"), ["seed", "i"])


class Graph:
    """A whole graph as arrays: ids in order; the out-edges of node k, by target, at starts[k] to starts[k + 1] in targets and weights; its in-edges, by source, at in_starts[k] to in_starts[k + 1] in sources, and their places among the out-edges in places. Of those out-edges, the ones to nodes before bounds[b] end at upto[b][k]."""

    def __init__(self, i: np.ndarray, j: np.ndarray, v: np.ndarray):
        self.ids = np.unique(np.concatenate([i, j]))
        n = len(self.ids)
        a, b = np.searchsorted(self.ids, i), np.searchsorted(self.ids, j)
        order = np.lexsort((b, a))
        a, b = a[order].astype(np.int32), b[order].astype(np.int32)
        self.targets, self.weights = b, v[order].astype(np.float64)
        del order
        starts = lambda x: np.concatenate([[0], np.cumsum(np.bincount(x, minlength=n))])
        self.starts, self.in_starts = starts(a), starts(b)
        places = np.argsort(b, kind="stable")
        self.places = places.astype(np.int32 if len(b) < 1 << 31 else np.int64)
        self.sources = a[places]
        self.bounds = [x for k in range(30) if (x := 1024 << 2 * k) < n] + [n]
        self.upto = [self.starts[:-1] + np.bincount(a[b < x], minlength=n) for x in self.bounds[:-1]] + [self.starts[1:]]

    def around(self, k: int, at: np.ndarray, degrees: int, most: int) -> tuple[np.ndarray, list[int], np.ndarray, np.ndarray, np.ndarray]:
        """The neighbourhood of node k: its nodes, k first and nearer ones before further ones, each ring in order; how many there are up to each degree; and sources, targets (places in nodes) and weights of the edges between them. at: -1 everywhere, before and after."""
        front, parts, ends = np.array([k]), [np.array([k])], [1]
        at[k] = 0
        while most > 0 and len(ends) <= degrees:
            first, total = self.starts[front], int((self.starts[front + 1] - self.starts[front]).sum())
            # Where a ring is cut, its nodes are the first ones: edges to further ones aren't looked at.
            for bound, upto in zip(self.bounds, self.upto):
                if bound == len(self.ids) or bound >= most + ends[-1] and total > 4 * most:
                    reached = self.targets[spans(first, upto[front] - first)[0]]
                    found = np.sort(reached[at[reached] < 0])
                    found = found[np.append(True, found[1:] != found[:-1])] if len(found) else found
                    if len(found) >= most:
                        break
            front = found[:most]
            if not len(front):
                break
            at[front] = np.arange(ends[-1], ends[-1] + len(front))
            parts.append(front)
            most -= len(front) + (len(ends) == 1)
            ends.append(ends[-1] + len(front))
        nodes = np.concatenate(parts)
        # The edges to nodes before a bound are looked for among out-edges, those to the rest among these nodes' in-edges.
        ways = []
        for bound, upto in zip(self.bounds, self.upto):
            if bound == len(self.ids) or bound > front[-1:].max(initial=0):
                far = np.flatnonzero(nodes >= bound)
                first, into = self.starts[nodes], self.in_starts[nodes[far]]
                out, back = upto[nodes] - first, self.in_starts[nodes[far] + 1] - into
                ways.append((out.sum() + back.sum(), bound, far, first, out, into, back))
        _, _, far, first, out, into, back = min(ways, key=lambda w: w[:2])
        edges, source = spans(first, out)
        target = at[self.targets[edges]]
        inside = np.flatnonzero(target >= 0)
        edges, source, target = edges[inside], source[inside], target[inside]
        if len(far):
            there, of = spans(into, back)
            came = at[self.sources[there]]
            inside = np.flatnonzero(came >= 0)
            edges, source, target = np.append(edges, self.places[there[inside]]), np.append(source, came[inside]), np.append(target, far[of[inside]])
        at[nodes] = -1
        return nodes, ends, source, target, self.weights[edges]

    def personal(self, many: np.ndarray, at: np.ndarray, degrees: int, most: int, alpha: float, epsilon: float) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(node, degree, ids, scores) of many nodes, solved as two graphs of separate parts: each node's last degree, which is large and settles in half the steps, and all nodes' other degrees."""
        parts: dict[bool, list] = {True: [], False: []}
        for k in many:
            nodes, ends, source, target, v = self.around(k, at, degrees, most)
            for degree in range(1, len(ends)):
                last = degree == len(ends) - 1
                some = slice(None) if last else np.flatnonzero((source < ends[degree]) & (target < ends[degree]))
                parts[last].append((k, degree, nodes, ends, source[some], target[some], v[some]))
        for found in filter(None, parts.values()):
            sizes = np.array([ends[degree] for _, degree, _, ends, *_ in found])
            firsts = np.cumsum(sizes) - sizes
            source, target, v = (np.concatenate([x[n] + (first if n < 6 else 0) for first, x in zip(firsts, found)]) for n in (4, 5, 6))
            t = seeded_scores(source, target, v, sizes, alpha, epsilon)
            for first, (k, degree, nodes, ends, *_) in zip(firsts, found):
                start = ends[degree - 1] if degree > 1 else 0
                new, scores = nodes[start : ends[degree]], t[first + start : first + ends[degree]]
                # Within a ring nodes are in order already.
                order = np.argsort(-scores, kind="stable") if degree > 1 else np.lexsort((new, -scores))
                yield self.ids[k], degree, self.ids[new[order]], scores[order]


def spans(first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in stretches that begin at first, one after the other, and the stretch of each."""
    ends = np.cumsum(sizes)
    of = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(ends[-1]) + (first - ends + sizes)[of], of


def seeded_scores(source: np.ndarray, target: np.ndarray, v: np.ndarray, sizes: np.ndarray, alpha: float, epsilon: float) -> np.ndarray:
    """Trust scores in separate graphs of `sizes` nodes, in a row, each seeded with its first node alone: within epsilon, in sum over a graph, of what they settle at.

    As all trust comes from the seed and that of nodes without out-edges goes back to it, the scores are in proportion to
    the sum of what 0, 1, 2, ... steps from the seed bring, each at most a share 1 - alpha of the one before. Once a step
    brings nearly `ratio` times the one before, in every node, so do all further ones, and their sum is known.
    """
    starts, n = np.cumsum(sizes) - sizes, int(sizes.sum())
    c = (1 - alpha) * v / np.bincount(source, v, n)[source]
    step, mass = np.zeros(n), np.ones(len(sizes))
    step[starts] = 1.0
    t = step.copy()
    while True:
        new = np.bincount(target, c * step[source], n)
        total = np.add.reduceat(new, starts)
        ratio = np.divide(total, mass, out=np.zeros(len(sizes)), where=mass > 0)
        apart = np.add.reduceat(np.abs(new - np.repeat(ratio, sizes) * step), starts)
        step, mass = new, total
        # A bound of the error of the further steps' sum, which counts twice as the scores are scaled to 1.
        if (2 * apart / (1 - ratio) / alpha < epsilon).all():
            t += step / np.repeat(1 - ratio, sizes)
            return t / np.repeat(np.add.reduceat(t, starts), sizes)
        t += step


def personal_graphs(edges: DataFrame, degrees: int = 5, most: int = 1000, alpha: float = 0.5, epsilon: float = 1e-6) -> DataFrame:
    """(fid, degree, scores): for every fid with out-edges and each degree, the fids first reached in that many steps, with their trust scores, best first.

    The scores of a degree are those over the edges between all fids up to it, seeded with the fid alone, within epsilon
    in sum of what they settle at. A fid gets
    `most` others in all, nearer ones first and by id within a ring; its own score is the first degree's and counts as
    one of them for what is left to further degrees.

    edges (i, j, v) without self edges and repeated pairs, v > 0. All of them go to the driver and to every worker, 20 bytes
    each: the graph must fit there. The fids are shared out over the tasks.
    """
    spark = edges.sparkSession
    e = edges.select("i", "j", F.col("v").cast("double").alias("v")).toArrow()
    if not e.num_rows:
        return spark.createDataFrame([], "fid bigint, degree int, scores array<struct<i: bigint, v: double>>")
    graph = Graph(*(e.column(c).to_numpy() for c in "ijv"))
    del e
    shared = spark.sparkContext.broadcast(graph)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        at = np.full(len(g.ids), -1, dtype=np.int32)
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            for first in range(0, len(nodes), 32):
                found = list(g.personal(nodes[first : first + 32], at, degrees, most, alpha, epsilon))
                if not found:
                    continue
                fid, degree, ids, scores = zip(*found)
                pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(scores))], names=["i", "v"])
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(fid, pa.int64()), pa.array(degree, pa.int32()), pa.ListArray.from_arrays(offsets, pairs)], names=["fid", "degree", "scores"])

    # Nodes without out-edges give no row. Neighbouring ids cost alike, so they are spread.
    nodes = spark.range(len(graph.ids)).repartition(8 * spark.sparkContext.defaultParallelism, F.xxhash64("id"))
    return nodes.mapInArrow(rows, "fid bigint, degree int, scores array<struct<i: bigint, v: double>>")
