"""Parent-child links to full hierarchies: subtree sizes upward, preorder ranges downward, nested sets for everything else.

Nodes are cut into blocks of neighbouring ids, each of a fixed number of nodes at most: ids that leave gaps are numbered
anew, in the same order. A block solves its own part with numpy: which of its nodes is the highest above each node (its
top), and what adds up on the way. Only the tops whose parent lies in another block, and what they hang on, remain; they
form a smaller forest of the same shape, solved in the same way until it fits one block.

Where parents don't have ids near their children's, as with random ids, that leaves nearly as many nodes as before. Such a
forest is contracted by joins instead: in each round all leaves are raked into their parents, and of the nodes with one
child that isn't a leaf those that a coin picks are spliced out of the way up, no two of them next to each other. At least
a quarter of the nodes is expected to go in each round, so the rounds follow the logarithm of the number of nodes and not the
depth; what went away is put back in the opposite order. No task ever gets more than a block's number of nodes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..storage import lookup, materialise

#: Nodes per block at most, and the size up to which a forest is solved as one block.
BLOCK = 50_000
#: Ids per node up to which ids serve as they are; sparser ones are numbered anew.
GAPS = 8


class Rows:
    """Whole-number columns as numpy arrays, exact and with their nulls: v holds 0 where ok is false."""

    def __init__(self, v: dict[str, np.ndarray], ok: dict[str, np.ndarray]):
        self.v, self.ok = v, ok

    @classmethod
    def of(cls, table: pa.Table) -> "Rows":
        columns = {c: table[c].combine_chunks() for c in table.column_names if c != "block"}
        v = {c: np.asarray(x.fill_null(False if pa.types.is_boolean(x.type) else 0).to_numpy(zero_copy_only=False)) for c, x in columns.items()}
        return cls(v, {c: np.asarray(x.is_valid().to_numpy(zero_copy_only=False)) for c, x in columns.items()})

    def take(self, mask: np.ndarray) -> "Rows":
        return Rows({c: x[mask] for c, x in self.v.items()}, {c: x[mask] for c, x in self.ok.items()})

    def table(self, names: list[str], **new: tuple[np.ndarray, np.ndarray]) -> pa.Table:
        """The named columns, those in new from (values, hidden)."""
        parts = {c: new[c] if c in new else (self.v[c], ~self.ok[c]) for c in names}
        return pa.table({c: pa.array(x.astype(np.int64), mask=np.asarray(hidden, dtype=bool)) for c, (x, hidden) in parts.items()})


class Forest:
    """A block of nodes with unique ids. A parent that isn't in the block counts as outside."""

    def __init__(self, own: Rows):
        self.ids, self.n = own.v["id"], len(own.v["id"])
        self.has_parent, parents = own.ok["parent"], own.v["parent"]
        self.order = np.argsort(self.ids, kind="stable")
        self.sorted = self.ids[self.order]
        at = np.minimum(np.searchsorted(self.sorted, parents), max(self.n - 1, 0))
        inside = self.has_parent & (self.sorted[at] == parents) if self.n else self.has_parent
        self.up = np.where(inside, self.order[at], -1) if self.n else np.zeros(0, dtype=np.int64)
        # Upward: peel leaf after leaf. What is never peeled lies on a cycle.
        waiting = np.bincount(self.up[self.up >= 0], minlength=self.n)
        ready, self.layers, peeled = np.flatnonzero(waiting == 0), [], np.zeros(self.n, dtype=bool)
        while len(ready):
            self.layers.append(ready)
            peeled[ready] = True
            above = self.up[ready]
            above = above[above >= 0]
            np.subtract.at(waiting, above, 1)
            above = np.unique(above)
            ready = above[waiting[above] == 0]
        self.on_cycle = ~peeled

    def position(self, ids: np.ndarray) -> np.ndarray:
        return self.order[np.searchsorted(self.sorted, ids)]

    def sums_up(self, weight: np.ndarray) -> np.ndarray:
        """The weight of each node's subtree, for nodes not on a cycle."""
        total = weight.copy()
        for layer in self.layers:
            above = self.up[layer]
            inner = above >= 0
            np.add.at(total, above[inner], total[layer[inner]])
        return total

    def walk_down(self, *weights: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The top of each node and the sums of weights on the way from it down to the node, the top's own left out. Top -1: the way up runs into a cycle."""
        top, totals = np.where(self.on_cycle, -1, np.arange(self.n)), [np.zeros(self.n, dtype=np.int64) for _ in weights]
        for layer in reversed(self.layers):
            above = self.up[layer]
            v = layer[above >= 0]
            p = above[above >= 0]
            top[v] = top[p]
            for total, w in zip(totals, weights):
                total[v] = total[p] + w[v]
        return top, totals


def _numbered(nodes: DataFrame) -> tuple[DataFrame, int, bool]:
    """Nodes whose ids take at most GAPS times as many numbers as there are nodes, so that a stretch of ids is a bound for the nodes in it; how many they are; and whether they were numbered anew.

    Then id and parent are places in the order of the ids, and own_id and own_parent what they were. The places come from
    range partitions and the sizes of these, a row per partition, so that nothing is sorted in one task.
    """
    n, lo, hi = nodes.agg(F.count(F.lit(1)), F.min("id"), F.max("id")).first()
    if not n or hi - lo + 1 <= GAPS * n:
        return nodes, n, False
    row = F.monotonically_increasing_id()
    placed = materialise(nodes.withColumnsRenamed({"id": "own_id", "parent": "own_parent"}).repartitionByRange("own_id").sortWithinPartitions("own_id").withColumn("row", row), "placed")
    part = F.shiftright("row", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    before = F.coalesce(F.sum("size").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = placed.withColumn("part", part).join(F.broadcast(sizes.select("part", before.alias("before"))), "part")
    placed = placed.withColumn("id", F.col("before") + F.expr("row & 8589934591")).drop("part", "before", "row")
    parents = placed.select(F.col("own_id").alias("own_parent"), F.col("id").alias("parent"))
    return materialise(placed.join(parents, "own_parent", "left"), "numbered"), n, True


def _renamed(done: DataFrame, anew: bool) -> DataFrame:
    """The ids as they were."""
    return done.drop("id", "parent").withColumnsRenamed({"own_id": "id", "own_parent": "parent"}) if anew else done


def _block(c: str, rows: int) -> Column:
    """The block of an id: a stretch of `rows` numbers, which at most as many nodes have."""
    return F.floor(F.col(c) / F.lit(rows)).cast("bigint")


def _nulls(*names: str) -> list[F.Column]:
    return [F.lit(None).cast("bigint").alias(c) for c in names]


def _with_given(nodes: DataFrame, given: DataFrame, rows: int) -> DataFrame:
    """Nodes, and what is known of some of them from outside their block, as rows of one input by block."""
    given = given.select("*", *_nulls(*[c for c in nodes.columns if c not in given.columns]))
    return nodes.withColumn("given", F.lit(False)).unionByName(given.withColumn("given", F.lit(True))).withColumn("block", _block("id", rows))


def _contract(nodes: DataFrame, block_rows: int, upward: bool) -> tuple[DataFrame, DataFrame]:
    """The smaller forest (id, parent, w, hop, label), and which of its nodes hangs on which node of another block (id, on).

    Upward its weights are those of the parts below the tops; downward those of the way from top to top.
    """
    nodes = nodes.select("id", "parent", "w", "hop", "label")
    asked = nodes.filter(F.col("parent").isNotNull() & (_block("id", block_rows) != _block("parent", block_rows))).select(F.col("parent").alias("id")).distinct()

    def local(table: pa.Table) -> pa.Table:
        rows = Rows.of(table)
        own, asked = rows.take(~rows.v["given"]), rows.take(rows.v["given"])
        f = Forest(own)
        top, (total, hops) = f.walk_down(own.v["w"], own.v["hop"])
        part = f.sums_up(own.v["w"]) if upward else own.v["w"]
        open_ = np.flatnonzero((f.up < 0) & f.has_parent)
        at = f.position(asked.v["id"])
        t = np.maximum(top[at], 0)
        # What lies on or below a cycle of the block stands for itself, as a node that is its own parent.
        name = np.where(top[at] >= 0, f.ids[t], f.ids[at]) if len(at) else at
        ends = np.unique(np.where(top[at] >= 0, t, at)[(top[at] < 0) | ~f.has_parent[t]]) if len(at) else at
        looped, shown = top[ends] < 0, lambda x: np.zeros(len(x), dtype=bool)
        none = lambda x: (np.zeros(len(x), dtype=np.int64), shown(x))
        say = lambda what, x, **c: Rows({}, {}).table(["what", "id", "parent", "w", "hop", "label"], what=(np.full(len(x), what), shown(x)), id=(f.ids[x], shown(x)), **{"w": none(x), "hop": none(x), "label": none(x)} | c)
        return pa.concat_tables([
            say(0, open_, parent=(own.v["parent"][open_], shown(open_)), w=(part[open_], shown(open_)), hop=(own.v["hop"][open_], shown(open_))),
            say(1, at, parent=(name, shown(at)), w=(total[at], shown(at)), hop=(hops[at], shown(at))),
            say(2, ends, parent=(f.ids[ends], ~looped), label=(own.v["label"][ends], shown(ends))),
        ])

    found = materialise(_with_given(nodes, asked, block_rows).groupBy("block").applyInArrow(local, "what bigint, id bigint, parent bigint, w bigint, hop bigint, label bigint"), "contract")
    tops, attach = found.filter("what = 0").select("id", F.col("parent").alias("on"), "w", "hop"), found.filter("what = 1")
    attach = attach.select(F.col("id").alias("on"), F.col("parent").alias("above"), F.col("w").alias("w2"), F.col("hop").alias("hop2"))
    hung = tops.join(attach, "on")
    way = (F.col("w"), F.col("hop")) if upward else (F.col("w") + F.col("w2"), F.col("hop") + F.col("hop2"))
    inner = hung.select("id", F.col("above").alias("parent"), way[0].alias("w"), way[1].alias("hop"), *_nulls("label"))
    return materialise(inner.unionByName(found.filter("what = 2").select(*inner.columns)), "inner"), tops.select("id", "on")


def _raked(nodes: DataFrame, round_: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One round of raking and splicing of nodes (id, parent, w, hop, label, up): what is left, the leaves and the spliced nodes.

    w and hop are on the way from the parent down to the node. `acc` of a node is the sum of `own` in what was raked into
    it, its own included; `up` is what was spliced out of the way between the node and its parent. Spliced nodes come with
    `only`, the child that stays, and `up_only`, what lay between the two.
    """
    kids = nodes.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("kids"))
    flagged = materialise(nodes.join(kids, "id", "left").withColumn("leaf", F.expr("kids is null and parent is not null")).drop("kids"), "flagged")
    leaves, inner = flagged.filter("leaf").drop("leaf"), flagged.filter("not leaf").drop("leaf")
    raked = leaves.groupBy(F.col("parent").alias("id")).agg(F.sum(F.col("acc") + F.col("up")).alias("got"))
    stems = inner.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("stems"), F.max("id").alias("only"), F.max("up").alias("up_only"))
    full = inner.join(raked, "id", "left").withColumn("acc", F.col("acc") + F.coalesce("got", F.lit(0))).drop("got").join(stems, "id", "left")
    coin = lambda c: F.pmod(F.xxhash64(F.lit(round_), c), F.lit(2))
    spliced = (F.col("stems") == 1) & F.col("parent").isNotNull() & (F.col("parent") != F.col("id")) & (coin("id") == 1) & (coin("parent") == 0)
    full = materialise(full.withColumn("spliced", F.coalesce(spliced, F.lit(False))).drop("stems"), "stems")
    gone, stay = full.filter("spliced").drop("spliced"), full.filter("not spliced").drop("spliced", "only", "up_only")
    skipped = gone.select(F.col("id").alias("parent"), F.col("parent").alias("p2"), F.col("w").alias("w2"), F.col("hop").alias("hop2"), (F.col("acc") + F.col("up")).alias("u2"))
    add = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
    left = stay.join(skipped, "parent", "left").select("id", F.coalesce("p2", "parent").alias("parent"), add("w", "w2"), add("hop", "hop2"), "label", "acc", add("up", "u2"))
    return materialise(left, "left"), leaves, gone


def _parts(left: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What still hangs on something with what it hangs on, and the roots and rings of one that nothing hangs on any more."""
    held, loose = left.filter("parent is not null and parent != id"), left.filter("parent is null or parent = id")
    busy = held.select(F.col("parent").alias("id")).distinct()
    return held.unionByName(loose.join(busy, "id", "left_semi")), loose.join(busy, "id", "left_anti")


def _contracted(nodes: DataFrame, rows: int) -> tuple[DataFrame, list[tuple[DataFrame, DataFrame, DataFrame]]]:
    """nodes raked and spliced until at most `rows` are left that hang on something or bear something; and of each round what went away: leaves, spliced nodes, and nodes that then were alone."""
    rest = nodes.select("id", "parent", "w", "hop", "label", F.col("w").alias("acc"), F.lit(0).cast("bigint").alias("up"))
    gone: list[tuple[DataFrame, DataFrame, DataFrame]] = []
    while not gone or rest.count() > rows:
        left, leaves, spliced = _raked(rest, len(gone))
        rest, alone = _parts(left)
        gone.append((leaves, spliced, alone))
    return rest, gone


def _raked_sums(nodes: DataFrame, rows: int) -> DataFrame:
    """subtree_sums by raking and splicing."""
    rest, gone = _contracted(nodes, rows)

    def solve(table: pa.Table) -> pa.Table:
        own = Rows.of(table)
        f, w = Forest(own), own.v["acc"].copy()
        inside = f.up >= 0
        np.add.at(w, f.up[inside], own.v["up"][inside])
        return own.table(["id", "total"], total=(f.sums_up(w), f.on_cycle))

    total = materialise(rest.groupBy(F.lit(0).alias("block")).applyInArrow(solve, "id bigint, total bigint"), "sums")
    for leaves, spliced, alone in reversed(gone):
        known = total.unionByName(alone.select("id", F.when(F.col("parent").isNull(), F.col("acc")).alias("total")))
        child = known.select(F.col("id").alias("only"), F.col("total").alias("t"))
        back = spliced.join(child, "only").select("id", (F.col("acc") + F.col("t") + F.col("up_only")).alias("total"))
        total = materialise(known.unionByName(back).unionByName(leaves.select("id", F.col("acc").alias("total"))), "sums")
    return materialise(nodes.join(total, "id"), "sums")


def _raked_paths(nodes: DataFrame, rows: int) -> DataFrame:
    """path_sums by raking and splicing."""
    rest, gone = _contracted(nodes, rows)

    def solve(table: pa.Table) -> pa.Table:
        own = Rows.of(table)
        f = Forest(own)
        top, (total, hops) = f.walk_down(own.v["w"], own.v["hop"])
        t = np.maximum(top, 0)
        hidden = (top < 0) | f.has_parent[t]
        return own.table(["id", "root", "pre", "depth"], root=(own.v["label"][t], hidden), pre=(total, hidden), depth=(hops, hidden))

    found = materialise(rest.groupBy(F.lit(0).alias("block")).applyInArrow(solve, "id bigint, root bigint, pre bigint, depth bigint"), "paths")
    given = lambda c, name: F.when(F.col("parent").isNull(), c).alias(name)
    zero = F.lit(0).cast("bigint")
    below = lambda part, above: part.join(above.withColumnRenamed("id", "parent"), "parent").select("id", "root", (F.col("pre") + F.col("w")).alias("pre"), (F.col("depth") + F.col("hop")).alias("depth"))
    for leaves, spliced, alone in reversed(gone):
        known = found.unionByName(alone.select("id", given(F.col("label"), "root"), given(zero, "pre"), given(zero, "depth")))
        known = materialise(known.unionByName(below(spliced, known)), "paths")
        found = materialise(known.unionByName(below(leaves, known)), "paths")
    return materialise(nodes.join(found, "id"), "paths")


def subtree_sums(nodes: DataFrame, block_rows: int = BLOCK) -> DataFrame:
    """nodes(id, parent, w, hop, label, ...) with `total`, the sum of w over each node's subtree; null for nodes on a cycle."""
    nodes, n, anew = _numbered(nodes)
    names = [*nodes.columns, "total"]

    def solve(table: pa.Table) -> pa.Table:
        rows = Rows.of(table)
        own, known = rows.take(~rows.v["given"]), rows.take(rows.v["given"])
        f, w = Forest(own), own.v["w"].copy()
        at, marks = f.position(known.v["id"]), np.zeros(f.n, dtype=np.int64)
        np.add.at(w, at, known.v["w"])
        # If what hangs here is on a cycle, so is everything above.
        np.add.at(marks, at, known.v["hop"])
        return own.table(names, total=(f.sums_up(w), f.on_cycle | (f.sums_up(marks) > 0)))

    shape = ", ".join(f"{c} bigint" for c in names)
    if n <= block_rows:
        return _renamed(materialise(nodes.withColumn("given", F.lit(False)).groupBy(F.lit(0).alias("block")).applyInArrow(solve, shape), "sums"), anew)
    inner, on = _contract(nodes, block_rows, upward=True)
    if inner.count() > n // 2:
        return _renamed(_raked_sums(nodes, block_rows), anew)
    below = subtree_sums(inner, block_rows).select("id", "total").join(on, "id")
    known = below.groupBy(F.col("on").alias("id")).agg(F.coalesce(F.sum("total"), F.lit(0)).alias("w"), F.max(F.col("total").isNull().cast("bigint")).alias("hop"))
    return _renamed(materialise(_with_given(nodes, known, block_rows).groupBy("block").applyInArrow(solve, shape), "sums"), anew)


def path_sums(nodes: DataFrame, block_rows: int = BLOCK) -> DataFrame:
    """nodes(id, parent, w, hop, label, ...) with `root` (the label of the root above), and the sums `pre` of w and `depth` of hop on the way from the root, its own left out; null for nodes that no root reaches."""
    nodes, n, anew = _numbered(nodes)
    names = [*nodes.columns, "root", "pre", "depth"]

    def solve(table: pa.Table) -> pa.Table:
        rows = Rows.of(table)
        own, known = rows.take(~rows.v["given"]), rows.take(rows.v["given"])
        f = Forest(own)
        top, (total, hops) = f.walk_down(own.v["w"], own.v["hop"])
        root, reached, base, base_hops = own.v["label"].copy(), ~f.has_parent, np.zeros(f.n, dtype=np.int64), np.zeros(f.n, dtype=np.int64)
        at = f.position(known.v["id"])
        root[at], base[at], base_hops[at], reached[at] = known.v["label"], known.v["w"], known.v["hop"], True
        t = np.maximum(top, 0)
        hidden = (top < 0) | ~reached[t]
        return own.table(names, root=(root[t], hidden), pre=(base[t] + total, hidden), depth=(base_hops[t] + hops, hidden))

    shape = ", ".join(f"{c} bigint" for c in names)
    if n <= block_rows:
        return _renamed(materialise(nodes.withColumn("given", F.lit(False)).groupBy(F.lit(0).alias("block")).applyInArrow(solve, shape), "paths"), anew)
    inner, _ = _contract(nodes, block_rows, upward=False)
    if inner.count() > n // 2:
        return _renamed(_raked_paths(nodes, block_rows), anew)
    above = path_sums(inner, block_rows).filter("parent is not null and root is not null")
    known = above.select("id", F.col("pre").alias("w"), F.col("depth").alias("hop"), F.col("root").alias("label"))
    return _renamed(materialise(_with_given(nodes, known, block_rows).groupBy("block").applyInArrow(solve, shape), "paths"), anew)


def sibling_offsets(nodes: DataFrame, block_rows: int) -> DataFrame:
    """nodes(id, parent, total, ...) with w: 1 + the totals of the siblings with smaller ids, 0 without parent.

    Two levels of prefix sums, within stretches of neighbouring ids and then over the stretches, spread a parent of millions.
    """
    inside = W.partitionBy("parent", "stretch").orderBy("id").rowsBetween(W.unboundedPreceding, -1)
    kids = nodes.filter("parent is not null").withColumn("stretch", _block("id", block_rows))
    kids = kids.withColumn("before", F.coalesce(F.sum("total").over(inside), F.lit(0)))
    sums = kids.groupBy("parent", "stretch").agg(F.coalesce(F.sum("total"), F.lit(0)).alias("part"))
    earlier = W.partitionBy("parent").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    skip = lookup(sums.withColumn("skip", F.sum("part").over(earlier)).filter("skip > 0").select("parent", "stretch", "skip"), "skip")
    placed = kids.join(skip, ["parent", "stretch"], "left").withColumn("w", 1 + F.col("before") + F.coalesce("skip", F.lit(0)))
    tops = nodes.filter("parent is null").withColumn("w", F.lit(0).cast("bigint"))
    return placed.select(*nodes.columns, "w").unionByName(tops.select(*nodes.columns, "w"))


def hierarchy(links: DataFrame, block_rows: int = BLOCK) -> DataFrame:
    """links(id, parent, missing, extra) to one row per id: id, parent, root, open_end, depth, pre, size, kind, extra.

    parent is the id of another row or null; `missing` (boolean) marks a node whose parent is named but doesn't exist: it
    is a root with open_end. `extra` (bigint) is handed through. Ids must be unique, not null and within +-2^61.
    kind: `tree` (a root reaches it), `cycle` (it lies on one, also as its own parent), or `below_cycle`; the last two have
    null root, open_end, depth and pre, and those on a cycle a null size. The nodes of a tree have the preorder numbers
    0, 1, ... in order of sibling ids: the descendants of x are those of the same root with pre in (x.pre, x.pre + x.size).
    No rows: none out. A parent id that no row has must come as null with missing = true.
    """
    one = F.lit(1).cast("bigint")
    nodes = links.select("id", "parent", one.alias("w"), one.alias("hop"), (F.col("id") * 2 + F.col("missing").cast("bigint")).alias("label"), "extra")
    nodes, _, anew = _numbered(materialise(nodes, "nodes"))
    sized = subtree_sums(nodes, block_rows).drop("w")
    done = _renamed(path_sums(materialise(sibling_offsets(sized, block_rows), "offsets"), block_rows), anew)
    kind = F.when(F.col("root").isNotNull(), "tree").when(F.col("total").isNull(), "cycle").otherwise("below_cycle")
    return done.select("id", "parent", F.expr("shiftright(root, 1)").alias("root"), F.expr("(root & 1) = 1").alias("open_end"), "depth", "pre", F.col("total").alias("size"), kind.alias("kind"), "extra")


def ancestors(tree: DataFrame, width: int = 1024) -> DataFrame:
    """(id, ancestor, ancestor_depth) for every node of a tree and each of its ancestors, itself included, from the preorder ranges.

    A range is entered in every stretch of `width` preorder numbers that it meets, so nodes are matched with ranges by
    root and stretch: a stretch has at most width nodes, and as many ranges as start in it or cover it.
    """
    tree = tree.filter("kind = 'tree'")
    last = F.floor((F.col("pre") + F.col("size") - 1) / width)
    ranges = tree.select("root", F.col("id").alias("ancestor"), F.col("depth").alias("ancestor_depth"), F.col("pre").alias("from"), (F.col("pre") + F.col("size")).alias("to"), F.explode(F.sequence(F.floor(F.col("pre") / width), last)).alias("stretch"))
    nodes = tree.select("root", "id", "pre", F.floor(F.col("pre") / width).alias("stretch"))
    return nodes.join(ranges, ["root", "stretch"]).filter(F.col("pre").between(F.col("from"), F.col("to") - 1)).select("id", "ancestor", "ancestor_depth")


def paths(tree: DataFrame) -> DataFrame:
    """(id, path): the ids from the root down to the node, for the nodes of trees."""
    steps = ancestors(tree).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("ancestor_depth", "ancestor"))).alias("s"))
    return steps.select("id", F.transform("s", lambda x: x["ancestor"]).alias("path"))
