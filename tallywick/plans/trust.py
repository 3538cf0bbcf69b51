"""Trust graphs, global ranks and neighbourhoods (G and R of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.semantics import any_nonnull, distinct_sorted, whole_percentile
from ..operators.graph import direct_edges, edge_weight, eigentrust, induced_edges, local_trust, merge_interactions, neighbours, personal_graphs, personalised, ranked, rings
from ..sources.tables import table
from ..storage import materialise
from .registry import query
from .social import SQL, global_rank, interactions, live_casts, live_channels, now, reactions, replies, stored_casts

_PAIRS = """, tagged AS (SELECT fid AS i, target_fid AS j, CASE WHEN reaction_type = 1 THEN 'l' ELSE 'c' END AS k, ts FROM reactions
    UNION ALL SELECT fid, parent_fid, 'r', ts FROM replies UNION ALL SELECT i, j, 'm', ts FROM named UNION ALL SELECT i, j, 'f', NULL FROM follows),
  pairs AS (SELECT i, j, count(*) FILTER (k = 'l') AS likes, count(*) FILTER (k = 'c') AS recasts, count(*) FILTER (k = 'r') AS replies, count(*) FILTER (k = 'm') AS mentions,
    max(CASE WHEN k = 'f' THEN 1 END) AS follows FROM tagged WHERE i IS NOT NULL AND j IS NOT NULL AND i <> j GROUP BY i, j)"""
_EDGES3 = _PAIRS + ", edges AS (SELECT i, j, CAST(likes + 6 * replies + 3 * recasts + 12 * mentions + coalesce(follows, 0) AS INTEGER) AS v FROM pairs WHERE likes + 6 * replies + 3 * recasts + 12 * mentions + coalesce(follows, 0) > 0)"


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    return merge_interactions({k: d.select("i", "j") for k, d in interactions(spark, folder).items()})


@query("G2_interactions", SQL + _PAIRS + " SELECT * FROM pairs")
def g2_interactions(spark: SparkSession, folder: str) -> DataFrame:
    return _pairs(spark, folder)


@query(
    "G1_interactions_90_days",
    SQL + _PAIRS.replace("FROM tagged WHERE", "FROM tagged, moment WHERE (k = 'f' OR ts >= at_now - INTERVAL 90 DAY AND ts <= at_now) AND") + " SELECT * FROM pairs",
)
def g1_window(spark: SparkSession, folder: str) -> DataFrame:
    """Interactions of the 90 days before now, and all follows."""
    since = now() - F.expr("INTERVAL '90' DAY")
    return merge_interactions({k: (d if k == "follows" else d.filter((F.col("ts") >= since) & (F.col("ts") <= now()))).select("i", "j") for k, d in interactions(spark, folder).items()})


@query(
    "G3_edge_weights",
    SQL + _PAIRS + """ SELECT i, j, likes + 6 * replies + 3 * recasts + 12 * mentions + coalesce(follows, 0) AS a, likes + 3 * replies + 6 * recasts + 12 * mentions + coalesce(follows, 0) AS b,
      likes + 3 * replies + 6 * recasts + 12 * mentions + coalesce(follows, 0) * (1 + replies + recasts + mentions) AS c FROM pairs""",
)
def g3_weights(spark: SparkSession, folder: str) -> DataFrame:
    return _pairs(spark, folder).select("i", "j", *[edge_weight(x.upper()).alias(x) for x in "abc"])


@query("G4_local_trust_follows", SQL + " SELECT i, j, 1 AS v FROM follows WHERE i <> j")
def g4_follows(spark: SparkSession, folder: str) -> DataFrame:
    return local_trust(_pairs(spark, folder), 1)


@query("G4_local_trust_engagement", SQL + _EDGES3 + " SELECT * FROM edges")
def g4_engagement(spark: SparkSession, folder: str) -> DataFrame:
    return local_trust(_pairs(spark, folder), 3)


_FORM_C = "likes + 3 * replies + 6 * recasts + 12 * mentions + coalesce(follows, 0) * (1 + replies + recasts + mentions)"
_PAIRS_90 = _PAIRS.replace("FROM tagged WHERE", "FROM tagged, moment WHERE (k = 'f' OR ts >= at_now - INTERVAL 90 DAY AND ts <= at_now) AND")


@query("G4_local_trust_boosted", SQL + _PAIRS + f" SELECT i, j, CAST({_FORM_C} AS INTEGER) AS v FROM pairs WHERE {_FORM_C} > 0")
def g4_boosted(spark: SparkSession, folder: str) -> DataFrame:
    """Strategy 9: replies, recasts and mentions of those who follow count more."""
    return local_trust(_pairs(spark, folder), 9)


@query("G4_local_trust_boosted_90_days", SQL + _PAIRS_90 + f" SELECT i, j, CAST({_FORM_C} AS INTEGER) AS v FROM pairs WHERE {_FORM_C} > 0")
def g4_boosted_90(spark: SparkSession, folder: str) -> DataFrame:
    """Strategy 11: the same over the last 90 days."""
    return local_trust(g1_window(spark, folder), 11)


@query("G5_local_trust_statistics", SQL + _EDGES3 + " SELECT count(*) AS edges, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS deviation, max(v) - min(v) AS spread FROM edges")
def g5_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return local_trust(_pairs(spark, folder), 3).agg(F.count(F.lit(1)).alias("edges"), F.round(F.avg("v"), 6).alias("mean"), F.round(F.stddev_samp("v"), 6).alias("deviation"), (F.max("v") - F.min("v")).alias("spread"))


_SEEDS = "(SELECT profile_id AS i, 1.0 / (SELECT count(*) FROM grank WHERE strategy_id = 9 AND rank <= 100) AS v FROM grank WHERE strategy_id = 9 AND rank <= 100)"


def top_tier(spark: SparkSession, folder: str, n: int = 100) -> DataFrame:
    """The best n profiles of strategy 9, each with the same share."""
    top = global_rank(spark, folder).filter(f"strategy_id = 9 and rank <= {n}")
    return top.crossJoin(F.broadcast(top.agg(F.count(F.lit(1)).alias("n")))).select(F.col("profile_id").alias("i"), (1.0 / F.col("n")).alias("v"))


@query("G6_pretrust_top_tier", SQL + f" SELECT i, round(v, 9) AS v FROM {_SEEDS}")
def g6_top_tier(spark: SparkSession, folder: str) -> DataFrame:
    return top_tier(spark, folder).select("i", F.round("v", 9).alias("v"))


@query(
    "G6_pretrust_popular",
    SQL + " SELECT target_fid AS i, 1.0 / 20 AS v FROM reactions, moment WHERE ts >= at_now - INTERVAL 7 DAY AND ts <= at_now GROUP BY target_fid ORDER BY count(*) DESC, target_fid LIMIT 20",
)
def g6_popular(spark: SparkSession, folder: str) -> DataFrame:
    r = reactions(spark, folder).filter((F.col("ts") >= now() - F.expr("INTERVAL '7' DAY")) & (F.col("ts") <= now()))
    top = r.groupBy(F.col("target_fid").alias("i")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "i").limit(20)
    return top.select("i", F.lit(1.0 / 20).alias("v"))


@query(
    "G6_pretrust_proportional",
    SQL + """, got AS (SELECT j AS i, sum(w) AS w FROM (SELECT i, j, count(*) AS w FROM named WHERE i <> j GROUP BY i, j) GROUP BY j ORDER BY w DESC, i LIMIT 100)
      SELECT i, round(w / (SELECT sum(w) FROM got), 9) AS v FROM got""",
)
def g6_proportional(spark: SparkSession, folder: str) -> DataFrame:
    named = interactions(spark, folder)["mentions"].filter("i != j and j is not null")
    top = named.groupBy(F.col("j").alias("i")).agg(F.count(F.lit(1)).alias("w")).orderBy(F.desc("w"), "i").limit(100)
    return top.crossJoin(F.broadcast(top.agg(F.sum("w").alias("all")))).select("i", F.round(F.col("w") / F.col("all"), 9).alias("v"))


def _trust_sql(steps: int, alpha: float) -> str:
    parts = [
        _EDGES3,
        ", c AS (SELECT i, j, v / sum(v) OVER (PARTITION BY i) AS c FROM edges), nodes AS (SELECT i AS n FROM edges UNION SELECT j FROM edges)",
        f", s AS (SELECT i AS n, v FROM {_SEEDS} WHERE i IN (SELECT n FROM nodes))",
        ", p AS (SELECT nodes.n, coalesce(s.v, 0) / (SELECT sum(v) FROM s) AS p, nodes.n NOT IN (SELECT i FROM edges) AS sink FROM nodes LEFT JOIN s ON s.n = nodes.n), t0 AS MATERIALIZED (SELECT n, p AS t FROM p)",
    ]
    for k in range(steps):
        parts.append(
            f", t{k + 1} AS MATERIALIZED (SELECT p.n, {1 - alpha} * (coalesce(f.flow, 0) + p.p * (SELECT coalesce(sum(t), 0) FROM t{k} JOIN p USING (n) WHERE sink)) + {alpha} * p.p AS t"
            f" FROM p LEFT JOIN (SELECT j AS n, sum(c * t) AS flow FROM c JOIN t{k} ON t{k}.n = c.i GROUP BY j) f ON f.n = p.n)"
        )
    return "".join(parts)


@query("G7_eigentrust", SQL + _trust_sql(5, 0.5) + " SELECT n AS i, round(t, 9) AS v FROM t5")
def g7_eigentrust(spark: SparkSession, folder: str) -> DataFrame:
    """Five steps, as in the SQL: nodes further than that from every seed have 0. G7_eigentrust_settled iterates to the end."""
    return eigentrust(local_trust(_pairs(spark, folder), 3), top_tier(spark, folder), 0.5, 0.0, 5).select("i", F.round("v", 9).alias("v"))


@query("G7_eigentrust_settled", None)
def g7_settled(spark: SparkSession, folder: str) -> DataFrame:
    """Until the change is under 1e-6, which 21 steps reach at alpha 0.5."""
    return eigentrust(local_trust(_pairs(spark, folder), 3), top_tier(spark, folder), 0.5, 1e-6, 50)


@query("G23_tip_graph_rank", None)
def g23_tip_graph(spark: SparkSession, folder: str) -> DataFrame:
    """Mentions as tips: seeds in proportion to what they got, alpha 0.1, until it settles: the change is under 1e-6 after 138 steps at most."""
    edges = interactions(spark, folder)["mentions"].groupBy("i", "j").agg(F.count(F.lit(1)).alias("v"))
    return ranked(eigentrust(edges, g6_proportional(spark, folder), 0.1, 1e-6, 150))


@query("G8_global_rank", SQL + " SELECT strategy_id, strategy_name, profile_id, score, rank FROM grank")
def g8_rank(spark: SparkSession, folder: str) -> DataFrame:
    return global_rank(spark, folder).drop("date")


@query("G9_direct_edges", SQL + _EDGES3 + f" SELECT i, j, v FROM edges WHERE i IN (SELECT i FROM {_SEEDS}) ORDER BY v DESC, i, j LIMIT 200")
def g9_direct(spark: SparkSession, folder: str) -> DataFrame:
    return direct_edges(local_trust(_pairs(spark, folder), 3), top_tier(spark, folder), 200)


_BEST5 = "(SELECT profile_id FROM grank WHERE strategy_id = 9 AND rank <= 5)"
_RINGS = f""", r0 AS (SELECT profile_id AS seed, profile_id AS node, 0 AS degree FROM {_BEST5}),
  r1 AS (SELECT DISTINCT seed, j AS node, 1 AS degree FROM r0 JOIN edges ON i = node WHERE NOT EXISTS (SELECT 1 FROM r0 x WHERE x.seed = r0.seed AND x.node = j)),
  r2 AS (SELECT DISTINCT seed, j AS node, 2 AS degree FROM r1 JOIN edges ON i = node WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM r0 UNION ALL SELECT * FROM r1) x WHERE x.seed = r1.seed AND x.node = j)),
  ring AS (SELECT * FROM r0 UNION ALL SELECT * FROM r1 UNION ALL SELECT * FROM r2)"""


def _around(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All edges, and the five best profiles as seeds."""
    return materialise(local_trust(_pairs(spark, folder), 3), "edges"), top_tier(spark, folder, 5)


@query("G10_rings", SQL + _EDGES3 + _RINGS + " SELECT * FROM ring")
def g10_rings(spark: SparkSession, folder: str) -> DataFrame:
    return rings(*_around(spark, folder), 2)


@query(
    "G11_rings_capped",
    SQL + _EDGES3 + _RINGS + " SELECT seed, node, degree FROM (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY degree, node) AS place FROM ring WHERE degree > 0) WHERE place <= 50",
)
def g11_capped(spark: SparkSession, folder: str) -> DataFrame:
    """The first 50 neighbours of each seed, nearer rings first and by id within one."""
    place = F.row_number().over(W.partitionBy("seed").orderBy("degree", "node"))
    return rings(*_around(spark, folder), 2).filter("degree > 0").withColumn("place", place).filter("place <= 50").drop("place")


@query("G12_induced_edges", SQL + _EDGES3 + _RINGS + " SELECT a.seed, s.i, s.j, s.v FROM edges s JOIN ring a ON a.node = s.i JOIN ring b ON b.node = s.j AND b.seed = a.seed")
def g12_induced(spark: SparkSession, folder: str) -> DataFrame:
    edges, seeds = _around(spark, folder)
    return induced_edges(edges, rings(edges, seeds, 2))


@query("G13_neighbours", SQL + _EDGES3 + f" SELECT j AS fid, CAST(sum(v) AS BIGINT) AS trust FROM edges WHERE i IN (SELECT i FROM {_SEEDS}) GROUP BY j")
def g13_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    edges = local_trust(_pairs(spark, folder), 3)
    return neighbours(edges.join(top_tier(spark, folder).select("i"), "i", "left_semi"))


@query("G14_personalised_scores", None)
def g14_personalised(spark: SparkSession, folder: str) -> DataFrame:
    return personalised(*_around(spark, folder), 2, max_iterations=50).select("seed", F.col("i").alias("fid"), F.col("v").alias("score"))


@query("G15_personal_graph", None)
def g15_personal_graph(spark: SparkSession, folder: str) -> DataFrame:
    """Per fid with out-edges and degree to 5, the scored fids of that ring, best first, at most 1000 per fid."""
    return personal_graphs(local_trust(_pairs(spark, folder), 3))


@query("G17_edges_by_address", SQL + _EDGES3 + " SELECT '0x' || lower(printf('%016x', i)) AS i, '0x' || lower(printf('%016x', j)) AS j, v FROM edges")
def g17_by_address(spark: SparkSession, folder: str) -> DataFrame:
    name = lambda c: F.concat(F.lit("0x"), F.lower(F.lpad(F.hex(c), 16, "0"))).alias(c)
    return local_trust(_pairs(spark, folder), 3).select(name("i"), name("j"), "v")


_CHANNEL = """, ce AS (SELECT channel_id, i, j, CAST(sum(w) AS BIGINT) AS v FROM (
    SELECT l.channel_id, r.fid AS i, r.target_fid AS j, CASE WHEN reaction_type = 1 THEN 1 ELSE 3 END AS w FROM reactions r JOIN live l ON l.id = r.cast_id
    UNION ALL SELECT channel_id, fid, parent_fid, 6 FROM replies UNION ALL SELECT channel_id, fid, m, 12 FROM (SELECT channel_id, fid, unnest(mentions) AS m FROM live))
  WHERE channel_id IS NOT NULL AND i IS NOT NULL AND j IS NOT NULL AND i <> j GROUP BY ALL)"""


def channel_trust(spark: SparkSession, folder: str) -> DataFrame:
    """Local trust of all channels at once: channel_id, i, j, v by formula A without follows."""
    base = stored_casts(spark, folder, "mentions")
    c = live_casts(spark, folder, "mentions", base=base)
    r = reactions(spark, folder, base).join(c.select(F.col("id").alias("cast_id"), "channel_id"), "cast_id").select("channel_id", F.col("fid").alias("i"), F.col("target_fid").alias("j"), F.when(F.col("reaction_type") == 1, 1).otherwise(3).alias("w"))

    p = replies(spark, folder, base).select("channel_id", F.col("fid").alias("i"), F.col("parent_fid").alias("j"), F.lit(6).alias("w"))
    m = c.select("channel_id", F.col("fid").alias("i"), F.explode("mentions").alias("j"), F.lit(12).alias("w"))
    rows = r.unionByName(p).unionByName(m).filter("channel_id is not null and i is not null and j is not null and i != j")
    return rows.groupBy("channel_id", "i", "j").agg(F.sum("w").alias("v"))


@query("G19_channel_local_trust", SQL + _CHANNEL + " SELECT * FROM ce")
def g19_channel_trust(spark: SparkSession, folder: str) -> DataFrame:
    return channel_trust(spark, folder)


_CHANNEL_SEEDS = "(SELECT DISTINCT channel_id, i FROM (SELECT channel_id, lead_fid AS i FROM chan UNION ALL SELECT channel_id, unnest(moderator_fids) FROM chan) WHERE i IS NOT NULL)"


def channel_seeds(spark: SparkSession, folder: str) -> DataFrame:
    """Lead and moderators of each channel, without repeats: channel_id, i, v = 1."""
    c = live_channels(spark, folder)
    both = c.select("channel_id", F.explode(F.array_distinct(F.concat(F.array("lead_fid"), F.coalesce("moderator_fids", F.array().cast("array<bigint>"))))).alias("i"))
    return both.filter("i is not null").select("channel_id", "i", F.lit(1.0).alias("v"))


@query("G20_channel_seeds", SQL + f" SELECT channel_id, i FROM {_CHANNEL_SEEDS}")
def g20_seeds(spark: SparkSession, folder: str) -> DataFrame:
    return channel_seeds(spark, folder).select("channel_id", "i")


_CHANNEL_TRUST = (
    _CHANNEL
    + f""", cn AS (SELECT channel_id, i, j, v / sum(v) OVER (PARTITION BY channel_id, i) AS c FROM ce), nodes AS (SELECT channel_id, i AS n FROM ce UNION SELECT channel_id, j FROM ce),
  sd AS (SELECT n.channel_id, n.n, CASE WHEN s.i IS NULL THEN 0 ELSE 1 END AS s FROM nodes n LEFT JOIN {_CHANNEL_SEEDS} s ON s.channel_id = n.channel_id AND s.i = n.n),
  p AS (SELECT channel_id, n, CASE WHEN sum(s) OVER w > 0 THEN s / sum(s) OVER w ELSE 1.0 / count(*) OVER w END AS p, NOT EXISTS (SELECT 1 FROM ce e WHERE e.channel_id = sd.channel_id AND e.i = sd.n) AS sink FROM sd WINDOW w AS (PARTITION BY channel_id)),
  t0 AS MATERIALIZED (SELECT channel_id, n, p AS t FROM p)"""
    + "".join(
        f""", t{k + 1} AS MATERIALIZED (SELECT p.channel_id, p.n, 0.5 * (coalesce(f.flow, 0) + p.p * coalesce(d.lost, 0)) + 0.5 * p.p AS t FROM p
    LEFT JOIN (SELECT cn.channel_id, j AS n, sum(c * t) AS flow FROM cn JOIN t{k} t ON t.channel_id = cn.channel_id AND t.n = cn.i GROUP BY ALL) f ON f.channel_id = p.channel_id AND f.n = p.n
    LEFT JOIN (SELECT p.channel_id, sum(t) AS lost FROM p JOIN t{k} t ON t.channel_id = p.channel_id AND t.n = p.n WHERE sink GROUP BY ALL) d ON d.channel_id = p.channel_id)"""
        for k in range(3)
    )
)


@query("G21_channel_trust_scores", SQL + _CHANNEL_TRUST + " SELECT channel_id, n AS fid, round(t, 9) AS score FROM t3")
def g21_channel_scores(spark: SparkSession, folder: str) -> DataFrame:
    """All channels' graphs in one keyed power iteration of three steps, as in the SQL. G21_channel_trust_scores_settled iterates to the end."""
    scores = eigentrust(channel_trust(spark, folder), channel_seeds(spark, folder), 0.5, 0.0, 3, keys=("channel_id",))
    return scores.select("channel_id", F.col("i").alias("fid"), F.round("v", 9).alias("score"))


@query("G21_channel_trust_scores_settled", None)
def g21_settled(spark: SparkSession, folder: str) -> DataFrame:
    """Until the change, summed over all channels, is under 1e-6; at alpha 0.5 it halves each step, so that 50 steps are enough for a billion channels."""
    scores = eigentrust(channel_trust(spark, folder), channel_seeds(spark, folder), 0.5, 1e-6, 50, keys=("channel_id",))
    return scores.select("channel_id", F.col("i").alias("fid"), F.col("v").alias("score"))


@query("G22_channel_rank_from_graph", None)
def g22_channel_rank(spark: SparkSession, folder: str) -> DataFrame:
    scores = eigentrust(channel_trust(spark, folder), channel_seeds(spark, folder), 0.5, 1e-4, 20, keys=("channel_id",))
    return ranked(scores, ("channel_id",)).select("channel_id", F.col("i").alias("fid"), F.col("v").alias("score"), "rank")


# ---- ranks and profiles

_TOTAL = "(SELECT count(*) FROM grank WHERE strategy_id = 9)"


def _profiles(spark: SparkSession, folder: str) -> DataFrame:
    g = global_rank(spark, folder).filter("strategy_id = 9")
    return g.crossJoin(F.broadcast(g.agg(F.count(F.lit(1)).alias("total"))))


@query("R1_top_profiles", SQL + f" SELECT profile_id AS fid, rank, score, CAST(({_TOTAL} - (rank - 1)) * 100 // {_TOTAL} AS BIGINT) AS percentile FROM grank WHERE strategy_id = 9 ORDER BY rank LIMIT 100 OFFSET 50")
def r1_top_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return _profiles(spark, folder).orderBy("rank").offset(50).limit(100).select(F.col("profile_id").alias("fid"), "rank", "score", whole_percentile("rank", "total").alias("percentile"))


@query("R2_profile_ranks", SQL + f" SELECT profile_id AS fid, rank, score, CAST(({_TOTAL} - (rank - 1)) * 100 // {_TOTAL} AS BIGINT) AS percentile FROM grank WHERE strategy_id = 9 AND profile_id IN (SELECT lead_fid FROM chan)")
def r2_profile_ranks(spark: SparkSession, folder: str) -> DataFrame:
    leads = live_channels(spark, folder).select(F.col("lead_fid").alias("profile_id"))
    return _profiles(spark, folder).join(leads, "profile_id", "left_semi").select(F.col("profile_id").alias("fid"), "rank", "score", whole_percentile("rank", "total").alias("percentile"))


_PEOPLE = """, people AS (SELECT DISTINCT c_custkey AS fid, c_name AS handle, '0xa' || c_custkey AS address FROM customer UNION SELECT s_suppkey, s_name, '0xb' || s_suppkey FROM supplier)"""


def _addresses(spark: SparkSession, folder: str) -> DataFrame:
    """Customers' and suppliers' keys as fids, with a handle and an address of each: fid, handle, address."""
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("fid"), F.col("c_name").alias("handle"), F.concat(F.lit("0xa"), F.col("c_custkey").cast("string")).alias("address"))
    s = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("fid"), F.col("s_name").alias("handle"), F.concat(F.lit("0xb"), F.col("s_suppkey").cast("string")).alias("address"))
    return c.unionByName(s).distinct()


@query("R3_handles_for_addresses", SQL + _PEOPLE + " SELECT address, handle, fid FROM people WHERE address LIKE '%7'")
def r3_handles(spark: SparkSession, folder: str) -> DataFrame:
    return _addresses(spark, folder).filter(F.col("address").like("%7")).select("address", "handle", "fid")


@query("R4_addresses_for_handles", SQL + _PEOPLE + " SELECT p.handle, q.fid, q.address FROM people p JOIN people q ON p.fid = q.fid WHERE p.handle LIKE 'Supplier%'")
def r4_addresses(spark: SparkSession, folder: str) -> DataFrame:
    a = _addresses(spark, folder)
    return a.filter(F.col("handle").like("Supplier%")).select("fid", "handle").join(a.select("fid", "address"), "fid")


@query("R5_one_row_per_fid", SQL + _PEOPLE + " SELECT fid, min(handle) AS handle FROM people GROUP BY fid")
def r5_one_row(spark: SparkSession, folder: str) -> DataFrame:
    return _addresses(spark, folder).groupBy("fid").agg(any_nonnull("handle").alias("handle"))


@query(
    "R6_latest_order_per_customer",
    """SELECT o_custkey AS fid, o_orderkey AS latest, handles FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) o
       JOIN (SELECT o_custkey AS k, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS handles FROM orders GROUP BY 1) h ON h.k = o_custkey WHERE r = 1""",
)
def r6_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The latest row per key and the distinct values of its group, in one aggregation."""
    o = table(spark, folder, "orders")
    return o.groupBy(F.col("o_custkey").alias("fid")).agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("latest"), F.concat_ws(",", distinct_sorted("o_orderpriority")).alias("handles"))


@query("R7_addresses_with_rank", SQL + _PEOPLE + " SELECT p.fid, p.address, g.rank FROM people p LEFT JOIN grank g ON g.profile_id = p.fid + 1000000 AND g.strategy_id = 9")
def r7_with_rank(spark: SparkSession, folder: str) -> DataFrame:
    g = global_rank(spark, folder).filter("strategy_id = 9").select((F.col("profile_id") - 1_000_000).alias("fid"), "rank")
    return _addresses(spark, folder).join(g, "fid", "left").select("fid", "address", "rank")


@query("R8_address_list_per_fid", SQL + _PEOPLE + " SELECT p.fid, string_agg(address, ',' ORDER BY address) AS addresses, min(g.rank) AS rank FROM people p LEFT JOIN grank g ON g.profile_id = p.fid + 1000000 AND g.strategy_id = 9 GROUP BY p.fid")
def r8_address_list(spark: SparkSession, folder: str) -> DataFrame:
    return r7_with_rank(spark, folder).groupBy("fid").agg(F.concat_ws(",", distinct_sorted("address")).alias("addresses"), F.min("rank").alias("rank"))


@query(
    "R10_talkative_low_ranks",
    SQL
    + """, n AS (SELECT l.fid, count(*) FILTER (top) AS casts, count(*) FILTER (NOT top) AS replies, count(*) AS n FROM live l, moment WHERE ts >= at_now - INTERVAL 30 DAY AND ts < at_now GROUP BY l.fid),
    r AS (SELECT n.*, g.score, g.rank, row_number() OVER (ORDER BY n.n / (g.score + 1e-10) DESC, n.fid) AS place, count(*) OVER () AS total FROM n JOIN grank g ON g.profile_id = n.fid AND g.strategy_id = 9)
    SELECT fid, casts, replies, rank, CASE WHEN place <= total * 0.1 THEN 'first tenth' WHEN place <= total * 0.5 THEN 'upper half' ELSE 'lower half' END AS bucket FROM r WHERE n > 3""",
)
def r10_talkative(spark: SparkSession, folder: str) -> DataFrame:
    c = live_casts(spark, folder).filter((F.col("ts") >= now() - F.expr("INTERVAL '30' DAY")) & (F.col("ts") < now()))
    n = c.groupBy("fid").agg(F.count(F.when(F.col("top"), 1)).alias("casts"), F.count(F.when(~F.col("top"), 1)).alias("replies"), F.count(F.lit(1)).alias("n"))
    g = global_rank(spark, folder).filter("strategy_id = 9").select(F.col("profile_id").alias("fid"), "score", "rank")
    r = n.join(g, "fid").select("fid", "casts", "replies", "n", F.col("rank").alias("global"), (F.col("n") / (F.col("score") + F.lit(1e-10))).alias("v"), F.col("fid").alias("i"))
    placed = ranked(r)
    placed = placed.crossJoin(F.broadcast(placed.agg(F.count(F.lit(1)).alias("total"))))
    bucket = F.when(F.col("rank") <= F.col("total") * 0.1, "first tenth").when(F.col("rank") <= F.col("total") * 0.5, "upper half").otherwise("lower half")
    return placed.filter("n > 3").select("fid", "casts", "replies", F.col("global").alias("rank"), bucket.alias("bucket"))


