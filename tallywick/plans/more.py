"""Further named queries: roots, backfill, search, fan-out over channels, followers, balances."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import local_trust, merge_interactions
from ..operators.topn import top_n_per_group
from ..sources.tables import table
from .feeds import Feed, _channel_feed, _window_sql
from .registry import query
from .social import SQL, actions, current_casts, global_rank, interactions, live_casts, live_channels, now, reactions

_RATERS = "SELECT channel_id, fid, score FROM crank WHERE strategy_name = 'channel_engagement'"


@query("I2_backfill_month", SQL + " SELECT cast_id, fid, action_ts, casted, replied, recasted, liked FROM actions WHERE action_ts >= TIMESTAMP '2025-01-01' AND action_ts < TIMESTAMP '2025-02-01'")
def i2_backfill(spark: SparkSession, folder: str) -> DataFrame:
    month = lambda x: F.lit(x).cast("timestamp_ntz")
    a = actions(spark, folder).filter((F.col("action_ts") >= month("2025-01-01 00:00:00")) & (F.col("action_ts") < month("2025-02-01 00:00:00")))
    return a.drop("channel_id")


@query("I15_roots_of_new_replies", SQL + " SELECT n.id, CASE WHEN p.id IS NULL THEN NULL ELSE '0x' || lower(hex(coalesce(p.root_parent_hash, p.hash))) END AS root, p.root_parent_url AS url FROM cur n LEFT JOIN cur p ON n.parent_hash = p.hash WHERE octet_length(n.parent_hash) > 0")
def i15_roots(spark: SparkSession, folder: str) -> DataFrame:
    """Every reply takes root and channel of the cast it answers, as stored; a parent without root is one itself."""
    c = current_casts(spark, folder, "hash", "parent_hash", "root_parent_hash", "root_parent_url")
    known = c.select(F.col("hash").alias("parent_hash"), F.coalesce("root_parent_hash", "hash").alias("root"), F.col("root_parent_url").alias("url"))
    new = c.filter("length(parent_hash) > 0").select("id", "parent_hash")
    return new.join(known, "parent_hash", "left").select("id", F.concat(F.lit("0x"), F.lower(F.hex("root"))).alias("root"), "url")


@query("F7_scores_of_given_casts", SQL + _window_sql(400, (1, 10, 5, 1), "1", _RATERS, "a.cast_id, a.channel_id", "a.fid = r.fid AND a.channel_id = r.channel_id") + " SELECT cast_id, channel_id, round(sum(s), 10) AS score FROM per WHERE cast_id IN (SELECT id FROM live WHERE fid IN (SELECT lead_fid FROM chan) AND top) GROUP BY ALL HAVING sum(s) > 0")
def f7_given(spark: SparkSession, folder: str) -> DataFrame:
    """The channel feed's scores of a given list of casts, those of the channels' leads."""
    leads = live_channels(spark, folder).select(F.col("lead_fid").alias("author"))
    s = _channel_feed(spark, folder, Feed("L1C10R5Y1", "sum", days=400, by=("cast_id", "channel_id"))).join(leads, "author", "left_semi")
    return s.select("cast_id", "channel_id", F.round("cast_score", 10).alias("score")).filter("score > 0")


@query("F14_for_you_over_all_channels", SQL + _window_sql(14, (1, 10, 5, 1), "1", _RATERS, "a.cast_id, a.channel_id", "a.fid = r.fid AND a.channel_id = r.channel_id") + """, s AS (SELECT p.channel_id, p.cast_id, round(sum(s), 10) AS score FROM per p JOIN live l ON l.id = p.cast_id AND l.channel_id = p.channel_id WHERE l.top GROUP BY ALL),
  n AS (SELECT s.*, row_number() OVER (PARTITION BY s.channel_id ORDER BY score DESC, cast_id) AS place FROM s), f AS (SELECT channel_id, fid FROM crank WHERE strategy_name = 'channel_engagement' AND rank <= 3)
  SELECT f.fid, n.channel_id, n.cast_id, n.score FROM n JOIN f ON f.channel_id = n.channel_id WHERE place <= 5""")
def f14_for_you(spark: SparkSession, folder: str) -> DataFrame:
    """The five best casts of every channel once, given to each of its three leading members: one job instead of one per channel."""
    from .social import channel_rank

    s = _channel_feed(spark, folder, Feed("L1C10R5Y1", "sum", days=14, by=("cast_id", "channel_id"))).withColumn("score", F.round("cast_score", 10))
    best = top_n_per_group(s, ["channel_id"], "cast_id", "score", 5)
    members = channel_rank(spark, folder).filter("strategy_name = 'channel_engagement' and rank <= 3").select("channel_id", "fid")
    return best.join(members, "channel_id").select("fid", "channel_id", "cast_id", "score")


@query("F19_channel_search", SQL + " SELECT channel_id, CASE WHEN channel_id ILIKE 'ma%' THEN 1 WHEN url ILIKE '%ma%' THEN 2 ELSE 3 END AS place FROM chan WHERE channel_id ILIKE 'ma%' OR url ILIKE '%/ma%'")
def f19_search(spark: SparkSession, folder: str) -> DataFrame:
    c = live_channels(spark, folder).filter(F.col("channel_id").ilike("ma%") | F.col("url").ilike("%/ma%"))
    return c.select("channel_id", F.when(F.col("channel_id").ilike("ma%"), 1).when(F.col("url").ilike("%ma%"), 2).otherwise(3).alias("place"))


@query("N2_distinct_reactions", SQL + " SELECT DISTINCT cast_id, fid, reaction_type FROM reactions")
def n2_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return reactions(spark, folder).select("cast_id", "fid", "reaction_type").distinct()


@query("N8_followers_of_leaders", SQL + ", n AS (SELECT j AS fid, count(*) AS followers FROM follows GROUP BY j) SELECT g.profile_id AS fid, g.rank, coalesce(n.followers, 0) AS followers FROM grank g LEFT JOIN n ON n.fid = g.profile_id WHERE g.strategy_id = 9 AND g.rank <= 10000")
def n8_followers(spark: SparkSession, folder: str) -> DataFrame:
    f = interactions(spark, folder)["follows"].select("i", "j").distinct().groupBy(F.col("j").alias("fid")).agg(F.count(F.lit(1)).alias("n"))
    g = global_rank(spark, folder).filter("strategy_id = 9 and rank <= 10000").select(F.col("profile_id").alias("fid"), "rank")
    return g.join(f, "fid", "left").select("fid", "rank", F.coalesce("n", F.lit(0)).alias("followers"))


@query("G18_follow_edges_of_ranked", SQL + " SELECT DISTINCT f.i, f.j FROM follows f WHERE f.i <> f.j AND f.j IN (SELECT profile_id FROM grank WHERE strategy_id = 9)")
def g18_edges(spark: SparkSession, folder: str) -> DataFrame:
    pairs = merge_interactions({k: d.select("i", "j") for k, d in interactions(spark, folder).items()})
    ranked = global_rank(spark, folder).filter("strategy_id = 9").select(F.col("profile_id").alias("j"))
    return local_trust(pairs, 1).join(ranked, "j", "left_semi").select("i", "j")


@query("R12_neighbours_with_profiles", SQL + ", n AS (SELECT target_fid AS fid, count(*) AS trust FROM reactions WHERE fid IN (SELECT profile_id FROM grank WHERE strategy_id = 9 AND rank <= 20) AND fid <> target_fid GROUP BY 1) SELECT n.fid, trust, g.rank FROM n LEFT JOIN grank g ON g.profile_id = n.fid AND g.strategy_id = 9")
def r12_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Whom the twenty best react to, with their ranks."""
    g = global_rank(spark, folder).filter("strategy_id = 9").select(F.col("profile_id").alias("fid"), "rank")
    r = reactions(spark, folder).filter("fid != target_fid").join(g.filter("rank <= 20").select("fid"), "fid", "left_semi")
    return r.groupBy(F.col("target_fid").alias("fid")).agg(F.count(F.lit(1)).alias("trust")).join(g, "fid", "left")


@query("C18_balance_pages", "WITH b AS (SELECT o_custkey AS fid, round(sum(o_totalprice), 2) AS balance, max(o_orderdate) AS updated FROM orders GROUP BY 1) SELECT fid, balance, CASE WHEN updated < TIMESTAMP '1998-01-01' THEN 0 ELSE balance END AS fresh, place FROM (SELECT *, row_number() OVER (ORDER BY balance DESC, fid) AS place FROM b) WHERE place > 50 AND place <= 150")
def c18_pages(spark: SparkSession, folder: str) -> DataFrame:
    from ..operators.graph import ranked

    b = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("i")).agg(F.round(F.sum("o_totalprice"), 2).alias("v"), F.max("o_orderdate").alias("updated"))
    page = ranked(b).filter("rank > 50 and rank <= 150")
    fresh = F.when(F.col("updated") < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"), 0.0).otherwise(F.col("v"))
    return page.select(F.col("i").alias("fid"), F.col("v").alias("balance"), fresh.alias("fresh"), F.col("rank").alias("place"))


@query("C21_totals_by_request", "SELECT o_orderpriority AS request, count(*) AS rounds, round(sum(o_totalprice), 2) AS amount, round(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 2) AS paid FROM orders GROUP BY 1")
def c21_totals(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("request"))
    return o.agg(F.count(F.lit(1)).alias("rounds"), F.round(F.sum("o_totalprice"), 2).alias("amount"), F.round(F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))), 2).alias("paid"))


@query("T10_recent_lookback", SQL + " SELECT count(*) FILTER (ts >= at_now - INTERVAL 1 DAY) AS day, count(*) FILTER (ts >= at_now - INTERVAL 7 DAY) AS week, count(*) FILTER (ts >= at_now - INTERVAL 1 MONTH) AS month FROM live, moment WHERE ts <= at_now")
def t10_lookback(spark: SparkSession, folder: str) -> DataFrame:
    since = lambda unit: F.count(F.when(F.col("ts") >= now() - F.expr(f"INTERVAL '1' {unit}"), 1))
    week = F.count(F.when(F.col("ts") >= now() - F.expr("INTERVAL '7' DAY"), 1))
    return live_casts(spark, folder).filter(F.col("ts") <= now()).agg(since("DAY").alias("day"), week.alias("week"), since("MONTH").alias("month"))
