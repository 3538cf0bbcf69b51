"""Ranked feeds (F of the inventory): one template of actions, posts and rater scores, with parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.semantics import SCORE_AGGREGATES, action_weight, decay, parse_weights, seconds_between, top_share
from ..operators.graph import ranked
from ..operators.topn import top_n_per_group
from ..sources.tables import table
from ..storage import materialise
from .registry import query
from .social import SQL, actions, channel_rank, global_rank, live_casts, live_channels, now


@dataclass(frozen=True)
class Feed:
    weights: str = "L1C10R5Y1"
    aggregate: str = "sum"
    decay_base: float = 1.0
    decay_seconds: int = 86_400
    days: int = 5
    minutes: int = 10
    post_days: int | None = None
    by: tuple[str, ...] = field(default=("cast_id",))


def scored_posts(acts: DataFrame, raters: DataFrame, feed: Feed) -> DataFrame:
    """Per cast (and whatever else `by` names): cast_score, raters, first and last action.

    Actions in the window are weighted, multiplied by the rater's score and the decay of their age, added up per cast and
    rater, and aggregated per cast. raters (fid[, channel_id], score) is the small side of the join, left to the planner.
    """
    at = F.col("action_ts")
    window = acts.filter((at >= now() - F.expr(f"INTERVAL '{feed.days}' DAY")) & (at <= now() - F.expr(f"INTERVAL '{feed.minutes}' MINUTE")))
    keys = ["fid", "channel_id"] if "channel_id" in raters.columns else ["fid"]
    one = action_weight(parse_weights(feed.weights)) * F.col("score") * decay(seconds_between(now(), at), feed.decay_base, feed.decay_seconds)
    per_rater = window.join(raters, keys).groupBy(*feed.by, "fid").agg(F.sum(one).alias("s"), F.min("action_ts").alias("first"), F.max("action_ts").alias("last"))
    return per_rater.groupBy(*feed.by).agg(SCORE_AGGREGATES[feed.aggregate](F.col("s")).alias("cast_score"), F.count(F.lit(1)).alias("raters"), F.min("first").alias("first_action"), F.max("last").alias("last_action"))


def _raters(spark: SparkSession, folder: str, strategy: int = 9, most: int | None = None) -> DataFrame:
    """The profiles of a strategy with their scores: all, or those of rank `most` and better."""
    g = global_rank(spark, folder).filter(F.col("strategy_id") == strategy)
    return (g if most is None else g.filter(F.col("rank") <= most)).select(F.col("profile_id").alias("fid"), "score")


def _window_sql(days: int, weights: tuple[int, int, int, int], decay_: str = "1", raters: str = "SELECT profile_id AS fid, score FROM grank WHERE strategy_id = 9", keys: str = "a.cast_id", on: str = "a.fid = r.fid") -> str:
    like, cast, recast, reply = weights
    return f""", raters AS ({raters}), per AS (SELECT {keys}, a.fid, sum((casted * {cast} + replied * {reply} + recasted * {recast} + liked * {like}) * score * {decay_}) AS s, min(action_ts) AS first_action, max(action_ts) AS last_action
      FROM actions a JOIN raters r ON {on}, moment WHERE action_ts >= at_now - INTERVAL {days} DAY AND action_ts <= at_now - INTERVAL 10 MINUTE GROUP BY ALL)"""


_HOURLY = "pow(1 - 1.0 / 8760, date_diff('microsecond', action_ts, at_now) / 1e6 / 3600)"
_ROUND = "round(CAST({0} AS DOUBLE), 10)"


@query("R9_top_casters", SQL + _window_sql(3, (1, 10, 5, 1), _HOURLY) + """ SELECT l.fid, round(sum(s * s), 12) AS score, count(DISTINCT cast_id) AS casts FROM per JOIN live l ON l.id = per.cast_id, moment
  WHERE l.top AND l.ts >= at_now - INTERVAL 3 DAY AND l.fid NOT IN (SELECT profile_id FROM grank WHERE strategy_id = 9 AND rank <= 100) GROUP BY l.fid""")
def r9_top_casters(spark: SparkSession, folder: str) -> DataFrame:
    feed = Feed("L1C10R5Y1", "sumsquare", 1 - 1 / 8760, 3600, 3)
    posts = live_casts(spark, folder).filter(F.col("top") & (F.col("ts") >= now() - F.expr("INTERVAL '3' DAY"))).select(F.col("id").alias("cast_id"), F.col("fid").alias("author"))
    trusted = global_rank(spark, folder).filter("strategy_id = 9 and rank <= 100").select(F.col("profile_id").alias("author"))
    s = scored_posts(actions(spark, folder), _raters(spark, folder), feed).join(posts.join(trusted, "author", "left_anti"), "cast_id")
    return s.groupBy(F.col("author").alias("fid")).agg(F.round(F.sum("cast_score"), 12).alias("score"), F.count(F.lit(1)).alias("casts"))


@query("R11_score_casts", SQL + _window_sql(400, (1, 10, 5, 7), _HOURLY) + f" SELECT cast_id, {_ROUND.format('sum(s)')} AS score FROM per GROUP BY cast_id")
def r11_score_casts(spark: SparkSession, folder: str) -> DataFrame:
    return scored_posts(actions(spark, folder), _raters(spark, folder), Feed("L1C10R5Y7", "sum", 1 - 1 / 8760, 3600, 400)).select("cast_id", F.round("cast_score", 10).alias("score"))


@query("F1_popular_neighbours_casts", SQL + _window_sql(5, (1, 10, 5, 1), _HOURLY, "SELECT DISTINCT m AS fid, 0.25 AS score FROM (SELECT unnest(moderator_fids) AS m FROM chan)") + f" SELECT cast_id, {_ROUND.format('sum(s)')} AS score, count(*) AS raters FROM per GROUP BY cast_id")
def f1_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    trust = live_channels(spark, folder).select(F.explode("moderator_fids").alias("fid")).distinct().withColumn("score", F.lit(0.25))
    s = scored_posts(actions(spark, folder), trust, Feed("L1C10R5Y1", "sum", 1 - 1 / 8760, 3600, 5))
    return s.select("cast_id", F.round("cast_score", 10).alias("score"), "raters")


@query("F2_recent_neighbours_casts", SQL + """, t AS (SELECT l.id, l.fid, l.ts, date_trunc('hour', l.ts) AS hour, g.score FROM live l JOIN grank g ON g.profile_id = l.fid AND g.strategy_id = 9, moment WHERE l.ts >= at_now - INTERVAL 5 DAY AND l.ts <= at_now)
  SELECT id, fid, row_number() OVER (PARTITION BY hour ORDER BY score DESC, id) AS place FROM t""")
def f2_recent(spark: SparkSession, folder: str) -> DataFrame:
    """Recent casts of trusted users, placed within their hour by score."""
    c = live_casts(spark, folder).filter((F.col("ts") >= now() - F.expr("INTERVAL '5' DAY")) & (F.col("ts") <= now()))
    hour = W.partitionBy(F.date_trunc("hour", F.col("ts"))).orderBy(F.desc("score"), "id")
    return c.join(_raters(spark, folder), "fid").select("id", "fid", F.row_number().over(hour).cast("bigint").alias("place"))


@query("F3_recent_casts_by_fids", SQL + " SELECT id, fid, ts FROM live WHERE fid IN (SELECT lead_fid FROM chan) ORDER BY ts DESC, id LIMIT 100")
def f3_by_fids(spark: SparkSession, folder: str) -> DataFrame:
    leads = live_channels(spark, folder).select(F.col("lead_fid").alias("fid"))
    return live_casts(spark, folder).join(leads, "fid", "left_semi").orderBy(F.desc("ts"), "id").limit(100).select("id", "fid", "ts")


@query("F4_trending_casts", SQL + _window_sql(3, (1, 10, 5, 1), "1", "SELECT profile_id AS fid, score FROM grank WHERE strategy_id = 3 AND rank <= 15000") + f", s AS (SELECT cast_id, {_ROUND.format('sum(s)')} AS score FROM per GROUP BY cast_id) SELECT * FROM s WHERE score * 1e6 > 1")
def f4_trending(spark: SparkSession, folder: str) -> DataFrame:
    s = scored_posts(actions(spark, folder), _raters(spark, folder, 3, 15_000), Feed("L1C10R5Y1", "sum", days=3))
    return s.select("cast_id", F.round("cast_score", 10).alias("score")).filter("score * 1e6 > 1")


_CHANNEL_RATERS = "SELECT channel_id, fid, score FROM crank WHERE strategy_name = 'channel_engagement'"
_AGE = "CAST(floor(date_diff('microsecond', l.ts, at_now) / 1e6 / 3600) AS BIGINT)"


def _channel_feed(spark: SparkSession, folder: str, feed: Feed) -> DataFrame:
    raters = channel_rank(spark, folder).filter("strategy_name = 'channel_engagement'").select("channel_id", "fid", "score")
    posts = live_casts(spark, folder).filter("top and channel_id is not null").select(F.col("id").alias("cast_id"), "channel_id", F.col("fid").alias("author"), "ts")
    s = scored_posts(actions(spark, folder), raters, feed)
    return s.join(posts, ["cast_id", "channel_id"]).withColumn("age_hours", F.floor(seconds_between(now(), F.col("ts")) / 3600).cast("bigint"))


@query("F5_popular_channel_casts", SQL + _window_sql(30, (1, 10, 5, 1), "1", _CHANNEL_RATERS, "a.cast_id, a.channel_id", "a.fid = r.fid AND a.channel_id = r.channel_id") + f""", s AS (SELECT cast_id, channel_id, sqrt(avg(s * s)) AS score, count(*) - 1 AS reactions FROM per GROUP BY ALL)
  SELECT s.cast_id, s.channel_id, {_ROUND.format('score')} AS score, reactions, {_AGE} AS age_hours, row_number() OVER (PARTITION BY s.channel_id ORDER BY {_ROUND.format('score')} DESC, s.cast_id) AS place FROM s JOIN live l ON l.id = s.cast_id AND l.channel_id = s.channel_id, moment WHERE l.top""")
def f5_popular_channel(spark: SparkSession, folder: str) -> DataFrame:
    """All channels at once, each ranked by itself."""
    s = _channel_feed(spark, folder, Feed("L1C10R5Y1", "rms", days=30, by=("cast_id", "channel_id"))).withColumn("score", F.round("cast_score", 10))
    place = F.row_number().over(W.partitionBy("channel_id").orderBy(F.desc("score"), "cast_id"))
    return s.select("cast_id", "channel_id", "score", (F.col("raters") - 1).alias("reactions"), "age_hours", place.cast("bigint").alias("place"))


@query("F6_trending_channel_casts", SQL + _window_sql(7, (1, 10, 5, 1), "1", _CHANNEL_RATERS, "a.cast_id, a.channel_id", "a.fid = r.fid AND a.channel_id = r.channel_id") + f""", s AS (SELECT cast_id, channel_id, {_ROUND.format('sum(s)')} AS score FROM per GROUP BY ALL),
  n AS (SELECT s.*, ntile(100) OVER (PARTITION BY s.channel_id ORDER BY score DESC, s.cast_id) AS tile FROM s JOIN live l ON l.id = s.cast_id AND l.channel_id = s.channel_id, moment WHERE l.top AND l.ts >= at_now - INTERVAL 7 DAY) SELECT * FROM n WHERE tile <= 50""")
def f6_trending_channel(spark: SparkSession, folder: str) -> DataFrame:
    s = _channel_feed(spark, folder, Feed("L1C10R5Y1", "sum", days=7, by=("cast_id", "channel_id"))).filter(F.col("ts") >= now() - F.expr("INTERVAL '7' DAY"))
    s = s.withColumn("score", F.round("cast_score", 10))
    tile = F.ntile(100).over(W.partitionBy("channel_id").orderBy(F.desc("score"), "cast_id"))
    return s.select("cast_id", "channel_id", "score", tile.cast("bigint").alias("tile")).filter("tile <= 50")


@query("F8_top_channel_casts_in_window", SQL + f""", w AS (SELECT l.id, l.channel_id, a.fid, sum(cbrt(r.score)) AS s FROM live l JOIN actions a ON a.cast_id = l.id AND a.action_ts >= l.ts AND a.action_ts < l.ts + INTERVAL 24 HOUR
    JOIN crank r ON r.channel_id = l.channel_id AND r.fid = a.fid AND r.strategy_name = 'channel_engagement' WHERE l.top GROUP BY ALL)
  SELECT id AS cast_id, channel_id, {_ROUND.format('sum(s)')} AS score, count(*) AS raters FROM w GROUP BY ALL""")
def f8_interval(spark: SparkSession, folder: str) -> DataFrame:
    """Reactions within 24 hours of the post, weighted by the cube root of the rater's channel score: an equi-join with a range on top."""
    posts = live_casts(spark, folder).filter("top and channel_id is not null").select(F.col("id").alias("cast_id"), "channel_id", "ts")
    acts = actions(spark, folder).select("cast_id", "fid", "action_ts")
    near = posts.join(acts, "cast_id").filter((F.col("action_ts") >= F.col("ts")) & (F.col("action_ts") < F.col("ts") + F.expr("INTERVAL '24' HOUR")))
    raters = channel_rank(spark, folder).filter("strategy_name = 'channel_engagement'").select("channel_id", "fid", F.cbrt("score").alias("s"))
    per = near.join(raters, ["channel_id", "fid"]).groupBy("cast_id", "channel_id", "fid").agg(F.sum("s").alias("s"))
    return per.groupBy("cast_id", "channel_id").agg(F.round(F.sum("s"), 10).alias("score"), F.count(F.lit(1)).alias("raters"))


_HOLD = "SELECT 1000000 + o_custkey % 2000 AS fid, sum(o_totalprice) AS score FROM orders GROUP BY 1"


@query("F9_token_holder_casts", SQL + _window_sql(10, (1, 10, 5, 1), "1", _HOLD) + """, s AS (SELECT cast_id, round(sum(s), 2) AS score FROM per GROUP BY cast_id), b AS (SELECT quantile_cont(score, 0.5) AS bar FROM s),
  n AS (SELECT s.*, l.fid AS author, CAST(floor(date_diff('microsecond', l.ts, at_now) / 1e6 / 86400) AS BIGINT) AS bucket FROM s, b, moment, live l WHERE l.id = s.cast_id AND l.top AND score >= bar)
  SELECT cast_id, author, bucket, score FROM (SELECT *, row_number() OVER (PARTITION BY bucket, author ORDER BY score DESC, cast_id) AS r FROM n) WHERE r <= 3""")
def f9_holders(spark: SparkSession, folder: str) -> DataFrame:
    """Casts rated by token holders: at or above the median score, at most three per author and day bucket."""
    holders = table(spark, folder, "orders").groupBy((1_000_000 + F.col("o_custkey") % 2000).alias("fid")).agg(F.sum("o_totalprice").alias("score"))
    s = scored_posts(actions(spark, folder), holders, Feed("L1C10R5Y1", "sum", days=10)).select("cast_id", F.round("cast_score", 2).alias("score"))
    posts = live_casts(spark, folder).filter("top").select(F.col("id").alias("cast_id"), F.col("fid").alias("author"), F.floor(seconds_between(now(), F.col("ts")) / 86_400).cast("bigint").alias("bucket"))
    return top_n_per_group(top_share(s, "score", 0.5).join(posts, "cast_id"), ["bucket", "author"], "cast_id", "score", 3).select("cast_id", "author", "bucket", "score")


@query("F10_new_user_casts", SQL + """, fresh AS (SELECT fid FROM live GROUP BY fid HAVING min(ts) >= (SELECT at_now - INTERVAL 30 DAY FROM moment) UNION SELECT target_fid FROM reactions GROUP BY target_fid HAVING min(ts) >= (SELECT at_now - INTERVAL 20 DAY FROM moment))
  SELECT id, fid, bucket FROM (SELECT l.id, l.fid, CAST(floor(date_diff('microsecond', l.ts, at_now) / 1e6 / 86400) AS BIGINT) AS bucket, row_number() OVER (PARTITION BY l.fid, CAST(floor(date_diff('microsecond', l.ts, at_now) / 1e6 / 86400) AS BIGINT) ORDER BY l.ts DESC, l.id) AS r
    FROM live l, moment WHERE l.fid IN (SELECT fid FROM fresh) AND l.top AND l.ts <= at_now) WHERE r <= 3""")
def f10_new_users(spark: SparkSession, folder: str) -> DataFrame:
    from .social import reactions

    c = live_casts(spark, folder)
    fresh = c.groupBy("fid").agg(F.min("ts").alias("first")).filter(F.col("first") >= now() - F.expr("INTERVAL '30' DAY")).select("fid")
    noticed = reactions(spark, folder).groupBy(F.col("target_fid").alias("fid")).agg(F.min("ts").alias("first")).filter(F.col("first") >= now() - F.expr("INTERVAL '20' DAY")).select("fid")
    own = c.join(fresh.union(noticed).distinct(), "fid", "left_semi").filter(F.col("top") & (F.col("ts") <= now()))
    own = own.withColumn("bucket", F.floor(seconds_between(now(), F.col("ts")) / 86_400).cast("bigint"))
    r = F.row_number().over(W.partitionBy("fid", "bucket").orderBy(F.desc("ts"), "id"))
    return own.withColumn("r", r).filter("r <= 3").select("id", "fid", "bucket")


@query("F11_page_per_day", SQL + _window_sql(10, (1, 10, 5, 1)) + f""", s AS (SELECT cast_id, {_ROUND.format('sum(s)')} AS score FROM per GROUP BY cast_id)
  SELECT cast_id, score, day FROM (SELECT s.*, CAST(l.ts AS DATE) AS d, strftime(l.ts, '%Y-%m-%d') AS day, row_number() OVER (PARTITION BY CAST(l.ts AS DATE) ORDER BY score DESC, cast_id) AS r FROM s JOIN live l ON l.id = s.cast_id) WHERE r > 5 AND r <= 15""")
def f11_page_per_day(spark: SparkSession, folder: str) -> DataFrame:
    s = scored_posts(actions(spark, folder), _raters(spark, folder), Feed("L1C10R5Y1", "sum", days=10)).select("cast_id", F.round("cast_score", 10).alias("score"))
    posts = live_casts(spark, folder).select(F.col("id").alias("cast_id"), F.col("ts").cast("date").cast("string").alias("day"))
    return top_n_per_group(s.join(posts, "cast_id"), ["day"], "cast_id", "score", 15).filter("position > 5").select("cast_id", "score", "day")


@query("F12_token_casts", SQL + f""", t AS (SELECT id FROM live WHERE text ILIKE '%$ORBIT9%' OR text ILIKE '%$QUILL%') SELECT a.cast_id, {_ROUND.format('sum((casted * 10 + replied + recasted * 5 + liked) * coalesce(g.score, 1e-5))')} AS score
  FROM actions a LEFT JOIN grank g ON g.profile_id = a.fid AND g.strategy_id = 9 WHERE a.cast_id IN (SELECT id FROM t) GROUP BY a.cast_id""")
def f12_token_casts(spark: SparkSession, folder: str) -> DataFrame:
    """Casts that name a ticker; unknown raters count a little."""
    named = live_casts(spark, folder, "text").filter(F.col("text").ilike("%$ORBIT9%") | F.col("text").ilike("%$QUILL%")).select(F.col("id").alias("cast_id"))
    a = actions(spark, folder).join(named, "cast_id", "left_semi").join(_raters(spark, folder), "fid", "left")
    s = action_weight(parse_weights("L1C10R5Y1")) * F.coalesce("score", F.lit(1e-5))
    return a.groupBy("cast_id").agg(F.round(F.sum(s), 10).alias("score"))


@query("F13_merged_pages", SQL + """, a AS (SELECT id, fid, ts, 1 AS src FROM live WHERE top ORDER BY ts DESC, id LIMIT 300), b AS (SELECT id, fid, ts, 2 AS src FROM live WHERE channel_id IS NOT NULL ORDER BY ts DESC, id LIMIT 300),
  u AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY src) AS r FROM (SELECT * FROM a UNION ALL SELECT * FROM b)) SELECT id, fid, ts, src FROM u WHERE r = 1 AND ts >= greatest((SELECT min(ts) FROM a), (SELECT min(ts) FROM b))""")
def f13_merged_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Two pages of a feed as one: the first source of a repeated cast holds, cut at the cursor that both have reached."""
    c = live_casts(spark, folder)
    page = lambda df, src: df.orderBy(F.desc("ts"), "id").limit(300).select("id", "fid", "ts", F.lit(src).alias("src"))
    a, b = page(c.filter("top"), 1), page(c.filter("channel_id is not null"), 2)
    both = a.unionByName(b)
    cut = both.groupBy("src").agg(F.min("ts").alias("m")).agg(F.max("m").alias("cut"))
    once = both.withColumn("r", F.row_number().over(W.partitionBy("id").orderBy("src"))).filter("r = 1").drop("r")
    return once.crossJoin(F.broadcast(cut)).filter(F.col("ts") >= F.col("cut")).drop("cut")


@query("F15_trending_channels", SQL + " SELECT l.channel_id, count(*) AS casts FROM live l JOIN grank g ON g.profile_id = l.fid AND g.strategy_id = 9 AND g.rank <= 10000, moment WHERE l.channel_id IS NOT NULL AND l.ts >= at_now - INTERVAL 7 DAY AND l.ts <= at_now GROUP BY ALL")
def f15_trending_channels(spark: SparkSession, folder: str) -> DataFrame:
    c = live_casts(spark, folder).filter((F.col("ts") >= now() - F.expr("INTERVAL '7' DAY")) & (F.col("ts") <= now()) & F.col("channel_id").isNotNull())
    return c.join(_raters(spark, folder, 9, 10_000).select("fid"), "fid", "left_semi").groupBy("channel_id").agg(F.count(F.lit(1)).alias("casts"))


_LINKS = ", links AS (SELECT id, fid, unnest(regexp_extract_all(text, 'https?://[A-Za-z0-9./_~-]+')) AS url FROM live)"


def _links(spark: SparkSession, folder: str) -> DataFrame:
    """Each link in a live cast's text: id, fid, url."""
    return live_casts(spark, folder, "text").select("id", "fid", F.explode(F.regexp_extract_all("text", F.lit(r"(https?://[A-Za-z0-9./_~-]+)"), F.lit(1))).alias("url"))


@query("F16_top_frames", SQL + _LINKS + f""", v AS (SELECT k.url, a.fid, max((casted * 10 + replied * 7 + recasted * 5 + liked) * g.score) AS s, min(k.id) AS c FROM (SELECT DISTINCT id, url FROM links) k JOIN actions a ON a.cast_id = k.id JOIN grank g ON g.profile_id = a.fid AND g.strategy_id = 3 GROUP BY ALL)
  SELECT url, {_ROUND.format('sum(s)')} AS score, count(*) AS voters FROM v GROUP BY url""")
def f16_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Links by the scores of those who acted on casts with them; a voter counts once per link, with the largest vote."""
    links = _links(spark, folder).select(F.col("id").alias("cast_id"), "url").distinct()
    a = actions(spark, folder).join(links, "cast_id").join(_raters(spark, folder, 3), "fid")
    votes = a.groupBy("url", "fid").agg(F.max(action_weight(parse_weights("L1C10R5Y7")) * F.col("score")).alias("s"))
    return votes.groupBy("url").agg(F.round(F.sum("s"), 10).alias("score"), F.count(F.lit(1)).alias("voters"))


@query("F17_trending_tickers", SQL + f""", t AS (SELECT DISTINCT id, unnest(regexp_extract_all(text, '[$][A-Z][A-Z0-9]+')) AS token FROM live)
  SELECT token, {_ROUND.format("sum(pow(0.9, greatest(date_diff('microsecond', action_ts, at_now), 0) / 86400e6) * (casted * 10 + replied * 7 + recasted * 5 + liked) * g.score)")} AS score,
  count(DISTINCT t.id) AS casts, count(DISTINCT t.id) FILTER (action_ts >= at_now - INTERVAL 7 DAY) AS recent FROM t JOIN actions a ON a.cast_id = t.id JOIN grank g ON g.profile_id = a.fid AND g.strategy_id = 9, moment WHERE action_ts <= at_now GROUP BY token""")
def f17_tickers(spark: SparkSession, folder: str) -> DataFrame:
    t = live_casts(spark, folder, "text").select(F.col("id").alias("cast_id"), F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"([$][A-Z][A-Z0-9]+)"), F.lit(1)))).alias("token"))
    a = actions(spark, folder).filter(F.col("action_ts") <= now()).join(t, "cast_id").join(_raters(spark, folder), "fid")
    one = decay(F.greatest(seconds_between(now(), F.col("action_ts")), F.lit(0.0)), 0.9, 86_400) * action_weight(parse_weights("L1C10R5Y7")) * F.col("score")
    recent = F.col("action_ts") >= now() - F.expr("INTERVAL '7' DAY")
    return a.groupBy("token").agg(F.round(F.sum(one), 10).alias("score"), F.countDistinct("cast_id").alias("casts"), F.countDistinct(F.when(recent, F.col("cast_id"))).alias("recent"))


@query("F18_leaderboard_with_shared_ranks", SQL + _window_sql(10, (1, 10, 5, 1)) + """, s AS (SELECT l.fid, round(cbrt(sum(s)), 6) AS w FROM per JOIN live l ON l.id = per.cast_id GROUP BY l.fid)
  SELECT fid, w, round(w / (SELECT sum(w) FROM s), 8) AS share, rank() OVER (ORDER BY w DESC) AS place FROM s""")
def f18_leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    """Authors by the cube root of what their casts got, with shares; equal ones share a place, which is one more than the number of authors above."""
    posts = live_casts(spark, folder).select(F.col("id").alias("cast_id"), F.col("fid").alias("author"))
    s = scored_posts(actions(spark, folder), _raters(spark, folder), Feed("L1C10R5Y1", "sum", days=10)).join(posts, "cast_id")
    w = s.groupBy(F.col("author").alias("fid")).agg(F.round(F.cbrt(F.sum("cast_score")), 6).alias("w"))
    w = materialise(w, "authors")
    above = ranked(w.select(F.col("w").alias("v"), F.col("fid").alias("i"))).groupBy(F.col("v").alias("w")).agg(F.min("rank").alias("place"))
    total = w.agg(F.sum("w").alias("total"))
    return w.crossJoin(F.broadcast(total)).join(above, "w").select("fid", "w", F.round(F.col("w") / F.col("total"), 8).alias("share"), "place")


@query("F20_sampled_channels_per_fid", SQL + " SELECT fid, channel_id FROM (SELECT fid, channel_id, row_number() OVER (PARTITION BY fid ORDER BY md5('7' || channel_id), channel_id) AS r FROM (SELECT DISTINCT fid, channel_id FROM crank)) WHERE r <= 3")
def f20_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Up to three channels of each fid, in an order that only a seed and the names decide."""
    own = channel_rank(spark, folder).select("fid", "channel_id").distinct()
    r = F.row_number().over(W.partitionBy("fid").orderBy(F.md5(F.concat(F.lit("7"), "channel_id")), "channel_id"))
    return own.withColumn("r", r).filter("r <= 3").drop("r")


@query("F21_token_balances", "SELECT o_custkey AS fid, round(sum(o_totalprice), 2) AS balance FROM orders GROUP BY 1 HAVING sum(o_totalprice) > 0 ORDER BY 2 DESC, 1 LIMIT 100")
def f21_balances(spark: SparkSession, folder: str) -> DataFrame:
    b = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("fid")).agg(F.round(F.sum("o_totalprice"), 2).alias("balance"))
    return b.filter("balance > 0").orderBy(F.desc("balance"), "fid").limit(100)
