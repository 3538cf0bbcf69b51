"""Ingestion, state and channels (I, K, T and C of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.semantics import hex_text, ntile_of, pct_rank_average, split_exactly, week_end_9am
from ..functions.urls import rebuilt, url_parts
from ..operators.state import additive_upsert, changes_to_counts, fold_log, insert_ignore, keep_missing, overwrite_upsert, safe_cursor, within_drift
from ..operators.topn import top_n_per_group
from ..sources.tables import table
from ..storage import materialise
from .registry import query
from .social import SQL, actions, channel_rank, current_casts, global_rank, live_casts, live_channels, now, reactions, replies

# ---- ingestion


@query("I1_cast_actions", SQL + " SELECT cast_id, fid, action_ts, channel_id, casted, replied, recasted, liked FROM actions")
def i1_actions(spark: SparkSession, folder: str) -> DataFrame:
    return actions(spark, folder)


@query("I3_gap_fill", SQL + ", have AS MATERIALIZED (SELECT cast_id, fid, action_ts FROM actions), known AS MATERIALIZED (SELECT * FROM have WHERE (cast_id + fid) % 3 <> 0) SELECT a.cast_id, a.fid, a.action_ts FROM have a ANTI JOIN known k ON k.cast_id = a.cast_id AND k.fid = a.fid AND k.action_ts = a.action_ts")
def i3_gap_fill(spark: SparkSession, folder: str) -> DataFrame:
    """The actions that a table with gaps (every third missing) lacks."""
    a = actions(spark, folder).select("cast_id", "fid", "action_ts")
    return a.join(a.filter("(cast_id + fid) % 3 != 0"), ["cast_id", "fid", "action_ts"], "left_anti")


@query("I4_T5_reply_deltas", """WITH last AS (SELECT id, arg_max(fid, updated_at) AS s, arg_max(parent_fid, updated_at) AS t, arg_max(deleted_at IS NULL, updated_at) AS live FROM casts WHERE parent_fid IS NOT NULL GROUP BY id),
  d AS (SELECT s AS source, t AS target, CASE WHEN live AND id % 2 = 1 THEN 1 WHEN NOT live AND id % 2 = 0 THEN -1 ELSE 0 END AS d FROM last)
  SELECT source, target, CAST(sum(d) AS BIGINT) AS delta FROM d GROUP BY ALL HAVING sum(d) <> 0""")
def i4_deltas(spark: SparkSession, folder: str) -> DataFrame:
    """Changes of reply counts by a chunk of changed casts, where those with even ids were counted before."""
    rows = table(spark, folder, "casts").filter("parent_fid is not null").select("id", F.col("fid").alias("source"), F.col("parent_fid").alias("target"), "updated_at", "deleted_at")
    return changes_to_counts(rows, rows.filter("id % 2 = 0").select("id").distinct(), "source", "target")[0]


@query("T4_safe_cursor", "SELECT DISTINCT updated_at AS cursor FROM casts ORDER BY 1 DESC LIMIT 1 OFFSET 1")
def t4_cursor(spark: SparkSession, folder: str) -> DataFrame:
    return safe_cursor(table(spark, folder, "casts"), "updated_at")


_URLS = ", links AS (SELECT id, created, unnest(regexp_extract_all(text, 'https?://[A-Za-z0-9./_~-]+')) AS url FROM (SELECT id, text, created_at AS created FROM cur WHERE deleted_at IS NULL))"


def _links(spark: SparkSession, folder: str) -> DataFrame:
    c = current_casts(spark, folder, "text", "created_at", "deleted_at").filter("deleted_at is null")
    return c.select("id", "created_at", F.explode(F.regexp_extract_all("text", F.lit(r"(https?://[A-Za-z0-9./_~-]+)"), F.lit(1))).alias("url"))


@query("I5_url_labels", SQL + _URLS + " SELECT url, min(created) AS earliest, max(created) AS latest FROM links WHERE NOT url LIKE '%/digest/%' GROUP BY url")
def i5_labels(spark: SparkSession, folder: str) -> DataFrame:
    return _links(spark, folder).filter(~F.col("url").like("%/digest/%")).groupBy("url").agg(F.min("created_at").alias("earliest"), F.max("created_at").alias("latest"))


@query("I6_cast_url_mapping", SQL + _URLS + " SELECT DISTINCT id AS cast_id, url FROM links")
def i6_mapping(spark: SparkSession, folder: str) -> DataFrame:
    return _links(spark, folder).select(F.col("id").alias("cast_id"), "url").distinct()


@query("I7_url_parts", "SELECT DISTINCT url, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, split_part(regexp_extract(url, '://([^/]+)', 1), '.', 1) AS domain, split_part(regexp_extract(url, '://([^/]+)', 1), '.', 2) AS tld, regexp_extract(url, '://[^/]+(/.*)', 1) AS path, url AS again FROM channels WHERE url LIKE 'https://%'")
def i7_parts(spark: SparkSession, folder: str) -> DataFrame:
    u = table(spark, folder, "channels").filter(F.col("url").like("https://%")).select("url").distinct().withColumn("p", url_parts("url"))
    return u.select("url", "p.scheme", "p.domain", "p.tld", "p.path", rebuilt("p").alias("again"))


@query("I8_frame_interactions", SQL + _URLS + " SELECT DISTINCT a.fid, k.url, CASE WHEN casted = 1 THEN 'cast' WHEN recasted = 1 THEN 'recast' ELSE 'like' END AS kind FROM links k JOIN actions a ON a.cast_id = k.id, moment WHERE replied = 0 AND action_ts >= at_now - INTERVAL 30 DAY AND action_ts <= at_now")
def i8_frames(spark: SparkSession, folder: str) -> DataFrame:
    a = actions(spark, folder).filter((F.col("replied") == 0) & (F.col("action_ts") >= now() - F.expr("INTERVAL '30' DAY")) & (F.col("action_ts") <= now()))
    kind = F.when(F.col("casted") == 1, "cast").when(F.col("recasted") == 1, "recast").otherwise("like")
    return a.join(i6_mapping(spark, folder), "cast_id").select("fid", "url", kind.alias("kind")).distinct()


@query("I9_recent_parent_casts", SQL + " SELECT id, fid, ts, channel_id FROM live, moment WHERE top AND ts >= at_now - INTERVAL 30 DAY AND ts <= at_now")
def i9_recent(spark: SparkSession, folder: str) -> DataFrame:
    c = live_casts(spark, folder).filter(F.col("top") & (F.col("ts") >= now() - F.expr("INTERVAL '30' DAY")) & (F.col("ts") <= now()))
    return c.select("id", "fid", "ts", "channel_id")


@query("I10_token_holding_fids", "SELECT c_custkey AS fid, o_orderpriority AS token, round(sum(o_totalprice), 2) AS value FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL HAVING sum(o_totalprice) > 1000")
def i10_holding(spark: SparkSession, folder: str) -> DataFrame:
    o, c = table(spark, folder, "orders"), table(spark, folder, "customer").select("c_custkey")
    return o.join(c, o["o_custkey"] == c["c_custkey"]).groupBy(F.col("c_custkey").alias("fid"), F.col("o_orderpriority").alias("token")).agg(F.round(F.sum("o_totalprice"), 2).alias("value")).filter("value > 1000")


@query("I11_tips_in_texts", SQL + """, t AS (SELECT id, fid, CAST(regexp_extract(text, '(\\d+(?:\\.\\d+)?)\\s*\\$([A-Z][A-Z0-9]*)', 1) AS DOUBLE) AS amount, regexp_extract(text, '(\\d+(?:\\.\\d+)?)\\s*\\$([A-Z][A-Z0-9]*)', 2) AS token, parent_hash
    FROM live WHERE regexp_matches(text, '\\d\\s*\\$[A-Z]')) SELECT t.id, t.fid, p.fid AS receiver, amount, token FROM t JOIN cur p ON p.hash = t.parent_hash AND p.fid <> t.fid""")
def i11_tips(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts of tokens named in replies, for the author of what they answer; not to oneself."""
    pattern = r"(\d+(?:\.\d+)?)\s*\$([A-Z][A-Z0-9]*)"
    texts = live_casts(spark, folder, "text").filter(F.col("text").rlike(r"\d\s*\$[A-Z]")).select("id", F.regexp_extract("text", pattern, 1).cast("double").alias("amount"), F.regexp_extract("text", pattern, 2).alias("token"))
    return replies(spark, folder).join(texts, "id").filter("fid != parent_fid").select("id", "fid", F.col("parent_fid").alias("receiver"), "amount", "token")


@query("I12_casts_without_known_parent", SQL + " SELECT id FROM live WHERE NOT top AND parent_hash NOT IN (SELECT hash FROM cur)")
def i12_missing(spark: SparkSession, folder: str) -> DataFrame:
    c = live_casts(spark, folder, "parent_hash").filter("not top")
    return c.join(current_casts(spark, folder, "hash").select(F.col("hash").alias("parent_hash")), "parent_hash", "left_anti").select("id")


@query("I13_profile_by_kind", "SELECT user_id, count(*) FILTER (event_type = 'view') AS views, max(value) FILTER (event_type = 'purchase') AS most, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds FROM events GROUP BY user_id")
def i13_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Typed rows turned into columns by conditional aggregates."""
    e = table(spark, folder, "events")
    return e.groupBy("user_id").agg(F.count(F.when(F.col("event_type") == "view", 1)).alias("views"), F.max(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("most"), F.concat_ws(",", F.array_sort(F.collect_set("event_type"))).alias("kinds"))


@query("I14_counts_by_day", SQL + """, d AS (SELECT CAST(ts AS DATE) AS day, 'c' AS k FROM live UNION ALL SELECT CAST(ts AS DATE), 'r' FROM reactions UNION ALL SELECT CAST(ts AS DATE), 'e' FROM events)
  SELECT strftime(day, '%Y-%m-%d') AS day, count(*) FILTER (k = 'c') AS casts, count(*) FILTER (k = 'r') AS reactions, count(*) FILTER (k = 'e') AS events FROM d GROUP BY ALL""")
def i14_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """Several daily counts side by side: tagged and counted once instead of joined."""
    parts = {"casts": live_casts(spark, folder).select("ts"), "reactions": reactions(spark, folder).select("ts"), "events": table(spark, folder, "events").select("ts")}
    rows = [d.select(F.col("ts").cast("date").cast("string").alias("day"), F.lit(k).alias("k")) for k, d in parts.items()]
    return rows[0].union(rows[1]).union(rows[2]).groupBy("day").agg(*[F.count(F.when(F.col("k") == k, 1)).alias(k) for k in parts])


# ---- state


def _halves(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, folder, "events").select("user_id", "event_type", F.round("value", 2).cast("decimal(18,2)").alias("value"), "event_id")
    return e.filter("event_id % 2 = 0"), e.filter("event_id % 2 = 1 and event_type != 'error'")


@query("K2_insert_ignore", "SELECT user_id, event_type, min(event_id) FILTER (event_id % 2 = 0) AS event_id FROM (SELECT user_id, event_type, event_id FROM events WHERE event_id % 2 = 0) GROUP BY ALL UNION ALL SELECT user_id, event_type, min(event_id) FROM events e WHERE event_id % 2 = 1 AND event_type <> 'error' AND NOT EXISTS (SELECT 1 FROM events o WHERE o.event_id % 2 = 0 AND o.user_id = e.user_id AND o.event_type = e.event_type) GROUP BY ALL")
def k2_insert_ignore(spark: SparkSession, folder: str) -> DataFrame:
    old, new = _halves(spark, folder)
    old = old.groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"))
    return insert_ignore(old, new.select("user_id", "event_type", "event_id"), ["user_id", "event_type"], ["event_id"])


@query("K4_additive_upsert", "SELECT user_id, event_type, CAST(sum(CAST(round(value, 2) AS DECIMAL(18, 2))) AS DOUBLE) AS value FROM events WHERE event_id % 2 = 0 OR event_type <> 'error' GROUP BY ALL")
def k4_additive(spark: SparkSession, folder: str) -> DataFrame:
    old, new = _halves(spark, folder)
    return additive_upsert(old, new, ["user_id", "event_type"], "value").withColumn("value", F.col("value").cast("double"))


@query("K5_overwrite_upsert", "WITH n AS (SELECT user_id, max(event_id) AS event_id FROM events WHERE event_id % 2 = 1 AND event_type <> 'error' GROUP BY 1), o AS (SELECT user_id, max(event_id) AS event_id FROM events WHERE event_id % 2 = 0 GROUP BY 1) SELECT * FROM n UNION ALL SELECT * FROM o WHERE user_id NOT IN (SELECT user_id FROM n)")
def k5_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    old, new = (d.groupBy("user_id").agg(F.max("event_id").alias("event_id")) for d in _halves(spark, folder))
    return overwrite_upsert(old, new, ["user_id"])


@query("K7_log_into_balances", """WITH b AS (SELECT user_id, sum(CAST(round(value, 2) AS DECIMAL(18, 2))) AS v FROM events WHERE event_id % 2 = 0 GROUP BY 1), l AS (SELECT user_id, sum(CAST(round(value, 2) AS DECIMAL(18, 2))) AS v FROM events WHERE event_id % 2 = 1 AND event_type <> 'error' GROUP BY 1)
  SELECT user_id, CAST(coalesce(b.v, 0) + coalesce(l.v, 0) AS DOUBLE) AS balance, CAST(coalesce(l.v, 0) AS DOUBLE) AS latest FROM b FULL JOIN l USING (user_id)""")
def k7_balances(spark: SparkSession, folder: str) -> DataFrame:
    old, new = _halves(spark, folder)
    b = old.groupBy("user_id").agg(F.sum("value").alias("balance"))
    return fold_log(b, new, ["user_id"], "balance", "value").select("user_id", F.col("balance").cast("double").alias("balance"), F.col("latest").cast("double").alias("latest"))


@query("K10_keep_missing_groups", "SELECT event_type, event_id FROM events WHERE event_id % 2 = 1 AND event_type <> 'error' UNION ALL SELECT event_type, event_id FROM events WHERE event_id % 2 = 0 AND event_type NOT IN (SELECT event_type FROM events WHERE event_id % 2 = 1 AND event_type <> 'error')")
def k10_keep_missing(spark: SparkSession, folder: str) -> DataFrame:
    old, new = (d.select("event_type", "event_id") for d in _halves(spark, folder))
    return keep_missing(old, new, "event_type")


@query("K12_drift_guard", "WITH o AS (SELECT count(DISTINCT event_type) AS groups_before, count(*) AS rows_before FROM events WHERE event_id % 2 = 0), n AS (SELECT count(DISTINCT event_type) AS groups_after, count(*) AS rows_after FROM events WHERE event_id % 2 = 1 AND event_type <> 'error') SELECT *, groups_after >= groups_before * 0.75 AND rows_after >= rows_before * 0.75 AS accepted FROM o, n")
def k12_guard(spark: SparkSession, folder: str) -> DataFrame:
    return within_drift(*_halves(spark, folder), "event_type", 0.75)


@query("K20_bulk_update", "SELECT channel_id, CASE WHEN channel_id IN (SELECT channel_id FROM k3l_channel_rank) THEN 'ranked' ELSE coalesce(nullif(description, ''), 'none') END AS description FROM channels")
def k20_bulk_update(spark: SparkSession, folder: str) -> DataFrame:
    """Values from another table where it has the key, else what was there."""
    c = table(spark, folder, "channels").select("channel_id", "description")
    new = table(spark, folder, "k3l_channel_rank").select("channel_id").distinct().withColumn("new", F.lit("ranked"))
    old = F.when(F.col("description") != "", F.col("description"))
    return c.join(new, "channel_id", "left").select("channel_id", F.coalesce("new", old, F.lit("none")).alias("description"))


@query("K21_decode_double_hex", "SELECT id, '0x' || lower(hex(hash)) AS address FROM casts GROUP BY id, hash")
def k21_fixup(spark: SparkSession, folder: str) -> DataFrame:
    """Hashes written as the hex text of their own hex text, decoded where they look like that."""
    c = table(spark, folder, "casts").select("id", "hash").distinct()
    twice = c.withColumn("a", F.when(F.col("id") % 2 == 0, F.concat(F.lit("0x"), F.hex(F.encode(hex_text("hash"), "UTF-8")))).otherwise(hex_text("hash")))
    doubled = F.col("a").rlike("^0x3078([0-9A-Fa-f]{2})+$") & (F.length("a") > 46)
    return twice.select("id", F.when(doubled, F.decode(F.unhex(F.expr("substring(a, 3)")), "UTF-8")).otherwise(F.col("a")).alias("address"))


@query("T6_weekly_buckets", "SELECT strftime(date_trunc('week', ts - INTERVAL 8 HOUR - INTERVAL 9 HOUR) + INTERVAL 7 DAY + INTERVAL 9 HOUR - INTERVAL 1 SECOND + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS week_end, count(*) AS events, count(DISTINCT user_id) AS users FROM events GROUP BY ALL")
def t6_weeks(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events").withColumn("w", week_end_9am("ts", -8))
    return e.groupBy(F.date_format("w", "yyyy-MM-dd HH:mm:ss").alias("week_end")).agg(F.count(F.lit(1)).alias("events"), F.countDistinct("user_id").alias("users"))


@query("T11_freshness", "SELECT max(created_at) AS newest, max(created_at) < TIMESTAMP '2025-02-15 00:00:00' - INTERVAL 600 SECOND AS stale FROM casts")
def t11_freshness(spark: SparkSession, folder: str) -> DataFrame:
    newest = table(spark, folder, "casts").agg(F.max("created_at").alias("newest"))
    return newest.withColumn("stale", F.col("newest") < now() - F.expr("INTERVAL '600' SECOND"))


# ---- channels


@query("C1_channel_stats", SQL + """ SELECT c.channel_id, c.follower_count, coalesce(r.n, 0) AS ranked, coalesce(m.n, 0) AS casters FROM chan c LEFT JOIN (SELECT channel_id, count(*) AS n FROM crank WHERE strategy_name = 'channel_engagement' GROUP BY 1) r USING (channel_id)
  LEFT JOIN (SELECT channel_id, count(DISTINCT fid) AS n FROM live GROUP BY 1) m USING (channel_id)""")
def c1_stats(spark: SparkSession, folder: str) -> DataFrame:
    r = channel_rank(spark, folder).filter("strategy_name = 'channel_engagement'").groupBy("channel_id").agg(F.count(F.lit(1)).alias("r"))
    m = live_casts(spark, folder).filter("channel_id is not null").groupBy("channel_id").agg(F.countDistinct("fid").alias("m"))
    c = live_channels(spark, folder).join(r, "channel_id", "left").join(m, "channel_id", "left")
    return c.select("channel_id", "follower_count", F.coalesce("r", F.lit(0)).alias("ranked"), F.coalesce("m", F.lit(0)).alias("casters"))


@query("C2_weekly_cast_metrics", SQL + " SELECT channel_id, strftime(date_trunc('week', ts - INTERVAL 17 HOUR) + INTERVAL 7 DAY + INTERVAL 17 HOUR - INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') AS week_end, count(*) AS casts, count(DISTINCT fid) AS casters FROM live WHERE channel_id IS NOT NULL GROUP BY ALL")
def c2_weekly(spark: SparkSession, folder: str) -> DataFrame:
    c = live_casts(spark, folder).filter("channel_id is not null").withColumn("w", week_end_9am("ts", -8))
    return c.groupBy("channel_id", F.date_format("w", "yyyy-MM-dd HH:mm:ss").alias("week_end")).agg(F.count(F.lit(1)).alias("casts"), F.countDistinct("fid").alias("casters"))


@query("C3_cumulative_casters", SQL + ", f AS (SELECT channel_id, fid, date_trunc('week', min(ts)) AS w FROM live WHERE channel_id IS NOT NULL GROUP BY ALL), n AS (SELECT channel_id, w, count(*) AS n FROM f GROUP BY ALL) SELECT channel_id, strftime(w, '%Y-%m-%d') AS week, CAST(sum(n) OVER (PARTITION BY channel_id ORDER BY w) AS BIGINT) AS casters FROM n")
def c3_cumulative(spark: SparkSession, folder: str) -> DataFrame:
    """Running number of different casters: each counts from their first week on."""
    first = live_casts(spark, folder).filter("channel_id is not null").groupBy("channel_id", "fid").agg(F.date_trunc("week", F.min("ts")).alias("w"))
    n = first.groupBy("channel_id", "w").agg(F.count(F.lit(1)).alias("n"))
    run = F.sum("n").over(W.partitionBy("channel_id").orderBy("w").rowsBetween(W.unboundedPreceding, 0))
    return n.select("channel_id", F.date_format("w", "yyyy-MM-dd").alias("week"), run.alias("casters"))


@query("C4_channel_profile_page", SQL + " SELECT c.channel_id, c.fid, c.rank, c.score, g.rank AS global_rank FROM crank c LEFT JOIN grank g ON g.profile_id = c.fid AND g.strategy_id = 9 WHERE c.strategy_name = 'channel_engagement' AND c.rank > 5 AND c.rank <= 15")
def c4_page(spark: SparkSession, folder: str) -> DataFrame:
    c = channel_rank(spark, folder).filter("strategy_name = 'channel_engagement' and rank > 5 and rank <= 15")
    g = global_rank(spark, folder).filter("strategy_id = 9").select(F.col("profile_id").alias("fid"), F.col("rank").alias("global_rank"))
    return c.join(g, "fid", "left").select("channel_id", "fid", "rank", "score", "global_rank")


@query("C5_leaderboard", SQL + """, n AS (SELECT channel_id, fid, count(*) FILTER (NOT top) AS replies, count(*) AS casts FROM live WHERE channel_id IS NOT NULL GROUP BY ALL), j AS (SELECT n.*, r.rank, row_number() OVER w AS place, count(*) OVER (PARTITION BY n.channel_id) AS total
    FROM n LEFT JOIN crank r ON r.channel_id = n.channel_id AND r.fid = n.fid AND r.strategy_name = 'channel_engagement' WINDOW w AS (PARTITION BY n.channel_id ORDER BY n.replies DESC, r.rank ASC NULLS LAST, n.fid))
  SELECT channel_id, fid, replies, casts, rank, CAST((total - (place - 1)) * 100 // total AS BIGINT) AS ptile FROM j""")
def c5_leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    c = live_casts(spark, folder).filter("channel_id is not null").groupBy("channel_id", "fid").agg(F.count(F.when(~F.col("top"), 1)).alias("replies"), F.count(F.lit(1)).alias("casts"))
    r = channel_rank(spark, folder).filter("strategy_name = 'channel_engagement'").select("channel_id", "fid", "rank")
    part = W.partitionBy("channel_id")
    j = c.join(r, ["channel_id", "fid"], "left").withColumn("place", F.row_number().over(part.orderBy(F.desc("replies"), F.col("rank").asc_nulls_last(), "fid"))).withColumn("total", F.count(F.lit(1)).over(part))
    return j.select("channel_id", "fid", "replies", "casts", "rank", F.expr("(total - (place - 1)) * 100 div total").alias("ptile"))


@query("C6_filtered_members", SQL + " SELECT DISTINCT channel_id, fid FROM live l WHERE channel_id IS NOT NULL AND EXISTS (SELECT 1 FROM crank r WHERE r.channel_id = l.channel_id AND r.fid = l.fid)")
def c6_members(spark: SparkSession, folder: str) -> DataFrame:
    return live_casts(spark, folder).select("channel_id", "fid").distinct().join(channel_rank(spark, folder).select("channel_id", "fid"), ["channel_id", "fid"], "left_semi")


@query("C7_top_channels_per_fid", SQL + ", s AS (SELECT fid, channel_id, CAST(sum(2 * casted + 2 * replied + 2 * recasted + liked) AS BIGINT) AS score FROM actions, moment WHERE channel_id IS NOT NULL AND action_ts >= at_now - INTERVAL 7 DAY AND action_ts <= at_now GROUP BY ALL) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fid ORDER BY score DESC, channel_id) AS place FROM s) WHERE place <= 5")
def c7_channels(spark: SparkSession, folder: str) -> DataFrame:
    a = actions(spark, folder).filter(F.col("channel_id").isNotNull() & (F.col("action_ts") >= now() - F.expr("INTERVAL '7' DAY")) & (F.col("action_ts") <= now()))
    s = a.groupBy("fid", "channel_id").agg(F.sum(F.expr("2 * casted + 2 * replied + 2 * recasted + liked")).alias("score"))
    return s.withColumn("place", F.row_number().over(W.partitionBy("fid").orderBy(F.desc("score"), "channel_id")).cast("bigint")).filter("place <= 5")


@query("C8_busy_channel_hosts", SQL + ", busy AS (SELECT channel_id FROM live, moment WHERE ts >= at_now - INTERVAL 30 DAY AND ts <= at_now AND channel_id IS NOT NULL GROUP BY 1 HAVING count(*) > 5) SELECT DISTINCT channel_id, fid FROM (SELECT channel_id, lead_fid AS fid FROM chan UNION ALL SELECT channel_id, unnest(moderator_fids) FROM chan) WHERE channel_id IN (SELECT channel_id FROM busy) AND fid IS NOT NULL")
def c8_hosts(spark: SparkSession, folder: str) -> DataFrame:
    busy = live_casts(spark, folder).filter((F.col("ts") >= now() - F.expr("INTERVAL '30' DAY")) & (F.col("ts") <= now()) & F.col("channel_id").isNotNull()).groupBy("channel_id").count().filter("count > 5")
    hosts = live_channels(spark, folder).select("channel_id", F.explode(F.array_distinct(F.concat(F.array("lead_fid"), F.coalesce("moderator_fids", F.array().cast("array<bigint>"))))).alias("fid")).filter("fid is not null")
    return hosts.join(busy, "channel_id", "left_semi")


@query("C9_weighted_author_scores", SQL + ", a AS (SELECT a.channel_id, l.fid AS author, sum((replied + 5 * recasted + liked) * r.score) AS s FROM actions a JOIN crank r ON r.channel_id = a.channel_id AND r.fid = a.fid AND r.strategy_name = 'channel_engagement' JOIN live l ON l.id = a.cast_id AND a.fid <> l.fid GROUP BY ALL) SELECT channel_id, author AS fid, round(s, 10) AS score FROM a WHERE s > 0")
def c9_weighted(spark: SparkSession, folder: str) -> DataFrame:
    r = channel_rank(spark, folder).filter("strategy_name = 'channel_engagement'").select("channel_id", "fid", "score")
    authors = live_casts(spark, folder).select(F.col("id").alias("cast_id"), F.col("fid").alias("author"))
    a = actions(spark, folder).join(r, ["channel_id", "fid"]).join(authors, "cast_id").filter("fid != author")
    s = a.groupBy("channel_id", F.col("author").alias("fid")).agg(F.sum(F.expr("(replied + 5 * recasted + liked) * score")).alias("score"))
    return s.filter("score > 0").withColumn("score", F.round("score", 10))


@query("C10_percentile_cube_root_shares", SQL + """, p AS (SELECT channel_id, fid, cbrt(score) AS w, (rank() OVER (PARTITION BY channel_id ORDER BY score) + (count(*) OVER (PARTITION BY channel_id, score) - 1) / 2.0) / count(*) OVER (PARTITION BY channel_id) AS pct FROM crank WHERE strategy_name = 'channel_engagement')
  SELECT channel_id, fid, round(pct, 6) AS pct, round(w / sum(w) OVER (PARTITION BY channel_id), 6) AS share FROM p WHERE pct > 0.1""")
def c10_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The mean percentile of equal scores; above the lowest tenth, shares by cube root."""
    c = channel_rank(spark, folder).filter("strategy_name = 'channel_engagement'").select("channel_id", "fid", "score", F.cbrt("score").alias("w"))
    p = c.withColumn("pct", pct_rank_average(["channel_id"], "score")).filter("pct > 0.1")
    return p.select("channel_id", "fid", F.round("pct", 6).alias("pct"), F.round(F.col("w") / F.sum("w").over(W.partitionBy("channel_id")), 6).alias("share"))


@query("C11_upper_nine_tenths", SQL + " SELECT channel_id, fid, tile FROM (SELECT channel_id, fid, ntile(10) OVER (PARTITION BY channel_id ORDER BY score DESC, fid) AS tile FROM crank WHERE strategy_name = 'channel_engagement') WHERE tile <= 9")
def c11_tiles(spark: SparkSession, folder: str) -> DataFrame:
    tile = F.ntile(10).over(W.partitionBy("channel_id").orderBy(F.desc("score"), "fid"))
    return channel_rank(spark, folder).filter("strategy_name = 'channel_engagement'").select("channel_id", "fid", tile.cast("bigint").alias("tile")).filter("tile <= 9")


@query("C14_batches_of_250", SQL + " SELECT channel_id, fid, CASE WHEN r <= (n % k) * (n // k + 1) THEN (r - 1) // (n // k + 1) + 1 ELSE n % k + (r - 1 - (n % k) * (n // k + 1)) // (n // k) + 1 END AS batch FROM (SELECT channel_id, fid, row_number() OVER (PARTITION BY channel_id ORDER BY fid) AS r, count(*) OVER (PARTITION BY channel_id) AS n, CAST(ceil(count(*) OVER (PARTITION BY channel_id) / 250.0) AS BIGINT) AS k FROM crank WHERE strategy_name = 'channel_engagement')")
def c14_batches(spark: SparkSession, folder: str) -> DataFrame:
    part = W.partitionBy("channel_id")
    c = channel_rank(spark, folder).filter("strategy_name = 'channel_engagement'").select("channel_id", "fid", F.count(F.lit(1)).over(part).alias("n"), F.row_number().over(part.orderBy("fid")).alias("r"))
    return c.select("channel_id", "fid", ntile_of(F.col("n"), F.ceil(F.col("n") / 250), F.col("r")).alias("batch"))


@query("C15_leaders_in_chunks", SQL + ", s AS (SELECT channel_id, fid, row_number() OVER (PARTITION BY channel_id ORDER BY n DESC, fid) AS place, n, started FROM (SELECT channel_id, fid, count(*) AS n, bool_or(top) AS started FROM live WHERE channel_id IS NOT NULL GROUP BY ALL)) SELECT channel_id, fid, n, started, CAST((place - 1) // 10 AS BIGINT) AS chunk FROM s WHERE place <= 50")
def c15_chunks(spark: SparkSession, folder: str) -> DataFrame:
    s = live_casts(spark, folder).filter("channel_id is not null").groupBy("channel_id", "fid").agg(F.count(F.lit(1)).alias("n"), F.bool_or("top").alias("started"))
    s = materialise(s, "authors")
    p = top_n_per_group(s, ["channel_id"], "fid", "n", 50).drop("n")
    return p.join(s, ["channel_id", "fid"]).select("channel_id", "fid", "n", "started", F.expr("cast((position - 1) div 10 as bigint)").alias("chunk"))


@query("C19_payout_report", "SELECT o_custkey AS fid, count(*) AS payouts, round(sum(o_totalprice), 2) AS total, quantile_disc(o_totalprice, 0.5) AS median, count(*) FILTER (o_orderstatus = 'F') AS done FROM orders GROUP BY 1")
def c19_report(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    return o.groupBy(F.col("o_custkey").alias("fid")).agg(F.count(F.lit(1)).alias("payouts"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY o_totalprice)").alias("median"), F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("done"))


@query("C20_exact_integer_split", "SELECT l_orderkey, l_linenumber, CAST(1000003 * c // t - 1000003 * (c - q) // t AS BIGINT) AS part FROM (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS HUGEINT) AS q, sum(CAST(l_quantity AS HUGEINT)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity ROWS UNBOUNDED PRECEDING) AS c, sum(CAST(l_quantity AS HUGEINT)) OVER (PARTITION BY l_orderkey) AS t FROM lineitem)")
def c20_split(spark: SparkSession, folder: str) -> DataFrame:
    """1000003 units per order over its lines by quantity: whole parts that add up exactly."""
    li = table(spark, folder, "lineitem").withColumn("q", F.col("l_quantity").cast("bigint"))
    return li.select("l_orderkey", "l_linenumber", split_exactly(F.lit(1_000_003), "q", W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_quantity")).alias("part"))


@query("C22_channel_lookup", SQL + " SELECT channel_id, url, lead_fid FROM chan WHERE channel_id LIKE 'b%' OR follower_count >= 100")
def c22_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return live_channels(spark, folder).filter(F.col("channel_id").like("b%") | (F.col("follower_count") >= 100)).select("channel_id", "url", "lead_fid")


@query("C23_rank_sanity", SQL + ", n AS (SELECT strategy_name, channel_id, count(*) AS n FROM crank GROUP BY ALL) SELECT strategy_name, count(*) AS channels, CAST(sum(n) AS BIGINT) AS fids, bool_and(n > 0) AS sane FROM n GROUP BY ALL")
def c23_sanity(spark: SparkSession, folder: str) -> DataFrame:
    n = channel_rank(spark, folder).groupBy("strategy_name", "channel_id").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("strategy_name").agg(F.count(F.lit(1)).alias("channels"), F.sum("n").alias("fids"), F.bool_and(F.col("n") > 0).alias("sane"))


# ---- the tipping study

_QUOTES = ", q AS (SELECT cast_id, fid, count(*) AS quotes FROM (SELECT id AS cast_id, unnest(mentions) AS fid FROM live) GROUP BY ALL)"


@query("N1_parse_bracket_lists", "SELECT id, len(mentions) AS n, CAST(coalesce(list_sum(mentions), 0) AS BIGINT) AS total FROM (SELECT id, max(mentions) AS mentions FROM casts GROUP BY id)")
def n1_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Lists written as bracketed text, read back."""
    c = table(spark, folder, "casts").groupBy("id").agg(F.max("mentions").alias("m")).select("id", F.concat(F.lit("["), F.concat_ws(", ", F.col("m").cast("array<string>")), F.lit("]")).alias("t"))
    bare = F.regexp_replace("t", r"[\[\]\s]", "")
    back = F.when(bare == "", F.array().cast("array<bigint>")).otherwise(F.split(bare, ",").cast("array<bigint>"))
    return c.select("id", F.size(back).cast("bigint").alias("n"), F.aggregate(back, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"))


@query("N4_tipper_scores", SQL + " SELECT n.i AS fid, count(DISTINCT n.j) AS named, round(coalesce(sum(g.score), 0), 10) AS named_score FROM (SELECT DISTINCT i, j FROM named) n LEFT JOIN grank g ON g.profile_id = n.j AND g.strategy_id = 9 GROUP BY ALL")
def n4_tippers(spark: SparkSession, folder: str) -> DataFrame:
    """Per author the number and score of those they name: the correlated sum as explode, join and group."""
    m = live_casts(spark, folder, "mentions").select("fid", F.explode("mentions").alias("j")).distinct()
    g = global_rank(spark, folder).filter("strategy_id = 9").select(F.col("profile_id").alias("j"), "score")
    return m.join(g, "j", "left").groupBy("fid").agg(F.countDistinct("j").alias("named"), F.round(F.coalesce(F.sum("score"), F.lit(0.0)), 10).alias("named_score"))


@query("N5_actions_full_join_quotes", SQL + _QUOTES + ", a AS (SELECT cast_id, fid, sum(liked + recasted) AS n FROM actions GROUP BY ALL HAVING sum(liked + recasted) > 0) SELECT cast_id, fid, CAST(coalesce(n, 0) AS BIGINT) AS reactions, coalesce(quotes, 0) AS quotes FROM a FULL JOIN q USING (cast_id, fid)")
def n5_full_join(spark: SparkSession, folder: str) -> DataFrame:
    a = actions(spark, folder).groupBy("cast_id", "fid").agg(F.sum(F.expr("liked + recasted")).alias("n")).filter("n > 0")
    q = live_casts(spark, folder, "mentions").select(F.col("id").alias("cast_id"), F.explode("mentions").alias("fid")).groupBy("cast_id", "fid").agg(F.count(F.lit(1)).alias("q"))
    return a.join(q, ["cast_id", "fid"], "full").select("cast_id", "fid", F.coalesce("n", F.lit(0)).alias("reactions"), F.coalesce("q", F.lit(0)).alias("quotes"))


@query("N6_N7_weight_variants_ranked", SQL + """, v(name, l, c) AS (VALUES ('L1C3', 1, 3), ('L1C6', 1, 6), ('L0C1', 0, 1)), s AS (SELECT name, cast_id, sum((l * liked + c * recasted) * g.score) AS s, count(DISTINCT a.fid) AS tippers FROM actions a JOIN grank g ON g.profile_id = a.fid AND g.strategy_id = 9, v WHERE liked + recasted > 0 GROUP BY ALL HAVING sum((l * liked + c * recasted) * g.score) > 0)
  SELECT * FROM (SELECT name, cast_id, round(s, 10) AS score, tippers, row_number() OVER (PARTITION BY name ORDER BY round(s, 10) DESC, cast_id) AS place FROM s) WHERE place <= 1000""")
def n6_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Each action under each of a fixed handful of weightings: a list of constants expanded per row, not a join."""
    variants = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(x).alias("l"), F.lit(y).alias("c")) for n, x, y in (("L1C3", 1, 3), ("L1C6", 1, 6), ("L0C1", 0, 1))])
    g = global_rank(spark, folder).filter("strategy_id = 9").select(F.col("profile_id").alias("fid"), "score")
    a = actions(spark, folder).filter("liked + recasted > 0").join(g, "fid").withColumn("v", F.explode(variants))
    s = a.groupBy("v.name", "cast_id").agg(F.round(F.sum(F.expr("(v.l * liked + v.c * recasted) * score")), 10).alias("score"), F.countDistinct("fid").alias("tippers"), F.sum(F.expr("(v.l * liked + v.c * recasted) * score")).alias("raw")).filter("raw > 0").drop("raw")
    s = materialise(s, "scores")
    best = top_n_per_group(s, ["name"], "cast_id", "score", 1000).select("name", "cast_id", F.col("position").cast("bigint").alias("place"))
    return s.join(best, ["name", "cast_id"])


@query("N9_json_paths", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS channel FROM events")
def n9_json(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, folder, "events").select("event_id", k.alias("k"), (k % 10).alias("channel"))


@query("N10_union_of_lists", SQL + " SELECT fid, string_agg(DISTINCT CAST(m AS VARCHAR), ',' ORDER BY CAST(m AS VARCHAR)) AS named FROM (SELECT fid, unnest(mentions) AS m FROM live) GROUP BY fid")
def n10_union(spark: SparkSession, folder: str) -> DataFrame:
    """The union of a group's lists, without gathering repeats: exploded, then a set."""
    m = live_casts(spark, folder, "mentions").select("fid", F.explode(F.col("mentions").cast("array<string>")).alias("m"))
    return m.groupBy("fid").agg(F.concat_ws(",", F.array_sort(F.collect_set("m"))).alias("named"))


