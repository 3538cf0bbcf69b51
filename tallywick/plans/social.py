"""The social relations that the named queries read, built from the stored tables, and the same in SQL for comparison.

Stored tables without counterpart are derived by fixed rules: a line item is a reaction to the cast with its order's key,
by the user 1000000 + part key modulo 2000, a recast if it was returned and else a like, as many hours after the cast as
the part key modulo 96; each first line of an order is also a follow from that user to the cast's author. An order is a token
balance of its customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import ranked
from ..sources.tables import table
from ..storage import materialise

#: The moment that stands for "now" in all queries, UTC.
AS_OF = "2025-02-15 00:00:00"


def now() -> F.Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


CAST_COLUMNS = ("fid", "hash", "parent_hash", "root_parent_hash", "root_parent_url", "timestamp", "created_at", "deleted_at", "text", "mentions")


def stored_casts(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    """current_casts with what most relations need, and more columns, written once for a query that reads them several times."""
    return materialise(current_casts(spark, folder, "fid", "hash", "parent_hash", "root_parent_url", "timestamp", "deleted_at", *more), "casts")


def current_casts(spark: SparkSession, folder: str, *columns: str, base: DataFrame | None = None) -> DataFrame:
    """One row per cast, its current one: id and the named columns. base: stored_casts to take them from."""
    if base is not None:
        return base.select("id", *columns)
    rows = table(spark, folder, "casts").filter("id is not null")
    return rows.groupBy("id").agg(F.max_by(F.struct(*columns), F.col("updated_at")).alias("c")).select("id", *[F.col(f"c.{c}").alias(c) for c in columns])


def live_channels(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "channels").filter("deleted_at is null").select("channel_id", "url", "lead_fid", "moderator_fids", "follower_count")


def live_casts(spark: SparkSession, folder: str, *more: str, base: DataFrame | None = None) -> DataFrame:
    """Casts that aren't deleted: id, fid, ts, channel_id (null outside live channels), top (no parent), and more columns."""
    columns = dict.fromkeys(["fid", "timestamp", "deleted_at", "parent_hash", "root_parent_url", *more])
    c = current_casts(spark, folder, *columns, base=base).filter("deleted_at is null").withColumn("top", F.coalesce(F.length("parent_hash"), F.lit(0)) == 0)
    urls = live_channels(spark, folder).select(F.col("url").alias("root_parent_url"), "channel_id")
    return c.join(urls, "root_parent_url", "left").select("id", "fid", F.col("timestamp").alias("ts"), "channel_id", "top", *more)


def reactions(spark: SparkSession, folder: str, base: DataFrame | None = None) -> DataFrame:
    """cast_id, target_fid, fid, reaction_type (1 like, 2 recast), ts, first."""
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id"), (F.lit(1_000_000) + F.col("l_partkey") % 2000).alias("actor"), F.when(F.col("l_returnflag") == "R", 2).otherwise(1).alias("reaction_type"), (F.col("l_partkey") % 96).alias("hours"), (F.col("l_linenumber") == 1).alias("first"))
    casts = current_casts(spark, folder, "fid", "timestamp", "deleted_at", base=base).filter("deleted_at is null").select("id", F.col("fid").alias("target_fid"), "timestamp")
    ts = F.expr("timestamp + make_dt_interval(0, cast(hours as int), 0, 0)")
    return lines.join(casts, "id").select(F.col("id").alias("cast_id"), "target_fid", F.col("actor").alias("fid"), "reaction_type", ts.alias("ts"), "first")


def replies(spark: SparkSession, folder: str, base: DataFrame | None = None) -> DataFrame:
    """Live casts below a known cast: id, fid, ts, parent_id, parent_fid, channel_id."""
    c = live_casts(spark, folder, "parent_hash", base=base).filter("not top")
    parents = current_casts(spark, folder, "hash", "fid", base=base).select(F.col("hash").alias("parent_hash"), F.col("id").alias("parent_id"), F.col("fid").alias("parent_fid"))
    return c.join(parents, "parent_hash").select("id", "fid", "ts", "parent_id", "parent_fid", "channel_id")


def interactions(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """(i, j) per interaction of each kind, and of each its time ts."""
    base = stored_casts(spark, folder, "mentions")
    r = reactions(spark, folder, base)
    named = live_casts(spark, folder, "mentions", base=base).select(F.col("fid").alias("i"), F.explode("mentions").alias("j"), "ts")
    return {
        "likes": r.filter("reaction_type = 1").select(F.col("fid").alias("i"), F.col("target_fid").alias("j"), "ts"),
        "recasts": r.filter("reaction_type = 2").select(F.col("fid").alias("i"), F.col("target_fid").alias("j"), "ts"),
        "replies": replies(spark, folder, base).select(F.col("fid").alias("i"), F.col("parent_fid").alias("j"), "ts"),
        "mentions": named,
        "follows": r.filter("first").select(F.col("fid").alias("i"), F.col("target_fid").alias("j"), "ts").distinct(),
    }


def actions(spark: SparkSession, folder: str) -> DataFrame:
    """One row per (cast_id, fid, action_ts): channel_id, casted, replied, recasted, liked. A reply counts for the cast it answers, besides its own row."""
    base = stored_casts(spark, folder)
    c = live_casts(spark, folder, base=base)
    flag = lambda *on: [F.lit(int(x in on)).alias(x) for x in ("casted", "replied", "recasted", "liked")]
    own = c.select(F.col("id").alias("cast_id"), "fid", F.col("ts").alias("action_ts"), "channel_id", *flag("casted"))
    rep = replies(spark, folder, base).select(F.col("parent_id").alias("cast_id"), "fid", F.col("ts").alias("action_ts"), "channel_id", *flag("replied"))
    r = reactions(spark, folder, base).join(c.select(F.col("id").alias("cast_id"), "channel_id"), "cast_id")
    liked = r.select("cast_id", "fid", F.col("ts").alias("action_ts"), "channel_id", F.lit(0).alias("casted"), F.lit(0).alias("replied"), (F.col("reaction_type") == 2).cast("int").alias("recasted"), (F.col("reaction_type") == 1).cast("int").alias("liked"))
    rows = own.unionByName(rep).unionByName(liked)
    # Insert-ignore keeps one row per key; which kind it is goes by a fixed order.
    best = F.struct("casted", "replied", "recasted", "liked", "channel_id")
    kept = rows.groupBy("cast_id", "fid", "action_ts").agg(F.max(best).alias("b"))
    return kept.select("cast_id", "fid", "action_ts", "b.channel_id", "b.casted", "b.replied", "b.recasted", "b.liked")


def global_rank(spark: SparkSession, folder: str) -> DataFrame:
    """The latest date of each strategy: strategy_id, strategy_name (of its latest settings), date, profile_id, score (double), rank."""
    rows = table(spark, folder, "k3l_rank").select("strategy_id", "date", "profile_id", F.col("score").cast("double").alias("score")).dropna().filter("not isnan(score)")
    scores = rows.groupBy("strategy_id", "date", "profile_id").agg(F.max("score").alias("score"))
    latest = scores.groupBy("strategy_id").agg(F.max("date").alias("date"))
    names = table(spark, folder, "globaltrust_config").groupBy("strategy_id").agg(F.max_by("strategy_name", F.struct("date", "strategy_name")).alias("strategy_name"))
    now = scores.join(latest, ["strategy_id", "date"]).join(names, "strategy_id", "left")
    placed = ranked(now.withColumnsRenamed({"score": "v", "profile_id": "i"}), ("strategy_id",))
    return placed.select("strategy_id", "strategy_name", "date", F.col("i").alias("profile_id"), F.col("v").alias("score"), "rank")


def channel_rank(spark: SparkSession, folder: str) -> DataFrame:
    """channel_id, strategy_name, fid, score (double), rank, of the latest computation of each."""
    rows = table(spark, folder, "k3l_channel_rank").select("channel_id", "strategy_name", "fid", "compute_ts", "pseudo_id", F.col("score").cast("double").alias("score"))
    last = rows.groupBy("channel_id", "strategy_name", "fid").agg(F.max_by("score", F.struct("compute_ts", "pseudo_id")).alias("score"))
    return ranked(last.withColumnsRenamed({"score": "v", "fid": "i"}), ("channel_id", "strategy_name")).withColumnsRenamed({"v": "score", "i": "fid"})


#: The same relations for DuckDB: an independent spelling, put before each query's own SQL.
SQL = f"""WITH
  moment AS (SELECT TIMESTAMP '{AS_OF}' AS at_now),
  cur AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) AS rn FROM casts) WHERE rn = 1),
  chan AS (SELECT channel_id, url, lead_fid, moderator_fids, follower_count FROM channels WHERE deleted_at IS NULL),
  live AS (SELECT c.id, c.fid, c.timestamp AS ts, ch.channel_id, coalesce(octet_length(c.parent_hash), 0) = 0 AS top, c.parent_hash, c.hash, c.text, c.mentions, c.root_parent_url
           FROM cur c LEFT JOIN chan ch ON c.root_parent_url = ch.url WHERE c.deleted_at IS NULL),
  reactions AS (SELECT c.id AS cast_id, c.fid AS target_fid, 1000000 + l_partkey % 2000 AS fid, CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS reaction_type,
                c.timestamp + to_hours(l_partkey % 96) AS ts, l_linenumber = 1 AS first FROM lineitem JOIN cur c ON c.id = l_orderkey WHERE c.deleted_at IS NULL),
  replies AS (SELECT l.id, l.fid, l.ts, p.id AS parent_id, p.fid AS parent_fid, l.channel_id FROM live l JOIN cur p ON l.parent_hash = p.hash WHERE NOT l.top),
  follows AS (SELECT DISTINCT fid AS i, target_fid AS j FROM reactions WHERE first),
  named AS (SELECT fid AS i, unnest(mentions) AS j, ts FROM live),
  acts AS (SELECT id AS cast_id, fid, ts AS action_ts, channel_id, 1 AS casted, 0 AS replied, 0 AS recasted, 0 AS liked FROM live
           UNION ALL SELECT parent_id, fid, ts, channel_id, 0, 1, 0, 0 FROM replies
           UNION ALL SELECT r.cast_id, r.fid, r.ts, l.channel_id, 0, 0, CASE WHEN reaction_type = 2 THEN 1 ELSE 0 END, CASE WHEN reaction_type = 1 THEN 1 ELSE 0 END FROM reactions r JOIN live l ON l.id = r.cast_id),
  actions AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY cast_id, fid, action_ts ORDER BY casted DESC, replied DESC, recasted DESC, liked DESC, channel_id DESC NULLS LAST) AS rn FROM acts) WHERE rn = 1),
  scored AS (SELECT strategy_id, date, profile_id, CAST(max(score) AS DOUBLE) AS score FROM k3l_rank
             WHERE score IS NOT NULL AND NOT isnan(score) AND strategy_id IS NOT NULL AND date IS NOT NULL GROUP BY ALL),
  grank AS (SELECT s.strategy_id, n.strategy_name, s.date, profile_id, score, row_number() OVER (PARTITION BY s.strategy_id ORDER BY score DESC, profile_id) AS rank
            FROM scored s JOIN (SELECT strategy_id, max(date) AS date FROM scored GROUP BY 1) l ON s.strategy_id = l.strategy_id AND s.date = l.date
            LEFT JOIN (SELECT strategy_id, arg_max(strategy_name, (date, strategy_name)) AS strategy_name FROM globaltrust_config GROUP BY 1) n ON n.strategy_id = s.strategy_id),
  crank AS (SELECT *, row_number() OVER (PARTITION BY channel_id, strategy_name ORDER BY score DESC, fid) AS rank
            FROM (SELECT channel_id, strategy_name, fid, CAST(arg_max(score, (compute_ts, pseudo_id)) AS DOUBLE) AS score FROM k3l_channel_rank GROUP BY ALL))
"""
