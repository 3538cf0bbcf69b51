"""The queries p1 to p6: each operator over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import day_text, epoch_micros
from ..operators.heavy_keys import heavy_keys, key_profile
from ..operators.hierarchy import hierarchy, paths
from ..operators.late_events import ReplayLedger, deliveries, replay_in_batches
from ..operators.orphans import find_orphans, orphans_by_period
from ..operators.rolling import rolling_totals
from ..operators.topn import top_n_per_group
from ..sources.tables import table
from ..storage import materialise
from .registry import query

# ---- 1: top N within every group

_BEST = """
  SELECT strategy_id, date, profile_id, s, row_number() OVER (PARTITION BY strategy_id, date ORDER BY s DESC, profile_id) AS place
  FROM (SELECT strategy_id, date, profile_id, max(score) AS s FROM k3l_rank
        WHERE score IS NOT NULL AND NOT isnan(score) AND strategy_id IS NOT NULL AND date IS NOT NULL AND profile_id IS NOT NULL
        GROUP BY strategy_id, date, profile_id)"""


def _best(spark: SparkSession, folder: str) -> DataFrame:
    return top_n_per_group(table(spark, folder, "k3l_rank"), ["strategy_id", "date"], "profile_id", "score", 10)


@query("p1_found", f"SELECT strategy_id, strftime(date, '%Y-%m-%d') AS rank_date, profile_id FROM ({_BEST}) WHERE place <= 10")
def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return _best(spark, folder).select("strategy_id", F.col("date").cast("string").alias("rank_date"), "profile_id")


@query("p1_best_with_place", f"SELECT strategy_id, strftime(date, '%Y-%m-%d') AS rank_date, profile_id, CAST(s AS DOUBLE) AS score, place FROM ({_BEST}) WHERE place <= 10")
def p1_best_with_place(spark: SparkSession, folder: str) -> DataFrame:
    return _best(spark, folder).select("strategy_id", F.col("date").cast("string").alias("rank_date"), "profile_id", "score", F.col("position").alias("place"))


# ---- 2: late and out-of-order events

_ARRIVALS = """
  SELECT id, min(CAST(timestamp AS DATE)) AS day, min(created_at) AS arrived, min(CAST(timestamp AS DATE)) + INTERVAL 4 DAY AS closes
  FROM casts WHERE id IS NOT NULL AND timestamp IS NOT NULL GROUP BY id HAVING min(created_at) IS NOT NULL"""


def _ledger(spark: SparkSession, folder: str, key: str | None = None, value: F.Column | None = None) -> ReplayLedger:
    """The casts' deliveries, repeated ones too, as they came in."""
    return replay_in_batches(deliveries(table(spark, folder, "casts"), key, "id", "timestamp", "created_at", value))


@query("p2_found", f"SELECT strftime(day, '%Y-%m-%d') AS event_day, id FROM ({_ARRIVALS}) WHERE arrived > closes")
def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return _ledger(spark, folder).rejected().select(day_text("period").alias("event_day"), "id")


@query(
    "p2_casts_per_day",
    f"""SELECT strftime(day, '%Y-%m-%d') AS event_day, n AS casts, CAST(sum(n) OVER (ORDER BY day) AS BIGINT) AS casts_so_far
        FROM (SELECT day, count(*) AS n FROM ({_ARRIVALS}) WHERE arrived <= closes GROUP BY day)""",
)
def p2_casts_per_day(spark: SparkSession, folder: str) -> DataFrame:
    return _ledger(spark, folder).outputs().select(day_text("period").alias("event_day"), F.col("n").alias("casts"), F.col("so_far").alias("casts_so_far"))


@query(
    "p2_casts_per_fid_day",
    """WITH one AS (SELECT id, min(fid) AS fid, min(CAST(timestamp AS DATE)) AS day, min(created_at) AS arrived, max(length(text)) AS size FROM casts WHERE id IS NOT NULL AND timestamp IS NOT NULL GROUP BY id HAVING min(created_at) IS NOT NULL),
       d AS (SELECT fid, day, count(*) AS n, sum(size) AS total, min(size) AS least, max(size) AS greatest FROM one WHERE arrived <= day + INTERVAL 4 DAY GROUP BY ALL)
       SELECT fid, strftime(day, '%Y-%m-%d') AS event_day, n AS casts, CAST(total AS DOUBLE) AS letters, CAST(least AS DOUBLE) AS least, CAST(greatest AS DOUBLE) AS greatest, round(total / n, 6) AS mean,
         CAST(sum(n) OVER w AS BIGINT) AS casts_so_far, CAST(sum(total) OVER w AS DOUBLE) AS letters_so_far, CAST(max(greatest) OVER w AS DOUBLE) AS greatest_so_far FROM d WINDOW w AS (PARTITION BY fid ORDER BY day)""",
)
def p2_casts_per_fid_day(spark: SparkSession, folder: str) -> DataFrame:
    """Per author and day: number of casts and the lengths of their texts, and both up to then."""
    out = _ledger(spark, folder, "fid", F.length("text")).outputs()
    return out.select(
        F.when(F.col("key") != "", F.col("key").cast("bigint")).alias("fid"), day_text("period").alias("event_day"), F.col("n").alias("casts"), F.col("total").alias("letters"), "least", "greatest",
        F.round(F.col("total") / F.col("n"), 6).alias("mean"), F.col("n_so_far").alias("casts_so_far"), F.col("total_so_far").alias("letters_so_far"), F.col("greatest_so_far"),
    )


# ---- 3: references to records that do not exist


def _url(column: str) -> F.Column:
    """A channel url as compared: letter case, surrounding blanks, trailing slashes and http for https make no difference. Blank: null."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(F.col(column)), r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""), r"[/\s]+$", "")
    bare = F.regexp_replace(bare, "^http://", "https://")
    return F.when(bare != "", bare)


def _orphans(spark: SparkSession, folder: str) -> DataFrame:
    casts, channels = table(spark, folder, "casts"), table(spark, folder, "channels")
    month = F.date_format(F.timestamp_micros(epoch_micros(casts, "timestamp")), "yyyy-MM")
    blank = F.trim(F.col("root_parent_url")) == ""
    rows = casts.select("id", "hash", "updated_at", F.col("deleted_at").isNull().alias("live"), F.when(F.length("parent_hash") > 0, F.col("parent_hash")).alias("parent"), F.when(~blank, _url("root_parent_url")).alias("url"), month.alias("month"))
    # A redelivered cast has one state; what it refers to and when it happened are the same in all its rows.
    current = rows.groupBy("id").agg(F.max_by("live", F.struct(F.col("updated_at").isNotNull(), "updated_at")).alias("live"), *[F.max(c).alias(c) for c in ("hash", "parent", "url", "month")])
    current = materialise(current, "current")
    refs = current.select("id", "month", F.explode(F.array(F.struct(F.lit("parent_hash").alias("field"), F.col("parent").alias("ref")), F.struct(F.lit("root_parent_url").alias("field"), F.encode("url", "UTF-8").alias("ref")))).alias("r"))
    refs = refs.select("r.field", "id", "r.ref", "month").filter(F.col("ref").isNotNull())
    cast_keys = current.filter("live").select(F.lit("parent_hash").alias("field"), F.col("hash").alias("key"))
    urls = channels.filter(F.col("deleted_at").isNull()).select(F.lit("root_parent_url").alias("field"), F.encode(_url("url"), "UTF-8").alias("key"))
    return find_orphans(refs, cast_keys.unionByName(urls), current.count() + channels.count())


_LINKS = """
  WITH cur AS (SELECT id, arg_max(deleted_at IS NULL, updated_at) AS live, max(hash) AS hash, max(parent_hash) AS ph, max(root_parent_url) AS url,
                 strftime(min(timestamp), '%Y-%m') AS month FROM casts GROUP BY id),
       norm AS (SELECT *, regexp_replace(regexp_replace(lower(trim(url, ' \t\n\r')), '[/ ]+$', ''), '^http://', 'https://') AS u FROM cur),
       known AS (SELECT DISTINCT regexp_replace(regexp_replace(lower(trim(url, ' \t\n\r')), '[/ ]+$', ''), '^http://', 'https://') AS u FROM channels WHERE deleted_at IS NULL),
       lost AS (SELECT 'parent_hash' AS ref_field, id, month FROM cur WHERE octet_length(ph) > 0 AND ph NOT IN (SELECT hash FROM cur WHERE live)
                UNION ALL
                SELECT 'root_parent_url', id, month FROM norm WHERE u <> '' AND u NOT IN (SELECT u FROM known))"""


@query("p3_found", _LINKS + " SELECT ref_field, id FROM lost")
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return _orphans(spark, folder).select(F.col("field").alias("ref_field"), "id")


@query("p3_orphans_per_month", _LINKS + " SELECT ref_field, month, count(*) AS orphans FROM lost GROUP BY ref_field, month")
def p3_orphans_per_month(spark: SparkSession, folder: str) -> DataFrame:
    return orphans_by_period(_orphans(spark, folder), "month").withColumnRenamed("field", "ref_field")


# ---- 4: parent-child links to full hierarchies


def cast_links(casts: DataFrame) -> DataFrame:
    """One row per cast: id, parent (its id), missing, and extra: the id of the cast that root_parent_hash names (-1: none has it), null for a null hash."""
    parent, root = F.when(F.length("parent_hash") > 0, F.col("parent_hash")), F.col("root_parent_hash")
    rows = casts.select("id", "hash", parent.alias("parent"), root.alias("root")).filter(F.col("id").isNotNull())
    own = rows.select("id", (F.col("parent") == F.col("hash")).alias("self"), (F.col("root") == F.col("hash")).alias("is_root"), "hash", "parent", "root")
    # What names the cast itself needs no lookup; a root named by the parent hash needs none of its own.
    asked = F.array_distinct(F.filter(F.array(F.when(~F.col("self"), F.col("parent")), F.when(~F.col("is_root"), F.col("root"))), lambda x: x.isNotNull()))
    refs = own.select("id", "parent", "root", F.explode(asked).alias("ref"))
    keys = rows.filter(F.col("hash").isNotNull()).groupBy(F.col("hash").alias("ref")).agg(F.min("id").alias("found"))
    found = refs.join(keys, "ref", "left").select("id", F.when(F.col("ref") == F.col("parent"), F.coalesce("found", F.lit(-1))).alias("parent"), F.when(F.col("ref") == F.col("root"), F.coalesce("found", F.lit(-1))).alias("extra"))
    known = own.select("id", F.when(F.col("self"), F.col("id")).alias("parent"), F.when(F.col("is_root"), F.col("id")).alias("extra"))
    links = found.unionByName(known).groupBy("id").agg(F.max("parent").alias("parent"), F.max("extra").alias("extra"))
    return links.select("id", F.when(F.col("parent") >= 0, F.col("parent")).alias("parent"), (F.coalesce("parent", F.lit(0)) < 0).alias("missing"), "extra")


def _tree(spark: SparkSession, folder: str) -> DataFrame:
    return hierarchy(cast_links(table(spark, folder, "casts")))


_WAYS = """
  WITH RECURSIVE c AS (SELECT id, max(hash) AS hash, max(parent_hash) AS ph, max(root_parent_hash) AS rh FROM casts GROUP BY id),
  link AS (SELECT c.id, c.hash, c.rh, p.id AS parent, coalesce(octet_length(c.ph), 0) > 0 AND p.id IS NULL AS missing FROM c LEFT JOIN c p ON octet_length(c.ph) > 0 AND c.ph = p.hash),
  tree AS (SELECT id, id AS root, 0 AS depth, CAST(id AS VARCHAR) AS path, missing AS open_end, hash AS root_hash, rh FROM link WHERE parent IS NULL
           UNION ALL SELECT l.id, t.root, t.depth + 1, t.path || '/' || l.id, t.open_end, t.root_hash, l.rh FROM link l JOIN tree t ON l.parent = t.id)"""


@query(
    "p4_found",
    _WAYS
    + """, lost AS (SELECT id, parent FROM link WHERE id NOT IN (SELECT id FROM tree)),
  down AS (SELECT id AS origin, parent AS place FROM lost UNION SELECT d.origin, l.parent FROM down d JOIN lost l ON d.place = l.id)
  SELECT id, CASE WHEN id IN (SELECT origin FROM down WHERE origin = place) THEN 'cycle' ELSE 'below_cycle' END AS kind FROM lost
  UNION ALL SELECT id, 'wrong_root' FROM tree WHERE NOT open_end AND (rh IS NULL OR rh <> root_hash)""",
)
def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    tree = _tree(spark, folder)
    wrong = F.expr("kind = 'tree' and not open_end and not (extra <=> root)")
    return tree.filter((F.col("kind") != "tree") | wrong).select("id", F.when(wrong, "wrong_root").otherwise(F.col("kind")).alias("kind"))


@query("p4_threads", _WAYS + " SELECT id, root AS root_id, CAST(depth AS BIGINT) AS depth, open_end, (SELECT count(*) FROM tree s WHERE s.root = t.root AND starts_with(s.path, t.path || '/')) AS descendants FROM tree t")
def p4_threads(spark: SparkSession, folder: str) -> DataFrame:
    return _tree(spark, folder).filter("kind = 'tree'").select("id", F.col("root").alias("root_id"), "depth", "open_end", (F.col("size") - 1).alias("descendants"))


@query("p4_paths", _WAYS + " SELECT id, path FROM tree")
def p4_paths(spark: SparkSession, folder: str) -> DataFrame:
    return paths(_tree(spark, folder)).select("id", F.concat_ws("/", F.col("path").cast("array<string>")).alias("path"))


# ---- 5: a few keys holding most records


def _delay(casts: DataFrame) -> DataFrame:
    """fid and delay: microseconds from a cast's time to its row's arrival."""
    return casts.select("fid", (epoch_micros(casts, "created_at") - epoch_micros(casts, "timestamp")).alias("delay"))


_HEAVY = "SELECT '{0}' AS table_name, CAST({1} AS VARCHAR) AS key_value FROM {0} WHERE {1} IS NOT NULL GROUP BY {1} HAVING count(*) * 100 >= (SELECT count(*) FROM {0})"


def _heavy(spark: SparkSession, folder: str) -> list[tuple[str, DataFrame, str, str, DataFrame]]:
    """Of each of the two tables: name, rows, key, value, and its heavy keys."""
    ranks, casts = table(spark, folder, "k3l_channel_rank"), table(spark, folder, "casts")
    return [("k3l_channel_rank", ranks, "channel_id", "score", heavy_keys(ranks.select("channel_id"), "channel_id")), ("casts", _delay(casts), "fid", "delay", heavy_keys(casts.select("fid"), "fid"))]


@query("p5_found", _HEAVY.format("k3l_channel_rank", "channel_id") + " UNION ALL " + _HEAVY.format("casts", "fid"))
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    named = [h.filter("key is not null").select(F.lit(name).alias("table_name"), F.col("key").cast("string").alias("key_value")) for name, _, _, _, h in _heavy(spark, folder)]
    return named[0].unionByName(named[1])


_PROFILE = "SELECT '{0}' AS table_name, CAST({1} AS VARCHAR) AS key_value, count(*) AS n_rows, round(CAST(quantile_disc({2}, 0.5) AS DOUBLE), 9) AS q50, round(CAST(quantile_disc({2}, 0.9) AS DOUBLE), 9) AS q90 FROM {3} WHERE {1} IS NOT NULL GROUP BY {1} HAVING count(*) * 100 >= (SELECT count(*) FROM {0})"


@query(
    "p5_heavy_quantiles",
    _PROFILE.format("k3l_channel_rank", "channel_id", "score", "k3l_channel_rank") + " UNION ALL " + _PROFILE.format("casts", "fid", "delay", "(SELECT fid, date_diff('microsecond', timestamp, created_at) AS delay FROM casts)"),
)
def p5_heavy_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """The heavy keys of both tables with median and ninth decile of their values, by the same histograms."""
    out = []
    for name, rows, key, value, heavy in _heavy(spark, folder):
        p = key_profile(rows, key, value, only=materialise(heavy, "heavy")).filter("key is not null")
        out.append(p.select(F.lit(name).alias("table_name"), F.col("key").cast("string").alias("key_value"), "n_rows", *[F.round(F.col(c).cast("double"), 9).alias(c) for c in ("q50", "q90")]))
    return out[0].unionByName(out[1])


@query(
    "p5_channel_scores",
    """SELECT channel_id, count(*) AS n_rows, round(CAST(max(score) AS DOUBLE), 9) AS greatest, round(avg(CAST(score AS DOUBLE)), 9) AS mean,
         round(CAST(quantile_disc(score, 0.5) AS DOUBLE), 9) AS q50, round(CAST(quantile_disc(score, 0.9) AS DOUBLE), 9) AS q90,
         count(*) * 100 >= (SELECT count(*) FROM k3l_channel_rank) AS heavy FROM k3l_channel_rank GROUP BY channel_id""",
)
def p5_channel_scores(spark: SparkSession, folder: str) -> DataFrame:
    p = key_profile(table(spark, folder, "k3l_channel_rank"), "channel_id", "score")
    return p.select(F.col("key").alias("channel_id"), "n_rows", "heavy", *[F.round(c, 9).alias(c) for c in ("greatest", "mean", "q50", "q90")])


@query(
    "p5_fid_delays",
    """WITH d AS (SELECT fid, date_diff('microsecond', timestamp, created_at) AS delay FROM casts)
       SELECT fid, count(*) AS n_rows, CAST(max(delay) AS DOUBLE) AS greatest, avg(delay) AS mean, CAST(quantile_disc(delay, 0.5) AS DOUBLE) AS q50, CAST(quantile_disc(delay, 0.9) AS DOUBLE) AS q90 FROM d GROUP BY fid""",
)
def p5_fid_delays(spark: SparkSession, folder: str) -> DataFrame:
    p = key_profile(_delay(table(spark, folder, "casts")), "fid", "delay")
    return p.select(F.col("key").alias("fid"), "n_rows", "mean", *[F.col(c).cast("double").alias(c) for c in ("greatest", "q50", "q90")])


# ---- 6: rolling totals over trailing periods

_DAYS = """
  WITH held AS (SELECT channel_id, metric, metric_ts, arg_max(coalesce(int_value, 0), insert_ts) AS v FROM k3l_channel_metrics
                WHERE metric IN ('num_casts', 'unique_casters', 'num_replies') AND channel_id IS NOT NULL AND metric_ts IS NOT NULL GROUP BY ALL),
  daily AS (SELECT channel_id, metric, CAST(timezone('UTC', metric_ts) AS DATE) AS day, sum(v) AS v FROM held GROUP BY ALL),
  span AS (SELECT channel_id, metric, min(day) AS first, max(day) AS last FROM daily GROUP BY ALL),
  grid AS (SELECT channel_id, metric, first, CAST(unnest(generate_series(CAST(first AS TIMESTAMP), CAST(last AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM span),
  dense AS (SELECT g.*, coalesce(d.v, 0) AS v FROM grid g LEFT JOIN daily d USING (channel_id, metric, day)),
  rolled AS (SELECT *, sum(v) OVER (PARTITION BY channel_id, metric ORDER BY day ROWS 6 PRECEDING) AS t7, sum(v) OVER (PARTITION BY channel_id, metric ORDER BY day ROWS 29 PRECEDING) AS t30 FROM dense)"""


def _rolled(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "k3l_channel_metrics").filter(F.col("metric").isin("num_casts", "unique_casters", "num_replies"))
    return rolling_totals(rows, ["channel_id", "metric"], "metric_ts", "int_value", "insert_ts", (7, 30))


@query("p6_found", _DAYS + " SELECT channel_id, metric, strftime(day, '%Y-%m-%d') AS metric_day FROM rolled WHERE day >= first + 29 AND 30 * t7 > 14 * t30")
def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    big = F.col("total_7").cast("decimal(38,0)") * 30 > F.col("total_30").cast("decimal(38,0)") * 14
    return _rolled(spark, folder).filter(big & (F.col("day_index") >= 30)).select("channel_id", "metric", day_text("day").alias("metric_day"))


@query(
    "p6_rolling",
    _DAYS
    + """ SELECT channel_id, metric, strftime(day, '%Y-%m-%d') AS metric_day, CAST(v AS BIGINT) AS day_value, CAST(t7 AS BIGINT) AS total_7, CAST(t30 AS BIGINT) AS total_30,
       round(t7 / 7.0, 6) AS average_7, round(t30 / 30.0, 6) AS average_30 FROM rolled""",
)
def p6_rolling(spark: SparkSession, folder: str) -> DataFrame:
    r = _rolled(spark, folder)
    return r.select("channel_id", "metric", day_text("day").alias("metric_day"), F.col("value").alias("day_value"), "total_7", "total_30", F.round(F.col("total_7") / 7, 6).alias("average_7"), F.round(F.col("total_30") / 30, 6).alias("average_30"))
