"""The generic constructs of the inventory (S, P, J, A, W, O, U), each on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.semantics import SCORE_AGGREGATES, asc, desc, distinct_sorted, mixed
from ..operators.graph import ranked
from ..sources.tables import table
from .registry import query


@query("S2_named_parameters", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 1000 AND o_orderpriority = '1-URGENT'")
def s2_parameters(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql("SELECT o_orderkey, o_totalprice FROM {o} WHERE o_totalprice >= :least AND o_orderpriority = :priority", args={"least": 1000, "priority": "1-URGENT"}, o=table(spark, folder, "orders"))


@query("S13_json_parameter_as_relation", "SELECT o_orderkey, CAST(t.score AS DOUBLE) AS score FROM orders JOIN (VALUES (1, 0.5), (2, 0.25), (7, 0.125)) t(fid, score) ON o_custkey = t.fid")
def s13_json(spark: SparkSession, folder: str) -> DataFrame:
    trust = spark.sql("SELECT inline(from_json(:j, 'array<struct<fid:int,score:double>>'))", args={"j": '[{"fid":1,"score":0.5},{"fid":2,"score":0.25},{"fid":7,"score":0.125}]'})
    o = table(spark, folder, "orders")
    return o.join(F.broadcast(trust), o["o_custkey"] == trust["fid"]).select("o_orderkey", "score")


@query("P2_ranges", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_quantity BETWEEN 10 AND 12 AND l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1996-01-01'")
def p2_ranges(spark: SparkSession, folder: str) -> DataFrame:
    li = table(spark, folder, "lineitem")
    d = lambda x: F.lit(x).cast("timestamp_ntz")
    return li.filter(F.col("l_quantity").between(10, 12) & (F.col("l_shipdate") >= d("1995-01-01 00:00:00")) & (F.col("l_shipdate") < d("1996-01-01 00:00:00"))).select("l_orderkey", "l_linenumber", "l_partkey")


@query("P5_not_in_with_nulls", "SELECT doc_id FROM documents WHERE fid NOT IN (SELECT fid FROM documents WHERE lang = 'de' AND fid IS NOT NULL)")
def p5_not_in(spark: SparkSession, folder: str) -> DataFrame:
    """NOT IN of a list without nulls: an anti join of the rows whose own key isn't null."""
    d = table(spark, folder, "documents")
    return d.filter("fid is not null").join(d.filter("lang = 'de' and fid is not null").select("fid"), "fid", "left_anti").select("doc_id")


@query("P10_like_families", "SELECT channel_id FROM channels WHERE description ILIKE '%SHARE%' AND description NOT LIKE '%notes%' AND NOT regexp_matches(description, '^[0-9]')")
def p10_like(spark: SparkSession, folder: str) -> DataFrame:
    d = F.col("description")
    return table(spark, folder, "channels").filter(d.ilike("%SHARE%") & ~d.like("%notes%") & ~d.rlike("^[0-9]")).select("channel_id")


@query("P14_equal_to_scalar_subquery", "SELECT pseudo_id FROM k3l_rank WHERE date = (SELECT max(date) FROM k3l_rank)")
def p14_scalar(spark: SparkSession, folder: str) -> DataFrame:
    r = table(spark, folder, "k3l_rank").select("pseudo_id", "date")
    return r.join(F.broadcast(r.agg(F.max("date").alias("date"))), "date").select("pseudo_id")


@query("P15_case_ladder", "SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN 'a' WHEN n_regionkey IN (1, 2) THEN 'b' ELSE 'c' END AS part FROM nation")
def p15_case(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("n_regionkey")
    return table(spark, folder, "nation").select("n_nationkey", F.when(k == 0, "a").when(k.isin(1, 2), "b").otherwise("c").alias("part"))


@query("J3_full_outer_as_union", "WITH a AS (SELECT o_custkey AS k, count(*) AS orders FROM orders GROUP BY 1), b AS (SELECT l_suppkey AS k, count(*) AS lines FROM lineitem GROUP BY 1) SELECT k, coalesce(orders, 0) AS orders, coalesce(lines, 0) AS lines FROM a FULL JOIN b USING (k)")
def j3_union(spark: SparkSession, folder: str) -> DataFrame:
    a = table(spark, folder, "orders").select(F.col("o_custkey").alias("k"), F.lit("o").alias("t"))
    b = table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("k"), F.lit("l").alias("t"))
    return a.union(b).groupBy("k").agg(F.count(F.when(F.col("t") == "o", 1)).alias("orders"), F.count(F.when(F.col("t") == "l", 1)).alias("lines"))


@query("J9_interval_join", "SELECT o_orderkey, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate >= o_orderdate AND l_shipdate < o_orderdate + INTERVAL 30 DAY GROUP BY o_orderkey")
def j9_interval(spark: SparkSession, folder: str) -> DataFrame:
    o, li = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    near = (li["l_orderkey"] == o["o_orderkey"]) & (li["l_shipdate"] >= o["o_orderdate"]) & (li["l_shipdate"] < o["o_orderdate"] + F.expr("INTERVAL '30' DAY"))
    return o.join(li, near).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query("J10_filter_before_outer_join", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F'")
def j10_outer(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return table(spark, folder, "customer").select("c_custkey").join(o, "c_custkey", "left")


@query("J11_semi_and_anti", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def j11_semi_anti(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    c = table(spark, folder, "customer").select("c_custkey")
    return c.join(o.filter("o_orderstatus = 'F'"), "c_custkey", "left_semi").join(o.filter("o_orderstatus = 'P'"), "c_custkey", "left_anti")


@query("J13_rows_of_latest_moment", "SELECT channel_id, strategy_name, fid FROM k3l_channel_rank r WHERE compute_ts >= (SELECT max(compute_ts) FROM k3l_channel_rank m WHERE m.channel_id = r.channel_id AND m.strategy_name = r.strategy_name)")
def j13_latest(spark: SparkSession, folder: str) -> DataFrame:
    r = table(spark, folder, "k3l_channel_rank").select("channel_id", "strategy_name", "fid", "compute_ts")
    last = r.groupBy("channel_id", "strategy_name").agg(F.max("compute_ts").alias("compute_ts"))
    return r.join(last, ["channel_id", "strategy_name", "compute_ts"]).select("channel_id", "strategy_name", "fid")


@query("A1_A3_aggregates", "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_quantity), 4) AS mean, count(DISTINCT l_suppkey) AS suppliers, count(*) FILTER (l_discount > 0.05) AS cheap FROM lineitem GROUP BY ALL")
def a1_aggregates(spark: SparkSession, folder: str) -> DataFrame:
    li = table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus")
    return li.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_quantity"), 4).alias("mean"), F.countDistinct("l_suppkey").alias("suppliers"), F.count(F.when(F.col("l_discount") > 0.05, 1)).alias("cheap"))


@query("A5_boolean_aggregates", "SELECT o_custkey, bool_and(o_totalprice > 1000) AS all_large, bool_or(o_orderstatus = 'P') AS any_open FROM orders GROUP BY 1")
def a5_booleans(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").groupBy("o_custkey").agg(F.bool_and(F.col("o_totalprice") > 1000).alias("all_large"), F.bool_or(F.col("o_orderstatus") == "P").alias("any_open"))


@query("A6_ordered_lists", "SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderdate DESC, o_orderkey DESC) AS recent, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS kinds FROM orders GROUP BY 1")
def a6_lists(spark: SparkSession, folder: str) -> DataFrame:
    recent = F.sort_array(F.collect_list(F.struct("o_orderdate", "o_orderkey")), asc=False)
    return table(spark, folder, "orders").groupBy("o_custkey").agg(F.concat_ws(",", F.transform(recent, lambda x: x["o_orderkey"].cast("string"))).alias("recent"), F.concat_ws(",", distinct_sorted("o_orderstatus")).alias("kinds"))


@query("A7_json_series", """SELECT o_custkey, '[' || string_agg('{"k":' || o_orderkey || ',"s":"' || o_orderstatus || '"}', ',' ORDER BY o_orderkey DESC) || ']' AS series FROM orders GROUP BY 1""")
def a7_json(spark: SparkSession, folder: str) -> DataFrame:
    rows = F.sort_array(F.collect_list(F.struct(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))), asc=False)
    return table(spark, folder, "orders").groupBy("o_custkey").agg(F.to_json(rows).alias("series"))


@query("A8_A9_percentiles", "SELECT o_orderpriority, quantile_disc(o_totalprice, 0.5) AS median, round(quantile_cont(o_totalprice, 0.9), 4) AS p90 FROM orders GROUP BY 1")
def a8_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").groupBy("o_orderpriority").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY o_totalprice)").alias("median"), F.round(F.expr("percentile_cont(0.9) WITHIN GROUP (ORDER BY o_totalprice)"), 4).alias("p90"))


@query("A11_A12_two_level_scores", "WITH s AS (SELECT l_orderkey, l_suppkey, sum(l_discount) AS x FROM lineitem GROUP BY ALL) SELECT l_orderkey, round(sum(x), 8) AS plain, round(sum(x * x), 8) AS squares, round(sqrt(avg(x * x)), 8) AS rms, round(sum(pow(x, 1.0 / 3)), 8) AS roots FROM s GROUP BY 1")
def a12_scores(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.sum("l_discount").alias("x"))
    return s.groupBy("l_orderkey").agg(*[F.round(SCORE_AGGREGATES[a](F.col("x")), 8).alias(n) for a, n in (("sum", "plain"), ("sumsquare", "squares"), ("rms", "rms"), ("sumcuberoot", "roots"))])


@query("A13_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 12")
def a13_having(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).filter("n >= 12")


@query("W4_shuffled_within_bucket", "SELECT o_orderkey, row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY (o_orderkey % 2147483647 * 1103515245 + 11 * 12345) % 2147483647, o_orderkey) AS place FROM orders")
def w4_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """An order within each day that looks random and is the same in every run."""
    day = F.col("o_orderdate").cast("date")
    return table(spark, folder, "orders").select("o_orderkey", F.row_number().over(W.partitionBy(day).orderBy(mixed("o_orderkey", 11), "o_orderkey")).cast("bigint").alias("place"))


@query("W9_W10_shared_ranks_and_running_sums", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC) AS place, sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_partkey, l_linenumber ROWS UNBOUNDED PRECEDING) AS so_far FROM lineitem")
def w9_running(spark: SparkSession, folder: str) -> DataFrame:
    part = W.partitionBy("l_orderkey")
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.rank().over(part.orderBy(F.desc("l_quantity"))).cast("bigint").alias("place"), F.sum("l_quantity").over(part.orderBy("l_quantity", "l_partkey", "l_linenumber").rowsBetween(W.unboundedPreceding, 0)).alias("so_far"))


@query("W13_global_row_number", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders")
def w13_global(spark: SparkSession, folder: str) -> DataFrame:
    """A rank over a whole table by range partitions and offsets, not in one task."""
    o = table(spark, folder, "orders").select(F.col("o_totalprice").alias("v"), F.col("o_orderkey").alias("i"))
    return ranked(o).select(F.col("i").alias("o_orderkey"), "rank")


@query("O1_null_order_and_page", "SELECT doc_id, lang FROM documents ORDER BY lang DESC NULLS FIRST, doc_id LIMIT 40 OFFSET 10")
def o1_page(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").orderBy(desc("lang"), asc("doc_id")).offset(10).limit(40).select("doc_id", "lang")


@query("O6_reproducible_sample", "SELECT c_custkey FROM customer ORDER BY (c_custkey % 2147483647 * 1103515245 + 3 * 12345) % 2147483647, c_custkey LIMIT 20")
def o6_sample(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").orderBy(mixed("c_custkey", 3), "c_custkey").limit(20).select("c_custkey")


@query("U1_U2_unions", "SELECT k, count(*) AS n FROM (SELECT o_custkey AS k FROM orders UNION ALL SELECT DISTINCT k FROM (SELECT c_custkey AS k FROM customer UNION SELECT l_suppkey FROM lineitem)) GROUP BY k")
def u1_unions(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders").select(F.col("o_custkey").alias("k"))
    u = table(spark, folder, "customer").select(F.col("c_custkey").alias("k")).union(table(spark, folder, "lineitem").select("l_suppkey")).distinct()
    return o.union(u).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("T7_T8_age_buckets", "SELECT CAST(floor(date_diff('microsecond', ts, TIMESTAMP '2024-01-31') / 1e6 / 21600) AS BIGINT) AS bucket, event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-24' AND ts <= TIMESTAMP '2024-01-31' GROUP BY ALL")
def t7_ages(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    end = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    age = (F.unix_micros(end.cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))) / 1e6
    return e.filter((F.col("ts") >= F.lit("2024-01-24 00:00:00").cast("timestamp_ntz")) & (F.col("ts") <= end)).groupBy(F.floor(age / 21_600).cast("bigint").alias("bucket"), "event_type").agg(F.count(F.lit(1)).alias("n"))
