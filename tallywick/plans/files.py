"""Files as sources and sinks (S5 to S9, K1, K8, K9, K11, K15 to K19 and the tools of the inventory): stored tables written in a form, read back, and held against what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.state import replace_partitions
from ..sources.files import EDGES, first_rows, keep_field, read_channel_seeds, read_edges, read_parquet_set, write_edges, write_per_channel, write_scores
from ..sources.tables import table
from ..storage import materialise, workspace
from .registry import query

_EDGES = "SELECT o_custkey AS i, o_orderkey AS j, o_totalprice AS v FROM orders"


def _edges(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as edges from customers to orders."""
    return table(spark, folder, "orders").select(F.col("o_custkey").alias("i"), F.col("o_orderkey").alias("j"), F.col("o_totalprice").alias("v"))


@query("S5_K15_K18_edges_through_gzip_csv", _EDGES)
def s5_edges(spark: SparkSession, folder: str) -> DataFrame:
    path = workspace(spark, "edges")
    write_edges(_edges(spark, folder), path)
    return read_edges(spark, path)


@query("S6_edges_between_listed_ids", "SELECT l_orderkey AS i, l_suppkey AS j, CAST(l_linenumber AS DOUBLE) AS v FROM lineitem WHERE l_orderkey IN (SELECT c_custkey FROM customer) AND l_suppkey IN (SELECT c_custkey FROM customer)")
def s6_listed(spark: SparkSession, folder: str) -> DataFrame:
    """An edge list and a file of ids, both CSV: edges with both ends in the list."""
    path, ids = workspace(spark, "edges"), workspace(spark, "ids")
    write_edges(table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("i"), F.col("l_suppkey").alias("j"), F.col("l_linenumber").cast("double").alias("v")), path)
    table(spark, folder, "customer").select(F.col("c_custkey").alias("id")).write.option("header", True).csv(ids)
    return read_edges(spark, path, ids)


@query("S8_K16_parquet_files_as_one_table", _EDGES)
def s8_parquet(spark: SparkSession, folder: str) -> DataFrame:
    """Two files of scores, written apart and compressed, read as one table."""
    paths = [workspace(spark, f"scores{k}") for k in range(2)]
    for k, path in enumerate(paths):
        write_scores(_edges(spark, folder).filter(F.col("j") % 2 == k), path)
    return read_parquet_set(spark, paths, EDGES)


@query("S9_channel_seeds_from_csv", "SELECT DISTINCT lower(trim(channel_id)) AS channel_id, unnest(moderator_fids) AS i FROM channels")
def s9_seeds(spark: SparkSession, folder: str) -> DataFrame:
    """Channels with comma lists of moderators, written as CSV and read as seeds."""
    path = workspace(spark, "seeds")
    table(spark, folder, "channels").select("channel_id", F.concat_ws(",", F.col("moderator_fids").cast("array<string>")).alias("seeds")).write.option("header", True).csv(path)
    return read_channel_seeds(spark, path).filter("i is not null")


@query("K1_append", "SELECT o_orderkey, o_totalprice FROM orders UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'")
def k1_append(spark: SparkSession, folder: str) -> DataFrame:
    """Rows added to a stored table, whatever it has."""
    path, o = workspace(spark, "appended"), table(spark, folder, "orders")
    o.select("o_orderkey", "o_totalprice").write.parquet(path)
    o.filter("o_orderstatus = 'P'").select("o_orderkey", "o_totalprice").write.mode("append").parquet(path)
    return spark.read.schema(o.select("o_orderkey", "o_totalprice").schema).parquet(path)


@query("K8_replaced_partitions", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS v, o_orderstatus FROM orders")
def k8_replaced(spark: SparkSession, folder: str) -> DataFrame:
    """A stored table by status, of which one partition comes anew."""
    path, o = workspace(spark, "staged"), table(spark, folder, "orders").select("o_orderkey", F.col("o_totalprice").alias("v"), "o_orderstatus")
    o.write.partitionBy("o_orderstatus").parquet(path)
    replace_partitions(o.filter("o_orderstatus = 'F'").withColumn("v", F.col("v") * 2), path, "o_orderstatus")
    return spark.read.schema(o.schema).parquet(path)


@query("K9_truncate_and_append", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0")
def k9_replaced(spark: SparkSession, folder: str) -> DataFrame:
    """A table whose rows are all replaced in one write: readers see the old or the new ones."""
    path, c = workspace(spark, "list"), table(spark, folder, "customer")
    for rows in (c.filter("c_acctbal <= 0"), c.filter("c_acctbal > 0")):
        rows.select("c_custkey", "c_name").write.mode("overwrite").parquet(path)
    return spark.read.schema(c.select("c_custkey", "c_name").schema).parquet(path)


@query("K11_refreshed_view", "SELECT o_custkey, count(*) AS n, max(o_orderdate) AS latest FROM orders GROUP BY 1")
def k11_refreshed(spark: SparkSession, folder: str) -> DataFrame:
    """A named view of a stored snapshot; a refresh writes the next snapshot and moves the name."""
    o = table(spark, folder, "orders")
    for rows in (o.filter("o_orderstatus = 'F'"), o):
        snapshot = materialise(rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("latest")), "snapshot")
        snapshot.createOrReplaceTempView("tallywick_latest_orders")
    return spark.table("tallywick_latest_orders")


@query("K19_folder_per_channel", "SELECT channel_id, CAST(fid AS BIGINT) AS i, CAST(rank AS BIGINT) AS v FROM k3l_channel_rank WHERE strategy_name = 'channel_engagement' AND channel_id IN (SELECT channel_id FROM k3l_channel_rank GROUP BY 1 HAVING count(*) >= 100)")
def k19_folders(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of CSV files for each of the larger channels, read back with the channel from the folder's name."""
    path, r = workspace(spark, "channels"), table(spark, folder, "k3l_channel_rank")
    large = r.groupBy("channel_id").agg(F.count(F.lit(1)).alias("n")).filter("n >= 100").select("channel_id")
    write_per_channel(r.filter("strategy_name = 'channel_engagement'").join(large, "channel_id", "left_semi").select("channel_id", F.col("fid").alias("i"), F.col("rank").alias("v")), path)
    return spark.read.schema("i bigint, v bigint, channel_id string").csv(path, header=True)


@query("S17_first_rows_of_a_field", "SELECT count(*) AS n, count(DISTINCT event_type) AS kinds FROM (SELECT * FROM events WHERE event_type IN ('click') LIMIT 50)")
def s17_tools(spark: SparkSession, folder: str) -> DataFrame:
    """The first rows whose field has one of a few values: how many there are is all that is definite about them."""
    rows = first_rows(keep_field(table(spark, folder, "events"), "event_type", ["click"]), 50)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_type").alias("kinds"))
