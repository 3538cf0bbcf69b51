"""Files as sources and sinks: edge lists, seed lists, score tables; schemas are given, never guessed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

EDGES = "i bigint, j bigint, v double"


def read_edges(spark: SparkSession, path: str, ids: str | None = None) -> DataFrame:
    """A CSV edge list with header i,j,v; with `ids` (a file of ids, one per line, with header id) only edges between those."""
    edges = spark.read.schema(EDGES).csv(path, header=True).dropna(subset=["i", "j"])
    if ids is None:
        return edges
    known = spark.read.schema("id bigint").csv(ids, header=True).distinct()
    return edges.join(known.withColumnRenamed("id", "i"), "i", "left_semi").join(known.withColumnRenamed("id", "j"), "j", "left_semi").select("i", "j", "v")


def read_channel_seeds(spark: SparkSession, path: str) -> DataFrame:
    """channel id and comma list of seed fids to rows (channel_id, i): names in lower case, of a repeated channel the last row holds, blanks and repeats dropped."""
    rows = spark.read.schema("channel_id string, seeds string").csv(path, header=True).dropna(subset=["channel_id"])
    rows = rows.withColumn("channel_id", F.lower(F.trim("channel_id"))).withColumn("line", F.monotonically_increasing_id())
    last = rows.withColumn("r", F.row_number().over(W.partitionBy("channel_id").orderBy(F.desc("line")))).filter("r = 1")
    return last.select("channel_id", F.explode(F.split("seeds", ",")).alias("s")).select("channel_id", F.expr("try_cast(trim(s) as bigint)").alias("i")).dropna().distinct()


def read_parquet_set(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """Several Parquet files or folders as one table; unreadable files are skipped, none left is an error."""
    df = spark.read.option("ignoreCorruptFiles", "true").schema(schema).parquet(*paths)
    if df.isEmpty():
        raise ValueError("no readable rows")
    return df


def write_edges(edges: DataFrame, path: str) -> None:
    edges.select("i", "j", "v").write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)


def write_per_channel(rows: DataFrame, path: str) -> None:
    """A folder of CSV files per channel_id."""
    rows.write.mode("overwrite").option("header", True).partitionBy("channel_id").csv(path)


def write_scores(scores: DataFrame, path: str) -> None:
    scores.write.mode("overwrite").option("compression", "lz4").parquet(path)


def first_rows(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def keep_field(df: DataFrame, field: str, values: list) -> DataFrame:
    """The rows whose field has one of the values: a small given list."""
    condition: Column = F.col(field).isin(values)
    return df.filter(condition)
