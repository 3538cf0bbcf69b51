"""Changes to stored tables as pure functions of old and new rows, for tables that can't be updated in place: the result is written as the next snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def insert_ignore(old: DataFrame, new: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """old, and the new rows whose key it lacks; of new rows with one key the first by `order`. Null-safe in no column: a null key never matches, as in SQL."""
    first = F.row_number().over(W.partitionBy(*key).orderBy(*order))
    once = new.withColumn("__first", first).filter("__first = 1").drop("__first")
    return old.unionByName(once.join(old.select(*key), key, "left_anti"))


def additive_upsert(old: DataFrame, new: DataFrame, key: list[str], value: str) -> DataFrame:
    """Values of equal keys added up: one shuffle, combined on the map side."""
    return old.select(*key, value).unionByName(new.select(*key, value)).groupBy(*key).agg(F.sum(value).alias(value))


def overwrite_upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """New rows, and the old ones whose key they lack."""
    return old.join(new.select(*key), key, "left_anti").unionByName(new)


def fold_log(balances: DataFrame, log: DataFrame, key: list[str], balance: str, amount: str) -> DataFrame:
    """Balances with a log folded in: key, balance, latest (what this log added, 0 if nothing)."""
    delta = log.groupBy(*key).agg(F.sum(amount).alias("__delta"))
    both = balances.select(*key, balance).join(delta, key, "full")
    return both.select(*key, (F.coalesce(balance, F.lit(0)) + F.coalesce("__delta", F.lit(0))).alias(balance), F.coalesce("__delta", F.lit(0)).alias("latest"))


def replace_partitions(new: DataFrame, path: str, partition: str) -> None:
    """Replace only those partitions of a stored table that the new rows have."""
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def keep_missing(old: DataFrame, new: DataFrame, group: str) -> DataFrame:
    """The new scrape, and of groups that it lacks altogether the old rows."""
    return new.unionByName(old.join(new.select(group).distinct(), group, "left_anti"))


def changes_to_counts(rows: DataFrame, seen: DataFrame, source: str, target: str) -> tuple[DataFrame, DataFrame]:
    """Changed records into changes of pair counts: +1 when a live record is first seen, -1 when one that was counted is deleted.

    rows (id, source, target, updated_at, deleted_at), of which the newest per id holds; seen (id) are those counted so
    far. Returns the changes (source, target, delta) and the ids counted from now on. Repeated chunks change nothing more.
    """
    last = rows.groupBy("id").agg(F.max_by(F.struct(source, target, "deleted_at"), "updated_at").alias("r")).select("id", "r.*")
    known = last.join(seen.select("id", F.lit(True).alias("known")), "id", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    live = F.col("deleted_at").isNull()
    delta = F.when(live & ~F.col("known"), 1).when(~live & F.col("known"), -1).otherwise(0)
    changes = known.groupBy(source, target).agg(F.sum(delta).cast("bigint").alias("delta")).filter("delta != 0")
    gone = known.filter(~live).select("id")
    return changes, seen.select("id").join(gone, "id", "left_anti").union(known.filter(live).select("id")).distinct()


def safe_cursor(rows: DataFrame, column: str) -> DataFrame:
    """The second-largest distinct value (cursor), so that the newest, perhaps still growing, moment is left for the next time; no row if there is only one."""
    return rows.select(F.col(column).alias("cursor")).distinct().orderBy(F.desc("cursor")).offset(1).limit(1)


def within_drift(old: DataFrame, new: DataFrame, group: str, least: float) -> DataFrame:
    """One row: groups and rows before and after, and whether neither fell below `least` of what it was."""
    a = old.agg(F.countDistinct(group).alias("groups_before"), F.count(F.lit(1)).alias("rows_before"))
    b = new.agg(F.countDistinct(group).alias("groups_after"), F.count(F.lit(1)).alias("rows_after"))
    ok = (F.col("groups_after") >= F.col("groups_before") * least) & (F.col("rows_after") >= F.col("rows_before") * least)
    return a.crossJoin(b).withColumn("accepted", ok)
