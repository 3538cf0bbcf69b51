"""Structured Streaming around the batch operators: every micro-batch is one step of the same state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.late_events import ReplayLedger, deliveries


def ledger_stream(stream: DataFrame, ledger: ReplayLedger, key: str | None, event_id: str, event_ts: str, arrival_ts: str, checkpoint: str) -> StreamingQuery:
    """Feed a ReplayLedger from a stream: counts per period, corrected as late events arrive.

    An event that comes again, in whatever batch, changes nothing: the ledger knows its id. A batch that is run again
    replaces its own tables, so results are exactly-once.
    """

    def step(batch: DataFrame, number: int) -> None:
        ledger.apply(deliveries(batch, key, event_id, event_ts, arrival_ts), number)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_stream(stream: DataFrame, path: str, key: list[str], order: list[str], checkpoint: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery:
    """Insert-ignore by key into a table of one folder per batch: a key that an earlier batch has is left out, also when batches come in other sizes or twice."""
    spark: SparkSession = stream.sparkSession

    def step(batch: DataFrame, number: int) -> None:
        new = shape(batch)
        first = F.row_number().over(W.partitionBy(*key).orderBy(*order))
        new = new.withColumn("__first", first).filter("__first = 1").drop("__first")
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
        earlier = [str(s.getPath()) for s in fs.listStatus(target) if int(s.getPath().getName()) < number] if fs.exists(target) else []
        if earlier:
            new = new.join(spark.read.schema(new.schema).parquet(*earlier).select(*key), key, "left_anti")
        new.write.mode("overwrite").parquet(f"{path}/{number:012d}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, ts: str, kind: str, window: str, delay: str) -> DataFrame:
    """Counts per kind and window of event time; what is later than the watermark is dropped."""
    return stream.withWatermark(ts, delay).groupBy(F.window(ts, window), kind).agg(F.count(F.lit(1)).alias("n"))
