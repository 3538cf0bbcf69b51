"""Per-period aggregates by event time, corrected as late records arrive: checkpoint and replay with a cut-off for lateness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.times import DAY_US as DAY
from ..functions.times import epoch_micros
from ..storage import materialise, workspace


def deliveries(df: DataFrame, key: str | None, event_id: str, event_ts: str, arrival_ts: str, value: F.Column | None = None) -> DataFrame:
    """Rows as a ledger takes them: key, id, at and arrived (microseconds), value (double, null without one). Events without id, event time or arrival time have no place in time and are left out."""
    rows = df.select(
        (F.col(key).cast("string") if key else F.lit("all")).alias("key"), F.col(event_id).alias("id"), epoch_micros(df, event_ts).alias("at"), epoch_micros(df, arrival_ts).alias("arrived"),
        (F.lit(None) if value is None else value).cast("double").alias("value"),
    )
    return rows.dropna(subset=["id", "at", "arrived"])


def once(rows: DataFrame) -> DataFrame:
    """One row per event of deliveries: a redelivered event arrives with its first row."""
    if "value" not in rows.columns:
        rows = rows.withColumn("value", F.lit(None).cast("double"))
    return rows.groupBy("id").agg(F.min("key").alias("key"), F.min("at").alias("at"), F.min("arrived").alias("arrived"), F.min_by("value", "arrived").alias("value"))


def first_arrivals(df: DataFrame, key: str | None, event_id: str, event_ts: str, arrival_ts: str) -> DataFrame:
    """The deliveries of df, one row per event."""
    return once(deliveries(df, key, event_id, event_ts, arrival_ts))


#: The mergeable state: number of events, and sum, least and greatest of their values.
STATE = ("n", "total", "least", "greatest")
_TYPES = "n bigint, total double, least double, greatest double"


class ReplayLedger:
    """Running state per key in event-time order, with snapshots of it between stretches of `snapshot_every` periods.

    A batch of deliveries may hold events that came before, in it or in earlier batches: the first arrival counts, the rest
    changes nothing. What arrives past the cut-off (period end + lateness) is kept as rejected. The rest is folded into
    states per key and period; the newest snapshot at or before the earliest stretch that got any is restored, the sorted
    suffix of states from there on is replayed with the new ones merged in, and the outputs of that suffix are replaced.

    Tables are folders <name>/b=<batch>/s=<stretch> in the shared folder; of a stretch the folder of the highest batch
    holds, so a batch that failed half-way is simply written again. A batch reads the events of the stretches that its
    own fall in, one snapshot, and the outputs after it: what came long ago is neither read nor written again. Snapshots
    are made for the stretches that may still change, as far as batches come in the order of arrival; batches in another
    order give the same, from older snapshots. Superseded folders are deleted by the next batch. Ids of all events are kept.

    States are mergeable: hot keys are combined on the map side, and a key's replay sorts one row per period, not its
    events. Null keys form a key of their own. Null values don't count in sum, least and greatest. Empty batches change nothing.
    """

    EVENTS = "id bigint, key string, period bigint, arrived bigint, value double, late boolean, b bigint, s bigint"
    SNAPSHOT = f"key string, {_TYPES}, b bigint, s bigint"
    OUTPUT = f"key string, period bigint, {_TYPES}, {_TYPES.replace('n b', 'n_so_far b').replace('l d', 'l_so_far d').replace('t d', 't_so_far d')}, b bigint, s bigint"

    def __init__(self, spark: SparkSession, root: str, period: int = DAY, lateness: int = 3 * DAY, snapshot_every: int = 7):
        self.spark, self.root, self.period, self.lateness, self.snapshot_every = spark, root, period, lateness, snapshot_every

    def _hadoop(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _folders(self, name: str, below: int | None = None) -> list[tuple[int, int]]:
        """(batch, stretch) of a table's folders, of all batches or those before one."""
        fs, top = self._hadoop(f"{self.root}/{name}")
        if not fs.exists(top):
            return []
        of = lambda path, mark: [(x.getPath(), int(x.getPath().getName()[2:])) for x in fs.listStatus(path) if x.getPath().getName().startswith(mark)]
        return [(b, s) for path, b in of(top, "b=") if below is None or b < below for _, s in of(path, "s=")]

    def _newest(self, name: str, below: int | None = None) -> dict[int, int]:
        """Of each stretch the highest batch."""
        return {s: b for b, s in sorted(self._folders(name, below))}

    def _read(self, name: str, schema: str, folders: list[tuple[int, int]]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*[f"{self.root}/{name}/b={b:012d}/s={s}" for b, s in folders])

    def _write(self, df: DataFrame, name: str, batch: int) -> None:
        df.write.mode("overwrite").partitionBy("s").parquet(f"{self.root}/{name}/b={batch:012d}")

    def _prune(self, batch: int) -> None:
        """Delete what the batches before this one have superseded: snapshots with a later change before them, older outputs of a stretch."""
        outputs, snapshots = self._folders("output", batch), self._folders("snapshot", batch)
        since = {b: min(s for c, s in outputs if c == b) for b, _ in outputs}
        newest, latest = self._newest("output", batch), self._newest("snapshot", batch)
        old = [("snapshot", b, s) for b, s in snapshots if latest[s] > b or any(c > b and first < s for c, first in since.items())]
        for name, b, s in old + [("output", b, s) for b, s in outputs if newest[s] > b]:
            fs, path = self._hadoop(f"{self.root}/{name}/b={b:012d}/s={s}")
            fs.delete(path, True)

    def apply(self, rows: DataFrame, batch: int) -> None:
        """Fold in a batch of deliveries. The same batch number again replaces what it wrote, if none came after it."""
        self._prune(batch)
        stretch = F.floor(F.col("period") / self.snapshot_every).cast("bigint")
        new = once(rows).withColumn("period", F.floor(F.col("at") / self.period).cast("bigint")).withColumn("key", F.coalesce("key", F.lit(""))).withColumn("s", stretch)
        new = new.withColumn("late", F.col("arrived") > (F.col("period") + 1) * F.lit(self.period) + F.lit(self.lateness))
        earlier = self._folders("events", batch)
        if earlier:
            touched = {r[0] for r in rows.select(F.floor(F.col("at") / (self.period * self.snapshot_every)).cast("bigint")).distinct().collect()}  # as many as stretches of time
            seen = self._read("events", self.EVENTS, [(b, s) for b, s in earlier if s in touched])
            new = new.join(seen.select("id", "s"), ["id", "s"], "left_anti")
        self._write(new.select("id", "key", "period", "arrived", "value", "late", "s"), "events", batch)
        fresh = self._read("events", self.EVENTS, [(b, s) for b, s in self._folders("events") if b == batch]).filter("not late")
        folded = fresh.groupBy("key", "period", "s").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.min("value").alias("least"), F.max("value").alias("greatest"))
        folded = materialise(folded, "folded")
        since, until = folded.agg(F.min("s"), F.max("s")).first()
        if since is None:
            return
        arrived = fresh.agg(F.max("arrived")).first()[0]
        restart, version = max(((s, b) for s, b in self._newest("snapshot", batch).items() if s <= since), default=(None, None))
        base = self._read("snapshot", self.SNAPSHOT, [] if restart is None else [(version, restart)]).select("key", *STATE)
        later = [(b, s) for s, b in self._newest("output", batch).items() if restart is None or s >= restart]
        states = self._read("output", self.OUTPUT, later).select("key", "period", "s", *STATE).unionByName(folded)
        # The snapshot goes before all periods of its key, and the rest is replayed on top of it.
        start = base.withColumns({"period": F.lit(-(1 << 62)).cast("bigint"), "s": F.lit(-(1 << 62)).cast("bigint")})
        merged = states.unionByName(start.select(*states.columns)).groupBy("key", "period", "s").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("greatest").alias("greatest"))
        order = W.partitionBy("key").orderBy("period").rowsBetween(W.unboundedPreceding, 0)
        how = {"n": F.sum, "total": F.sum, "least": F.min, "greatest": F.max}
        replayed = materialise(merged.select("*", *[how[c](c).over(order).alias(f"{c}_so_far") for c in STATE]), "replayed")
        self._write(replayed.filter(F.col("s") >= since), "output", batch)
        still_open = (arrived - self.lateness - self.period) // (self.period * self.snapshot_every)
        marks = [m for m in range(max(since + 1, still_open), until + 1)]
        if marks:
            at = F.explode(F.filter(F.array(*[F.lit(m).cast("bigint") for m in marks]), lambda m: F.col("s") < m))
            last = replayed.withColumn("m", at).groupBy("key", "m").agg(F.max_by(F.struct(*[F.col(f"{c}_so_far").alias(c) for c in STATE]), "period").alias("x"))
            self._write(last.select("key", "x.*", F.col("m").alias("s")), "snapshot", batch)

    def outputs(self) -> DataFrame:
        """key, period, and of its events in time n, total, least and greatest, the same up to its end (n_so_far ...), as corrected by the last batch."""
        return self._read("output", self.OUTPUT, [(b, s) for s, b in self._newest("output").items()]).drop("b", "s").withColumn("so_far", F.col("n_so_far"))

    def rejected(self) -> DataFrame:
        """Events whose first arrival is after the cut-off: key, id, period, arrived, batch."""
        return self._read("events", self.EVENTS, self._folders("events")).filter("late").select("key", "id", "period", "arrived", F.col("b").alias("batch"))


def replay_in_batches(arrivals: DataFrame, batches: int = 6, **options) -> ReplayLedger:
    """Run a ledger over stored deliveries as they came in: `batches` equal stretches of arrival time, one after the other."""
    spark = arrivals.sparkSession
    kept = materialise(arrivals, "arrivals")
    lo, hi = kept.agg(F.min("arrived"), F.max("arrived")).first()
    ledger = ReplayLedger(spark, workspace(spark, "ledger"), **options)
    if lo is None:
        return ledger
    width = (hi - lo) // batches + 1
    for b in range(batches):
        ledger.apply(kept.filter((F.col("arrived") >= lo + b * width) & (F.col("arrived") < lo + (b + 1) * width)), b)
    return ledger
