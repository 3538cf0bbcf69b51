"""The N best items of every group, by score histograms and an exact ranking of the rows above a safe threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..storage import is_small, materialise


def score_bucket(score: str, per_octave: int = 8) -> F.Column:
    """A whole number that never falls as the score (double, not NaN) rises: logarithmic steps on both sides of zero."""
    size = F.expr(f"least(greatest(log2(abs({score})), -1080d), 1030d)")
    step = (F.floor(size * per_octave) + 1080 * per_octave + 1).cast("int")
    return F.when(F.col(score) > 0, step).when(F.col(score) < 0, -step).otherwise(0)


def score_histogram(rows: DataFrame, groups: list[str], slots: int) -> DataFrame:
    """Per group and bucket, bitmaps of the item slots seen: mergeable, so combined before the shuffle; equal items share a slot."""
    slot = F.pmod(F.xxhash64("item"), F.lit(slots))
    words = rows.withColumn("slot", slot).withColumn("word", F.floor(F.col("slot") / 64).cast("int"))
    return words.groupBy(*groups, "word", "bucket").agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("bits"))


def safe_thresholds(histogram: DataFrame, groups: list[str], n: int) -> DataFrame:
    """Per group the highest bucket such that at least n different items lie in or above it.

    Distinct slots never outnumber distinct items, so n slots prove n items, however often an item is repeated.
    Groups that cannot prove n items have no row.
    """
    higher = W.partitionBy(*groups, "word").orderBy(F.desc("bucket")).rowsBetween(W.unboundedPreceding, -1)
    fresh = histogram.withColumn("before", F.coalesce(F.bit_or("bits").over(higher), F.lit(0).cast("long")))
    gain = fresh.groupBy(*groups, "bucket").agg(F.sum(F.expr("bit_count(bits & ~before)")).alias("gain"))
    total = F.sum("gain").over(W.partitionBy(*groups).orderBy(F.desc("bucket")))
    return gain.withColumn("total", total).filter(F.col("total") >= n).groupBy(*groups).agg(F.max("bucket").alias("threshold"))


def top_n_per_group(df: DataFrame, groups: list[str], item: str, score: str, n: int, salts: int = 32) -> DataFrame:
    """The n best items of each group: the group columns, `item`, `score` (double) and `position` (1 is best).

    An item counts once per group, with its highest score; equal scores go by smaller item first. Rows with a null
    group column, null item, or null or NaN score don't count; infinite scores do. Empty input gives no rows. Other
    columns of df, whatever their names, are ignored.

    One pass builds per-group score histograms, a second drops rows under the group's threshold. The rest is ranked in
    `salts` parts of each group and then among the n winners of the parts, so that equal scores in masses stay spread.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    keys = [f"g{i}" for i in range(len(groups))]
    rows = df.select(*[F.col(g).alias(k) for g, k in zip(groups, keys)], F.col(item).alias("item"), F.col(score).cast("double").alias("score"))
    rows = rows.dropna(subset=[*keys, "item", "score"]).filter(~F.isnan("score")).withColumn("bucket", score_bucket("score"))
    slots = 64
    while slots < 4 * n:
        slots *= 2
    bars = materialise(safe_thresholds(score_histogram(rows, keys, slots), keys, n), "thresholds")
    salted = rows.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(salts)).cast("int"))
    above = F.col("threshold").isNull() | (F.col("bucket") >= F.col("threshold"))
    if is_small(bars):
        kept = salted.join(F.broadcast(bars), keys, "left").filter(above).repartition(*keys, "part")
    else:
        # Thresholds of very many groups come to the rows by the shuffle that the ranking needs anyway, a copy per part.
        copies = bars.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).repartition(*keys, "part")
        kept = salted.repartition(*keys, "part").join(copies, [*keys, "part"], "left").filter(above)
    best = kept.groupBy(*keys, "part", "item").agg(F.max("score").alias("score"))
    order = [F.desc("score"), F.asc("item")]
    winners = best.withColumn("position", F.row_number().over(W.partitionBy(*keys, "part").orderBy(*order))).filter(F.col("position") <= n)
    final = winners.withColumn("position", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("position") <= n)
    return final.select(*[F.col(k).alias(g) for g, k in zip(groups, keys)], F.col("item").alias(item), F.col("score").alias(score), "position")
