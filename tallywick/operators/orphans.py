"""References to records that do not exist: a Bloom filter proves definite orphans, an exact join settles the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialise, workspace

#: Bits of the filter per key: with four bits set in one word, about one orphan in fifty passes and is joined.
BITS_PER_KEY = 12
#: Bytes of filter that are broadcast at once. A larger filter is tested shard by shard, each within this size.
SHARD_BYTES = 64 << 20
#: Words of 64 bits in one row of the filter, so that what a row costs besides doesn't count.
PACKED = 1 << 10


def _place(key: str, words: int) -> tuple[F.Column, F.Column]:
    """The word of a key of a field, and the four bits it sets there, from two independent hashes."""
    h = f"xxhash64(2, {key})"
    return F.pmod(F.xxhash64(F.lit(1), "field", key), F.lit(words)), F.expr(" | ".join(f"shiftleft(1L, cast(shiftright({h}, {s}) & 63 as int))" for s in (0, 7, 14, 21)))


def bloom_filter(keys: DataFrame, words: int) -> DataFrame:
    """A register-blocked Bloom filter over keys(field, key), packed: one row (block, bits) per PACKED words, built in one shuffle. `words` is a multiple of PACKED."""
    word, bits = _place("key", words)
    split = lambda df, w, b: df.select(F.shiftright(w, 10).alias("block"), (w % PACKED).cast("int").alias("at"), b.alias("b"))
    zeros = keys.sparkSession.range(words)
    rows = split(keys, word, bits).unionByName(split(zeros, F.col("id"), F.lit(0).cast("bigint"))).repartition("block")
    full = rows.groupBy("block", "at").agg(F.bit_or("b").alias("b"))
    return full.groupBy("block").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "b"))), lambda x: x["b"]).alias("bits"))


def find_orphans(refs: DataFrame, targets: DataFrame, n_targets: int, shard_bytes: int = SHARD_BYTES, bits_per_key: int = BITS_PER_KEY) -> DataFrame:
    """The rows of refs(field, id, ref, ...) whose ref is no key of targets(field, key) of the same field.

    `n_targets` is an upper bound of the targets' rows and sizes the filter. Only up to shard_bytes of it are broadcast at
    once: a larger filter, and with it the references, is cut into shards by the hash of the key, which are tested one
    after the other, so that any number of keys goes the same way. Null refs are no references; null keys match nothing.
    Repeated rows of refs come out as often; repeated keys don't matter. No targets: every reference is an orphan. ref and
    key must be of one type.

    A reference whose bits aren't all set is an orphan for certain. The others are joined exactly: a left-anti join by
    hash partitions, in which AQE splits a hot reference, as that side has every row of it once and the keys' side one.
    """
    spark = refs.sparkSession
    keys = targets.filter(F.col("key").isNotNull())
    blocks = max(1, -(-max(n_targets, 1) * bits_per_key // (64 * PACKED)))
    per_shard = max(1, shard_bytes // (8 * PACKED))
    shards = -(-blocks // per_shard)
    words = blocks * PACKED
    bloom = bloom_filter(keys, words)
    word, want = _place("ref", words)
    rows = refs.filter(F.col("ref").isNotNull()).select(F.struct("*").alias("row"), "field", "ref")  # other columns keep their names inside
    rows = rows.withColumn("word", word).withColumn("block", F.shiftright("word", 10))
    if shards > 1:
        shard = F.floor(F.col("block") / per_shard).cast("int")
        bloom, rows = materialise(bloom.withColumn("shard", shard), "filter", ["shard"]), materialise(rows.withColumn("shard", shard), "refs", ["shard"])
    path, kept = workspace(spark, "tested"), None
    for s in range(shards):
        part, filter_ = (rows, bloom) if shards == 1 else (rows.filter(F.col("shard") == s).drop("shard"), bloom.filter(F.col("shard") == s).drop("shard"))
        bits = F.element_at("bits", (F.col("word") % PACKED + 1).cast("int"))
        tested = part.join(F.broadcast(filter_), "block").withColumn("certain", bits.bitwiseAND(want) != want).select("row", "field", "ref", "certain")
        kept = tested.schema
        tested.write.mode("overwrite").parquet(f"{path}/{s}")
    tested = spark.read.schema(kept).parquet(*[f"{path}/{s}" for s in range(shards)])
    exact_keys = keys.select("field", F.col("key").alias("ref")).distinct()
    verified = tested.filter("not certain").join(exact_keys, ["field", "ref"], "left_anti").select("row.*")
    return tested.filter("certain").select("row.*").unionByName(verified)


def orphans_by_period(orphans: DataFrame, period: str) -> DataFrame:
    """Orphans per field and period."""
    return orphans.groupBy("field", period).agg(F.count(F.lit(1)).alias("orphans"))
