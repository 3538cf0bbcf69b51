import random

import pytest
from pyspark.sql import functions as F

from tallywick.operators.orphans import PACKED, bloom_filter, find_orphans, orphans_by_period


@pytest.mark.parametrize("bits,n", [(12, None), (1, 10), (64 * PACKED, 7)])
def test_against_brute_force(spark, bits, n):
    """With a roomy filter, a crowded one, and one that is tested in seven shards."""
    random.seed(bits)
    keys = [("p", f"k{i}".encode()) for i in range(0, 900, 2)] + [("q", f"k{i}".encode()) for i in range(50)] + [("p", None)]
    refs = [(random.choice("pq"), i, random.choice([None, b"", b"hot", f"k{random.randrange(1000)}".encode()]), random.choice(["a", None])) for i in range(3000)]
    df = spark.createDataFrame(refs, "field string, id bigint, ref binary, word string")
    found = find_orphans(df, spark.createDataFrame(keys, "field string, key binary"), n or len(keys), shard_bytes=8 * PACKED, bits_per_key=bits)
    known = set(keys)
    assert sorted(r.id for r in found.collect()) == sorted(i for f, i, ref, _ in refs if ref is not None and (f, ref) not in known)
    assert sum(r.orphans for r in orphans_by_period(found, "word").collect()) == found.count()


def test_many_keys_in_shards(spark):
    keys = spark.range(1_000_000).select(F.lit("p").alias("field"), F.col("id").alias("key"))
    refs = spark.range(999_000, 1_001_000).select(F.lit("p").alias("field"), "id", F.col("id").alias("ref"))
    assert find_orphans(refs, keys, 1_000_000, shard_bytes=1 << 20).count() == 1000
    packed = bloom_filter(keys.limit(1000), 4 * PACKED).collect()
    assert sorted(r.block for r in packed) == [0, 1, 2, 3] and all(len(r.bits) == PACKED for r in packed)


def test_repeats_and_empty_sides(spark):
    refs = spark.createDataFrame([("p", 1, b"x"), ("p", 1, b"x")], "field string, id bigint, ref binary")
    none = spark.createDataFrame([], "field string, key binary")
    assert find_orphans(refs, none, 0).count() == 2
    assert find_orphans(refs.limit(0), none, 0).count() == 0
