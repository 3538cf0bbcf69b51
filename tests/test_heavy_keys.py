import math
import random
import struct
from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from tallywick.operators.heavy_keys import double_bits, heavy_keys, key_profile

SCHEMA = "k string, v double, key string, n_rows int, q int"


def brute(rows):
    groups = {}
    for k, v, *_ in rows:
        groups.setdefault(k, []).append(v)
    out = {}
    for k, vs in groups.items():
        s = sorted(v for v in vs if v is not None and v == v)
        pick = lambda q: s[max(1, math.ceil(q * len(s))) - 1] if s else None  # noqa: E731, B023
        out[k] = (len(vs), len(vs) * 100 >= len(rows), s[-1] if s else None, pick(0.5), pick(0.9))
    return out


def run(spark, rows, schema=SCHEMA, **options):
    p = key_profile(spark.createDataFrame(rows, schema), "k", "v", **options)
    return {r.key: (r.n_rows, r.heavy, r.greatest, r.q50, r.q90) for r in p.collect()}


def test_bits_of_doubles(spark):
    random.seed(3)
    xs = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, math.inf, -math.inf, 1.0, 2.0, 0.9999999999999999, 4.0, 2.0**-1000, 2.0**1000]
    xs += [random.choice([-1, 1]) * random.random() * 2.0 ** random.randrange(-1074, 1024) for _ in range(2000)] + [2.0**k for k in range(-1074, 1024)] + [math.nextafter(2.0**k, 0) for k in range(-1020, 1024)]
    want = {k: (-1 if x < 0 else 1) * struct.unpack("<q", struct.pack("<d", abs(x)))[0] for k, x in enumerate(xs)}
    df = spark.createDataFrame(list(enumerate(xs)), "k int, x double")
    assert {r.k: r.b for r in df.select("k", double_bits("x").alias("b")).collect()} == want


def test_histograms_agree_with_brute_force(spark):
    random.seed(4)
    odd = [None, float("nan"), float("inf"), float("-inf"), 0.0, -1.7e308, 1.7e308, 5e-324, 3.0, 3.0]
    rows = [(random.choice(["hot"] * 6 + ["a", "b", None, f"k{random.randrange(200)}"]), random.choice([*odd, random.gauss(0, 1), random.lognormvariate(0, 9)]), "x", 1, 1) for _ in range(3000)]
    want = brute(rows)
    assert run(spark, rows) == want
    only = spark.createDataFrame([("hot",), (None,), ("absent",)], "key string")
    assert run(spark, rows, only=only) == {k: want[k] for k in ("hot", None)}


def test_values_of_many_magnitudes(spark):
    rows = [("all", 2.0**-i, "x", 1, 1) for i in range(1074)]
    p = key_profile(spark.createDataFrame(rows, SCHEMA), "k", "v", quantiles=(0.001, 0.5)).collect()
    assert (p[0].q0, p[0].q50) == (2.0**-1072, 2.0**-537)


def test_whole_numbers_and_decimals_stay_exact(spark):
    big = 2**62
    rows = [(k % 3, big + k * 7) for k in range(300)]
    assert run(spark, rows, "k int, v bigint") == brute(rows)
    wide = [("a", Decimal(10**30 + k) / 10**10) for k in range(100)] + [("b", Decimal(-k)) for k in range(5)]
    assert run(spark, wide, "k string, v decimal(38,10)") == brute(wide)
    days = spark.sql("select 1 as k, date'2024-01-01' + cast(id as int) as v from range(99)")
    assert str(key_profile(days, "k", "v", quantiles=(0.5,)).first().q50) == "2024-02-19"


def test_heavy_keys(spark):
    random.seed(6)
    keys = ["hot"] * 700 + [None] * 40 + ["ten"] * 20 + ["under"] * 19 + [f"k{k}" for k in range(1221)]
    random.shuffle(keys)
    df = spark.createDataFrame([(k, "x") for k in keys], "k string, o string")
    n = Counter(keys)
    assert {r.key: r.n_rows for r in heavy_keys(df, "k").collect()} == {k: c for k, c in n.items() if c * 100 >= len(keys)}
    assert {r.key for r in heavy_keys(df, "k", 0.3).collect()} == {"hot"}
    assert heavy_keys(df.filter("false"), "k").collect() == []
    assert [tuple(r) for r in heavy_keys(df.filter("k = 'ten'"), "k").collect()] == [("ten", 20, 20)]
    assert heavy_keys(spark.range(50).select(F.col("id").alias("k")), "k", 0.02).count() == 50


def test_equal_values_and_valueless_keys(spark):
    rows = [("hot", 2.5, "x", 1, 1)] * 500 + [("none", None, "x", 1, 1)] * 3
    assert run(spark, rows) == {"hot": (500, True, 2.5, 2.5, 2.5), "none": (3, False, None, None, None)}


def test_empty(spark):
    assert run(spark, []) == {}
