import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywick.functions.semantics import ntile_of, parse_weights, pct_rank_average, split_exactly, week_end_9am, whole_percentile
from tallywick.functions.urls import category_of, erc20_of, rebuilt, url_parts


def test_percentiles_and_ranks(spark):
    rows = spark.range(1, 8).select("id", F.lit(7).alias("n")).withColumn("p", whole_percentile("id", "n"))
    assert [r.p for r in rows.orderBy("id").collect()] == [100, 85, 71, 57, 42, 28, 14]
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 2.0), ("a", 3.0), ("b", 5.0)], "g string, v double")
    got = df.withColumn("p", pct_rank_average(["g"], "v")).toPandas()
    want = got.groupby("g")["v"].rank(pct=True)
    pd.testing.assert_series_equal(got["p"], want, check_names=False)


@pytest.mark.parametrize("amount,weights,parts", [(100, [1, 1, 1], [33, 33, 34]), (10, [5, 3, 1], [5, 3, 2]), (7, [0, 2], [0, 7])])
def test_whole_parts_add_up(spark, amount, weights, parts):
    df = spark.createDataFrame([(k, w) for k, w in enumerate(weights)], "k int, w bigint")
    got = df.withColumn("p", split_exactly(F.lit(amount), "w", W.partitionBy(F.lit(0)).orderBy("k"))).orderBy("k").collect()
    assert [r.p for r in got] == parts


def test_ntile_of_data(spark):
    df = spark.range(1, 5).select("id", ntile_of(F.lit(4), F.lit(3), F.col("id")).alias("t"))
    assert [r.t for r in df.orderBy("id").collect()] == [1, 1, 2, 3]


def test_week_ends_at_nine(spark):
    df = spark.sql("SELECT * FROM VALUES (timestamp_ntz'2025-01-06 16:59:59'), (timestamp_ntz'2025-01-06 17:00:00') AS t(ts)")
    assert [r.w for r in df.select(week_end_9am("ts", -8).alias("w")).collect()] == [dt.datetime(2025, 1, 6, 16, 59, 59), dt.datetime(2025, 1, 13, 16, 59, 59)]


def test_weights():
    assert parse_weights("L1C10R5Y1") == {"like": 1, "cast": 10, "recast": 5, "reply": 1}
    assert parse_weights("L1C10R5")["reply"] == 0 and set(parse_weights("").values()) == {0}
    with pytest.raises(ValueError):
        parse_weights("C1L1")


def test_urls(spark):
    df = spark.createDataFrame([("https://a.b.example.co.uk/p:",), ("not a url",), (None,), ("http://x.org",), ("https://t.io/eip155:8453/erc20:0x" + "aB" * 20,)], "u string")
    got = df.withColumn("p", url_parts("u")).withColumn("r", rebuilt("p")).withColumn("e", erc20_of("u")).collect()
    assert tuple(got[0].p) == ("https", "a.b", "example", "co.uk", "/p") and got[0].r == "https://a.b.example.co.uk/p"
    assert got[1].p.domain is None and got[2].p.scheme is None
    assert tuple(got[3].p) == ("http", None, "x", "org", "")
    assert tuple(got[4].e) == (8453, "0x" + "ab" * 20) and got[0].e is None
    pages = spark.createDataFrame([('<META name="fc:frame" content="x">',), ("<p>",), (None,)], "h string")
    assert [r.c for r in pages.select(category_of("h").alias("c")).collect()] == ["frame", "page", None]
