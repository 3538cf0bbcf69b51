"""Per-key results without imbalance: mergeable counts, and exact selection of ranks by refining value histograms.

Values are selected by an order-preserving whole number: whole numbers and decimals by themselves, doubles by their bits.
A round cuts the interval that holds a rank into at most BINS bins of equal width, counts them on the map side first, and
goes on with the bin that holds the rank, narrowed to the values it really has. So a rank among 64-bit numbers is settled
after seven rounds at most, whatever the values and however many there are, and values are never gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, IntegralType, TimestampNTZType, TimestampType

from ..storage import BROADCAST_ROWS, materialise

BITS = 10
BINS = 1 << BITS


def double_bits(x: str) -> Column:
    """The 64 bits of a double (not NaN) as a whole number in the order of the doubles: for x >= 0 as they are stored, for x < 0 those of -x, negated.

    Exact: the exponent by a logarithm put right by one where it was rounded, the rest by scaling with powers of two.
    """
    a = f"abs({x})"
    guess = f"greatest(-1022, least(1023, cast(floor(log2({a})) as int)))"
    near = f"({a} * pow(2d, -({guess})))"
    e = f"(({guess}) + case when {near} >= 2 then 1 when {near} < 1 and ({guess}) > -1022 then -1 else 0 end)"
    normal = f"({e} + 1023L) * 4503599627370496L + cast(({a} * pow(2d, -{e}) - 1) * 4503599627370496d as bigint)"
    small = f"cast(({a} * pow(2d, 537)) * pow(2d, 537) as bigint)"
    bits = f"case when {x} = 0 then 0L when {a} = double('Infinity') then 9218868437227405312L when {a} < pow(2d, -1022) then {small} else {normal} end"
    return F.expr(f"case when {x} < 0 then -({bits}) else {bits} end")


def _ordered(c: str, kind: DataType) -> Column:
    """The order-preserving whole number of a value: a bigint, or decimal(38,0) for decimals of more than 18 digits."""
    if isinstance(kind, DecimalType):
        whole = F.expr(f"cast({c} * cast('1{'0' * kind.scale}' as decimal({kind.scale + 1},0)) as decimal(38,0))")
        return whole.cast("bigint") if kind.precision <= 18 else whole
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(c).cast("timestamp"))
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("bigint")
    return F.col(c).cast("bigint") if isinstance(kind, IntegralType) else double_bits(c)


def _typed(df: DataFrame, value: str) -> Column:
    """The value as it is compared: floats and texts as doubles, other kinds as they are; NaN as null."""
    kind, c = df.schema[value].dataType, F.col(f"`{value}`")
    if isinstance(kind, (DecimalType, IntegralType, DateType, TimestampType, TimestampNTZType)):
        return c
    c = c.cast("double")
    return F.when(~F.isnan(c), c)


def key_summary(df: DataFrame, key: str, value: str) -> DataFrame:
    """Per key: rows (all), n_values (neither null nor NaN), least, greatest and total value (null for dates and times).

    Partial aggregates are combined before the shuffle, so a hot key sends one row per map task. A null key is a key.
    """
    v = _typed(df, value)
    rows = df.select(F.col(key).alias("key"), v.alias("v"))
    kind = rows.schema["v"].dataType
    total = F.sum("v") if isinstance(kind, DecimalType) else F.lit(None).cast("double") if isinstance(kind, (DateType, TimestampType, TimestampNTZType)) else F.sum(F.col("v").cast("double"))
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.count("v").alias("n_values"), F.min("v").alias("least"), F.max("v").alias("greatest"), total.alias("total"))


def select_ranks(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The value at each wanted rank: g, rank, v, o, and n, how many rows of g have an o equal to it.

    rows (g, o, v): o a bigint or decimal(38,0) in the order of v, not null; g may be null. wanted (g, rank, lo, hi): ranks
    from 1 among the rows of g, and the least and greatest o of g. A round moves at most BINS + 1 rows per open interval
    and map task; ranks that share an interval share its bins. rows are read once per round, by joins on g and the leading
    bits that all values of an interval share, which AQE splits where one g holds much.
    """
    wide = isinstance(rows.schema["o"].dataType, DecimalType)
    length = lambda lo, hi: f"case when ({lo} ^ {hi}) < 0 then 64 else length(bin({lo} ^ {hi})) end"
    open_ = materialise(wanted.select("g", "rank", F.col("rank").alias("left"), "lo", "hi"), "wanted")
    settled = []
    while True:
        most = F.lit(0) if wide else F.max(F.expr(length("lo", "hi")))
        todo, bits = open_.agg(F.count(F.lit(1)), most).first()
        if not todo:
            break
        intervals = open_.select("g", "lo", "hi").distinct()
        if wide:
            rows_at, at = rows.withColumn("prefix", F.lit(0)), intervals.withColumn("prefix", F.lit(0))
            bin_ = F.expr(f"cast((o - lo) div (floor((hi - lo) / {BINS}) + 1) as int)")
        else:
            shared = lambda c: F.lit(0) if bits >= 63 else F.shiftright(c, bits)
            rows_at, at = rows.withColumn("prefix", shared("o")), intervals.withColumn("prefix", shared("lo"))
            bin_ = F.shiftright("o", max(bits - BITS, 0))
        at = at.select(F.col("g").alias("g2"), F.col("prefix").alias("prefix2"), "lo", "hi")
        near = rows_at.join(F.broadcast(at) if todo <= BROADCAST_ROWS else at, F.col("g").eqNullSafe(F.col("g2")) & (F.col("prefix") == F.col("prefix2")) & F.col("o").between(F.col("lo"), F.col("hi")))
        bins = near.select("g", "lo", bin_.alias("bin"), "o", "v").groupBy("g", "lo", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("o").alias("bl"), F.max("o").alias("bh"), F.min("v").alias("v"))
        upto = F.sum("n").over(W.partitionBy("g", "lo").orderBy("bin"))
        bins = bins.withColumn("upto", upto).select(F.col("g").alias("g2"), F.col("lo").alias("lo2"), "n", "bl", "bh", "v", "upto")
        hit = open_.join(bins, F.col("g").eqNullSafe(F.col("g2")) & (F.col("lo") == F.col("lo2")) & (F.col("left") <= F.col("upto")) & (F.col("left") > F.col("upto") - F.col("n")))
        step = materialise(hit.select("g", "rank", (F.col("left") - F.col("upto") + F.col("n")).alias("left"), F.col("bl").alias("lo"), F.col("bh").alias("hi"), "v", "n"), "step")
        settled.append(step.filter("lo = hi").select("g", "rank", "v", F.col("lo").alias("o"), "n"))
        open_ = step.filter("lo != hi").select("g", "rank", "left", "lo", "hi")
    if not settled:
        return wanted.join(rows.withColumnRenamed("g", "g2"), F.lit(False)).select("g", "rank", "v", "o", F.lit(0).cast("bigint").alias("n"))
    done = settled[0]
    for s in settled[1:]:
        done = done.unionByName(s)
    return done


def exact_quantiles(df: DataFrame, key: str, value: str, summary: DataFrame, quantiles: tuple[float, ...]) -> DataFrame:
    """The exact value at rank ceil(q * n) of each key of `summary` and quantile q: key, q, quantile_value.

    Nulls and NaN don't count; a key without values has no row. Infinite values are values.
    """
    v = _typed(df, value)
    rows = df.select(F.col(key).alias("g"), v.alias("v")).filter(F.col("v").isNotNull())
    kind = rows.schema["v"].dataType
    rows = materialise(rows.select("g", _ordered("v", kind).alias("o"), "v"), "values")
    known = summary.filter("n_values > 0").withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in quantiles])))
    rank = F.greatest(F.lit(1), F.ceil(F.col("q") * F.col("n_values"))).cast("bigint")
    grid = materialise(known.select("key", "q", rank.alias("rank"), _ordered("least", kind).alias("lo"), _ordered("greatest", kind).alias("hi")), "grid")
    found = select_ranks(rows, grid.select(F.col("key").alias("g"), "rank", "lo", "hi").distinct())
    found = found.select("g", F.col("rank").alias("rank2"), F.col("v").alias("quantile_value"))
    return grid.join(found, F.col("key").eqNullSafe(F.col("g")) & (F.col("rank") == F.col("rank2"))).select("key", "q", "quantile_value")


def heavy_keys(df: DataFrame, key: str, share: float = 0.01) -> DataFrame:
    """The keys that hold at least `share` of all rows: key, n_rows, total_rows. A null key is a key; other columns are ignored.

    By exact selection, without a row per key: in the order of the keys' hashes a heavy key takes at least
    ceil(share * rows) ranks in a row, so one of every so many ranks is its own. The values at those ranks, at most
    1 / share, are refined from histograms of the hashes, and how many rows have them is what the last bin counts. Hashes
    that hold enough rows are then told apart by the keys themselves, exactly. Equal hashes can't hide a key.
    """
    rows = materialise(df.select(F.lit(0).alias("g"), F.col(key).alias("key"), F.xxhash64(key).alias("o")), "hashes")
    total, lo, hi = rows.agg(F.count(F.lit(1)), F.min("o"), F.max("o")).first()
    whole = round(share * 1_000_000)
    least = max(1, -(-total * whole // 1_000_000))
    spark = df.sparkSession
    kind = rows.schema["key"].dataType.simpleString()
    if not total:
        return spark.createDataFrame([], f"key {kind}, n_rows bigint, total_rows bigint")
    wanted = spark.range(1, total // least + 1).select(F.lit(0).alias("g"), (F.col("id") * least).alias("rank"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
    found = select_ranks(rows.select("g", "o", F.col("o").alias("v")), wanted)
    heavy = found.filter(F.col("n") >= least).select("o").distinct()  # at most 1 / share rows
    exact = rows.join(F.broadcast(heavy), "o").groupBy("key").agg(F.count(F.lit(1)).alias("n_rows"))
    return exact.filter(F.col("n_rows") >= least).select("key", "n_rows", F.lit(total).cast("bigint").alias("total_rows"))


def key_profile(df: DataFrame, key: str, value: str, quantiles: tuple[float, ...] = (0.5, 0.9), heavy_share: float = 0.01, only: DataFrame | None = None) -> DataFrame:
    """Per key: `key`, n_rows, share of all rows, heavy (share at least heavy_share), greatest, mean, and one column
    q50... per quantile, the value at rank ceil(q * n), in the values' own type. only (key): these keys only.

    The heavy test is exact, in whole numbers of rows. Keys without values have null results. Null is a key; NaN and null
    values don't count, infinite ones do, and a mean over both infinities is NaN. Other columns of df are ignored. Empty
    input gives no rows. All keys go through the histograms, those of one value and those of billions.
    """
    total = df.count()
    if only is not None:
        df = df.join(only.select(F.col("key").alias("__only")), F.col(key).eqNullSafe(F.col("__only")), "left_semi")
    summary = materialise(key_summary(df, key, value), "summary")
    heavy = F.col("rows").cast("decimal(38,0)") * 1_000_000 >= F.lit(total).cast("decimal(38,0)") * round(heavy_share * 1_000_000)
    found = exact_quantiles(df, key, value, summary, quantiles)
    wide = found.groupBy("key").agg(*[F.max(F.when(F.col("q") == F.lit(float(q)), F.col("quantile_value"))).alias(f"q{round(q * 100)}") for q in quantiles])
    out = summary.join(wide, summary["key"].eqNullSafe(wide["key"]), "left").drop(wide["key"])
    mean = F.when(F.col("n_values") > 0, F.col("total") / F.col("n_values"))
    return out.select("key", F.col("rows").alias("n_rows"), (F.col("rows") / F.lit(max(total, 1))).alias("share"), heavy.alias("heavy"), "greatest", mean.alias("mean"), *[f"q{round(q * 100)}" for q in quantiles])
