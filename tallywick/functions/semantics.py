"""Expressions whose meaning differs between engines: PostgreSQL's and pandas' way of counting, spelled for Spark."""

from __future__ import annotations

import datetime as dt
import re
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def asc(column: str) -> Column:
    """Ascending with nulls last, as PostgreSQL sorts."""
    return F.col(column).asc_nulls_last()


def desc(column: str) -> Column:
    """Descending with nulls first, as PostgreSQL sorts."""
    return F.col(column).desc_nulls_first()


def any_nonnull(column: str) -> Column:
    """An arbitrary but definite value of a group, nulls skipped."""
    return F.min(column)


def distinct_sorted(column: str) -> Column:
    """The distinct values of a group in order, without nulls."""
    return F.array_sort(F.collect_set(column))


def hex_text(column: str) -> Column:
    """0x and lower-case digits of a binary."""
    return F.concat(F.lit("0x"), F.lower(F.hex(column)))


def whole_percentile(rank: str, total: str) -> Column:
    """(total - (rank - 1)) * 100 / total in whole numbers, cut off."""
    return F.expr(f"(({total}) - (({rank}) - 1)) * 100 div ({total})")


def pct_rank_average(partition: list[str], value: str) -> Column:
    """The mean rank of equal values over the number of rows: pandas' rank(pct=True)."""
    part = W.partitionBy(*partition)
    ties = F.count(F.lit(1)).over(W.partitionBy(*partition, value))
    return (F.rank().over(part.orderBy(value)) + (ties - 1) / 2) / F.count(F.lit(1)).over(part)


def ntile_of(n: Column, buckets: Column, row_number: Column) -> Column:
    """ntile with a number of buckets that depends on the data: the first n mod k buckets have one row more."""
    small, large = F.floor(n / buckets), n % buckets
    edge = large * (small + 1)
    first = F.floor((row_number - 1) / (small + 1))
    rest = large + F.floor((row_number - 1 - edge) / F.greatest(small, F.lit(1)))
    return (F.when(row_number <= edge, first).otherwise(rest) + 1).cast("bigint")


def split_exactly(amount: Column, weight: str, order: W) -> Column:
    """Whole parts of `amount` in proportion to whole weights that add up to it exactly: differences of floored prefix shares. `order` is an ordered window over the recipients."""
    upto = F.sum(weight).over(order.rowsBetween(W.unboundedPreceding, 0)).cast("decimal(38,0)")
    total = F.sum(weight).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).cast("decimal(38,0)")
    before = upto - F.col(weight)
    whole = amount.cast("decimal(20,0)")
    # A decimal quotient is rounded to its scale, so the remainder is taken off first.
    share = lambda x: (whole * x - whole * x % total) / total
    return F.round(share(upto) - share(before)).cast("bigint")


def pacific_offset_hours(as_of: dt.datetime) -> int:
    """The UTC offset of the US Pacific coast at a UTC moment, in hours."""
    return int(as_of.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo("America/Los_Angeles")).utcoffset().total_seconds() // 3600)


def week_end_9am(ts: str, offset_hours: int) -> Column:
    """The end (Monday 08:59:59 local) of the week that a UTC timestamp is in, in UTC, for one fixed offset."""
    shift = F.expr(f"INTERVAL '{abs(offset_hours)}' HOUR")
    local = F.col(ts) + shift if offset_hours >= 0 else F.col(ts) - shift
    moved = local - F.expr("INTERVAL '9' HOUR")
    end = F.date_trunc("week", moved) + F.expr("INTERVAL '7' DAY") + F.expr("INTERVAL '9' HOUR") - F.expr("INTERVAL '1' SECOND")
    return (end - shift if offset_hours >= 0 else end + shift).cast("timestamp_ntz")


def mixed(column: str, seed: int) -> Column:
    """A whole number that looks random but follows from a key (0 or more) and a seed: a linear congruence that any SQL engine can say."""
    return (F.col(column) % 2_147_483_647 * 1_103_515_245 + seed * 12_345) % 2_147_483_647


def parse_weights(text: str) -> dict[str, int]:
    """`L1C10R5Y1` to weights of like, cast, recast and reply; a missing part is 0, another order an error."""
    m = re.fullmatch(r"(?:L(\d+))?(?:C(\d+))?(?:R(\d+))?(?:Y(\d+))?", text.upper())
    if not m:
        raise ValueError(f"weights must look like L1C10R5Y1, not {text!r}")
    return dict(zip(("like", "cast", "recast", "reply"), (int(x or 0) for x in m.groups())))


def action_weight(weights: dict[str, int]) -> Column:
    return F.col("casted") * weights["cast"] + F.col("replied") * weights["reply"] + F.col("recasted") * weights["recast"] + F.col("liked") * weights["like"]


def decay(age_seconds: Column, base: float, period_seconds: int) -> Column:
    """base to the power of age over period."""
    if not 0 < base <= 1 or period_seconds <= 0:
        raise ValueError("decay needs 0 < base <= 1 and a positive period")
    return F.pow(F.lit(base), age_seconds / period_seconds)


SCORE_AGGREGATES = {
    "sum": lambda c: F.sum(c),
    "sumsquare": lambda c: F.sum(F.pow(c, F.lit(2.0))),
    "rms": lambda c: F.sqrt(F.avg(F.pow(c, F.lit(2.0)))),
    "sumcuberoot": lambda c: F.sum(F.pow(c, F.lit(1 / 3))),
}


def seconds_between(later: Column, earlier: Column) -> Column:
    return F.unix_micros(later.cast("timestamp")) / 1e6 - F.unix_micros(earlier.cast("timestamp")) / 1e6


def top_share(df: DataFrame, column: str, share: float) -> DataFrame:
    """Rows at or above the continuous percentile of the column counted from the top."""
    bar = df.agg(F.expr(f"percentile_cont({share}) WITHIN GROUP (ORDER BY {column} DESC)").alias("bar"))
    return df.crossJoin(F.broadcast(bar)).filter(F.col(column) >= F.col("bar")).drop("bar")
