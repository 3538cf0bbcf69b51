"""Time helpers that give the same in every session time zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAY_US = 86_400_000_000


def epoch_micros(df: DataFrame, column: str) -> F.Column:
    """Microseconds since 1970. A timestamp without zone is UTC by convention."""
    if df.schema[column].dataType.typeName() != "timestamp_ntz":
        return F.unix_micros(F.col(column).cast("timestamp"))
    c = f"`{column}`"
    return F.expr(f"unix_date(cast({c} as date)) * 86400000000L + (hour({c}) * 3600L + minute({c}) * 60L) * 1000000L + cast(extract(second from {c}) * 1000000 as bigint)")


def epoch_day(df: DataFrame, column: str) -> F.Column:
    """The UTC day as a number of days since 1970."""
    return F.floor(epoch_micros(df, column) / F.lit(DAY_US)).cast("int")


def day_text(day: str | F.Column) -> F.Column:
    """yyyy-MM-dd of a number of days since 1970."""
    return F.date_from_unix_date(F.col(day).cast("int") if isinstance(day, str) else day.cast("int")).cast("string")
