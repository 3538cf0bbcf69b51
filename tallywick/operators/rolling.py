"""Rolling totals over trailing days: dense blocks of entities by days, multiplied by banded window operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.times import epoch_day, epoch_micros
from ..storage import materialise


def banded(days: int, halo: int, window: int) -> np.ndarray:
    """The 0/1 matrix by which a block of halo + days columns gives, for each of the days, the sum of the last `window` days."""
    at = np.arange(halo + days)[:, None] - np.arange(days)[None, :] - halo
    return ((at <= 0) & (at > -window)).astype(np.int64)


def block_totals(block: np.ndarray, bands: list[np.ndarray]) -> list[np.ndarray]:
    """block (entities x days) times each band. Whole numbers stay exact: doubles up to 2^53, else Python's integers."""
    largest = float(np.abs(block.astype(np.float64)).sum(axis=1).max(initial=0))
    if largest < 2**53:
        return [np.rint(block.astype(np.float64) @ b.astype(np.float64)).astype(np.int64) for b in bands]
    if largest < 2**62:
        return [block @ b for b in bands]
    exact = [block.astype(object) @ b.astype(object) for b in bands]
    limit = 2**63
    if any(abs(int(x)) >= limit for e in exact for x in e.ravel()):
        raise OverflowError("a rolling total exceeds bigint")
    return [e.astype(np.int64) for e in exact]


def rolling_totals(
    df: DataFrame, entity: list[str], ts: str, value: str, version: str | None, windows: tuple[int, ...] = (7, 30), tile_days: int = 64, entities_per_block: int = 128
) -> DataFrame:
    """For each entity and UTC day from its first to its last day with any row, silent days included: `day` (days since
    1970), `day_index` (1 for the first day), `value` of the day and `total_w` for each window of w days ending with it.

    With `version`, rows equal in entity and ts are versions of one reading and only the greatest version holds; null
    values and superseded rows add 0, but their days count as days with a row. Before the first day everything is 0.
    Rows with a null entity column or ts are left out. Empty input gives no rows. Values must be whole numbers.

    Days are cut into tiles of tile_days, each with the halo of the preceding days that its windows reach; entities are
    hashed into blocks, so a task holds at most some entities_per_block x (tile_days + halo) numbers however many rows an
    entity has: they are summed per day before, on the map side first.
    """
    keys = [f"e{i}" for i in range(len(entity))]
    cols = [F.col(c).alias(k) for c, k in zip(entity, keys)] + [epoch_day(df, ts).alias("day"), epoch_micros(df, ts).alias("at"), F.col(value).cast("bigint").alias("v")]
    rows = df.select(*cols, *([F.struct(F.col(version).isNotNull(), F.col(version)).alias("ver")] if version else [])).dropna(subset=[*keys, "at"])
    if version:
        rows = rows.groupBy(*keys, "day", "at").agg(F.max_by("v", "ver").alias("v"))
    daily = materialise(rows.groupBy(*keys, "day").agg(F.coalesce(F.sum("v"), F.lit(0)).alias("v")), "daily")
    halo = max(windows) - 1
    whole = W.partitionBy(*keys)
    series = daily.withColumn("first", F.min("day").over(whole)).withColumn("last", F.max("day").over(whole))
    tile = F.floor(F.col("day") / tile_days).cast("int")
    # A day belongs to its own tile and, as halo, to those after it that reach back to it; the first day also to every tile up to the last, for silent stretches.
    reach = F.floor((F.col("day") + halo) / tile_days).cast("int")
    last_tile = F.floor(F.col("last") / tile_days).cast("int")
    to = F.when(F.col("day") == F.col("first"), last_tile).otherwise(F.least(reach, last_tile))
    tiled = series.withColumn("tile", F.explode(F.sequence(tile, to)))
    n_blocks = daily.select(*keys).distinct().count() // entities_per_block + 1
    tiled = tiled.withColumn("block", F.pmod(F.xxhash64(*keys), F.lit(n_blocks)))
    bands = [banded(tile_days, halo, w) for w in windows]
    fields = {f.name: f.dataType.simpleString() for f in daily.schema.fields}
    schema = ", ".join([f"{k} {fields[k]}" for k in keys] + ["day int", "day_index int", "value bigint"] + [f"total_{w} bigint" for w in windows])

    def one_tile(key: tuple, pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        start = int(key[1]) * tile_days
        codes, names = pd.factorize(pd.MultiIndex.from_frame(pdf[keys]) if len(keys) > 1 else pdf[keys[0]])
        head = pdf.groupby(codes)[["first", "last"]].first()
        at = pdf["day"].to_numpy() - start + halo
        seen = at >= 0
        for lo in range(0, len(names), entities_per_block):
            take = seen & (codes >= lo) & (codes < lo + entities_per_block)
            size = min(entities_per_block, len(names) - lo)
            block = np.zeros((size, halo + tile_days), dtype=np.int64)
            block[codes[take] - lo, at[take]] = pdf["v"].to_numpy()[take]
            first, last = (head[c].to_numpy()[lo : lo + size, None] for c in ("first", "last"))
            days = start + np.arange(tile_days)[None, :]
            i, d = np.nonzero((days >= first) & (days <= last))
            out = pd.DataFrame({k: (names.get_level_values(n) if len(keys) > 1 else names)[lo + i] for n, k in enumerate(keys)})
            out["day"], out["value"] = (start + d).astype(np.int32), block[i, halo + d]
            out["day_index"] = (start + d - first[i, 0] + 1).astype(np.int32)
            for w, total in zip(windows, block_totals(block, bands)):
                out[f"total_{w}"] = total[i, d]
            yield out[[*keys, "day", "day_index", "value", *[f"total_{w}" for w in windows]]]

    def tile_job(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.concat(list(one_tile(key, pdf)))

    done = tiled.groupBy("block", "tile").applyInPandas(tile_job, schema)
    return done.select(*[F.col(k).alias(c) for k, c in zip(keys, entity)], "day", "day_index", "value", *[f"total_{w}" for w in windows])
