import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest

from tallywick.operators.rolling import banded, block_totals, rolling_totals

START = datetime(2025, 1, 1, tzinfo=timezone.utc)
SCHEMA = "channel string, metric string, ts timestamp, v bigint, came timestamp, day string, tile int"


def brute(rows):
    held = {}
    for c, m, ts, v, came, *_ in rows:
        if c is None or m is None or ts is None:
            continue
        old = held.get((c, m, ts))
        if old is None or came is not None and (old[1] is None or came > old[1]):
            held[c, m, ts] = (v or 0, came)
    days, out = {}, {}
    for (c, m, ts), (v, _) in held.items():
        d = days.setdefault((c, m), {})
        n = (ts - datetime(1970, 1, 1, tzinfo=timezone.utc)).days
        d[n] = d.get(n, 0) + v
    for e, d in days.items():
        for n in range(min(d), max(d) + 1):
            out[(*e, n)] = (n - min(d) + 1, d.get(n, 0), sum(d.get(n - k, 0) for k in range(7)), sum(d.get(n - k, 0) for k in range(30)))
    return out


def run(spark, rows, **options):
    df = rolling_totals(spark.createDataFrame(rows, SCHEMA), ["channel", "metric"], "ts", "v", "came", **options)
    return {(r.channel, r.metric, r.day): (r.day_index, r.value, r.total_7, r.total_30) for r in df.collect()}


@pytest.mark.parametrize("tile_days,per_block", [(64, 128), (5, 2)])
def test_against_brute_force(spark, tile_days, per_block):
    random.seed(tile_days)
    rows = []
    for k in range(400):
        ts = START + timedelta(days=random.choice([random.randrange(20), random.randrange(150)]), hours=random.choice([0, 23]))
        rows.append((random.choice(["a", "a", "b", "c", None]), random.choice(["n", "u", None]), random.choice([ts, ts, ts, None]), random.choice([None, 0, 5, -3, random.randrange(1000)]), START + timedelta(seconds=k), "x", 1))
    assert run(spark, rows, tile_days=tile_days, entities_per_block=per_block) == brute(rows)


def test_empty_and_one_day(spark):
    assert run(spark, []) == {}
    rows = [("a", "n", START, 4, None, "x", 1), ("a", "n", START, 9, START, "x", 1)]
    assert run(spark, rows) == brute(rows)


def test_exact_sums_beyond_doubles():
    block = np.array([[2**53 + 1] * 8], dtype=np.int64)
    assert block_totals(block, [banded(2, 6, 7)])[0].tolist() == [[7 * (2**53 + 1)] * 2]
    with pytest.raises(OverflowError):
        block_totals(np.array([[2**62] * 8], dtype=np.int64), [banded(2, 6, 7)])
