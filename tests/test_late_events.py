import random
from collections import Counter

from tallywick.operators.late_events import DAY, ReplayLedger, first_arrivals, replay_in_batches
from tallywick.storage import workspace

SCHEMA = "key string, id bigint, at bigint, arrived bigint"


def brute(rows):
    kept = Counter((k or "", at // DAY) for k, _, at, arrived in rows if arrived <= (at // DAY + 1) * DAY + 3 * DAY)
    out = {}
    for k, p in kept:
        out[k, p] = (kept[k, p], sum(n for (k2, p2), n in kept.items() if k2 == k and p2 <= p))
    return out, {i for _, i, at, arrived in rows if arrived > (at // DAY + 1) * DAY + 3 * DAY}


def events(seed, n=600):
    random.seed(seed)
    rows = []
    for i in range(n):
        at = random.randrange(40 * DAY)
        rows.append((random.choice(["a", "a", "b", None]), i, at, at + int(random.choice([-DAY, 0, 1, 2 * DAY, 3.9 * DAY, 4 * DAY, 20 * DAY]) * random.random())))
    return rows


def check(ledger, rows):
    want, late = brute(rows)
    assert {(r.key, r.period): (r.n, r.so_far) for r in ledger.outputs().collect()} == want
    assert {r.id for r in ledger.rejected().collect()} == late


def test_any_number_of_batches_gives_the_same(spark):
    rows = events(1)
    for batches in (1, 7):
        check(replay_in_batches(spark.createDataFrame(rows, SCHEMA), batches), rows)


def test_random_order_and_repeated_batch(spark):
    rows = events(2, 300)
    ledger = ReplayLedger(spark, workspace(spark, "test"))
    for b in range(4):
        part = spark.createDataFrame(rows[b::4], SCHEMA)
        ledger.apply(part, b)
        ledger.apply(part, b)
    ledger.apply(spark.createDataFrame([], SCHEMA), 4)
    check(ledger, rows)


def test_exactly_at_the_close_is_in_time(spark):
    rows = [("a", 1, 5, 4 * DAY), ("a", 2, 5, 4 * DAY + 1)]
    check(replay_in_batches(spark.createDataFrame(rows, SCHEMA), 2), rows)


def test_empty(spark):
    ledger = replay_in_batches(spark.createDataFrame([], SCHEMA))
    assert ledger.outputs().count() == 0 and ledger.rejected().count() == 0


def test_first_arrivals_takes_the_first_row_and_leaves_out_the_timeless(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, timestamp_ntz'2025-01-01 10:00:00', timestamp_ntz'2025-01-09 00:00:00', 'x'), (1, timestamp_ntz'2025-01-01 10:00:00', timestamp_ntz'2025-01-02 00:00:00', 'x'),
      (2, null, timestamp_ntz'2025-01-02 00:00:00', 'x'), (3, timestamp_ntz'2025-01-01 10:00:00', null, 'x'), (null, timestamp_ntz'2025-01-01 10:00:00', timestamp_ntz'2025-01-02 00:00:00', 'x') AS t(id, ts, came, at)""")
    rows = first_arrivals(df, None, "id", "ts", "came").collect()
    assert [(r.id, r.at // DAY, r.arrived // DAY) for r in rows] == [(1, 20089, 20090)]


def test_redelivered_events_count_once_across_batches(spark):
    rows = events(3, 300)
    ledger = ReplayLedger(spark, workspace(spark, "test"))
    order = sorted(rows, key=lambda r: r[3])
    for b in range(4):
        again = [(k, i, at, arrived + 9 * DAY) for k, i, at, arrived in order[: b * 75 : 3]]  # known ones, some of them after the cut-off
        ledger.apply(spark.createDataFrame(order[b * 75 : (b + 1) * 75] + order[b * 75 : b * 75 + 20] + again, SCHEMA), b)
    check(ledger, rows)


def test_values_and_what_a_batch_leaves_behind(spark):
    random.seed(5)
    rows = [(random.choice("ab"), i, i * DAY // 10, i * DAY // 10 + random.randrange(3 * DAY), random.choice([None, 1.5, -2.0, 7.0])) for i in range(400)]
    ledger = ReplayLedger(spark, workspace(spark, "test"))
    order = sorted(rows, key=lambda r: r[3])
    for b in range(5):
        ledger.apply(spark.createDataFrame(order[b * 80 : (b + 1) * 80], SCHEMA + ", value double"), b)
    for r in ledger.outputs().collect():
        own = [v for k, _, at, _, v in rows if (k, at // DAY) == (r.key, r.period)]
        upto = [v for k, _, at, _, v in rows if k == r.key and at // DAY <= r.period and v is not None]
        known = [v for v in own if v is not None]
        assert (r.n, r.total, r.least, r.greatest) == (len(own), sum(known) if known else None, min(known, default=None), max(known, default=None))
        assert (r.total_so_far, r.least_so_far, r.greatest_so_far) == (sum(upto) if upto else None, min(upto, default=None), max(upto, default=None))
    ledger._prune(9)
    assert len(ledger._folders("output")) == len({s for _, s in ledger._folders("output")}) and len(ledger._folders("snapshot")) <= 6
