"""Queries whose SQL leaves out a part of the rows, held against that SQL with the cut lifted."""

from pathlib import Path

import duckdb
import pytest

from tallywick.plans import more, trust  # noqa: F401
from tallywick.plans.registry import ORACLES, QUERIES

DATA = Path("/root/testdata/sf0.001")


def differs(spark, name, cut, whole):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    got = QUERIES[name](spark, str(DATA))
    columns = ", ".join(got.columns)
    want = con.execute(f"SELECT {columns} FROM ({ORACLES[name].replace(cut, whole)})").fetchall()
    rows = [tuple(r) for r in got.collect()]
    assert len(want) > 0 and sorted(rows, key=repr) == sorted(want, key=repr)


@pytest.mark.skipif(not DATA.exists(), reason="no stored tables")
def test_roots_of_all_replies(spark):
    differs(spark, "I15_roots_of_new_replies", " AND n.id % 10 = 0", "")


@pytest.mark.skipif(not DATA.exists(), reason="no stored tables")
def test_window_of_90_days(spark):
    differs(spark, "G1_interactions_90_days", "INTERVAL 30 DAY", "INTERVAL 90 DAY")
