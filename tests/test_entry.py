from pathlib import Path

import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 140


@pytest.mark.skipif(not DATA.exists(), reason="no stored tables")
def test_flagship(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["id", "root_id", "depth", "open_end", "descendants"] and rows.count() > 1000
