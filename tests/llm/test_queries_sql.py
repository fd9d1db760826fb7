"""The corpus queries that SQL can express, against DuckDB on the smallest given tables."""

from pathlib import Path

import duckdb
import pytest

from regolith.llm import queries as q

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no given tables")


@pytest.mark.parametrize("name", sorted(set(q.oracle_sql()) - {"pipeline"}))
def test_query(spark, name):
    c = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    mine = q.queries()[name](spark, SF)
    columns = sorted(mine.columns)
    theirs = c.sql(q.oracle_sql()[name])
    assert columns == sorted(theirs.columns)
    rows = lambda found: sorted(map(repr, found))
    assert rows(map(tuple, mine.select(*columns).collect())) == rows(theirs.select(*columns).fetchall())
