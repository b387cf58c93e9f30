"""The registered queries against DuckDB, where SQL can state them."""

import duckdb
import pytest

from fleetmeter.llm.oracles import ORACLES
from fleetmeter.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    got = QUERIES[name](spark, sf).toPandas()
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    want = con.execute(ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    got, want = (
        x[columns].astype(str).sort_values(columns).reset_index(drop=True) for x in (got, want)
    )
    assert got.equals(want)


def test_every_operator_has_a_query():
    numbers = {int(name[2:].split("_")[0]) for name in QUERIES}
    assert numbers == set(range(1, 14))
