"""Every registered query against its SQL in DuckDB: same columns, types and rows."""

import os
from pathlib import Path

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as spark_entry

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")

# The operators for training data have tests of their own.
QUERIES = spark_entry._own_queries()
ORACLES = spark_entry._own_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(FOLDER).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def types_of(table: pa.Table) -> dict[str, str]:
    plain = {"large_string": "string", "timestamp[us, tz=UTC]": "zoned"}
    return {f.name: plain.get(str(f.type), str(f.type)) for f in sorted(table.schema, key=lambda f: f.name)}


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_same_as_sql(spark, duck, name):
    ours = QUERIES[name](spark, FOLDER).toArrow()
    theirs = duck.sql(ORACLES[name]).to_arrow_table().select(ours.column_names)
    assert types_of(ours) == types_of(theirs)
    assert ours.num_rows == theirs.num_rows > 0, "an empty result checks nothing"
    for one, other in ((ours, theirs), (theirs, ours)):
        assert duck.sql("SELECT * FROM one EXCEPT ALL SELECT * FROM other").limit(5).fetchall() == []
