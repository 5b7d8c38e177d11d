import pytest
from odd_cases import SCHEMA, odd_rows

from starledger.llm.common import ship


@pytest.fixture(scope="session")
def shipped(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def odd(shipped):
    return shipped.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(shipped):
    return shipped.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(shipped):
    return shipped.read.parquet("/root/testdata/sf0.001/documents.parquet")
