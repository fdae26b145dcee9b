import pytest
from samples import SCHEMA, prose, rows


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with copies, near copies, empty and odd texts, a repeated row, an id with two texts, and clashing columns."""
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def unnamed(spark):
    """A few rows without an id."""
    return spark.createDataFrame([(None, prose(3, 60), *[None] * 10), (None, None, *[None] * 10)], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def texts():
    return [(r[0], r[1] or "") for r in rows()]
