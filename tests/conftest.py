import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from crawlweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def one(spark):
    """Evaluate a column expression over the given named values."""
    from pyspark.sql import functions as F

    def run(expression, **values):
        columns = [F.lit(v).alias(k) for k, v in values.items()]
        return spark.range(1).select(*columns).select(expression.alias("x")).first()[0]

    return run
