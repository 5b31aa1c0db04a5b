import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cataloguer.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", app="cataloguer-tests", shuffle_partitions=8)
    yield s


def one_col(spark, values, expr, dtype="string"):
    """Evaluate a Column expression over a one-column DataFrame of ``values``; returns a list."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]
