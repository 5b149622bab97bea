import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from articleflow.session import build_session

    s = build_session("local[4]", app_name="articleflow-tests", shuffle_partitions=4)
    yield s
    s.stop()


def one(spark, expr_fn, value, schema="v string"):
    """Evaluate a column function on a one-row frame."""
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr_fn(df.columns[0]).alias("r")).first()["r"]
