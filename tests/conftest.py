import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fundweave.session import local  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local("8", shuffle_partitions=4, memory="4g")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


def column(spark, expression, values, type_="string"):
    """Evaluates a Column -> Column helper on literal values."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {type_}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]
