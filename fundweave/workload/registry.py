"""Named queries and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Registers a query; its result is brought to plain column types both engines share."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(spark, sf_dir))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, decimals as doubles, lists joined by '|'."""

    def cell(f):
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, T.DateType):
            c = c.cast("string")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, T.ArrayType):
            c = F.when(c.isNotNull(), F.concat_ws("|", c.cast("array<string>")))
        return c.alias(f.name)

    return df.select(*[cell(f) for f in df.schema.fields])
