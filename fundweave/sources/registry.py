"""Model registry: which logged run a model's aliases point at. Append-only; the newest version of an
alias is the one in force."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import first_per_key
from . import workspace
from .tables import append_by_name

SCHEMA = "model string, version int, run_id string, alias string, registered timestamp"


def versions(spark: SparkSession, path: str) -> DataFrame:
    if not workspace.exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def register(spark: SparkSession, path: str, model: str, runs: Sequence[tuple[str, str]]) -> None:
    """A new version for each (run id, alias), in the given order."""
    known = versions(spark, path).filter(F.col("model") == model)
    last = known.agg(F.max("version")).first()[0] or 0
    now = datetime.now(timezone.utc)
    rows = [(model, last + i, run_id, alias, now) for i, (run_id, alias) in enumerate(runs, 1)]
    append_by_name(spark.createDataFrame(rows, SCHEMA), path, SCHEMA)


def aliases(spark: SparkSession, path: str, model: str) -> DataFrame:
    """alias, version and run_id in force."""
    known = versions(spark, path).filter((F.col("model") == model) & F.col("alias").isNotNull())
    return first_per_key(known, ["alias"], [F.desc("version")]).select("alias", "version", "run_id")
