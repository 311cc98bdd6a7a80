"""Run log: one row per model run, append-only, with maps for what varies between runs."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .tables import append_by_name

# Phases and families a run may belong to, and the leading columns of the export.
PHASES = ("baseline", "candidato", "tuning", "final")
FAMILIES = ("dummy", "regla", "lineal", "bagging", "boosting", "red_neuronal", "sota")
EXPORT_COLUMNS = ("run_id", "name", "fase", "familia", "git_commit", "parent_run_id", "start_time", "status")
UNKNOWN_COMMIT = "desconocido"

RUNS_SCHEMA = (
    "run_id string, name string, fase string, familia string, git_commit string, "
    "parent_run_id string, start_time timestamp, status string, "
    "params map<string,string>, metrics map<string,double>"
)


def check(phase: str, family: str) -> None:
    if phase not in PHASES:
        raise ValueError(f"phase must be one of {PHASES}")
    if family not in FAMILIES:
        raise ValueError(f"family must be one of {FAMILIES}")


def log_run(
    spark: SparkSession,
    path: str,
    name: str,
    family: str,
    phase: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    commit: str = UNKNOWN_COMMIT,
    parent: str | None = None,
    started: datetime | None = None,
) -> str:
    row = run_row(name, family, phase, params, metrics, commit, parent, started)
    log_rows(spark, path, [row])
    return row[0]


def run_row(
    name: str,
    family: str,
    phase: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    commit: str = UNKNOWN_COMMIT,
    parent: str | None = None,
    started: datetime | None = None,
) -> tuple:
    """One run as the log keeps it, under a new id."""
    check(phase, family)
    return (
        uuid.uuid4().hex, name, phase, family, commit, parent, started or datetime.now(timezone.utc), "FINISHED",
        {k: str(v) for k, v in params.items()},
        {k: float(v) for k, v in metrics.items() if v is not None},
    )


def log_rows(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    """Several runs in one append."""
    append_by_name(spark.createDataFrame(rows, RUNS_SCHEMA), path, RUNS_SCHEMA)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(T.StructType.fromDDL(RUNS_SCHEMA)).parquet(path)


def flat(runs: DataFrame) -> DataFrame:
    """Fixed columns, then one column per metric and per parameter, names sorted."""
    names = lambda column: sorted(
        r[0] for r in runs.select(F.explode(F.map_keys(column))).distinct().collect()
    )
    metrics = [F.col("metrics")[n].alias(f"metrics.{n}") for n in names("metrics")]
    params = [F.col("params")[n].alias(f"params.{n}") for n in names("params")]
    return runs.select(*EXPORT_COLUMNS, *metrics, *params)


def export_csv(runs: DataFrame, path: str) -> DataFrame:
    ordered = flat(runs).orderBy("start_time", "run_id")
    ordered.write.option("header", True).csv(path)
    return ordered


# What is measured on every set of rows.
MEASURED = ("ap", "p_at_3")


def gap(metric: str, value: Callable[[str], Column]) -> Column:
    """How much better a metric is on the training rows than in cross-validation."""
    return (value(f"train_{metric}") - value(f"cv_{metric}_mean")).alias(f"brecha_{metric}")


def train_cv_gap(runs: DataFrame, metrics: tuple[str, ...] = MEASURED) -> DataFrame:
    value = F.col("metrics").getItem
    return runs.select("run_id", "name", *[gap(n, value) for n in metrics])


def leaderboard(runs: DataFrame, metric: str = "cv_ap_mean") -> DataFrame:
    return runs.select("run_id", "name", "familia", F.col("metrics")[metric].alias(metric)).orderBy(
        F.desc_nulls_last(metric), "run_id"
    )


ALIASES = ("champion", "challenger")


def finalists(runs: DataFrame, metric: str = "cv_ap_mean", n: int = 3) -> DataFrame:
    """The n best candidates go on to tuning; the first two also get their registry alias."""
    best = leaderboard(runs, metric).limit(n)
    place = F.row_number().over(Window.orderBy(F.desc_nulls_last(metric), "run_id"))  # n rows
    names = F.array(*[F.lit(a) for a in ALIASES])
    return best.withColumn("place", place).withColumn("alias", F.get(names, F.col("place") - 1))
