"""Joins against dimensions: unknown members, match markers, roles, scopes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: key of the member that stands for "not known" in every dimension.
UNKNOWN = "UNKNOWN"


def with_unknown_member(df: DataFrame, **values) -> DataFrame:
    """Adds one literal row: the given values, NULL everywhere else."""
    row = df.sparkSession.range(1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    return df.unionByName(row)


def resolve_key(
    df: DataFrame, source: str, dimension: DataFrame, dimension_key: str, target: str
) -> DataFrame:
    """Adds `target`: the dimension's key when `source` is found there, the unknown member if not."""
    keys = dimension.select(F.col(dimension_key).alias(f"_found_{target}"))
    joined = df.join(keys, F.col(source) == F.col(f"_found_{target}"), "left")
    return joined.withColumn(
        target, F.coalesce(F.col(f"_found_{target}"), F.lit(UNKNOWN))
    ).drop(f"_found_{target}")


def marker(name: str) -> str:
    return f"_m_{name}"


def left_with_marker(df: DataFrame, dimension: DataFrame, key: str, name: str) -> DataFrame:
    """Many-to-one left join that leaves a marker column, NULL exactly when nothing matched."""
    return df.join(dimension.withColumn(marker(name), F.lit(1)), key, "left")


def orphan_counts(names: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(marker(n)).isNull()).alias(f"orphans_{n}") for n in names]


def as_role(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One role of a shared dimension: {source column: name in this role}."""
    return df.select(*[F.col(c).alias(a) for c, a in columns.items()])


def in_scope(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_semi")


def missing_parents(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    return children.join(parents.select(key), key, "left_anti")
