"""Keeping tables up to date from a new load, as DataFrame -> DataFrame steps.

The current table is only ever read by key columns or anti-joined, so when the load is small
Spark broadcasts it and the big side is streamed without a shuffle.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: high-water mark of a table that has no rows yet.
EPOCH_MARK = datetime(1900, 1, 1)


def high_water(df: DataFrame, column: str = "_loaded_at") -> datetime:
    """Largest load time of a table. An action: one row comes back, so that the filter built from
    it is a literal and reaches the Parquet scan."""
    mark = df.agg(F.max(column)).first()[0]
    return mark or EPOCH_MARK


def newer_than(df: DataFrame, mark: datetime, column: str = "_loaded_at") -> DataFrame:
    return df.filter(F.col(column) > F.lit(mark).cast(df.schema[column].dataType))


def union_by_name(current: DataFrame, extra: DataFrame) -> DataFrame:
    """Additive schema drift: columns missing on either side become NULL."""
    return current.unionByName(extra, allowMissingColumns=True)


def unseen(batch: DataFrame, current: DataFrame, key: str, version: str) -> DataFrame:
    """Rows of `batch` whose (key, version) is not in `current`; NULL versions count as equal."""
    b, c = batch.alias("b"), current.select(key, version).alias("c")
    same = (F.col(f"b.{key}") == F.col(f"c.{key}")) & F.col(f"b.{version}").eqNullSafe(
        F.col(f"c.{version}")
    )
    return b.join(c, same, "left_anti")


def append_new(current: DataFrame, batch: DataFrame, key: str, version: str) -> DataFrame:
    return union_by_name(current, unseen(batch, current, key, version))


def accepted_changes(
    current: DataFrame, changes: DataFrame, key: str, version: str
) -> DataFrame:
    """Changes that may replace the current row: new key, newer version, or undated current row."""
    cur = current.select(
        F.col(key).alias("_cur_key"), F.col(version).alias("_cur_version")
    )
    joined = changes.join(cur, F.col(key) == F.col("_cur_key"), "left")
    wins = (
        F.col("_cur_key").isNull()
        | F.col("_cur_version").isNull()
        | (F.col(version) > F.col("_cur_version"))
    )
    return joined.filter(wins).drop("_cur_key", "_cur_version")


def replace_rows(current: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Rows with the same key are replaced, the others kept."""
    kept = current.join(rows.select(key), key, "left_anti")
    return union_by_name(kept, rows)


def merge_newer(current: DataFrame, changes: DataFrame, key: str, version: str) -> DataFrame:
    return replace_rows(current, accepted_changes(current, changes, key, version), key)


def replace_children(
    current: DataFrame,
    children: DataFrame,
    parent: str,
    changed_parents: DataFrame | None = None,
) -> DataFrame:
    """Children of every changed parent are dropped and the new ones added.

    Without `changed_parents` only parents that appear among the new children count as changed, so
    a parent whose new version has no children keeps its old ones. With it they are dropped too.
    """
    touched = children.select(parent) if changed_parents is None else changed_parents.select(parent)
    kept = current.join(touched.distinct(), parent, "left_anti")
    return union_by_name(kept, children)
