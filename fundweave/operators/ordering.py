"""Row picking and running totals inside groups.

`first_per_key` and `top_k` filter directly on a row_number, which Spark plans as a
WindowGroupLimit below the shuffle: each map task forwards at most k rows per key, so a key
holding a large share of the table does not land whole in one task.

`running_totals` is the counterpart for results that need every row of a group ranked: the group
is cut into ordered blocks, blocks are summed on their own, and only block totals are
accumulated per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources import workspace


def newest_first(*columns: str) -> list[Column]:
    return [F.desc_nulls_last(c) for c in columns]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first under `order`, which should be a total order."""
    return top_k(df, keys, order, 1)


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    block: str,
    order: Sequence[Column],
    totals: dict[str, Column],
    overall: dict[str, str] | None = None,
) -> DataFrame:
    """Adds the inclusive running total of each expression in `totals`, ordered by (block, *order).

    `block` is an existing column whose values are compatible with the wanted order and small
    enough that one block of one group fits a task. No window ever spans more than one block, or
    one group's block totals. `overall` adds {new column: name in totals} with the group's sum.
    """
    cells = df.groupBy(*group, block).agg(*[F.sum(e).alias(f"_c_{n}") for n, e in totals.items()])
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    before = whole.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    overall = overall or {}
    offsets = cells.select(
        *group,
        block,
        *[F.coalesce(F.sum(f"_c_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in totals],
        *[F.sum(f"_c_{n}").over(whole).alias(a) for a, n in overall.items()],
    )
    upto = (
        Window.partitionBy(*group, block)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = df.select("*", *[F.sum(e).over(upto).alias(f"_l_{n}") for n, e in totals.items()])
    return local.join(offsets, [*group, block]).select(
        *df.columns,
        *[(F.col(f"_l_{n}") + F.col(f"_o_{n}")).alias(n) for n in totals],
        *overall,
    )


def rank_in_group(
    df: DataFrame,
    group: Sequence[str],
    block: str,
    order: Sequence[Column],
    name: str,
    size: str | None = None,
) -> DataFrame:
    """1-based rank of every row inside its group, and on request the group's size, without
    gathering the group in one task."""
    one = {name: F.lit(1).cast("long")}
    return running_totals(df, group, block, order, one, {size: name} if size else None)


def ordered_blocks(df: DataFrame, order: Sequence[Column], block: str = "_block") -> DataFrame:
    """Stages `df` range-partitioned under `order` and adds each row's partition as its block.

    Spark samples the bounds and AQE merges small neighbours, so the number of blocks follows the
    size of the data and their bounds follow every column of the order. Rows should be distinct
    under `order`; then no value is large enough to fill a block by itself. Staging fixes the blocks
    for all later passes.
    """
    dealt = df.repartitionByRange(*order).withColumn(block, F.spark_partition_id())
    return workspace.cut(dealt, "blocks")


def quantiles(df: DataFrame, columns: Sequence[str], steps: Sequence[float]) -> DataFrame:
    """Exact quantiles (linear interpolation, NULLs ignored) of several numeric columns.

    One row per column: name, n, then one column per step. Equal values are counted before
    anything is ordered, and the ordering is done in blocks.
    """
    named = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns]))
    values = df.select(named.alias("_v")).select("_v.name", "_v.value").filter("value IS NOT NULL")
    counts = values.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    blocked = ordered_blocks(counts, [F.col("name"), F.col("value")])
    ranked = running_totals(
        blocked, ["name"], "_block", [F.col("value")], {"upto": F.col("n")}, {"total": "upto"}
    )
    picks = []
    for step in steps:
        at = F.lit(step) * (F.col("total") - 1)
        low = F.min(F.when(F.col("upto") > F.floor(at), F.col("value")))
        high = F.min(F.when(F.col("upto") > F.ceil(at), F.col("value")))
        share = F.first(at - F.floor(at))
        picks.append((low + (high - low) * share).alias(f"q{round(step * 100)}"))
    return ranked.groupBy("name").agg(F.first("total").alias("n"), *picks)
