"""Ranking metrics over scored pairs, for one set of rows or several at once (`by`)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import ordered_blocks, rank_in_group, running_totals, top_k
from .sampling import SEED

# Size of a recommendation and number of folds.
TOP_K = 3
N_FOLDS = 5


def average_precision(
    scored: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()
) -> DataFrame:
    """Sum over distinct scores, best first, of the recall each adds times the precision there.

    Rows are reduced to distinct scores, which are staged, before anything is ordered. One row per `by` group; NULL
    when a group has no positives.
    """
    per_score = scored.groupBy(*by, score).agg(
        F.sum(F.col(label).cast("long")).alias("_tp"), F.count(F.lit(1)).alias("_n")
    )
    blocked = ordered_blocks(per_score, [*[F.col(c) for c in by], F.desc(score)])
    upto = running_totals(
        blocked, list(by), "_block", [F.desc(score)], {"_ctp": F.col("_tp"), "_cn": F.col("_n")}
    )
    gained = F.sum(F.col("_tp") * F.col("_ctp") / F.col("_cn"))
    return upto.groupBy(*by).agg((gained / F.nullif(F.sum("_tp"), F.lit(0))).alias("ap"))


def tie_break(*keys: str, seed: int = SEED) -> Column:
    """Random but repeatable order among equal scores: depends on the pair, not on row order."""
    return F.xxhash64(*keys, F.lit(seed))


def top_k_per_group(
    scored: DataFrame,
    group: Sequence[str],
    score: str = "score",
    k: int = TOP_K,
    tie: Sequence[Column] = (),
) -> DataFrame:
    return top_k(scored, group, [F.desc(score), *tie], k)


def precision_at_k(
    scored: DataFrame,
    group: str,
    label: str = "label",
    score: str = "score",
    k: int = TOP_K,
    tie: Sequence[Column] = (),
    by: Sequence[str] = (),
) -> DataFrame:
    """Mean over groups of the share of positives among each group's k best rows; a group smaller
    than k divides by its own size."""
    best = top_k_per_group(scored, [*by, group], score, k, tie)
    per_group = best.groupBy(*by, group).agg(F.avg(F.col(label).cast("double")).alias("_p"))
    return per_group.groupBy(*by).agg(F.avg("_p").alias(f"p_at_{k}"))


def with_fold(df: DataFrame, group: str, n_folds: int = N_FOLDS, hash_of=None) -> DataFrame:
    """A fold number that depends on the group alone, so a group is never on both sides. No shuffle."""
    h = F.xxhash64(F.col(group), F.lit(SEED)) if hash_of is None else hash_of(F.col(group))
    return df.withColumn("fold", F.pmod(h, F.lit(n_folds)).cast("int"))


def _taken(loads: list[int], size: int, n: int) -> tuple[list[int], list[int]]:
    """Of groups of one size, dealt one after the other to the lightest fold (the first of equal ones):
    how many each fold has got after n of them, and which folds follow next among equally light ones.

    A fold with load l takes its groups at loads l, l + size, l + 2 size, ... The n smallest of all
    these loads are the ones taken, so they are counted instead of dealt."""
    below = lambda level: [max(0, -(-(level - load) // size)) for load in loads]
    low, high = min(loads), max(loads) + size * (n + 1)
    while high - low > 1:
        level = (low + high) // 2
        low, high = (level, high) if sum(below(level)) <= n else (low, level)
    counts = below(low)
    tied = [f for f, load in enumerate(loads) if load <= low and (low - load) % size == 0]
    for f in tied[: n - sum(counts)]:
        counts[f] += 1
    return counts, tied[n - sum(below(low)) :]


def _fold_loads(n_folds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sizes come in falling order; gives the folds' loads before the groups of each."""
        loads = [0] * n_folds
        for rows in batches:
            sizes, before = rows.column("size").to_pylist(), []
            for size, groups in zip(sizes, rows.column("groups").to_pylist()):
                before.append(loads)
                counts, _ = _taken(loads, size, groups)
                loads = [load + size * c for load, c in zip(loads, counts)]
            yield pa.RecordBatch.from_pydict(
                {"l_size": pa.array(sizes, pa.int64()), "loads": pa.array(before, pa.list_(pa.int64()))}
            )

    return run


def _fold_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fold of the turn-th group of its size."""
    for rows in batches:
        names = ("size", "turn", "loads")
        found = [_taken(loads, size, turn - 1)[1][0] for size, turn, loads in zip(*(rows.column(c).to_pylist() for c in names))]
        yield pa.RecordBatch.from_arrays(
            [rows.column("group"), rows.column("size"), pa.array(found, pa.int32())], names=["group", "size", "fold"]
        )


def balanced_folds(df: DataFrame, group: str, n_folds: int = N_FOLDS) -> DataFrame:
    """(group, size, fold): groups from the largest to the smallest, equal ones by their value, each dealt
    to the fold with the fewest rows so far. Sizes of folds differ by the largest group at most.

    Only the histogram of sizes is walked through in order, by one task: with N rows it has sqrt(2 N)
    entries at most. Which group is the how-manieth of its size is counted in ordered blocks.
    """
    sizes = df.groupBy(F.col(group).alias("group")).agg(F.count(F.lit(1)).alias("size"))
    order = [F.desc("size"), F.asc_nulls_first("group")]
    blocked = ordered_blocks(sizes, order)
    placed = rank_in_group(blocked, ["size"], "_block", order[1:], "turn")
    histogram = blocked.groupBy("size").agg(F.count(F.lit(1)).alias("groups")).coalesce(1)
    loads = histogram.sortWithinPartitions(F.desc("size")).mapInArrow(
        _fold_loads(n_folds), "l_size bigint, loads array<bigint>"
    )
    # Most groups may have one size: keys in a struct let Spark split it.
    kind = df.schema[group].dataType.simpleString()
    met = placed.join(loads, F.struct("size") == F.struct("l_size")).select("group", "size", "turn", "loads")
    found = met.mapInArrow(_fold_of, f"group {kind}, size bigint, fold int")
    return found.withColumnRenamed("group", group)


def ceiling_at_k(pairs: DataFrame, group: str, label: str = "label", k: int = TOP_K) -> DataFrame:
    """Best precision@k any ranking could reach, given how many positives each group has."""
    per_group = pairs.groupBy(group).agg(
        F.sum(F.col(label).cast("long")).alias("_pos"), F.count(F.lit(1)).alias("_n")
    )
    best = F.least("_pos", F.lit(k)) / F.least("_n", F.lit(k))
    return per_group.agg(F.avg(best).alias("ceiling"), F.count(F.lit(1)).alias("groups"))
