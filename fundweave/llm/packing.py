"""Best-fit packing of token sequences into bins of several permitted lengths.

Sequences longer than the largest length are cut into chunks of it. Inside a group the chunks go,
longest first, into the open bin with the least room that still takes them; a new bin is opened only
where none does. Which length a new bin gets is optimised jointly: a plan names, for each class of chunks
(those that need the same permitted length), the length that a bin opened for one of them gets. A plan
is carried out in full, each of its bins is shrunk to the smallest permitted length that holds its
contents, and its cost is the sum over bins of the length times `PER_TOKEN`, plus `PER_BIN`, plus
`PER_PAIR` times the length squared (attention). The search begins with the cheapest plan of one opening
length for all, and then changes one class at a time, the largest first, as long as a sweep over the
classes makes it cheaper. A plan with long and short bins side by side wins where it costs less.

Groups hold about `GROUP` chunks each, however long the sequences, and are dealt by a hash of the chunk,
so no key decides their size. Equal rows are counted before the shuffle and dealt out in lots of `LOT`, so a group does not
grow with the copies of one row either. A group's bins lose at most a few part-filled ones.

Defined cases: null and negative lengths count as 0; a sequence of length 0 is one chunk of length
0, and rides in any bin; null ids are packed like others; repeated rows are packed as often as they
occur, told apart by `copy`; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, ship

LENGTHS = (512, 1024, 2048, 4096, 8192)
GROUP = 20_000
LOT = 1_000
PER_TOKEN, PER_BIN, PER_PAIR = 1.0, 16.0, 0.00002


def cost(length: int) -> float:
    return PER_BIN + PER_TOKEN * length + PER_PAIR * length * length


def fitting(lengths: Sequence[int], need: int) -> int:
    """The least-cost permitted length that holds `need`."""
    return min((c for c in lengths if c >= need), key=cost)


def best_fit(
    sizes: Sequence[int], lengths: Sequence[int], opening: int | Sequence[int]
) -> tuple[list[int], list[int]]:
    """(bin of each chunk, contents of each bin) for `sizes` in falling order; a new bin is opened with
    `opening`, one length or one for each class of chunks, or with what the chunk needs. Rooms are found
    by the bits of one integer."""
    each = [opening] * len(lengths) if isinstance(opening, int) else opening
    bins: list[int] = []
    room: dict[int, list[int]] = {}
    left: list[int] = []
    rooms = 0
    filled: list[int] = []
    for size in sizes:
        fit = rooms >> size
        if fit:
            free = size + (fit & -fit).bit_length() - 1
            stack = room[free]
            b = stack.pop()
            if not stack:
                rooms &= ~(1 << free)
        else:
            free = each[bisect_left(lengths, size)]
            b, free = len(left), free if free >= size else fitting(lengths, size)
            left.append(free)
            filled.append(0)
        free -= size
        left[b] = free
        filled[b] += size
        room.setdefault(free, []).append(b)
        rooms |= 1 << free
        bins.append(b)
    return bins, filled


#: A plan carried out: its cost, the bin of each chunk, the length of each bin.
Carried = tuple[float, list[int], list[int]]


def carried_out(sizes: Sequence[int], lengths: Sequence[int], opening: int | Sequence[int]) -> Carried:
    bins, filled = best_fit(sizes, lengths, opening)
    shrunk = [fitting(lengths, f) for f in filled]
    return sum(map(cost, shrunk)), bins, shrunk


def pack(sizes: Sequence[int], lengths: Sequence[int]) -> tuple[list[int], list[int]]:
    """(bin of each chunk, length of each bin) of the cheapest plan with one opening length; of equal
    plans, the one that opens the shorter bins."""
    _, bins, shrunk = min((carried_out(sizes, lengths, c) for c in lengths), key=lambda p: p[0])
    return bins, shrunk


def pack_jointly(sizes: Sequence[int], lengths: Sequence[int]) -> tuple[list[int], list[int]]:
    """(bin of each chunk, length of each bin) of the cheapest plan found over opening lengths by class
    of chunks; never dearer than `pack`."""
    plans = [[c] * len(lengths) for c in lengths]
    tried = [carried_out(sizes, lengths, plan) for plan in plans]
    at = min(range(len(plans)), key=lambda i: tried[i][0])
    plan, best = plans[at], tried[at]
    there = sorted({bisect_left(lengths, s) for s in sizes}, reverse=True)
    better = len(there) > 1
    while better:
        better = False
        for k in there:
            for length in lengths[k:]:
                if length == max(plan[k], lengths[k]):
                    continue
                other = [*plan[:k], length, *plan[k + 1 :]]
                found = carried_out(sizes, lengths, other)
                if found[0] < best[0]:
                    plan, best, better = other, found, True
    return best[1], best[2]


def chunks(df: DataFrame, length: Column, id_col: str, longest: int) -> DataFrame:
    """(doc_id, copy, chunk, start, length) of every row."""
    n = F.greatest(F.coalesce(length.cast("bigint"), F.lit(0)), F.lit(0))
    equal = df.select(col(id_col).alias("doc_id"), n.alias("n")).groupBy("doc_id", "n").count()
    lots = equal.select(
        "doc_id", "n", "count", F.explode(F.sequence(F.lit(0), F.floor((F.col("count") - 1) / LOT))).alias("lot")
    )
    last = F.least(F.col("count"), (F.col("lot") + 1) * LOT) - 1
    cut = F.greatest(F.lit(0), F.ceil(F.col("n") / longest) - 1)
    each = lots.select(
        "doc_id", "n", "lot", last.alias("last"), F.explode(F.sequence(F.lit(0), cut)).alias("chunk")
    )
    start = F.col("chunk") * longest
    return each.select(
        "doc_id",
        "lot",
        "last",
        F.col("chunk").cast("int").alias("chunk"),
        start.alias("start"),
        F.least(F.lit(longest), F.col("n") - start).cast("int").alias("length"),
    )


def packed(
    df: DataFrame,
    length: Column,
    id_col: str = "doc_id",
    lengths: Sequence[int] = LENGTHS,
    group: int = GROUP,
) -> DataFrame:
    """One row per chunk: doc_id, copy, chunk, start and length (the chunk's place in its document),
    bin_id (group and number), position in the bin, bin_length."""
    lengths = tuple(sorted(set(lengths)))
    ship(df.sparkSession)
    n = F.greatest(F.ceil(F.coalesce(length.cast("bigint"), F.lit(0)) / lengths[-1]), F.lit(1))
    pieces = df.agg(F.sum(n)).first()[0] or 0  # one number
    groups = max(1, -(-pieces // group))
    id_type = df.schema[id_col].dataType.simpleString()
    dealt = chunks(df, length, id_col, lengths[-1]).withColumn(
        "group", F.pmod(F.xxhash64("doc_id", "lot", "chunk", "length"), F.lit(groups))
    )

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("lot", "ascending"), ("chunk", "ascending"), ("length", "ascending")])
        lot, last = (rows.column(c).to_numpy() for c in ("lot", "last"))
        first = lot * LOT
        times = (last - first + 1).astype(np.int64)
        which = np.repeat(np.arange(len(times)), times)
        copy = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + first[which]
        size = rows.column("length").to_numpy()[which]
        order = np.argsort(-size, kind="stable")
        which, copy, size = which[order], copy[order], size[order]
        bins, shrunk = pack_jointly(size.tolist(), lengths)
        bins = np.asarray(bins, np.int64)
        by_bin = np.argsort(bins, kind="stable")
        which, copy, size, bins = which[by_bin], copy[by_bin], size[by_bin].astype(np.int64), bins[by_bin]
        ends = np.cumsum(size)
        starts = ends - size
        heads = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
        base = np.repeat(starts[heads], np.diff(np.r_[heads, len(bins)]))
        taken = rows.select(["doc_id", "chunk", "start", "length"]).take(pa.array(which))
        name = rows.column("group")[0].as_py()
        return pa.table(
            {
                "doc_id": taken.column("doc_id"),
                "copy": pa.array(copy.astype(np.int64)),
                "chunk": taken.column("chunk"),
                "start": taken.column("start"),
                "length": taken.column("length"),
                "bin_id": pa.array([f"{name}-{b}" for b in bins.tolist()]),
                "position": pa.array(starts - base),
                "bin_length": pa.array(np.asarray(shrunk, np.int32)[bins]),
            }
        )

    return dealt.groupBy("group").applyInArrow(
        run,
        f"doc_id {id_type}, copy bigint, chunk int, start bigint, length int, bin_id string, "
        "position bigint, bin_length int",
    )
