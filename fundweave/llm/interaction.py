"""Filter interaction audit: what every order of a set of filters removes at each of its steps.

A document's verdicts are a mask with one bit for each filter it fails. What a mask does in all
orders is a fixed pattern: for each step of each order a document is kept, removed there, or fails
the filter after an earlier one removed it. `Counters` writes that pattern as one big integer with a
64-bit field for every (order, step, outcome); a document adds its mask's integer to its part's sum,
and the sum's fields are the counts. A field counts documents, whose number fits 63 bits, so no
field ever carries into the next, and a sum is read back by its bytes.

Spark computes the masks and deals the work: texts never leave the JVM, and rows with equal verdicts
of equal texts are counted before they are shuffled, so a group of copies of any size is a few rows.
Tasks add integers in Arrow batches and hand on one integer per part; these are added in two steps,
lots first, so a part that holds most rows costs no task more than its lots.

A document repeats another one if a row with a smaller id has the same text anywhere in the table
(texts are compared by SHA-256).

Defined cases: null texts are empty ones; a null part is the empty string; documents without a label
count as neither good nor toxic, and one with several labels as good or toxic if any says so; null ids
sort behind all others, so such a row repeats any row with an id and its text; rows that repeat an id
and its text are documents of their own, and none of them is the smaller id; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import col, ship, whole, words

#: What a step counts, in the order of the fields.
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
FIELD = 8  # bytes
#: Parts whose sums a task holds before it hands them on.
HOLD = 256
#: Lots that the sums of a part are added in before they meet.
LOTS = 64

GOOD, TOXIC = 1, 2


class Counters:
    """The packed integers of every (mask, labels) for `filters`, one letter each."""

    def __init__(self, filters: str) -> None:
        self.filters = filters
        self.orders = ["".join(p) for p in itertools.permutations(filters)]
        self.size = len(self.orders) * len(filters) * len(OUTCOMES)
        self._known: dict[int, int] = {}

    def pattern(self, mask: int, labels: int) -> np.ndarray:
        """(order, step, outcome) of one document."""
        out = np.zeros((len(self.orders), len(self.filters), len(OUTCOMES)), np.uint64)
        for o, order in enumerate(self.orders):
            gone = False
            for s, letter in enumerate(order):
                bit = 1 << self.filters.index(letter)
                fails = bool(mask & bit)
                removed = fails and not gone
                redundant = fails and gone
                gone = gone or fails
                out[o, s] = (
                    not gone,
                    removed,
                    redundant,
                    mask == bit,
                    removed and bool(labels & GOOD),
                    removed and bool(labels & TOXIC),
                )
        return out

    def wide(self, code: int) -> int:
        """The integer of a code: the mask above two bits of labels."""
        if code not in self._known:
            fields = self.pattern(code >> 2, code & 3).ravel()
            self._known[code] = int.from_bytes(fields.astype("<u8").tobytes(), "little")
        return self._known[code]

    def pack(self, total: int) -> bytes:
        return total.to_bytes(self.size * FIELD, "little")

    def unpack(self, total: int) -> np.ndarray:
        """(order, step, outcome) counts of a sum."""
        shape = (len(self.orders), len(self.filters), len(OUTCOMES))
        return np.frombuffer(self.pack(total), "<u8").astype(np.int64).reshape(shape)


def text_filters(text: Column) -> dict[str, Column]:
    """The filters on one text; true means that it fails."""
    body, w = whole(text), words(text)
    capitals = F.length(body) - F.length(F.translate(body, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(w) < 200,
        "B": 100 * F.size(F.array_distinct(w)) < 50 * F.size(w),
        "C": 100 * capitals.cast("long") > 3 * F.length(body).cast("long"),
        "D": body.rlike(r"[#$%&*|]"),
    }


def verdicts(
    docs: DataFrame,
    labels: DataFrame,
    filters: dict[str, Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """(part, code, n): documents of a part by verdicts and labels. The bit behind those of
    `filters` is that of a repeated text. Only narrow rows are shuffled: by id to meet the labels,
    then by text."""
    mask = sum((c.cast("int") * (1 << i) for i, c in enumerate(filters.values())), F.lit(0))
    rows = docs.select(
        col(id_col).alias("doc_id"),
        F.unhex(F.sha2(whole(col(text_col)), 256)).alias("digest"),
        F.coalesce(col(part_col).cast("string"), F.lit("")).alias("part"),
        mask.alias("mask"),
    )
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("l_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    same = rows.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    marks = F.coalesce("good", F.lit(0)) * GOOD + F.coalesce("toxic", F.lit(0)) * TOXIC
    # Keys in a struct make Spark shuffle both sides for this join, which lets it split a hot id.
    on = F.struct(F.col("doc_id").alias("id")) == F.struct(F.col("l_id").alias("id"))
    marked = same.join(known, on, "left").select(
        "digest", "part", (F.col("mask") * 4 + marks).alias("code"), F.col("n"),
        F.struct(F.col("doc_id").isNull().alias("none"), "doc_id").alias("id"),
    )
    # Rows of one text have one mask, so a group of copies leaves each task as a few rows.
    grouped = marked.groupBy("digest", "part", "code").agg(
        F.sum("n").alias("n"),
        F.min(F.struct("id", F.col("n").alias("at"))).alias("first"),
    )
    text = Window.partitionBy("digest")
    led = grouped.withColumn("least", F.min("first.id").over(text))
    # Rows that share the smallest id are all first; others with the text repeat it.
    alone = F.when(F.col("first.id") == F.col("least"), F.col("first.at")).otherwise(F.lit(0))
    bit = 4 << len(filters)
    split = F.array(
        F.struct(F.col("code").alias("code"), alone.alias("n")),
        F.struct((F.col("code") + bit).alias("code"), (F.col("n") - alone).alias("n")),
    )
    return led.select("part", F.explode(split).alias("x")).select("part", "x.*").filter("n > 0")


def audit(counted: DataFrame, filters: str) -> DataFrame:
    """One row for each part, order and step of `counted` (part, code, n): `OUTCOMES`, and shapley,
    the removed of the step's filter summed over all orders."""
    ship(counted.sparkSession)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, sums = Counters(filters), {}
        lot = TaskContext.get().partitionId() % LOTS

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(list(sums), pa.string()),
                    "lot": pa.array([lot] * len(sums), pa.int32()),
                    "total": pa.array([counters.pack(t) for t in sums.values()], pa.binary()),
                }
            )
            sums.clear()
            return out

        for rows in batches:
            for part, code, n in zip(*(rows.column(c).to_pylist() for c in ("part", "code", "n"))):
                sums[part] = sums.get(part, 0) + n * counters.wide(code)
                if len(sums) > HOLD:
                    yield flush()
        if sums:
            yield flush()

    def merged(batches: Iterator[pa.RecordBatch]) -> int:
        return sum(int.from_bytes(t.as_py(), "little") for rows in batches for t in rows.column("total"))

    def meet(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        total = Counters(filters).pack(merged(batches))
        yield pa.RecordBatch.from_pydict({"part": pa.array([key[0].as_py()]), "total": pa.array([total], pa.binary())})

    def read(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        counters = Counters(filters)
        counts = counters.unpack(merged(batches))
        n, steps = len(counters.orders) * len(filters), len(filters)
        letters = [c for order in counters.orders for c in order]
        removed = counts[:, :, OUTCOMES.index("removed")].ravel().tolist()
        whole_sum = {f: sum(r for r, c in zip(removed, letters) if c == f) for f in filters}
        out = {
            "part": pa.array([key[0].as_py()] * n, pa.string()),
            "filter_order": pa.array([o for o in counters.orders for _ in range(steps)]),
            "step": pa.array([s + 1 for _ in counters.orders for s in range(steps)], pa.int32()),
        }
        for i, name in enumerate(OUTCOMES):
            out[name] = pa.array(counts[:, :, i].ravel())
        out["shapley"] = pa.array([whole_sum[c] for c in letters], pa.int64())
        yield pa.RecordBatch.from_pydict(out)

    assert len(set(filters)) == len(filters) and math.factorial(len(filters)) <= 5040
    sums = counted.select("part", "code", "n").mapInArrow(add, "part string, lot int, total binary")
    lots = sums.groupBy("part", "lot").applyInArrow(meet, "part string, total binary")
    counts = ", ".join(f"{c} bigint" for c in (*OUTCOMES, "shapley"))
    return lots.groupBy("part").applyInArrow(read, f"part string, filter_order string, step int, {counts}")
