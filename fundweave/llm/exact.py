"""Exact duplicates by sorting the content itself.

Texts are normalised by deleting white space. Spark samples splitters and range-partitions the rows
by (first characters, digest, length, id), each partition is sorted (externally, with spills) with
the whole normalised text in the order, and one pass compares every row's whole text with its
neighbour's. The splitters hold a bounded key, never a text, and end in the id, so a group of any
size is cut into several partitions; equal texts still follow each other in the overall order.

A run that reaches the edge of its partition may go on in the next one. The edges, at most two per
partition, are compared by digest and merged; their number is bounded by the number of partitions,
so this small table is broadcast back.

Defined cases: null and empty texts and texts of white space are one group; null ids sort last and
are kept only if nothing else is in the group; repeated rows form a group of which one row stays;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundweave.sources.workspace import cut

from .common import SPACE, col, only_rows, ship, whole

#: Characters of the text that lead the sort key; the digest of the whole text follows them.
LEAD = 16


def normal(text):
    return F.regexp_replace(whole(text), f"{SPACE}+", "")


def digest(text):
    return F.sha2(normal(text), 256)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in the overall order. Gives each row its run's first id and size in this
    partition; `head` marks the run's first row, `first` and `last` the partition's edge runs."""
    part = TaskContext.get().partitionId()
    run, body, sha, ids = -1, None, None, []
    out, held = [], 0

    def close(last: bool) -> None:
        nonlocal held
        if ids:
            out.append((run, sha, ids, last))
            held += len(ids)

    def batch() -> pa.RecordBatch:
        nonlocal out, held
        rows = [(r, d, i, g, n == 0, e) for r, d, g, e in out for n, i in enumerate(g)]
        out, held = [], 0
        runs, shas, each, groups, heads, lasts = zip(*rows)
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(each, ids_type),
                "keep_id": pa.array([g[0] for g in groups], ids_type),
                "group_size": pa.array([len(g) for g in groups], pa.int64()),
                "head": pa.array(heads, pa.bool_()),
                "text_sha256": pa.array(shas, pa.string()),
                "part": pa.array([part] * len(rows), pa.int32()),
                "run": pa.array(runs, pa.int64()),
                "first": pa.array([r == 0 for r in runs], pa.bool_()),
                "last": pa.array(lasts, pa.bool_()),
            }
        )

    ids_type = pa.int64()
    for rows in batches:
        ids_type = rows.schema.field("doc_id").type
        for i, d, text in zip(
            rows.column("doc_id").to_pylist(),
            rows.column("digest").to_pylist(),
            rows.column("body").to_pylist(),
        ):
            if d != sha or text != body:
                close(last=False)
                run, body, sha, ids = run + 1, text, d, []
            ids.append(i)
        if held >= 4096:
            yield batch()
    close(last=True)
    if out:
        yield batch()


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id (of the group's row with the most code points, then
    the smallest id), group_size, kept (true on exactly one row of a group), text_sha256."""
    order = ["lead", "digest", "body", F.desc("points"), F.asc_nulls_last("doc_id")]
    ranged = (
        df.select(col(id_col).alias("doc_id"), whole(col(text_col)).alias("text"))
        .select("doc_id", F.length("text").alias("points"), normal(F.col("text")).alias("body"))
        .withColumn("digest", F.sha2("body", 256))
        .withColumn("lead", F.substring("body", 1, LEAD))
        .repartitionByRange("lead", "digest", F.desc("points"), F.asc_nulls_last("doc_id"))
        .sortWithinPartitions(*order)
        .select("doc_id", "digest", "body")
    )
    ship(df.sparkSession)
    id_type = df.schema[id_col].dataType.simpleString()
    marked = cut(
        ranged.mapInArrow(
            _runs,
            f"doc_id {id_type}, keep_id {id_type}, group_size bigint, head boolean, "
            "text_sha256 string, part int, run bigint, first boolean, last boolean",
        ),
        "exact",
    )
    edges = (
        marked.filter(F.col("first") | F.col("last"))
        .filter("head")
        .select("part", "run", "text_sha256", "keep_id", "group_size")
    )
    by_place = Window.orderBy("part", "run")
    starts = F.coalesce(F.col("text_sha256") != F.lag("text_sha256").over(by_place), F.lit(True))
    islands = edges.withColumn("start", starts.cast("int")).withColumn(
        "island", F.sum("start").over(by_place)
    )
    island = Window.partitionBy("island")
    merged = islands.select(
        F.col("part").alias("e_part"),
        F.col("run").alias("e_run"),
        F.col("start").alias("e_start"),
        F.sum("group_size").over(island).alias("e_size"),
        F.first("keep_id").over(island.orderBy("part", "run")).alias("e_keep"),
    )
    joined = marked.join(
        F.broadcast(merged),
        (F.col("part") == F.col("e_part")) & (F.col("run") == F.col("e_run")),
        "left",
    )
    edge = F.col("e_part").isNotNull()
    return joined.select(
        "doc_id",
        F.when(edge, F.col("e_keep")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(edge, F.col("e_size")).otherwise(F.col("group_size")).alias("group_size"),
        (F.col("head") & (~edge | (F.col("e_start") == 1))).alias("kept"),
        "text_sha256",
    )


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that `dedup` keeps, with all their columns."""
    kept = dedup(docs, id_col, text_col).filter("kept").select("doc_id", "text_sha256")
    keys = [("doc_id", col(id_col)), ("text_sha256", digest(col(text_col)))]
    longest = F.length(whole(col(text_col)))
    return only_rows(docs, kept, keys, first=[F.desc(longest)])

