"""The most similar candidates of each ask, as a matrix product in blocks.

Candidates of a group are dealt to blocks by a hash of their key, asks to tiles, and a task multiplies
one tile with one block: it holds `BLOCK` candidates and `TILE` asks whatever the size of the group. Each
product hands on k candidates for an ask, and the k best of these are the k best of all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import top_k

BLOCK = 8192
TILE = 256


def _dealt(rows: DataFrame, group: str, key: str, most: int, number: str, count: str) -> DataFrame:
    """Adds the row's place among its group's pieces of about `most` rows, and how many there are.
    Keys in a struct make Spark shuffle both sides of the join, which lets it split a hot group."""
    sizes = rows.groupBy(F.struct(group).alias("_g")).agg(F.ceil(F.count(F.lit(1)) / most).alias(count))
    joined = rows.join(sizes, F.struct(group) == F.col("_g")).drop("_g")
    return joined.withColumn(number, F.pmod(F.xxhash64(key), F.col(count)))


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    lists = vectors.combine_chunks()
    widths = set(lists.value_lengths().to_pylist())
    if len(widths) > 1:
        raise ValueError(f"vectors of different widths: {sorted(widths)}")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1).astype(np.float64)


def _best(k: int):
    def run(asks: pa.Table, candidates: pa.Table) -> pa.Table:
        chosen_ask, chosen_key, chosen_score = [], [], []
        if len(asks) and len(candidates):
            left, right = _matrix(asks.column("vector")), _matrix(candidates.column("vector"))
            scores = left @ right.T
            own = asks.column("own").to_pylist()
            keys = candidates.column("key").to_pylist()
            place = {key: i for i, key in enumerate(keys)}
            names = asks.column("ask").to_pylist()
            for row, mine, name in zip(scores, own, names):
                if mine is not None and mine in place:
                    row[place[mine]] = -np.inf
                # Every candidate that ties with the last one chosen stays in: keys decide later.
                last = np.partition(row, max(len(row) - k, 0))[max(len(row) - k, 0)]
                near = np.flatnonzero((row >= last) & (row > -np.inf))
                near = sorted(near, key=lambda i: (-row[i], keys[i]))[:k]
                chosen_ask += [name] * len(near)
                chosen_key += [keys[i] for i in near]
                chosen_score += [float(row[i]) for i in near]
        group = (asks if len(asks) else candidates).column("group")
        return pa.table(
            {
                "group": pa.array([group[0].as_py()] * len(chosen_ask), group.type),
                "ask": pa.array(chosen_ask, asks.schema.field("ask").type),
                "key": pa.array(chosen_key, candidates.schema.field("key").type),
                "score": pa.array(chosen_score, pa.float64()),
            }
        )

    return run


def most_similar(
    asks: DataFrame,
    candidates: DataFrame,
    group: str,
    ask: str,
    key: str,
    vector: str,
    k: int = 3,
    own: str | None = None,
    block: int = BLOCK,
    tile: int = TILE,
) -> DataFrame:
    """(group, ask, key, score): for each ask its k candidates of the same group with the largest dot
    product, ties by the smaller key. `own` names a column of the asks with a candidate to leave out.
    Rows without a vector or group are neither asks nor candidates; keys are unique in their group."""
    there = lambda df: df.filter(F.col(vector).isNotNull() & F.col(group).isNotNull())
    left = there(asks).select(
        F.col(group).alias("group"), F.col(ask).alias("ask"), F.col(vector).alias("vector"),
        (F.col(own) if own else F.lit(None)).alias("own"),
    )
    right = there(candidates).select(
        F.col(group).alias("group"), F.col(key).alias("key"), F.col(vector).alias("vector")
    )
    left = _dealt(left, "group", "ask", tile, "tile", "tiles")
    right = _dealt(right, "group", "key", block, "block", "blocks")
    pieces: Column = F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)
    # How many pieces the other side has: one row for each group.
    tiles = left.groupBy(F.struct("group").alias("_g")).agg(F.max("tiles").alias("n"))
    blocks = right.groupBy(F.struct("group").alias("_g")).agg(F.max("blocks").alias("n"))
    right = right.join(tiles, F.struct("group") == F.col("_g")).select(
        "group", "block", F.explode(pieces).alias("tile"), "key", "vector"
    )
    left = left.join(blocks, F.struct("group") == F.col("_g")).select(
        "group", F.explode(pieces).alias("block"), "tile", "ask", "own", "vector"
    )
    cell = ["group", "block", "tile"]
    kind = {f.name: f.dataType.simpleString() for f in (*left.schema.fields, *right.schema.fields)}
    schema = f"group {kind['group']}, ask {kind['ask']}, key {kind['key']}, score double"
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(_best(k), schema)
    best = top_k(found, ["group", "ask"], [F.desc("score"), F.col("key")], k)
    return best.select(
        F.col("group").alias(group), F.col("ask").alias(ask), F.col("key").alias(key), "score"
    )
