"""Near duplicates by 64-bit SimHash, found through vantage-point trees.

A fingerprint is linked to every other one at most `radius` bits away, and documents are grouped by
the components of these links.

Shards. The upper levels of the tree deal fingerprints out to shards. Level j has a vantage point on
its own block of bits and a threshold m at about the median distance: d <= m goes one way, d > m the
other. The Hamming distance is the sum over blocks, so the triangle bounds of the levels add up: a
fingerprint at distance d <= m differs in at least m + 1 - d bits of the block from everything beyond
the threshold, and in at least d - m bits the other way round. It is sent as a query across a
threshold only while the sum of these bounds is at most `radius`, which prunes almost all shards.

Inside a shard an ordinary vantage-point tree (whole fingerprints, median thresholds) answers the
queries with the bounds d - r <= m and d + r > m, and its leaves are compared exactly. A shard gives
back a spanning forest of the links it found, never its pairs.

Shards that got far more than their share, as a dense cloud of near copies makes, are split by further
levels of the same tree: a vantage point of their own, whole fingerprints, the median distance as
threshold. Where a cloud is so dense that most fingerprints would have to go both ways, a level gains
nothing; such a shard's members and queries are dealt into cells of a bounded number of either, and a
cell is searched by its own tree. No pair is lost on either way, and no task holds more than a cell.

Equal fingerprints are one node before the search, so exact copies cost nothing there.

Defined cases: a text without words has fingerprint zero and is linked like any other; null ids are
never a component's id unless it has no other; an empty table gives an empty result; repeated rows
each get their row of the result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundweave.sources.workspace import cut

from . import components
from .common import col, only_rows, ship, whole

#: Distinct fingerprints per shard that the number of levels aims at.
SHARD = 8192
#: A shard with more than this many members and queries is split by further levels.
DENSE = 16 * SHARD
#: Further levels, and the growth of a shard's rows beyond which a level gains nothing.
DEEPER = 24
GROWTH = 1.6
#: Fingerprints of a leaf inside a shard, compared one by one.
LEAF = 48


def fingerprint(text: str, shingle: int = 3) -> int:
    """Lower-cases A-Z; bytes.split knows exactly the white space \\x20 and \\x09-\\x0D."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    if len(w) < shingle:
        grams = [b" ".join(w)]
    else:
        grams = map(b" ".join, zip(*[w[i:] for i in range(shingle)]))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(g, 42) for g in grams), np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 15):
        part = h[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(h), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, content, fp): content is a hash of the text that tells rows of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in rows.column("text")]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("content"), pa.array(fps, pa.int64())],
                names=["doc_id", "content", "fp"],
            )

    ship(df.sparkSession)
    id_type = df.schema[id_col].dataType.simpleString()
    text = whole(col(text_col))
    return df.select(
        col(id_col).alias("doc_id"), F.xxhash64(text).alias("content"), text.alias("text")
    ).mapInArrow(run, f"doc_id {id_type}, content bigint, fp bigint")


def vantage_blocks(levels: int) -> list[tuple[int, int]]:
    """(mask, vantage point on it) of each level: the 64 bits in contiguous blocks, fixed points."""
    ends = [64 * i // levels for i in range(levels + 1)] if levels else []
    out = []
    for j in range(levels):
        mask = (1 << ends[j + 1]) - (1 << ends[j])
        out.append((mask, xxhash.xxh64_intdigest(b"vantage", j) & mask))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def thresholds(nodes: DataFrame, blocks: list[tuple[int, int]]) -> list[int]:
    """For each level the distance that splits all fingerprints most evenly. The driver gets one
    count for each level and distance, 64 + levels at most."""
    if not blocks:
        return []
    distance = [
        F.struct(
            F.lit(j).alias("level"),
            F.bit_count(
                F.col("fp").bitwiseXOR(F.lit(_signed(v))).bitwiseAND(F.lit(_signed(mask)))
            ).alias("d"),
        )
        for j, (mask, v) in enumerate(blocks)
    ]
    counts = nodes.select(F.explode(F.array(*distance)).alias("x")).groupBy("x.level", "x.d").count()
    found: list[dict[int, int]] = [{} for _ in blocks]
    for r in counts.collect():
        found[r["level"]][r["d"]] = r["count"]
    out = []
    for hist in found:
        total, below, best = sum(hist.values()), 0, (2.0, 0)
        for d in sorted(hist):
            below += hist[d]
            best = min(best, (abs(below / total - 0.5), d))
        out.append(best[1])
    return out


def route(
    fps: np.ndarray, blocks: list[tuple[int, int]], cuts: list[int], radius: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of fingerprint, shard, whether the shard is its home) for all shards to be asked."""
    index = np.arange(len(fps))
    shard = np.zeros(len(fps), np.int64)
    spent = np.zeros(len(fps), np.int64)
    for (mask, v), m in zip(blocks, cuts):
        d = np.bitwise_count((fps[index] ^ np.uint64(v)) & np.uint64(mask)).astype(np.int64)
        inside = d <= m
        cost = spent + np.where(inside, m + 1 - d, d - m)
        over = cost <= radius
        shard = np.concatenate([2 * shard + ~inside, 2 * shard[over] + inside[over]])
        spent = np.concatenate([spent, cost[over]])
        index = np.concatenate([index, index[over]])
    return index, shard, spent == 0


class Forest:
    """Components of a growing set of links over 0..n-1, in arrays."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            open_ = x != y
            if not open_.any():
                return
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def search(fps: np.ndarray, home: np.ndarray, radius: int) -> Forest:
    """Links between `fps[home]` and all `fps` (positions are distinct fingerprints) through a
    vantage-point tree over the home ones."""
    forest = Forest(len(fps))
    todo = [(np.flatnonzero(home), np.arange(len(fps)))]
    while todo:
        items, queries = todo.pop()
        if not len(items) or not len(queries):
            continue
        if len(items) > LEAF:
            v = fps[items[len(items) // 2]]
            d = np.bitwise_count(fps[items] ^ v)
            m = int(np.partition(d, len(d) // 2)[len(d) // 2])
            if m == d.max():
                m -= 1
            inside = d <= m
            if inside.any():
                q = np.bitwise_count(fps[queries] ^ v).astype(np.int64)
                todo.append((items[inside], queries[q - radius <= m]))
                todo.append((items[~inside], queries[q + radius > m]))
                continue
        for i in range(0, len(queries), 1 << 14):
            some = queries[i : i + (1 << 14)]
            for j in range(0, len(items), 64):
                near = np.bitwise_count(fps[some][:, None] ^ fps[items[j : j + 64]][None, :])
                a, b = np.nonzero(near <= radius)
                forest.add(some[a], items[j : j + 64][b])
    return forest


def _forest_of_shard(radius: int):
    def run(rows: pa.Table) -> pa.Table:
        fps = rows.column("fp").to_numpy().view(np.uint64)
        forest = search(fps, rows.column("home").to_numpy(zero_copy_only=False), radius)
        hung = np.flatnonzero(forest.root != np.arange(len(fps)))
        return pa.table(
            {
                "a": pa.array(fps[hung].view(np.int64)),
                "b": pa.array(fps[forest.root[hung]].view(np.int64)),
            }
        )

    return run


def deeper(dealt: DataFrame, radius: int, most: int) -> DataFrame:
    """`dealt` (shard, fp, home) with every shard of more than `most` rows split by further levels, as
    far as they gain something. Thresholds are joined as one row for each crowded shard."""
    done, seen = [], dealt
    for level in range(DEEPER):
        counts = seen.groupBy("shard").agg(
            F.count("*").alias("n"),
            F.min(F.when(F.col("home"), F.struct(F.xxhash64("fp", F.lit(level)).alias("h"), "fp"))).alias("v"),
        )
        points = cut(
            counts.filter(F.col("n") > most).select(F.struct("shard").alias("c"), "n", F.col("v.fp").alias("v")),
            "crowded",
        )
        if points.isEmpty():
            break
        met = seen.join(points, F.struct("shard") == F.col("c"), "left")
        met = met.withColumn("d", F.bit_count(F.col("fp").bitwiseXOR(F.col("v"))))
        met = cut(met.select("shard", "fp", "home", "d"), "measured")
        done.append(met.filter("d IS NULL").select("shard", "fp", "home"))
        crowd = met.filter("d IS NOT NULL")
        # At most 65 distances in a shard.
        by_d = crowd.groupBy("shard", "d").agg(F.count("*").alias("n"), F.sum(F.col("home").cast("int")).alias("homes"))
        of_shard = Window.partitionBy("shard")
        halves = by_d.withColumn("upto", F.sum("homes").over(of_shard.orderBy("d"))).withColumn(
            "homes", F.sum("homes").over(of_shard)
        )
        median = F.min(F.when(2 * F.col("upto") >= F.col("homes"), F.col("d"))).over(of_shard)
        halves = halves.withColumn("m", median)
        rows = F.sum("n")
        both = F.sum(F.when((F.col("d") <= F.col("m") + radius) & (F.col("d") > F.col("m") - radius), F.col("n")))
        cuts = halves.groupBy("shard").agg(
            F.first("m").alias("m"), ((rows + F.coalesce(both, F.lit(0))) / rows <= GROWTH).alias("gains"),
            (F.max("upto") > F.max(F.when(F.col("d") <= F.col("m"), F.col("upto")))).alias("splits"),
        )
        cuts = cuts.select(F.struct("shard").alias("c"), "m", (F.col("gains") & F.col("splits")).alias("go"))
        placed = crowd.join(cuts, F.struct("shard") == F.col("c"))
        done.append(placed.filter(~F.col("go")).select("shard", "fp", "home"))
        side = lambda beyond, asked: F.when(
            asked,
            F.struct(
                F.xxhash64("shard", F.lit(level), F.lit(beyond)).alias("shard"), "fp",
                (F.col("home") & ((F.col("d") > F.col("m")) == F.lit(beyond))).alias("home"),
            ),
        )
        sides = F.array(
            side(False, F.col("d") - radius <= F.col("m")), side(True, F.col("d") + radius > F.col("m"))
        )
        split = placed.filter("go").select(F.explode(F.array_compact(sides)).alias("x")).select("x.*")
        seen = cut(split, "deeper")
    out = seen
    for part in done:
        out = out.unionByName(part)
    return out


def links(nodes: DataFrame, radius: int = 2, shard: int = SHARD, dense: int = DENSE) -> DataFrame:
    """Links (a, b) between distinct fingerprints `nodes` (fp) that have the same components as all
    links of `radius` bits or fewer."""
    n = nodes.count()
    levels = min(32, max(0, (max(n, 1) - 1) // shard).bit_length())
    blocks = vantage_blocks(levels)
    cuts = thresholds(nodes, blocks) if n else []

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            fps = rows.column("fp").to_numpy().view(np.uint64)
            for i in range(0, len(fps), 1 << 13):
                part = fps[i : i + (1 << 13)]
                index, shards, home = route(part, blocks, cuts, radius)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shards),
                        pa.array(part[index].view(np.int64)),
                        pa.array(home),
                    ],
                    names=["shard", "fp", "home"],
                )

    dealt = cut(nodes.select("fp").mapInArrow(deal, "shard bigint, fp bigint, home boolean"), "shards")
    found = deeper(dealt, radius, dense)
    return celled(found, max(shard, dense)).groupBy("shard", "row", "column").applyInArrow(
        _forest_of_shard(radius), "a bigint, b bigint"
    )


def celled(dealt: DataFrame, most: int) -> DataFrame:
    """Deals each shard into cells: members by `row`, every member and query by `column`, about `most` of
    either in a cell. A shard of usual size is one cell; its rows are not repeated."""
    sizes = dealt.groupBy("shard").agg(
        F.greatest(F.ceil(F.count_if("home") / most), F.lit(1)).alias("rows"),
        F.ceil(F.count("*") / most).alias("columns"),
    )
    big = cut(sizes.filter("rows > 1 OR columns > 1").select(F.struct("shard").alias("c"), "rows", "columns"), "big")
    if big.isEmpty():
        return dealt.withColumns({"row": F.lit(0).cast("bigint"), "column": F.lit(0).cast("bigint")})
    one = F.lit(1).cast("bigint")
    met = dealt.join(big, F.struct("shard") == F.col("c"), "left").select(
        "shard", "fp", "home", F.coalesce("rows", one).alias("rows"), F.coalesce("columns", one).alias("columns")
    )
    met = met.withColumns(
        {"row": F.pmod(F.xxhash64("fp"), F.col("rows")), "column": F.pmod(F.xxhash64("fp", F.lit(1)), F.col("columns"))}
    )
    upto = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    cell = lambda r, c, h: F.struct(r.alias("row"), c.alias("column"), h.alias("home"))
    # A query asks every row of its column; a member is also there for the other columns of its row.
    asks = F.transform(upto("rows"), lambda r: cell(r, F.col("column"), F.col("home") & (r == F.col("row"))))
    others = F.transform(
        F.filter(upto("columns"), lambda c: F.col("home") & (c != F.col("column"))),
        lambda c: cell(F.col("row"), c, F.lit(True)),
    )
    return met.select("shard", "fp", F.explode(F.concat(asks, others)).alias("x")).select("shard", "fp", "x.*")


def classes(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = 2,
    shard: int = SHARD,
    dense: int = DENSE,
) -> DataFrame:
    """One row per input row: doc_id, content, fp (as a signed long), component_id, the smallest
    doc_id reachable over links of `radius` bits or fewer, and root, the component's least
    fingerprint, which tells components apart where rows share an id."""
    rows = cut(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    nodes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    member = cut(components.roots(links(nodes, radius, shard, dense)), "members")
    rooted = nodes.join(member, F.col("fp") == F.col("node")).select("fp", "root", "least")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # One component may hold most fingerprints: keys in a struct let Spark split it.
    of_root = least.select(F.struct("root").alias("c"), "component_id")
    linked = rooted.join(of_root, F.struct("root") == F.col("c")).select(F.col("fp").alias("l_fp"), "component_id", "root")
    of_node = cut(
        nodes.join(linked, F.col("fp") == F.col("l_fp"), "left").select(
            F.col("fp").alias("n_fp"),
            F.when(F.col("l_fp").isNull(), F.col("least"))
            .otherwise(F.col("component_id"))
            .alias("component_id"),
            F.coalesce("root", "fp").alias("root"),
        ),
        "classes",
    )
    return rows.join(of_node, F.col("fp") == F.col("n_fp")).select(
        "doc_id", "content", "fp", "component_id", "root"
    )


def as_hex(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` with one document of each class, that of the smallest id, with all their
    columns."""
    found = classes(docs, id_col, text_col, **options)
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content")
    kept = cut(found.groupBy("root").agg(F.min(first).alias("f")).select("f.doc_id", "f.content"), "kept")
    keys = [("doc_id", col(id_col)), ("content", F.xxhash64(whole(col(text_col))))]
    return only_rows(docs, kept, keys)
