"""What several operators here share: column names, words, row keys and class samples."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path

import fundweave
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundweave.operators.ordering import top_k

#: White space of the word rules: blank and the five control characters \x09-\x0D.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package. Spark hands the archive to every executor, so they
    need no copy of the repository of their own."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(fundweave.__file__).parent
    path = Path(tempfile.mkdtemp(prefix="fundweave-code-")) / "fundweave-workers.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(path))
    _SHIPPED.add(app)


_SHIPPED: set[str] = set()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """`names`, lengthened where `df` already has a column so called (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole(text: Column) -> Column:
    """Null texts read as empty ones."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text in order, by `SPACE`."""
    return F.array_remove(F.split(whole(text), f"{SPACE}+"), "")


def fold(doc_id: Column, folds: int) -> Column:
    """The fixed fold of a document: CRC-32 of its id as text."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


#: Hash ranges that a sample's cut is looked for in.
RANGES = 4096


def class_sample(rows: DataFrame, key: str, klass: str, per_class: int) -> DataFrame:
    """(key, class) of at most `per_class` rows of each class, in the order of a hash of the key.

    Rows are counted by class and hash range first, so that the ranking sees little more than the
    rows it takes, however large a class or the number of tasks is. Only the two columns are read."""
    keyed = rows.select(col(key).alias("key"), col(klass).alias("class")).filter(
        "key IS NOT NULL AND class IS NOT NULL"
    )
    keyed = keyed.withColumn("h", F.xxhash64("key"))
    ranged = keyed.withColumn("range", F.floor(F.col("h") / (2.0**64 / RANGES)))
    counts = ranged.groupBy("class", "range").count()
    upto = Window.partitionBy("class").orderBy("range")
    before = F.sum("count").over(upto) - F.col("count")
    cuts = (
        counts.withColumn("before", before)
        .filter(F.col("before") < per_class)
        .groupBy(F.col("class").alias("c"))
        .agg(F.max("range").alias("last"))
    )
    # One row per class is broadcast; dealing the rows out by class would put a class into one task.
    below = (F.col("class") == F.col("c")) & (F.col("range") <= F.col("last"))
    few = ranged.join(F.broadcast(cuts), below)
    picked = top_k(few, ["class"], [F.col("h"), F.col("key")], per_class)
    return picked.select(F.col("key").alias(key), F.col("class").alias(klass))


def only_rows(
    docs: DataFrame,
    chosen: DataFrame,
    keys: Sequence[tuple[str, Column]],
    first: Sequence[Column] = (),
) -> DataFrame:
    """One row of `docs` for each row of `chosen`, which has the unique key columns named in
    `keys`; the expressions compute the same keys from a row of `docs`. Of rows with equal keys
    the first by `first`, then by a hash of its content, stays. Columns of `docs` come back unchanged."""
    names = fresh(docs, *[n for n, _ in keys])
    left = docs.withColumns({n: e for n, (_, e) in zip(names, keys)})
    others = fresh(left, *[f"{n}_r" for n in names])
    right = chosen.select(*[col(n).alias(o) for o, (n, _) in zip(others, keys)])
    on = F.lit(True)
    for n, o in zip(names, others):
        on = on & col(n).eqNullSafe(col(o))
    joined = left.join(right, on, "left_semi")
    (rank,) = fresh(joined, "_rank")
    plain = [col(f.name) for f in docs.schema.fields if f.dataType.typeName() != "map"]
    order = Window.partitionBy(*[col(n) for n in names]).orderBy(
        *first, F.xxhash64(*plain)
    )
    return (
        joined.withColumn(rank, F.row_number().over(order))
        .filter(col(rank) == 1)
        .select(*[col(c) for c in docs.columns])
    )
