"""Labelled publication-award pairs: building, splitting, describing and checking them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import sampling as S
from ..operators.ordering import first_per_key, quantiles
from ..sources import workspace
from ..sources.tables import columns_between

# The temporal cut and the contract's columns.
TRAIN_YEARS = (2017, 2024)
TEST_YEAR = 2025
KEYS = ["work_key", "award_key"]
TEXT_COLUMNS = ["award_title", "award_description", "work_title", "work_abstract"]
#: Texts of the wide table that a development sample does without.
LONG_TEXTS = ["award_description", "abstract_text", "award_text", "work_text"]
#: Pairs that a task of the contract compares with each other.
BLOCK_ROWS = 500_000
AWARD_SPAN = ("funder_award_id", "has_inconsistent_dates")
WORK_SPAN = ("work_doi", "author_country_codes")


def split_sides(wide: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The wide table's award columns and its publication columns, one row per award and per work.

    The other side's key decides which row stands for an entity, so the choice is repeatable.
    """
    awards = wide.select("award_key", "work_key", *columns_between(wide.columns, *AWARD_SPAN))
    works = wide.select("work_key", "award_key", *columns_between(wide.columns, *WORK_SPAN))
    return (
        first_per_key(awards, ["award_key"], [F.col("work_key")]).drop("work_key"),
        first_per_key(works, ["work_key"], [F.col("award_key")]).drop("award_key"),
    )


def labelled(positives: DataFrame, negatives: DataFrame) -> DataFrame:
    return positives.select(*KEYS, F.lit(1).alias("label")).unionByName(
        negatives.select(*KEYS, F.lit(0).alias("label"))
    )


def enriched(pairs: DataFrame, works: DataFrame, awards: DataFrame) -> DataFrame:
    return pairs.join(works, "work_key").join(awards, "award_key")


def development_sample(
    wide: DataFrame,
    n_works: int = 400,
    years: tuple[int, int] = TRAIN_YEARS,
    hash_of: S.Hash = S.seeded_hash,
    order_of: Callable[..., Column] | None = None,
) -> DataFrame:
    """Pairs of a fixed-size sample of publications, what they received plus simple negatives, without
    the long texts, and each row's `position` in a seeded random order."""
    awards, works = split_sides(wide)
    in_range = works.filter(F.col("publication_year").between(*years))
    chosen = S.sample_entities(in_range.select("work_key"), "work_key", n_works, hash_of)
    # read several times below: stored once
    positives = workspace.cut(wide.select(*KEYS).join(chosen, "work_key", "left_semi"), "positives")
    pairs = labelled(positives, S.random_negatives(positives, awards, hash_of))
    placed = S.shuffled(pairs, *KEYS, hash_of=order_of)
    blank = F.lit(None).cast("string")
    return enriched(placed, works, awards).withColumns(
        {"work_abstract": blank, "award_description": blank}
    )


def split_of(year: Column, train: tuple[int, int] = TRAIN_YEARS, test: int = TEST_YEAR) -> Column:
    """train, test, or NULL for publications of any other year."""
    return F.when(year.between(*train), "train").when(year == test, "test")


def temporal_split(
    pairs: DataFrame, train: tuple[int, int] = TRAIN_YEARS, test: int = TEST_YEAR
) -> DataFrame:
    return pairs.withColumn("split", split_of(F.col("publication_year"), train, test)).filter(
        F.col("split").isNotNull()
    )


def write_splits(split_pairs: DataFrame, path: str) -> None:
    """One folder per split. Files are balanced by size, so the larger split gets more of them."""
    split_pairs.hint("rebalance", "split").write.partitionBy("split").parquet(path)


def attach_text(pairs: DataFrame, work_texts: DataFrame, award_texts: DataFrame) -> DataFrame:
    """Abstract and description by key. Texts are looked up last, on the keys alone, and a key
    without text keeps its pair."""
    return pairs.join(award_texts, "award_key", "left").join(work_texts, "work_key", "left")


def content_hash(df: DataFrame) -> Column:
    """Aggregate that depends on the set of rows, not on their order or files."""
    return F.bit_xor(F.xxhash64(*sorted(df.columns))).alias("content_hash")


def manifest(pairs: DataFrame, source: str, cut_off: Column, row_hash: Column | None = None) -> DataFrame:
    """What a model run needs to say about its data, in one pass."""
    hashed = content_hash(pairs) if row_hash is None else row_hash.alias("content_hash")
    return pairs.agg(
        F.max(cut_off).alias("fecha_corte"),
        hashed,
        F.count(F.lit(1)).alias("filas"),
        F.sum(F.col("label").cast("long")).alias("positivos"),
        F.countDistinct("work_key").alias("publicaciones"),
    ).select(F.lit(source).alias("tabla_origen"), "fecha_corte", "content_hash", "filas",
             "positivos", "publicaciones")


def label_balance(pairs: DataFrame, group: str = "work_key") -> DataFrame:
    return pairs.groupBy(group).agg(
        F.sum(F.col("label").cast("long")).alias("positives"), F.count(F.lit(1)).alias("pairs")
    )


def contract(pairs: DataFrame, years: tuple[int, int] = TRAIN_YEARS) -> DataFrame:
    """One row of booleans, one per clause of the pair contract.

    The four columns it looks at are stored narrow, so that their number is known, and dealt out by
    publication to as many tasks as they need: a task holds about BLOCK_ROWS pairs at any size."""
    needed = [*KEYS, "label", "publication_year", *TEXT_COLUMNS]
    narrow = workspace.cut(pairs.select(*KEYS, "label", "publication_year"), "contract")
    dealt = narrow.repartition(1 + narrow.count() // BLOCK_ROWS, "work_key")
    per_pair = dealt.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("copies"),
        F.sum("label").alias("label_sum"),
        F.min(F.coalesce(F.col("label").isin(0, 1), F.lit(False))).alias("binary"),
        F.min(F.col("publication_year").between(*years)).alias("in_years"),
    )
    per_group = per_pair.groupBy("work_key").agg(
        F.max("copies").alias("copies"),
        F.min("binary").alias("binary"),
        F.min(F.coalesce("in_years", F.lit(False))).alias("in_years"),
        F.sum("label_sum").alias("positives"),
        F.sum("copies").alias("rows"),
    )
    both = (F.col("positives") >= 1) & (F.col("rows") > F.col("positives"))
    return per_group.agg(
        F.min("binary").alias("labels_binary"),
        (F.max("copies") == 1).alias("keys_unique"),
        F.min("in_years").alias("years_in_range"),
        F.min(both).alias("groups_have_both"),
    ).select(F.lit(set(needed) <= set(pairs.columns)).alias("columns_present"), "labels_binary",
             "keys_unique", "years_in_range", "groups_have_both")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max of every column, one row per column."""
    row = df.agg(
        *[e.alias(f"{c}_{n}") for c in columns for n, e in (
            ("mean", F.avg(c)), ("std", F.stddev_samp(c)), ("min", F.min(c)), ("max", F.max(c)))]
    )
    cells = [
        F.struct(F.lit(c).alias("name"),
                 *[F.col(f"{c}_{n}").cast("double").alias(n) for n in ("mean", "std", "min", "max")])
        for c in columns
    ]
    long = row.select(F.inline(F.array(*cells)))
    return quantiles(df, columns, [0.25, 0.5, 0.75]).join(long, "name")
