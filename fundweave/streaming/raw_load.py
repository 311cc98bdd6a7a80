"""Raw layer: whole records in one VARIANT column, loaded file by file exactly once, one partition for
each load. All rows of a load share its time, which names the partition, so "newer than" is a choice of
partitions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import union_all

RAW_SCHEMA = T.StructType(
    [
        T.StructField("raw", T.VariantType(), False),
        T.StructField("_source_file", T.StringType(), False),
        T.StructField("_source_row_number", T.LongType(), True),
        T.StructField("_loaded_at", T.TimestampType(), False),
    ]
)
#: Partition of a raw table: the time of the load, in a form that sorts like it.
LOAD = "_load"
LOAD_FORMAT = "%Y%m%dT%H%M%S.%f"
PARTITION_DATE = r"updated_date=(\d{4}-\d{2}-\d{2})"


def as_raw(records: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """File rows in the raw-table layout, with the file and row they came from."""
    return records.select(
        F.to_variant_object(F.struct(*records.columns)).alias("raw"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.row_index").alias("_source_row_number"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("_loaded_at"),
    )


# Fixed value: how the source names its files, first part 0.
PART_NAME = "part_{:04d}.parquet"


def planned_files(source: str, days: Sequence[str] | None, files_per_day: int | None) -> tuple[str, str]:
    """Folder glob and file-name glob of the planned files: what is not planned is never listed."""
    folder = source if days is None else f"{source}/updated_date={{{','.join(days)}}}"
    names = "*.parquet" if files_per_day is None else f"{{{','.join(map(PART_NAME.format, range(files_per_day)))}}}"
    return folder, names


def load_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType,
    days: Sequence[str] | None = None,
    files_per_day: int | None = None,
    loaded_at: datetime | None = None,
) -> None:
    """Loads the files under `source` that no earlier run has loaded, then stops. Their rows get the time
    `loaded_at` (now), which should be later than that of any earlier load.

    With `days` only the files of those update partitions, with `files_per_day` only the first parts
    of each. The checkpoint remembers the files, so a second run adds nothing, whatever either run
    planned. A batch becomes visible only through the sink's commit log: an unreadable file fails the
    batch and leaves no rows behind. No day planned means nothing to do.
    """
    if days is not None and not days:
        return
    folder, names = planned_files(source, days, files_per_day)
    files = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", names)
        .option("recursiveFileLookup", True)
        .option("ignoreCorruptFiles", False)
        # a backfill brings files older than the newest one loaded: none is too old
        .option("maxFileAge", "36500d")
        .parquet(folder)
    )
    at = (loaded_at or datetime.now(timezone.utc)).astimezone(timezone.utc)
    query = (
        as_raw(files, F.lit(at))
        .withColumn(LOAD, F.lit(load_name(at)))
        .writeStream.format("parquet")
        .partitionBy(LOAD)
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_raw(spark: SparkSession, target: str, after: datetime | None = None) -> DataFrame:
    """The raw table, or its loads later than `after`: others are neither listed nor opened."""
    rows = spark.read.schema(T.StructType([*RAW_SCHEMA.fields, T.StructField(LOAD, T.StringType())])).parquet(target)
    if after is not None:
        rows = rows.filter(F.col(LOAD) > F.lit(load_name(after)))
    return rows.drop(LOAD)


def load_name(at: datetime) -> str:
    """Partition of a load's time; a time without a zone, as Spark hands it out, is local."""
    return at.astimezone(timezone.utc).strftime(LOAD_FORMAT)


def pick_files(files: DataFrame, path: str, days: list[str], files_per_day: int) -> DataFrame:
    """Rows from the first files of the wanted update partitions, chosen by file path."""
    wanted = rf"updated_date=({'|'.join(days)})/part_0*(\d+)\.parquet$"
    part = F.regexp_extract(path, wanted, 2)
    return files.filter((part != "") & (part.try_cast("int") < files_per_day))


def partition_date(path: Column) -> Column:
    return F.regexp_extract(path, PARTITION_DATE, 1).try_cast("date")


def plan_partitions(
    loaded: DataFrame,
    snapshot: date | str,
    initial_days: int,
    max_days: int,
    backfill: tuple[str, str] | None = None,
) -> DataFrame:
    """One row: which update partitions to load next.

    From the day after the last loaded one (or the last `initial_days` up to the snapshot when
    nothing is loaded, or the backfill range) to the snapshot, at most `max_days` of them.
    """
    mark = loaded.agg(F.max(partition_date(F.col("_source_file"))).alias("last"))
    snap = F.lit(str(snapshot)).cast("date")
    if backfill:
        first, last = (F.lit(d).cast("date") for d in backfill)
    else:
        first = F.coalesce(F.date_add("last", 1), F.date_add(snap, 1 - initial_days))
        last = snap
    days = F.when(
        F.col("_to") >= F.col("_from"),
        F.sequence(F.col("_from"), F.least(F.col("_to"), F.date_add("_from", max_days - 1))),
    ).otherwise(F.array().cast("array<date>"))
    bounds = mark.select("last", first.alias("_from"), last.alias("_to"))
    return bounds.withColumn("_days", days).select(
        F.col("last").cast("string").alias("last_loaded"),
        snap.cast("string").alias("snapshot_date"),
        F.size("_days").alias("n_days"),
        F.array_join(F.transform("_days", lambda d: d.cast("string")), "|").alias("dates"),
        F.coalesce(F.array_max("_days") < F.col("_to"), F.lit(False)).alias("truncated"),
    )


def load_summary(tables: dict[str, DataFrame], run_start: Column) -> DataFrame:
    """New rows since the run started and all rows, one row per raw table."""
    return union_all(
        [
            df.agg(
                F.count_if(F.col("_loaded_at") >= run_start).alias("new_rows"),
                F.count(F.lit(1)).alias("total_rows"),
            ).select(F.lit(name).alias("table_name"), "new_rows", "total_rows")
            for name, df in tables.items()
        ]
    )


def freshness(tables: dict[str, DataFrame], as_of: Column, warn_after_days: int = 35) -> DataFrame:
    return union_all(
        [
            df.agg(F.max("_loaded_at").alias("last_load")).select(
                F.lit(name).alias("table_name"),
                "last_load",
                (F.col("last_load") + F.make_interval(days=F.lit(warn_after_days)) < as_of).alias("stale"),
            )
            for name, df in tables.items()
        ]
    )
