"""Balanced folds, the shuffled sample, reads of splits and of single loads."""

from collections import Counter
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fundweave.operators import ranking, sampling
from fundweave.sources import workspace
from fundweave.sources.tables import csv_records, load_split, read_wide_csv, write_wide_csv
from fundweave.streaming import raw_load


def dealt(sizes, n_folds):
    """One group after the other, largest first, to the lightest fold."""
    loads, out = [0] * n_folds, []
    for size in sizes:
        fold = loads.index(min(loads))
        out.append(fold)
        loads[fold] += size
    return out, loads


@settings(max_examples=300, deadline=None, derandomize=True)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=6), st.integers(1, 9), st.integers(0, 30))
def test_counting_equals_dealing(loads, size, n):
    now, got = list(loads), [0] * len(loads)
    for _ in range(n):
        fold = now.index(min(now))
        got[fold] += 1
        now[fold] += size
    counts, following = ranking._taken(loads, size, n)
    assert counts == got and following[0] == now.index(min(now))


@pytest.mark.parametrize("n_folds", [2, 5])
def test_balanced_folds_equal_the_plain_rule(spark, n_folds):
    sizes = {f"g{i:03d}": 1 + i * i % 7 + (90 if i in (3, 50) else 0) for i in range(120)} | {None: 4}
    rows = spark.createDataFrame([(g,) for g, n in sizes.items() for _ in range(n)], "g string")
    got = {r.g: (r.size, r.fold) for r in ranking.balanced_folds(rows, "g", n_folds).collect()}
    order = sorted(sizes, key=lambda g: (-sizes[g], g is not None, g or ""))
    folds, loads = dealt([sizes[g] for g in order], n_folds)
    assert got == {g: (sizes[g], f) for g, f in zip(order, folds)}
    assert max(loads) - min(loads) <= max(sizes.values())
    assert ranking.balanced_folds(rows.limit(0), "g").count() == 0


def test_shuffled_rows_have_one_place_each(spark):
    rows = spark.range(500).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"))
    first, again = (sampling.shuffled(df, "a", "b").collect() for df in (rows, rows.repartition(9)))
    assert sorted(r.position for r in first) == list(range(1, 501))
    places = {r.a: r.position for r in first}
    assert places == {r.a: r.position for r in again}
    assert sum(places[i] == i + 1 for i in range(500)) < 25


def test_the_sample_stands_in_where_it_is_asked_for(spark):
    path = workspace.new_folder(spark, "splits")
    sample = spark.range(3)
    assert load_split(spark, path, sample=sample).count() == 3
    with pytest.raises(FileNotFoundError):
        load_split(spark, path, sample=sample, use_sample=False)
    spark.createDataFrame([(1, "train"), (2, "test")], "k int, split string").write.partitionBy("split").parquet(path)
    assert [r.k for r in load_split(spark, path, sample=sample).collect()] == [1]
    assert load_split(spark, path, sample=sample, use_sample=True).count() == 3
    with pytest.raises(FileNotFoundError):
        load_split(spark, path, "test", sample, use_sample=True)


def test_later_loads_are_read_without_opening_earlier_ones(spark):
    root = workspace.new_folder(spark, "loads")
    schema = "id string"
    begin = datetime(2024, 5, 1, 12)
    for i in range(3):
        spark.createDataFrame([(f"r{i}{j}",) for j in range(4)], schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        raw_load.load_new_files(
            spark, f"{root}/in", f"{root}/raw", f"{root}/progress", spark.createDataFrame([], schema).schema,
            loaded_at=begin + timedelta(hours=i),
        )
    ids = lambda df: Counter(r[0][:2] for r in df.selectExpr("variant_get(raw, '$.id', 'string')").collect())
    read = lambda after=None: raw_load.read_raw(spark, f"{root}/raw", after)
    assert read().columns == [f.name for f in raw_load.RAW_SCHEMA]
    assert ids(read()) == {"r0": 4, "r1": 4, "r2": 4}
    assert ids(read(begin)) == {"r1": 4, "r2": 4} and ids(read(begin + timedelta(hours=2))) == {}
    marks = {r[0] for r in read().select("_loaded_at").distinct().collect()}
    assert marks == {begin + timedelta(hours=i) for i in range(3)}
    assert ids(read(max(marks) - timedelta(hours=1))) == {"r2": 4}
    later = read(begin + timedelta(hours=1)).select(F.count("*"))
    later.collect()
    plan = later._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_load" in plan


def test_one_quoted_file_is_read_by_many_tasks(spark):
    texts = [None, "plain", 'a "quoted" word', "two\nlines", 'ends with "\n"', "\n\n", "com,ma", "win\r\ndows", "é中\n\U0001f600"]
    rows = [(i, texts[i % len(texts)], float(i) / 3 if i % 4 else None, texts[(i * 7 + 3) % len(texts)]) for i in range(3000)]
    schema = "id long, a string, x double, b string"
    df = spark.createDataFrame(rows, schema)
    path = workspace.new_folder(spark, "csv")
    df.coalesce(1).write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        blocks = spark.read.text(path).select(F.col("_metadata.file_block_start")).distinct().count()
        got = read_wide_csv(spark, path, schema).collect()
        records = csv_records(spark, path).filter("record > 1").count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert blocks > 10 and records == 3000
    whole = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    assert sorted(map(tuple, got), key=lambda r: r[0]) == sorted(map(tuple, whole.collect()), key=lambda r: r[0])


def test_exported_csv_is_small_and_read_without_a_copy(spark, monkeypatch):
    texts = [None, "plain", 'a "quoted" word', "two\nlines", 'ends with "\n"', "\n\n", "win\r\ndows", " blanks ", "x" * 9000, "é中\n\U0001f600"]
    rows = [(i, texts[i // 300], float(i) / 3 if i % 4 else None, texts[(i * 7 + 3) % len(texts)]) for i in range(3000)]
    schema = "id long, a string, x double, b string"
    path = workspace.new_folder(spark, "csv-export")
    write_wide_csv(spark.createDataFrame(rows, schema).repartition(3, "a"), path)
    files = workspace.files(spark, path)
    assert all(name.endswith(".csv.gz") for name, _ in files)
    assert sum(n for _, n in files) < sum(len(r[1] or "") + len(r[3] or "") for r in rows) / 20
    monkeypatch.setattr(workspace, "cut", None)  # nothing is staged
    back = read_wide_csv(spark, path, schema)
    assert "Exchange" not in back._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, back.collect())) == rows
