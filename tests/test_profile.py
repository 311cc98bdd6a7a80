"""The profile reads each raw table once; inputs are stored once in a session."""

from pyspark.sql import functions as F

from fundweave.plans import profile
from fundweave.sources import workspace
from fundweave.workload import records

SMALL = "/root/testdata/sf0.001"


def test_each_raw_table_is_read_once(spark, monkeypatch):
    raws = [read(spark, SMALL) for read in (records.raw_awards, records.raw_works, records.raw_funders, records.raw_topics)]
    read, plain = [], workspace.cut
    monkeypatch.setattr(profile.workspace, "cut", lambda df, name: read.append(df) or plain(df, name))
    out = profile.quality_profile(*raws, F.lit(records.AS_OF).cast("date"))
    assert [sorted(df.inputFiles()) for df in read] == [sorted(df.inputFiles()) for df in raws]
    assert all(df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1 for df in read)
    assert all("/grains-" in f for f in out.inputFiles())
    assert out.count() == len(profile.LABELS)


def test_inputs_are_stored_once_and_again_when_they_are_gone(spark):
    built = []
    read = lambda: workspace.once(spark, "numbers", lambda: built.append(1) or spark.range(5).toDF("n"))
    first = read()
    assert first.count() == read().count() == 5 and len(built) == 1
    folder = first.inputFiles()[0].rsplit("/", 1)[0]
    workspace.discard(spark, [folder])
    assert read().count() == 5 and len(built) == 2
