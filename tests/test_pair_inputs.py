"""What the pair queries store on their way."""

from fundweave.sources import workspace
from fundweave.workload import pairs
from fundweave.workload.shape import shape

SMALL = "/root/testdata/sf0.001"


def test_the_wide_table_of_a_sample_is_stored_without_long_texts(spark, monkeypatch):
    stored, cut = {}, workspace.cut
    monkeypatch.setattr(workspace, "cut", lambda df, name="step", *rest: stored.setdefault(name, df.columns) and cut(df, name, *rest))
    sample = pairs.development_sample(spark, SMALL)
    assert sample.filter("label = 1").count() > 0
    assert not {"award_description", "abstract_text", "award_text", "work_text"} & set(stored["wide"])
    assert {"award_key", "work_key", "award_title", "work_title", "funder_name", "publication_year"} <= set(stored["wide"])


def test_feature_pairs_are_the_rows_of_the_pairs(spark):
    got = pairs.feature_pairs(spark, SMALL)
    want = shape(spark, SMALL, "pairs").select(*got.columns)
    assert got.count() > 0 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_pairs_travel_without_names_and_texts(spark):
    """Topic names are joined above the joins that shuffle the pairs, not carried through them."""
    tree = pairs.feature_pairs(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [line for line in tree if "Join " in line]
    assert ["LeftOuter" in j for j in joins[:3]] == [True, True, False]
    assert not [line for line in tree if "work_title" in line or "award_description" in line]


def test_lists_of_countries_meet_the_pairs_last(spark):
    """The widest column comes with the last join that shuffles the pairs, so no shuffle carries it on."""
    tree = pairs.feature_pairs(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(tree) if "Join Inner" in line)
    depth = tree[at].index("Join Inner")
    left = [line for line in tree[at + 1:]]
    left = left[: next(i for i, line in enumerate(left) if line[depth:].startswith("+- "))]
    assert any("label" in line for line in left)
    assert not [line for line in left if "author_country_codes" in line]


def test_pair_numbers_of_odd_lines(spark, tmp_path):
    """Repeated lines, lines without a key, and lines whose negative is another line's link."""
    lines = [(1, 5), (1, 5), (2, 5), (None, 5), (7, None), (None, None), (-3, 4), (6, 0), (7, 0), (8, 10**18)]
    day = "CAST('1998-01-01 00:00:00' AS TIMESTAMP_NTZ) AS l_shipdate"
    table = spark.createDataFrame(lines, "l_orderkey long, l_partkey long").selectExpr("*", day)
    table.write.parquet(f"{tmp_path}/lineitem.parquet")
    whole = "_work IS NOT NULL AND _award IS NOT NULL"  # others find neither publication nor award
    got = pairs.pair_numbers(spark, str(tmp_path)).filter(whole).selectExpr("'W' || _work AS work_key", "'G' || _award AS award_key", "label")
    want = shape(spark, str(tmp_path), "pair_keys").filter("work_key IS NOT NULL AND award_key IS NOT NULL")
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() > 5


def test_queries_read_the_stored_pairs(spark, monkeypatch):
    """What is read from the stored pairs is not stored once more; of a vocabulary Spark knows the size."""
    stored, cut = [], workspace.cut
    monkeypatch.setattr(workspace, "cut", lambda df, name="step", *rest: stored.append(name) or cut(df, name, *rest))
    pairs.impute_median(spark, SMALL)
    assert "features" not in stored
    stored.clear()
    encoded = pairs.one_hot_rare(spark, SMALL)
    assert [name for name in stored if name != "once"] == ["slots"]
    assert "BroadcastHashJoin" in encoded._jdf.queryExecution().executedPlan().toString()
