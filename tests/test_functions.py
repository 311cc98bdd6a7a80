import datetime as dt
from decimal import Decimal

from conftest import column
from pyspark.sql import functions as F

from fundweave.functions import rules as R
from fundweave.functions import text as T
from fundweave.functions import variant as V


def test_short_id(spark):
    got = column(spark, T.short_id, ["https://x.example/G1", " G2 ", "https://x.example/", "", None])
    assert got == ["G1", "G2", None, None, None]


def test_clean_text(spark):
    got = column(spark, T.clean_text, ["<p>a</p><br/> b\n\tc", "p < 0.05 and q > 3", "  ", "<br/>", None])
    assert got == ["a b c", "p 3", None, None, None]


def test_codes(spark):
    assert column(spark, T.upper_code, [" usd ", " "]) == ["USD", None]
    assert column(spark, T.lower_code, [" GRANT", None]) == ["grant", None]


def test_join_text(spark):
    rows = [("Can AI predict floods?", "Climate models"), ("Policy in the U.S.", "Abstract one"), ("Title", "Body"),
            ("Only title", None), (" ", "Only body"), (None, " "), ("Wait…", "what")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, b string")
    got = [r[0] for r in df.orderBy("i").select(T.join_text(F.col("t"), F.col("b"))).collect()]
    assert got == ["Can AI predict floods? Climate models", "Policy in the U.S. Abstract one", "Title. Body",
                   "Only title", "Only body", None, "Wait… what"]


def test_casts(spark):
    values = ["1.5", "2.5", "-1.5", "abc", " 12 ", "1e3", None]
    assert column(spark, R.safe_int, values) == [2, 3, -2, None, 12, 1000, None]
    assert column(spark, R.safe_money, ["12.345", "x", "-5"]) == [Decimal("12.35"), None, Decimal("-5.00")]
    assert column(spark, R.safe_bool, ["true", "FALSE", "maybe", None]) == [True, False, None, None]


def test_dates(spark):
    got = column(spark, R.safe_date, ["2024-01-31", "2024", "2024-13-45", "2024-01-31T10:00:00", None])
    assert got == [dt.date(2024, 1, 31), None, None, dt.date(2024, 1, 31), None]
    got = column(spark, R.start_from_year, [1899, 1900, 2100, 2101, None], "int")
    assert got == [None, dt.date(1900, 1, 1), dt.date(2100, 1, 1), None, None]
    days = [dt.date(1949, 12, 31), dt.date(1950, 1, 1), dt.date(2035, 12, 31), None]
    assert column(spark, R.date_key, days, "date") == [-1, 19500101, 20351231, -1]
    got = column(spark, R.us_fiscal_year, [dt.date(2024, 9, 30), dt.date(2024, 10, 1), dt.date(2024, 12, 31)], "date")
    assert got == [2024, 2025, 2025]


def test_year_gate(spark):
    as_of = F.lit("2024-06-30").cast("date")
    got = column(spark, lambda c: R.year_in_range(c, as_of), [0, 1500, 2025, 2026, None], "int")
    assert got == [False, True, True, False, None]


def test_json_list_contains(spark):
    df = spark.createDataFrame([(0, '["CN", "US"]', "US"), (1, '["CN"]', "US"), (2, None, "US"), (3, '["CUS"]', "US"),
                                (4, '["US"]', ""), (5, '["US"]', None)], "i int, l string, c string")
    got = [r[0] for r in df.orderBy("i").select(V.json_list_contains(F.col("l"), F.col("c"))).collect()]
    assert got == [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]


def test_inverted_index(spark):
    values = ['{"b": [1, 3], "a": [0, 2]}', '"{\\"x\\": [1], \\"y\\": [0]}"', '"{\\"broken\\": ["', "null", "{}",
              '{"a": [0], "odd": 7, "worse": ["z"]}', None]
    got = column(spark, lambda c: V.inverted_index_text(F.try_parse_json(c)), values)
    assert got == ["a b a b", "y x", None, None, None, "a", None]


def test_paths_and_sizes(spark):
    values = ['{"a": {"b": 1}, "x": [{"id": "p"}, {"id": "q"}]}', '{"a": null, "x": "scalar"}']
    node = F.try_parse_json
    assert column(spark, lambda c: V.text_at(node(c), "a.b"), values) == ["1", None]
    assert column(spark, lambda c: V.text_at(node(c), "x[0].id"), values) == ["p", None]
    assert column(spark, lambda c: V.array_length(V.node_at(node(c), "x")), values) == [2, None]


def test_explode_drops_parents_without_elements(spark):
    df = spark.createDataFrame([(1, "[10, 20]"), (2, "[]"), (3, None), (4, "5")], "id int, j string")
    rows = V.explode_elements(df.select("id", F.try_parse_json("j").alias("n")), "n", "id").select("id", "position").collect()
    assert sorted(map(tuple, rows)) == [(1, 0), (1, 1)]
