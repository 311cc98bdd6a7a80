"""Scalar queries over pages, orders and the catalog tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import text as T
from ..operators.ordering import first_per_key
from .registry import query
from .shape import oracle, select, shape


@query("short_id", "SELECT page_id, nullif(split_part(trim(url), '/', -1), '') AS short_id FROM pages")
def short_id(spark, sf):
    return shape(spark, sf, "pages").select("page_id", T.short_id(F.col("url")).alias("short_id"))


CLEAN_SQL = (
    "nullif(trim(regexp_replace(regexp_replace({0}, '<[^>]+>', ' ', 'g'), '[[:space:]]+', ' ', 'g')), '')"
)


@query("clean_text", f"SELECT page_id, {CLEAN_SQL.format('html')} AS clean FROM pages")
def clean_text(spark, sf):
    return shape(spark, sf, "pages").select("page_id", T.clean_text(F.col("html")).alias("clean"))


@query(
    "has_markup",
    "SELECT regexp_matches(html, '(?s)<[^>]+>') AS has_markup, count(*) AS pages FROM pages GROUP BY 1"
    " UNION ALL SELECT regexp_matches(text, '(?s)<[^>]+>'), count(*) FROM documents GROUP BY 1",
)
def has_markup(spark, sf):
    count = lambda df, c: df.groupBy(T.has_markup(F.col(c)).alias("has_markup")).agg(
        F.count(F.lit(1)).alias("pages")
    )
    return count(shape(spark, sf, "pages"), "html").unionAll(count(shape(spark, sf, "documents"), "text"))


@query(
    "norm_code",
    "SELECT page_id, nullif(lower(trim(split_part(url, '?', 2))), '') AS query_code,"
    " nullif(upper(trim(split_part(url, '#', 2))), '') AS anchor_code FROM pages",
)
def norm_code(spark, sf):
    part = lambda sep: F.split_part("url", F.lit(sep), F.lit(2))
    return shape(spark, sf, "pages").select(
        "page_id",
        T.lower_code(part("?")).alias("query_code"),
        T.upper_code(part("#")).alias("anchor_code"),
    )


@query(
    "drop_keyless",
    "SELECT page_id, nullif(split_part(trim(url), '/', -1), '') AS page_key FROM pages"
    " WHERE nullif(split_part(trim(url), '/', -1), '') IS NOT NULL",
)
def drop_keyless(spark, sf):
    keyed = shape(spark, sf, "pages").select("page_id", T.short_id(F.col("url")).alias("page_key"))
    return keyed.filter(F.col("page_key").isNotNull())


MESSY = """
SELECT o_orderkey,
       CASE o_orderkey % 6 WHEN 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) WHEN 1 THEN ' 12.345 '
            WHEN 2 THEN 'abc' WHEN 3 THEN CAST(o_custkey AS STRING) || '.5' WHEN 4 THEN '1e3' END AS number_text,
       CASE o_orderkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'FALSE' WHEN 2 THEN 'maybe' END AS flag_text,
       CASE o_orderkey % 5 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
            WHEN 1 THEN '2024' WHEN 2 THEN '2024-13-45' WHEN 3 THEN 'soon' END AS day_text,
       CASE o_orderkey % 3 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 10:30:00'
            WHEN 1 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T23:59:59' ELSE '20240131' END AS time_text
FROM {orders}
"""


@query(
    "safe_cast",
    oracle(f"""
SELECT o_orderkey, CAST(try_cast(number_text AS DECIMAL(18,2)) AS DOUBLE) AS money,
       CAST(round(try_cast(number_text AS DECIMAL(38,6)), 0) AS INTEGER) AS whole,
       try_cast(number_text AS DOUBLE) AS real, try_cast(flag_text AS BOOLEAN) AS flag
FROM ({MESSY}) t"""),
)
def safe_cast(spark, sf):
    number = F.col("number_text")
    return select(spark, sf, MESSY).select(
        "o_orderkey",
        R.safe_money(number).alias("money"),
        R.safe_int(number).alias("whole"),
        R.safe_double(number).alias("real"),
        R.safe_bool(F.col("flag_text")).alias("flag"),
    )


@query(
    "safe_dates",
    oracle(f"""
SELECT o_orderkey,
       CAST(CASE WHEN day_text SIMILAR TO '....-..-..' THEN try_cast(day_text AS DATE) END AS VARCHAR) AS day,
       strftime(CASE WHEN time_text SIMILAR TO '....-..-...*' THEN try_cast(time_text AS TIMESTAMP) END,
                '%Y-%m-%d %H:%M:%S') AS moment
FROM ({MESSY}) t"""),
)
def safe_dates(spark, sf):
    return select(spark, sf, MESSY).select(
        "o_orderkey",
        R.safe_date(F.col("day_text")).alias("day"),
        R.safe_timestamp(F.col("time_text")).alias("moment"),
    )


NET = "SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) - CAST(250000 AS DECIMAL(18,2)) AS net FROM {orders}"


@query(
    "amount_rules",
    oracle(f"""
SELECT o_orderkey, CAST(CASE WHEN net > 0 THEN net END AS DOUBLE) AS amount,
       coalesce(net <= 0, FALSE) AS is_amount_invalid,
       CAST(CASE WHEN o_orderstatus = 'F' AND net > 0 THEN net END AS DOUBLE) AS amount_usd,
       net > 0 AS has_amount FROM ({NET}) t"""),
)
def amount_rules(spark, sf):
    rows = select(spark, sf, NET)
    net = F.col("net")
    amount = R.positive_or_null(net)
    return rows.select(
        "o_orderkey",
        amount.alias("amount"),
        R.is_non_positive(net).alias("is_amount_invalid"),
        F.when(F.col("o_orderstatus") == "F", amount).alias("amount_usd"),
        amount.isNotNull().alias("has_amount"),
    )


@query(
    "nonneg_count",
    "SELECT c_custkey AS row_key, CAST(CASE WHEN floor(c_acctbal) >= 0 THEN floor(c_acctbal) END AS INTEGER)"
    " AS n FROM customer UNION ALL SELECT s_suppkey,"
    " CAST(CASE WHEN floor(s_acctbal) >= 0 THEN floor(s_acctbal) END AS INTEGER) FROM supplier",
)
def nonneg_count(spark, sf):
    count = lambda t, k, c: shape(spark, sf, t).select(
        F.col(k).alias("row_key"), R.non_negative_or_null(F.floor(c).cast("int")).alias("n")
    )
    return count("customer", "c_custkey", "c_acctbal").unionAll(count("supplier", "s_suppkey", "s_acctbal"))


YEARS = """
SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 0 WHEN 1 THEN 9999 WHEN 2 THEN NULL WHEN 3 THEN 1500
       WHEN 4 THEN 2001 ELSE CAST(year(o_orderdate) AS INT) END AS y FROM {orders}
"""


@query(
    "year_gate",
    oracle(f"""
SELECT o_orderkey, CASE WHEN y BETWEEN 1500 AND 2001 THEN y END AS publication_year,
       coalesce(NOT (y BETWEEN 1500 AND 2001), FALSE) AS is_publication_year_invalid FROM ({YEARS}) t"""),
)
def year_gate(spark, sf):
    plausible = R.year_in_range(F.col("y"), F.lit("2000-06-30").cast("date"))
    return select(spark, sf, YEARS).select(
        "o_orderkey",
        F.when(plausible, F.col("y")).alias("publication_year"),
        F.coalesce(~plausible, F.lit(False)).alias("is_publication_year_invalid"),
    )


DAYS = """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END AS start_raw,
       CASE o_orderkey % 5 WHEN 0 THEN 1899 WHEN 1 THEN 1900 WHEN 2 THEN 2100 WHEN 3 THEN 2101
            ELSE NULL END AS start_year,
       CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 - 45 AS INT)
       END AS end_raw
FROM {orders}
"""


@query(
    "date_repair",
    oracle(f"""
SELECT o_orderkey, CAST(start_date AS VARCHAR) AS start_date, from_year AS is_start_date_from_year,
       CAST(CASE WHEN end_raw < start_date THEN NULL ELSE end_raw END AS VARCHAR) AS end_date,
       coalesce(end_raw < start_date, FALSE) AS has_inconsistent_dates
FROM (SELECT *, coalesce(start_raw, CASE WHEN start_year BETWEEN 1900 AND 2100
                                         THEN make_date(start_year, 1, 1) END) AS start_date,
             coalesce(start_raw IS NULL AND start_year BETWEEN 1900 AND 2100, FALSE) AS from_year
      FROM ({DAYS}) d) t"""),
)
def date_repair(spark, sf):
    rebuilt = R.start_from_year(F.col("start_year"))
    rows = select(spark, sf, DAYS).withColumns(
        {
            "start_date": F.coalesce("start_raw", rebuilt),
            "is_start_date_from_year": F.col("start_raw").isNull() & rebuilt.isNotNull(),
        }
    )
    early = R.ends_before(F.col("end_raw"), F.col("start_date"))
    return rows.select(
        "o_orderkey", "start_date", "is_start_date_from_year",
        F.when(~early, F.col("end_raw")).alias("end_date"),
        early.alias("has_inconsistent_dates"),
    )


FAR_DAYS = """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN DATE '1949-12-31'
       WHEN 2 THEN DATE '2036-01-01' WHEN 3 THEN DATE '2035-12-31' ELSE CAST(o_orderdate AS DATE) END AS d
FROM {orders}
"""


@query(
    "date_key",
    oracle(f"""
SELECT o_orderkey, CASE WHEN d BETWEEN DATE '1950-01-01' AND DATE '2035-12-31'
       THEN CAST(strftime(d, '%Y%m%d') AS INTEGER) ELSE -1 END AS date_key FROM ({FAR_DAYS}) t"""),
)
def date_key(spark, sf):
    return select(spark, sf, FAR_DAYS).select("o_orderkey", R.date_key(F.col("d")).alias("date_key"))


PREFERRED = """
SELECT o_custkey AS author_key, o_orderdate AS _loaded_at, o_orderpriority AS author_name,
       CASE WHEN o_orderkey % 3 = 0 THEN 'O' || CAST(o_orderkey AS STRING) END AS orcid
FROM {orders}
"""


@query(
    "preferred_row",
    oracle(f"""
SELECT author_key, author_name, orcid FROM ({PREFERRED}) t
QUALIFY row_number() OVER (PARTITION BY author_key
  ORDER BY _loaded_at DESC, (orcid IS NULL), author_name, orcid) = 1"""),
)
def preferred_row(spark, sf):
    order = [F.desc("_loaded_at"), F.col("orcid").isNull(), F.asc("author_name"), F.asc("orcid")]
    rows = select(spark, sf, PREFERRED)
    return first_per_key(rows, ["author_key"], order).drop("_loaded_at")


@query(
    "title_fallback",
    "SELECT doc_id, coalesce(" + CLEAN_SQL.format("t1") + ", " + CLEAN_SQL.format("t2") + ") AS title FROM ("
    " SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '<b> </b>' WHEN doc_id % 3 = 1 THEN '<i>' || source || '</i> ' || lang END AS t1,"
    " 'About  ' || source AS t2 FROM documents) t",
)
def title_fallback(spark, sf):
    doc = F.col("doc_id") % 3
    title = F.when(doc == 0, F.lit("<b> </b>")).when(
        doc == 1, F.concat(F.lit("<i>"), "source", F.lit("</i> "), "lang")
    )
    display = F.concat(F.lit("About  "), "source")
    return shape(spark, sf, "documents").select(
        "doc_id", F.coalesce(T.clean_text(title), T.clean_text(display)).alias("title")
    )
