"""Driver tables shaped into the engine's inputs.

Each shape is one SELECT in the subset both Spark SQL and DuckDB read, so a query and its oracle
start from the same rows. `{name}` stands for a table or for another shape.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SHAPES: dict[str, str] = {}

# ---------------------------------------------------------------- cleaned tables (silver grain)
SHAPES["order_lines"] = """
SELECT l_orderkey,
       min(CAST(l_linenumber AS BIGINT) * 1000000000 + l_suppkey) % 1000000000 AS lead_supp,
       CAST(count(*) AS INT) AS n_lines
FROM {lineitem} GROUP BY l_orderkey
"""

SHAPES["s_awards"] = """
SELECT award_id, award_title, award_description, award_description IS NOT NULL AS has_description,
       funder_award_id, funder_scheme, funding_type, funder_id, doi, landing_page_url, provenance,
       CASE WHEN net > 0 THEN net END AS amount, net <= 0 AS is_amount_invalid, currency,
       CASE WHEN net > 0 AND currency = 'USD' THEN net END AS amount_usd,
       start_date, is_start_date_from_year,
       CASE WHEN end_raw >= start_date THEN end_raw END AS end_date,
       coalesce(end_raw < start_date, FALSE) AS has_inconsistent_dates,
       primary_topic_id, lead_institution_id, institutions_count, funded_outputs_count, _loaded_at
FROM (
  SELECT 'G' || CAST(o_orderkey AS STRING) AS award_id,
         nullif(o_orderpriority, '4-NOT SPECIFIED') AS award_title,
         CASE WHEN o_orderkey % 5 <> 0 THEN 'Placed by customer ' || CAST(o_custkey AS STRING) END
           AS award_description,
         'FA-' || CAST(o_orderkey AS STRING) AS funder_award_id,
         CASE WHEN o_orderstatus <> 'P' THEN 'scheme ' || o_orderstatus END AS funder_scheme,
         CASE WHEN o_orderkey % 10 <> 3 THEN lower(o_orderstatus) END AS funding_type,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 'F-missing'
              ELSE 'F' || CAST(o_custkey AS STRING) END AS funder_id,
         CASE WHEN o_orderkey % 4 = 0 THEN '10.5/' || CAST(o_orderkey AS STRING) END AS doi,
         CAST(NULL AS STRING) AS landing_page_url, 'shape' AS provenance,
         CAST(o_totalprice AS DECIMAL(18,2)) - CAST(250000 AS DECIMAL(18,2)) AS net,
         CASE o_orderstatus WHEN 'F' THEN 'USD' WHEN 'O' THEN 'EUR' END AS currency,
         CASE WHEN o_orderkey % 41 <> 0 THEN CAST(o_orderdate AS DATE) END AS start_date,
         o_orderkey % 23 = 0 AS is_start_date_from_year,
         CASE WHEN o_orderkey % 6 <> 0
              THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey * 11 % 1500 - 60 AS INT) END AS end_raw,
         CASE WHEN o_orderkey % 13 <> 0 THEN 'T' || CAST(o_custkey % 27 AS STRING) END
           AS primary_topic_id,
         'I' || CAST(lead_supp AS STRING) AS lead_institution_id,
         coalesce(n_lines, 0) AS institutions_count, coalesce(n_lines, 0) AS funded_outputs_count,
         o_orderdate AS _loaded_at
  FROM {orders} LEFT JOIN {order_lines} ON l_orderkey = o_orderkey
) t
"""

SHAPES["s_works"] = """
SELECT 'W' || CAST(p_partkey AS STRING) AS work_id,
       CASE WHEN p_partkey % 9 <> 0 THEN '10.1/' || CAST(p_partkey AS STRING) END AS doi,
       CASE WHEN p_partkey % 31 = 0 THEN NULL WHEN p_partkey % 8 = 0 THEN p_name || '?'
            ELSE p_name END AS title,
       text AS abstract_text, text IS NOT NULL AS has_abstract,
       year(pub) AS publication_year,
       CASE WHEN p_partkey % 37 <> 0 THEN pub END AS publication_date,
       lower(p_type) AS work_type, lang AS language, p_size AS cited_by_count,
       p_retailprice / 1000 AS fwci, p_partkey % 50 = 0 AS is_retracted,
       CASE WHEN p_partkey % 11 <> 0 THEN 'T' || CAST(p_size % 27 AS STRING) END AS primary_topic_id,
       CAST(p_size % 5 AS INT) AS authors_count, CAST(pub AS TIMESTAMP) AS _loaded_at
FROM (SELECT *, DATE '1995-01-01' + CAST(p_partkey * 37 % 2557 AS INT) AS pub FROM {part}) p
LEFT JOIN {documents} ON doc_id = p_partkey
"""

SHAPES["s_work_awards"] = """
SELECT 'W' || CAST(l_partkey AS STRING) AS work_id, 'G' || CAST(l_orderkey AS STRING) AS award_id,
       max(l_shipdate) AS _loaded_at
FROM {lineitem} GROUP BY l_partkey, l_orderkey
"""

SHAPES["s_authorships"] = """
SELECT 'W' || CAST(l_partkey AS STRING) AS work_id, 'A' || CAST(l_suppkey AS STRING) AS author_id,
       s_name AS author_name,
       CASE WHEN l_suppkey % 3 = 0 THEN 'O' || CAST(l_suppkey AS STRING) END AS orcid,
       CASE WHEN first_line = 1 THEN 'first' WHEN first_line < 5 THEN 'middle' ELSE 'last' END
         AS author_position,
       returned = 1 AS is_corresponding,
       'I' || CAST(l_suppkey AS STRING) AS institution_id,
       CASE WHEN s_nationkey <> 7 THEN 'C' || CAST(s_nationkey AS STRING) END
         AS institution_country_code,
       _loaded_at
FROM (SELECT l_partkey, l_suppkey, min(l_linenumber) AS first_line,
             max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned,
             max(l_shipdate) AS _loaded_at
      FROM {lineitem} GROUP BY l_partkey, l_suppkey) a
JOIN {supplier} ON s_suppkey = l_suppkey
"""

SHAPES["s_funders"] = """
SELECT 'F' || CAST(c_custkey AS STRING) AS funder_id, c_name AS funder_name,
       'C' || CAST(c_nationkey AS STRING) AS country_code, c_nationkey % 2 = 0 AS is_global_south,
       CAST(NULL AS STRING) AS ror_id, CAST(NULL AS STRING) AS homepage_url,
       CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal) AS INT) END AS awards_count,
       CAST(c_custkey % 90 AS INT) AS works_count
FROM {customer}
"""

SHAPES["s_topics"] = """
SELECT 'T' || CAST(n_nationkey AS STRING) AS topic_id, n_name AS topic_name,
       'About ' || n_name AS topic_description, CAST(NULL AS STRING) AS keywords,
       'S' || CAST(n_nationkey % 9 AS STRING) AS subfield_id,
       'Subfield ' || CAST(n_nationkey % 9 AS STRING) AS subfield_name,
       'R' || CAST(r_regionkey AS STRING) AS field_id, r_name AS field_name,
       'D' || CAST(r_regionkey % 2 AS STRING) AS domain_id,
       CASE r_regionkey % 2 WHEN 0 THEN 'EVEN' ELSE 'ODD' END AS domain_name
FROM {nation} JOIN {region} ON r_regionkey = n_regionkey
"""

SHAPES["s_institutions"] = """
SELECT 'I' || CAST(s_suppkey AS STRING) AS institution_key, s_name AS institution_name,
       'C' || CAST(s_nationkey AS STRING) AS country_code,
       CASE WHEN s_acctbal >= 0 THEN 'company' ELSE 'facility' END AS institution_type,
       CAST(NULL AS STRING) AS ror_id
FROM {supplier}
"""

PLACEHOLDER = re.compile(r"\{(\w+)\}")


def oracle(sql: str, **ctes: str) -> str:
    """DuckDB text of `sql`: the shapes and named CTEs it refers to, then the query itself."""
    named = {**SHAPES, **ctes}
    order: list[str] = []

    def visit(text: str) -> None:
        for name in PLACEHOLDER.findall(text):
            if name in named and name not in order:
                visit(named[name])
                order.append(name)

    visit(sql)
    flat = lambda text: PLACEHOLDER.sub(r"\1", text).strip()
    heads = [f"{name} AS (\n{flat(named[name])}\n)" for name in order]
    return ("WITH " + ",\n".join(heads) + "\n" if heads else "") + flat(sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shape(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or a shape over them, as a DataFrame."""
    if name not in SHAPES:
        return table(spark, sf_dir, name)
    return select(spark, sf_dir, SHAPES[name])


def spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table or shape with its rows dealt out evenly before costly per-row work: a driver table may be
    one small file, which one task would read whole. AQE sets the number of tasks by size."""
    return shape(spark, sf_dir, name).hint("rebalance")


def select(spark: SparkSession, sf_dir: str, sql: str, read=shape) -> DataFrame:
    names = set(PLACEHOLDER.findall(sql))
    return spark.sql(sql, **{n: read(spark, sf_dir, n) for n in names})
