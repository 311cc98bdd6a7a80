"""Raw nested records and everything read out of them: JSON operators and the cleaned tables.

The flat record shapes say what each record holds; the Spark side nests them into one VARIANT per
row, the oracle reads the flat columns directly.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import variant as V
from ..operators.incremental import replace_children as replace_children_of
from ..operators.ordering import first_per_key
from ..plans import gold, silver
from ..sources import workspace
from ..sources.tables import SnapshotStore
from .registry import query
from .scalars import CLEAN_SQL
from .shape import SHAPES, oracle, select, shape, spread

SHAPES["rec_awards"] = """
SELECT 'https://records.example/' || CASE WHEN k % 97 = 0 THEN 'G/' ELSE 'G' || CAST(k AS STRING) END AS id,
       CASE WHEN k % 29 <> 0 THEN CAST(day + CASE WHEN batch = 2 THEN 30 ELSE 0 END AS STRING) || ' 08:00:00' END AS updated_date,
       '  ' || o_orderpriority || CASE WHEN batch = 3 THEN '  again ' ELSE '' END AS display_name,
       CASE k % 5 WHEN 1 THEN '<p>Work</p><br/>for  customer ' || CAST(o_custkey AS STRING)
                  WHEN 2 THEN 'p < 0.05 and q > 3 holds' WHEN 3 THEN '   ' WHEN 4 THEN 'plain' END AS description,
       ' FA-' || CAST(k AS STRING) || ' ' AS funder_award_id,
       CASE o_orderstatus WHEN 'P' THEN '' ELSE o_orderstatus END AS funder_scheme,
       ' GRANT ' || o_orderstatus AS funding_type,
       CASE WHEN k % 17 <> 0 THEN 'https://records.example/F' || CAST(o_custkey AS STRING) END AS funder_id,
       CASE k % 7 WHEN 0 THEN '0' WHEN 1 THEN '-5' WHEN 2 THEN '12.345' WHEN 3 THEN 'abc' WHEN 4 THEN NULL
                  ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS amount,
       CASE o_orderstatus WHEN 'F' THEN ' usd ' WHEN 'O' THEN 'EUR' END AS currency,
       CASE WHEN k % 4 <> 0 THEN CAST(day AS STRING) END AS start_date,
       CASE k % 20 WHEN 0 THEN '1899' WHEN 4 THEN '1900' WHEN 8 THEN '2100' WHEN 12 THEN '2101'
                   WHEN 16 THEN '1999.6' END AS start_year,
       CAST(day + CAST(k % 90 - 45 AS INT) AS STRING) AS end_date,
       CASE WHEN k % 13 <> 0 THEN 'https://records.example/T' || CAST(o_custkey % 25 AS STRING) END AS topic_id,
       k % 3 AS n_inst,
       CASE WHEN k % 11 <> 0 THEN 'https://records.example/I' || CAST(o_custkey % 90 AS STRING) END AS inst1_id,
       '<b>Place</b> ' || CAST(o_custkey % 90 AS STRING) AS inst1_name,
       'https://records.example/I' || CAST(k % 90 AS STRING) AS inst2_id,
       'Place ' || CAST(k % 90 AS STRING) AS inst2_name,
       CASE WHEN k % 4 <> 1 THEN CAST(k % 6 AS STRING) END AS outputs_count, k % 3 AS n_outputs,
       '10.5/AB' || CAST(k AS STRING) AS doi,
       'awards/updated_date=2024-0' || CAST(batch AS STRING) || '-01/part_0000.parquet' AS _source_file,
       CAST('2024-0' || CAST(batch AS STRING) || '-01 00:00:00' AS TIMESTAMP) AS _loaded_at
FROM (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, CAST(o_orderdate AS DATE) AS day, batch
  FROM {orders} CROSS JOIN (SELECT 1 AS batch UNION ALL SELECT 2 UNION ALL SELECT 3) b
  WHERE batch = 1 OR (batch = 2 AND o_orderkey % 3 = 0) OR (batch = 3 AND o_orderkey % 5 = 0)
) t
"""

SHAPES["rec_works"] = """
SELECT doc_id, 'https://records.example/' || CASE WHEN doc_id % 61 = 0 THEN '' ELSE 'W' || CAST(doc_id AS STRING) END AS id,
       CAST(day + CASE WHEN batch = 2 THEN 10 ELSE 0 END AS STRING) || ' 09:00:00' AS updated_date,
       '10.1/X' || CAST(doc_id AS STRING) AS doi,
       CASE WHEN doc_id % 3 <> 0 THEN '<i>' || source || '</i>  ' || lang END AS title,
       CASE WHEN doc_id % 9 <> 0 THEN 'Shown as ' || source END AS display_name,
       CASE doc_id % 10 WHEN 0 THEN '0' WHEN 1 THEN '9999' ELSE CAST(1995 + doc_id % 8 AS STRING) END AS publication_year,
       CASE WHEN doc_id % 12 <> 0 THEN CAST(day AS STRING) END AS publication_date,
       ' Article ' AS type, lang AS language,
       CAST(doc_id % 40 - 5 AS STRING) AS cited_by_count, CAST(doc_id % 7 AS STRING) || '.5' AS fwci,
       CASE doc_id % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS is_retracted,
       CASE WHEN doc_id % 6 <> 0 THEN 'https://records.example/T' || CAST(doc_id % 30 AS STRING) END AS topic_id,
       doc_id % 4 AS n_auth,
       'https://records.example/A' || CAST(doc_id % 83 AS STRING) AS a1_id, 'Author ' || CAST(doc_id % 83 AS STRING) AS a1_name,
       'https://orcid.example/0-' || CAST(doc_id % 83 AS STRING) AS a1_orcid,
       CASE WHEN doc_id % 7 <> 0 THEN 'https://records.example/A' || CAST(doc_id * 5 % 83 AS STRING) END AS a2_id,
       'Author ' || CAST(doc_id * 5 % 83 AS STRING) AS a2_name,
       'https://records.example/A' || CAST(CASE WHEN doc_id % 5 = 0 THEN doc_id % 83 ELSE doc_id * 11 % 83 END AS STRING) AS a3_id,
       'Author third' AS a3_name,
       'https://records.example/I' || CAST(doc_id % 90 AS STRING) AS place_id, ' c' || CAST(doc_id % 9 AS STRING) || ' ' AS country,
       doc_id * 3 % 4 AS n_aw,
       CASE WHEN doc_id % 8 <> 0 THEN 'https://records.example/G' || CAST(doc_id * 13 % 9000 AS STRING) END AS w1_id,
       'https://records.example/G' || CAST(CASE WHEN doc_id % 5 = 0 THEN doc_id * 13 % 9000 ELSE doc_id * 7 % 9000 END AS STRING) AS w2_id,
       'https://records.example/G' || CAST(doc_id * 3 % 20000 AS STRING) AS w3_id,
       CASE WHEN doc_id % 10 = 9 THEN 'none' WHEN doc_id % 10 = 8 THEN 'broken' WHEN doc_id % 10 = 7 THEN 'text'
            ELSE 'object' END AS index_kind,
       'works/updated_date=2024-0' || CAST(batch AS STRING) || '-01/part_0000.parquet' AS _source_file,
       CAST('2024-0' || CAST(batch AS STRING) || '-01 00:00:00' AS TIMESTAMP) AS _loaded_at
FROM (
  SELECT doc_id, lang, source, DATE '1995-01-01' + CAST(doc_id * 37 % 2557 AS INT) AS day, batch
  FROM {documents} CROSS JOIN (SELECT 1 AS batch UNION ALL SELECT 2 UNION ALL SELECT 3) b
  WHERE batch = 1 OR (batch = 2 AND doc_id % 4 = 0) OR (batch = 3 AND doc_id % 5 = 0)
) t
"""

SHAPES["rec_funders"] = """
SELECT CASE WHEN k % 50 <> 0 THEN 'https://records.example/F' || CAST(k AS STRING) END AS id,
       ' <b>' || c_name || '</b> ' AS display_name, 'In segment  ' || c_mktsegment AS description,
       ' n' || CAST(c_nationkey AS STRING) AS country_code,
       CASE k % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS is_global_south,
       'https://ror.example/0' || CAST(k AS STRING) AS ror, ' ' AS homepage_url,
       CAST(CAST(floor(c_acctbal) AS INT) AS STRING) AS awards_count, CAST(k % 9 AS STRING) AS works_count,
       '2024-0' || CAST(batch AS STRING) || '-05 00:00:00' AS updated_date,
       'funders/updated_date=2024-0' || CAST(batch AS STRING) || '-05/part_0000.parquet' AS _source_file,
       CAST('2024-0' || CAST(batch AS STRING) || '-06 00:00:00' AS TIMESTAMP) AS _loaded_at
FROM (SELECT c_custkey AS k, c_name, c_mktsegment, c_nationkey, c_acctbal, batch
      FROM {customer} CROSS JOIN (SELECT 1 AS batch UNION ALL SELECT 2) b
      WHERE batch = 1 OR c_custkey % 4 = 0) t
"""

SHAPES["rec_topics"] = """
SELECT 'https://records.example/T' || CAST(n_nationkey AS STRING) AS id, ' ' || n_name AS display_name,
       'Topic of ' || r_name AS description,
       'https://records.example/subfields/' || CAST(n_nationkey % 9 AS STRING) AS subfield_id,
       'Subfield ' || CAST(n_nationkey % 9 AS STRING) AS subfield_name,
       'https://records.example/fields/' || CAST(r_regionkey AS STRING) AS field_id, r_name AS field_name,
       'https://records.example/domains/' || CAST(r_regionkey % 2 AS STRING) AS domain_id, 'Domain' AS domain_name,
       CAST(n_nationkey * 10 AS STRING) || '.4' AS works_count,
       CASE WHEN batch = 1 THEN '2024-01-05 00:00:00' END AS updated_date,
       'topics/updated_date=2024-0' || CAST(batch AS STRING) || '-05/part_0000.parquet' AS _source_file,
       CAST('2024-0' || CAST(batch AS STRING) || '-06 00:00:00' AS TIMESTAMP) AS _loaded_at
FROM {nation} JOIN {region} ON r_regionkey = n_regionkey CROSS JOIN (SELECT 1 AS batch UNION ALL SELECT 2) b
"""

LOAD = ["_source_file", "_loaded_at"]


def _named(**fields) -> Column:
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in fields.items()])


def _first_n(n: str, *items: Column) -> Column:
    """A list of the first n items; no list at all when n is 0."""
    return F.when(F.col(n) > 0, F.slice(F.array(*items), 1, F.col(n).cast("int")))


def stored(build):
    """The raw layer is a table: records are nested once in a session and every reader scans the files."""

    @wraps(build)
    def read(spark: SparkSession, sf: str) -> DataFrame:
        return workspace.once(spark, f"{build.__name__} {sf}", lambda: build(spark, sf))

    return read


@stored
def raw_awards(spark: SparkSession, sf: str) -> DataFrame:
    funder = F.when(
        F.col("funder_id").isNotNull(),
        _named(id="funder_id", display_name=F.concat(F.lit("Funder "), F.split_part("funder_id", F.lit("/"), F.lit(-1)))),
    )
    place = lambda i, country: _named(
        id=f"inst{i}_id", display_name=f"inst{i}_name", country_code=F.lit(country), type=F.lit(" Company "),
        ror=F.concat(F.lit("https://ror.example/"), f"inst{i}_name"),
    )
    plain = ["id", "updated_date", "display_name", "description", "funder_award_id", "funder_scheme",
             "funding_type", "amount", "currency", "start_date", "start_year", "end_date", "doi"]
    record = F.struct(
        *plain,
        funder.alias("funder"),
        F.when(F.col("topic_id").isNotNull(), _named(id="topic_id")).alias("primary_topic"),
        _first_n("n_inst", place(1, " us "), place(2, "cl")).alias("institution_awarded"),
        _first_n("n_outputs", F.lit("x"), F.lit("y")).alias("funded_outputs"),
        F.col("outputs_count").alias("funded_outputs_count"),
    )
    # the narrow orders are dealt out, not the wide records made of them
    return select(spark, sf, SHAPES["rec_awards"], spread).select(F.to_variant_object(record).alias("raw"), *LOAD)


def document_texts(spark: SparkSession, sf: str) -> DataFrame:
    """documents as (doc_id, texts), where a text is known. One shuffle, of whole documents."""
    docs = shape(spark, sf, "documents").select("doc_id", "text").repartition("doc_id")
    return docs.groupBy("doc_id").agg(F.collect_list("text").alias("texts")).filter(F.size("texts") > 0)


def with_positions(rows: DataFrame) -> DataFrame:
    """`texts` replaced by `positions`, word -> positions. Words are sorted and cut into runs of equal ones
    inside the row of their document, so there is no table of words to sort or shuffle."""
    keep = [c for c in rows.columns if c != "texts"]
    placed = F.flatten(F.transform("texts", lambda t: F.transform(
        F.split(F.trim(t), r"\s+"), lambda word, at: F.struct(word.alias("word"), at.alias("at")))))
    ordered = rows.select(*keep, F.sort_array(placed).alias("words"))
    word = lambda i: F.get("words", i)["word"]
    starts = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: (i == 0) | (word(i) != word(i - 1)))
    cut = ordered.withColumn("starts", F.when(F.col("words").isNotNull(), starts))
    run = lambda start, i: F.slice(
        "words", start + 1, F.coalesce(F.get("starts", i + 1), F.size("words")) - start)
    entries = F.transform("starts", lambda start, i: F.struct(
        word(start).alias("word"), F.transform(run(start, i), lambda w: w["at"]).alias("at")))
    return cut.select(*keep, F.map_from_entries(entries).alias("positions"))


def word_positions(spark: SparkSession, sf: str) -> DataFrame:
    """documents as (doc_id, word -> positions)."""
    return with_positions(document_texts(spark, sf))


@stored
def raw_works(spark: SparkSession, sf: str) -> DataFrame:
    author = lambda i, place, corresponding, where, orcid=F.lit(None).cast("string"): F.struct(
        _named(id=f"a{i}_id", display_name=f"a{i}_name", orcid=orcid).alias("author"),
        F.lit(place).alias("author_position"),
        F.lit(corresponding).alias("is_corresponding"),
        where.alias("institutions"),
    )
    here = F.array(_named(id="place_id", display_name=F.lit(" Lab "), country_code="country"))
    nowhere = F.filter(here, lambda x: F.lit(False))
    award = lambda i: _named(
        id=f"w{i}_id", funder_id=F.lit(f"https://records.example/F{i}"), funder_award_id=F.lit(f" N{i} ")
    )
    kind = F.col("index_kind")
    index = (
        F.when(kind == "object", F.to_variant_object("positions"))
        .when(kind == "text", F.to_json("positions").cast("variant"))
        .when(kind == "broken", F.lit('{"broken": [').cast("variant"))
    )
    plain = ["id", "updated_date", "doi", "title", "display_name", "publication_year", "publication_date",
             "type", "language", "cited_by_count", "fwci", "is_retracted"]
    record = F.struct(
        *plain,
        F.when(F.col("topic_id").isNotNull(), _named(id="topic_id")).alias("primary_topic"),
        index.alias("abstract_inverted_index"),
        _first_n("n_auth", author(1, "First", True, here, F.col("a1_orcid")), author(2, "middle", False, nowhere),
                 author(3, " LAST ", False, here)).alias("authorships"),
        _first_n("n_aw", award(1), award(2), award(3)).alias("awards"),
    )
    # texts meet the narrow records, and become the far larger positions after the join: once a document,
    # whose records are listed until then, and only where one of them shows its words
    records = shape(spark, sf, "rec_works")
    listed = records.groupBy("doc_id").agg(
        F.collect_list(F.struct(*[c for c in records.columns if c != "doc_id"])).alias("records")
    )
    shows = F.exists("records", lambda r: r["index_kind"].isin("object", "text"))
    rows = listed.join(document_texts(spark, sf), "doc_id", "left").withColumn("texts", F.when(shows, F.col("texts")))
    rows = with_positions(rows).select("doc_id", "positions", F.inline("records"))
    return rows.select(F.to_variant_object(record).alias("raw"), *LOAD)


@stored
def raw_funders(spark: SparkSession, sf: str) -> DataFrame:
    plain = ["id", "display_name", "description", "country_code", "is_global_south", "homepage_url",
             "awards_count", "works_count", "updated_date"]
    record = F.struct(*plain, _named(ror="ror").alias("ids"))
    return shape(spark, sf, "rec_funders").select(F.to_variant_object(record).alias("raw"), *LOAD)


@stored
def raw_topics(spark: SparkSession, sf: str) -> DataFrame:
    level = lambda n: _named(id=f"{n}_id", display_name=f"{n}_name").alias(n)
    record = F.struct("id", "display_name", "description", "works_count", "updated_date",
                      level("subfield"), level("field"), level("domain"))
    return shape(spark, sf, "rec_topics").select(F.to_variant_object(record).alias("raw"), *LOAD)


# ---------------------------------------------------------------- oracle side of the records
def id_sql(c: str) -> str:
    return f"nullif(split_part(trim({c}), '/', -1), '')"


def secs(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def whole_sql(c: str) -> str:
    return f"CAST(round(try_cast({c} AS DECIMAL(38,6)), 0) AS INTEGER)"


CLEANED = {
    "h_awards": f"""
SELECT *, coalesce(amount_raw <= 0, FALSE) AS is_amount_invalid,
       CASE WHEN amount_raw > 0 THEN amount_raw END AS amount,
       CASE WHEN amount_raw > 0 AND currency = 'USD' THEN amount_raw END AS amount_usd,
       CASE WHEN end_raw < start_date THEN NULL ELSE end_raw END AS end_date,
       coalesce(end_raw < start_date, FALSE) AS has_inconsistent_dates
FROM (
  SELECT {id_sql("id")} AS award_id, try_cast(updated_date AS TIMESTAMP) AS updated_at,
         {CLEAN_SQL.format("display_name")} AS award_title, {CLEAN_SQL.format("description")} AS award_description,
         nullif(trim(funder_award_id), '') AS funder_award_id, nullif(trim(funder_scheme), '') AS funder_scheme,
         nullif(lower(trim(funding_type)), '') AS funding_type, {id_sql("funder_id")} AS funder_id,
         'Funder ' || {id_sql("funder_id")} AS funder_name,
         try_cast(amount AS DECIMAL(18,2)) AS amount_raw, nullif(upper(trim(currency)), '') AS currency,
         {whole_sql("start_year")} AS start_year,
         coalesce(try_cast(start_date AS DATE), CASE WHEN {whole_sql("start_year")} BETWEEN 1900 AND 2100
                  THEN make_date({whole_sql("start_year")}, 1, 1) END) AS start_date,
         coalesce(start_date IS NULL AND {whole_sql("start_year")} BETWEEN 1900 AND 2100, FALSE) AS is_start_date_from_year,
         try_cast(end_date AS DATE) AS end_raw, {id_sql("topic_id")} AS primary_topic_id,
         CASE WHEN n_inst > 0 THEN {id_sql("inst1_id")} END AS lead_institution_id,
         CAST(n_inst AS INTEGER) AS institutions_count,
         CAST(coalesce(try_cast(outputs_count AS INTEGER), n_outputs) AS INTEGER) AS funded_outputs_count,
         lower(doi) AS doi, n_inst, inst1_id, inst1_name, inst2_id, inst2_name, _source_file, _loaded_at
  FROM {{rec_awards}}) t
WHERE award_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY award_id, updated_at ORDER BY _loaded_at DESC, _source_file DESC) = 1""",
    "st_awards": """
SELECT * FROM {h_awards} QUALIFY row_number() OVER (
  PARTITION BY award_id ORDER BY updated_at DESC NULLS LAST, _loaded_at DESC) = 1""",
    "h_works": f"""
SELECT *, title IS NOT NULL AS has_title,
       CASE WHEN y BETWEEN 1500 AND 2025 THEN y END AS publication_year,
       coalesce(NOT (y BETWEEN 1500 AND 2025), FALSE) AS is_publication_year_invalid
FROM (
  SELECT {id_sql("id")} AS work_id, try_cast(updated_date AS TIMESTAMP) AS updated_at, lower(doi) AS doi,
         coalesce({CLEAN_SQL.format("title")}, {CLEAN_SQL.format("display_name")}) AS title,
         {whole_sql("publication_year")} AS y, try_cast(publication_date AS DATE) AS publication_date,
         lower(trim(type)) AS work_type, lower(language) AS language,
         CASE WHEN {whole_sql("cited_by_count")} >= 0 THEN {whole_sql("cited_by_count")} END AS cited_by_count,
         CAST(fwci AS DOUBLE) AS fwci, coalesce(try_cast(is_retracted AS BOOLEAN), FALSE) AS is_retracted,
         {id_sql("topic_id")} AS primary_topic_id, CAST(n_auth AS INTEGER) AS authors_count,
         CAST(n_aw AS INTEGER) AS awards_count, _source_file, _loaded_at, doc_id, index_kind, n_auth, n_aw,
         a1_id, a1_name, a1_orcid, a2_id, a2_name, a3_id, a3_name, place_id, country, w1_id, w2_id, w3_id
  FROM (SELECT * EXCLUDE (publication_year), publication_year FROM {{rec_works}}) r) t
WHERE work_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY work_id, updated_at ORDER BY _loaded_at DESC, _source_file DESC) = 1""",
    "st_works": """
SELECT h.*, CASE WHEN index_kind IN ('object', 'text')
            THEN array_to_string(string_split_regex(trim(text), '[[:space:]]+'), ' ') END AS abstract_text
FROM (SELECT * FROM {h_works} QUALIFY row_number() OVER (
        PARTITION BY work_id ORDER BY updated_at DESC NULLS LAST, _loaded_at DESC) = 1) h
JOIN documents d ON d.doc_id = h.doc_id""",
    "authors": f"""
SELECT work_id, {id_sql("aid")} AS author_id, {CLEAN_SQL.format("aname")} AS author_name, {id_sql("orcid")} AS orcid,
       author_position, is_corresponding, {id_sql("inst")} AS institution_id, inst_name AS institution_name,
       nullif(upper(trim(ctry)), '') AS institution_country_code, author_order, _loaded_at
FROM (
  SELECT work_id, a1_id AS aid, a1_name AS aname, a1_orcid AS orcid, 'first' AS author_position, TRUE AS is_corresponding,
         place_id AS inst, 'Lab' AS inst_name, country AS ctry, 0 AS author_order, _loaded_at FROM {{st_works}} WHERE n_auth > 0
  UNION ALL SELECT work_id, a2_id, a2_name, NULL, 'middle', FALSE, NULL, NULL, NULL, 1, _loaded_at FROM {{st_works}} WHERE n_auth > 1
  UNION ALL SELECT work_id, a3_id, a3_name, NULL, 'last', FALSE, place_id, 'Lab', country, 2, _loaded_at FROM {{st_works}} WHERE n_auth > 2
) t
WHERE {id_sql("aid")} IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY work_id, {id_sql("aid")} ORDER BY author_order) = 1""",
    "wk_awards": f"""
SELECT work_id, {id_sql("wid")} AS award_id, 'F' || i AS funder_id, 'N' || i AS funder_award_id, i - 1 AS award_order, _loaded_at
FROM (
  SELECT work_id, w1_id AS wid, 1 AS i, _loaded_at FROM {{st_works}} WHERE n_aw > 0
  UNION ALL SELECT work_id, w2_id, 2, _loaded_at FROM {{st_works}} WHERE n_aw > 1
  UNION ALL SELECT work_id, w3_id, 3, _loaded_at FROM {{st_works}} WHERE n_aw > 2) t
WHERE {id_sql("wid")} IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY work_id, {id_sql("wid")} ORDER BY i) = 1""",
}


def cleaned_oracle(sql: str) -> str:
    return oracle(sql, **CLEANED)


AWARD_COLUMNS = [
    "award_id", "updated_at", "award_title", "award_description", "has_description", "funder_award_id",
    "funder_scheme", "funding_type", "funder_id", "funder_name", "amount", "is_amount_invalid", "currency",
    "amount_usd", "start_date", "is_start_date_from_year", "start_year", "end_date", "has_inconsistent_dates",
    "primary_topic_id", "lead_institution_id", "institutions_count", "funded_outputs_count", "doi",
    "_source_file", "_loaded_at",
]
AWARD_SQL = ", ".join(
    {"updated_at": f"{secs('updated_at')} AS updated_at", "_loaded_at": f"{secs('_loaded_at')} AS _loaded_at",
     "amount": "CAST(amount AS DOUBLE) AS amount", "amount_usd": "CAST(amount_usd AS DOUBLE) AS amount_usd",
     "start_date": "CAST(start_date AS VARCHAR) AS start_date", "end_date": "CAST(end_date AS VARCHAR) AS end_date",
     "has_description": "award_description IS NOT NULL AS has_description"}.get(c, c)
    for c in AWARD_COLUMNS
)
WORK_COLUMNS = [
    "work_id", "updated_at", "doi", "title", "has_title", "publication_year", "is_publication_year_invalid",
    "publication_date", "work_type", "language", "cited_by_count", "fwci", "is_retracted", "primary_topic_id",
    "authors_count", "awards_count", "_source_file", "_loaded_at",
]
WORK_SQL = ", ".join(
    {"updated_at": f"{secs('updated_at')} AS updated_at", "_loaded_at": f"{secs('_loaded_at')} AS _loaded_at",
     "publication_date": "CAST(publication_date AS VARCHAR) AS publication_date"}.get(c, c)
    for c in WORK_COLUMNS
)
AS_OF = "2024-06-30"


def works_read(spark: SparkSession, sf: str) -> DataFrame:
    return silver.work_history(raw_works(spark, sf), F.lit(AS_OF).cast("date"))


# ---------------------------------------------------------------- cleaned tables
@query("award_history", cleaned_oracle(f"SELECT {AWARD_SQL} FROM {{h_awards}}"))
def award_history(spark, sf):
    return silver.award_history(raw_awards(spark, sf)).select(*AWARD_COLUMNS)


@query("award_state", cleaned_oracle(f"SELECT {AWARD_SQL} FROM {{st_awards}}"))
def award_state(spark, sf):
    return silver.award_state(silver.award_history(raw_awards(spark, sf))).select(*AWARD_COLUMNS)


@query("work_history", cleaned_oracle(f"SELECT {WORK_SQL} FROM {{h_works}}"))
def work_history(spark, sf):
    return works_read(spark, sf).select(*WORK_COLUMNS)


@query(
    "work_state",
    cleaned_oracle(
        f"SELECT {WORK_SQL}, md5(abstract_text) AS abstract_md5, abstract_text IS NOT NULL AS has_abstract FROM {{st_works}}"
    ),
)
def work_state(spark, sf):
    state = silver.work_state(works_read(spark, sf))
    return state.select(*WORK_COLUMNS, F.md5("abstract_text").alias("abstract_md5"), "has_abstract")


@query("authorships", cleaned_oracle(f"SELECT * REPLACE ({secs('_loaded_at')} AS _loaded_at) FROM {{authors}}"))
def authorships(spark, sf):
    return silver.work_authorships(silver.latest_version(works_read(spark, sf), "work_id"))


@query("work_awards", cleaned_oracle(f"SELECT * REPLACE ({secs('_loaded_at')} AS _loaded_at) FROM {{wk_awards}}"))
def work_awards(spark, sf):
    return silver.work_awards(silver.latest_version(works_read(spark, sf), "work_id"))


@query(
    "funder_catalog",
    oracle(f"""
SELECT {id_sql("id")} AS funder_id, {CLEAN_SQL.format("display_name")} AS funder_name,
       {CLEAN_SQL.format("description")} AS funder_description, upper(trim(country_code)) AS country_code,
       try_cast(is_global_south AS BOOLEAN) AS is_global_south, {id_sql("ror")} AS ror_id,
       nullif(trim(homepage_url), '') AS homepage_url,
       CASE WHEN {whole_sql("awards_count")} >= 0 THEN {whole_sql("awards_count")} END AS awards_count,
       {whole_sql("works_count")} AS works_count, {secs("CAST(updated_date AS TIMESTAMP)")} AS updated_at
FROM {{rec_funders}} WHERE id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_date DESC NULLS LAST, _loaded_at DESC) = 1"""),
)
def funder_catalog(spark, sf):
    return silver.funders(raw_funders(spark, sf)).drop(*LOAD)


TOPIC_SQL = f"""
SELECT {id_sql("id")} AS topic_id, {CLEAN_SQL.format("display_name")} AS topic_name, description AS topic_description,
       {id_sql("subfield_id")} AS subfield_id, subfield_name, {id_sql("field_id")} AS field_id, field_name,
       {id_sql("domain_id")} AS domain_id, domain_name, {whole_sql("works_count")} AS works_count
FROM {{rec_topics}}
QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_date DESC NULLS LAST, _loaded_at DESC) = 1"""


@query("topic_catalog", oracle(TOPIC_SQL))
def topic_catalog(spark, sf):
    return silver.topics(raw_topics(spark, sf)).drop("keywords", "updated_at", *LOAD)


@query(
    "dim_from_array",
    cleaned_oracle(f"""
SELECT * FROM (
  SELECT {id_sql("iid")} AS institution_key, {CLEAN_SQL.format("iname")} AS institution_name, country_code,
         'company' AS institution_type, {id_sql("ror")} AS ror_id, {secs("_loaded_at")} AS _loaded_at
  FROM (SELECT inst1_id AS iid, inst1_name AS iname, 'US' AS country_code, 'https://ror.example/' || inst1_name AS ror, _loaded_at
        FROM {{st_awards}} WHERE n_inst > 0
        UNION ALL SELECT inst2_id, inst2_name, 'CL', 'https://ror.example/' || inst2_name, _loaded_at
        FROM {{st_awards}} WHERE n_inst > 1) t
  WHERE {id_sql("iid")} IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {id_sql("iid")}
    ORDER BY t._loaded_at DESC, {CLEAN_SQL.format("iname")}, country_code, {id_sql("ror")}) = 1)
UNION ALL SELECT 'UNKNOWN', 'Institución desconocida', NULL, NULL, NULL, '1900-01-01 00:00:00'"""),
)
def dim_from_array(spark, sf):
    return gold.dim_institution(silver.award_state(silver.award_history(raw_awards(spark, sf))))


# ---------------------------------------------------------------- JSON operators
@query("json_path", "SELECT event_id, json_extract_string(props, '$.k') AS k,"
       " json_extract_string(props, '$.missing.deep') AS missing FROM events")
def json_path(spark, sf):
    node = F.try_parse_json("props")
    return shape(spark, sf, "events").select(
        "event_id", V.text_at(node, "k").alias("k"), V.text_at(node, "missing.deep").alias("missing")
    )


@query(
    "json_first_elem",
    oracle(f"SELECT _source_file, CAST(id AS VARCHAR) AS id, CASE WHEN n_inst > 0 THEN {id_sql('inst1_id')} END AS lead FROM {{rec_awards}}"),
)
def json_first_elem(spark, sf):
    raw = F.col("raw")
    return raw_awards(spark, sf).select(
        "_source_file", V.text_at(raw, "id").alias("id"),
        T.short_id(V.text_at(raw, "institution_awarded[0].id")).alias("lead"),
    )


@query(
    "json_array_size",
    oracle("""
SELECT id, _source_file, CAST(n_inst AS INTEGER) AS institutions,
       CAST(coalesce(try_cast(outputs_count AS INTEGER), n_outputs) AS INTEGER) AS outputs,
       CAST(NULL AS INTEGER) AS not_a_list FROM {rec_awards}"""),
)
def json_array_size(spark, sf):
    raw = F.col("raw")
    size = lambda path: V.array_length(V.node_at(raw, path))
    return raw_awards(spark, sf).select(
        V.text_at(raw, "id").alias("id"), "_source_file",
        F.coalesce(size("institution_awarded"), F.lit(0)).alias("institutions"),
        F.coalesce(V.text_at(raw, "funded_outputs_count").try_cast("int"), size("funded_outputs"), F.lit(0)).alias("outputs"),
        size("display_name").alias("not_a_list"),
    )


DISTINCT_WORDS = "CAST(len(list_distinct(string_split_regex(trim(text), '[[:space:]]+'))) AS INTEGER)"


@query(
    "json_object_or_text",
    oracle(f"""
SELECT r.id, r._source_file, CASE WHEN index_kind IN ('object', 'text') THEN {DISTINCT_WORDS} END AS words
FROM {{rec_works}} r JOIN documents d ON d.doc_id = r.doc_id"""),
)
def json_object_or_text(spark, sf):
    index = V.object_or_json_text(V.node_at(F.col("raw"), "abstract_inverted_index"))
    words = F.try_variant_get(index, "$", "map<string,variant>")
    return raw_works(spark, sf).select(
        V.text_at(F.col("raw"), "id").alias("id"), "_source_file",
        F.when(words.isNotNull(), F.size(words)).alias("words"),
    )


@query(
    "flatten_array",
    oracle(f"""
SELECT id, _source_file, position, {id_sql("place")} AS institution_id, name AS institution_name FROM (
  SELECT id, _source_file, 0 AS position, inst1_id AS place, inst1_name AS name FROM {{rec_awards}} WHERE n_inst > 0
  UNION ALL SELECT id, _source_file, 1, inst2_id, inst2_name FROM {{rec_awards}} WHERE n_inst > 1) t"""),
)
def flatten_array(spark, sf):
    rows = raw_awards(spark, sf).select(
        V.text_at(F.col("raw"), "id").alias("id"), "_source_file",
        V.node_at(F.col("raw"), "institution_awarded").alias("places"),
    )
    item = lambda path: V.text_at(F.col("element"), path)
    return V.explode_elements(rows, "places", "id", "_source_file").select(
        "id", "_source_file", "position", T.short_id(item("id")).alias("institution_id"),
        item("display_name").alias("institution_name"),
    )


@query(
    "flatten_map",
    """
SELECT word, count(*) AS occurrences, count(DISTINCT doc_id) AS docs, CAST(sum(pos) AS BIGINT) AS position_sum
FROM (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos
      FROM (SELECT doc_id, string_split_regex(trim(text), '[[:space:]]+') AS words FROM documents) d) t
GROUP BY word""",
)
def flatten_map(spark, sf):
    """Object to (key, value) rows, then each nested list to its values; shown per word."""
    index = word_positions(spark, sf).select("doc_id", F.to_variant_object("positions").alias("node"))
    entries = index.select(F.explode(F.try_variant_get("node", "$", "map<string,variant>")).alias("word", "list"))
    placed = entries.select("word", F.posexplode(F.try_variant_get("list", "$", "array<int>")).alias("place", "at"))
    # a document has one list for a word: the list's first value stands for the document
    return placed.groupBy("word").agg(
        F.count(F.lit(1)).alias("occurrences"), F.count_if(F.col("place") == 0).alias("docs"),
        F.sum("at").alias("position_sum"),
    )


@query(
    "inverted_index_text",
    """
SELECT doc_id, md5(array_to_string(words, ' ')) AS text_md5, CAST(len(words) AS INTEGER) AS words
FROM (SELECT doc_id, string_split_regex(trim(text), '[[:space:]]+') AS words FROM documents) t""",
)
def inverted_index_text(spark, sf):
    index = word_positions(spark, sf).select("doc_id", F.to_variant_object("positions").alias("node"))
    rebuilt = index.select("doc_id", V.inverted_index_text(F.col("node")).alias("text"))
    return rebuilt.select("doc_id", F.md5("text").alias("text_md5"), F.size(F.split("text", " ")).alias("words"))


@query(
    "first_in_parent",
    cleaned_oracle("SELECT work_id, author_id, author_order FROM {authors} WHERE author_position <> 'middle'"),
)
def first_in_parent(spark, sf):
    works = silver.latest_version(works_read(spark, sf), "work_id").select("work_id", "authorships")
    item = lambda path: V.text_at(F.col("element"), path)
    listed = V.explode_elements(works, "authorships", "work_id").select(
        "work_id", T.short_id(item("author.id")).alias("author_id"), F.col("position").alias("author_order"),
        T.lower_code(item("author_position")).alias("place"),
    )
    known = listed.filter(F.col("author_id").isNotNull())
    kept = first_per_key(known, ["work_id", "author_id"], [F.col("author_order")])
    return kept.filter("place <> 'middle'").drop("place")


LISTS = """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '["CN", "US"]'
       WHEN 3 THEN '["CN"]' ELSE '["C' || CAST(o_custkey % 3 AS STRING) || '"]' END AS codes,
       CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'US' WHEN 2 THEN 'C1' ELSE 'C' END AS code
FROM {orders}
"""


@query(
    "json_list_contains",
    oracle(f"""
SELECT o_orderkey, CASE WHEN code IS NOT NULL AND contains(coalesce(codes, ''), '"' || code || '"')
       THEN 1.0 ELSE 0.0 END::DOUBLE AS hit FROM ({LISTS}) t"""),
)
def json_list_contains(spark, sf):
    return select(spark, sf, LISTS).select(
        "o_orderkey", V.json_list_contains(F.col("codes"), F.col("code")).alias("hit")
    )


# ---------------------------------------------------------------- children and catalogs
CHILD_SQL = """
SELECT parent, child, n FROM (
  SELECT 'W' || CAST(p AS STRING) AS parent, 'A' || CAST(s AS STRING) AS child, n FROM (
    SELECT l_partkey AS p, l_suppkey AS s, count(*) AS n FROM {lineitem} WHERE l_shipdate < TIMESTAMP '1999-01-01' GROUP BY l_partkey, l_suppkey) a
  WHERE p % 3 <> 0
  UNION ALL
  SELECT 'W' || CAST(p AS STRING), 'A' || CAST(s AS STRING), n FROM (
    SELECT l_partkey AS p, l_suppkey AS s, count(*) AS n FROM {lineitem} WHERE l_shipdate >= TIMESTAMP '1999-01-01' GROUP BY l_partkey, l_suppkey) b
  WHERE p % 3 = 0 AND p % 6 <> 0) t
"""


@query("replace_children", oracle(CHILD_SQL))
def replace_children(spark, sf):
    """Parents divisible by 3 got a new version; every second one of them lost all its children."""
    lines = shape(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate")
    split = F.lit("1999-01-01").cast("timestamp_ntz")
    links = lambda rows: rows.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    current = links(lines.filter(F.col("l_shipdate") < split))
    new = links(lines.filter((F.col("l_shipdate") >= split) & (F.col("l_partkey") % 3 == 0) & (F.col("l_partkey") % 6 != 0)))
    changed = shape(spark, sf, "part").filter("p_partkey % 3 = 0").select(F.col("p_partkey").alias("l_partkey"))
    merged = replace_children_of(current, new, "l_partkey", changed)
    return merged.select(
        F.concat(F.lit("W"), "l_partkey").alias("parent"), F.concat(F.lit("A"), "l_suppkey").alias("child"), "n"
    )


@query("catalog_rebuild", oracle(TOPIC_SQL))
def catalog_rebuild(spark, sf):
    """A catalog is rebuilt whole and swapped in; building it twice leaves one copy."""
    store = SnapshotStore(spark, workspace.new_folder(spark, "catalog"))
    topics = silver.topics(raw_topics(spark, sf)).drop("keywords", "updated_at", *LOAD)
    store.overwrite(topics, "topics")
    return store.overwrite(topics, "topics")
