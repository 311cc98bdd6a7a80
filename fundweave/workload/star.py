"""Star-schema queries: dimensions, facts, gates, the wide table and its roll-ups."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import join_text
from ..operators import lookup as L
from ..operators import quality as K
from ..plans import gold, obt, reports
from ..sources import workspace
from ..sources.tables import SnapshotStore, read_columns
from .registry import query
from .shape import oracle, select, shape

# ---------------------------------------------------------------- the star, in both engines
class Star(Mapping):
    """The star's tables, each built from the cleaned tables when first asked for."""

    NAMES = ("dim_date", "dim_topic", "dim_funder", "dim_institution", "dim_award", "dim_work",
             "dim_author", "brg_work_author", "fact_awards", "fact_award_works")

    def __init__(self, spark: SparkSession, cleaned: Callable[[str], DataFrame]):
        self.spark, self.cleaned = spark, cache(cleaned)
        self._built: dict[str, DataFrame] = {}

    def __iter__(self):
        return iter(self.NAMES)

    def __len__(self):
        return len(self.NAMES)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        s = self.cleaned
        match name:
            case "dim_date":
                return gold.calendar(self.spark)
            case "dim_topic":
                return gold.dim_topic(s("s_topics"))
            case "dim_funder":
                return gold.dim_funder(s("s_funders"))
            case "dim_institution":
                named = {"institution_key": "UNKNOWN", "institution_name": gold.UNKNOWN_INSTITUTION}
                return L.with_unknown_member(s("s_institutions"), **named)
            case "dim_award":
                return gold.dim_award(s("s_awards"))
            case "dim_work":
                return gold.dim_work(s("s_works"), self["dim_topic"])
            case "dim_author":
                return gold.dim_author(s("s_authorships"))
            case "brg_work_author":
                return gold.bridge(s("s_authorships"), self["dim_work"], self["dim_author"])
            case "fact_awards":
                dims = ("dim_award", "dim_funder", "dim_topic", "dim_institution")
                return gold.fact_awards(s("s_awards"), *[self[d] for d in dims])
            case "fact_award_works":
                return gold.fact_award_works(s("s_work_awards"), self["dim_work"], self["fact_awards"])
        raise KeyError(name)


CLEANED = ("s_awards", "s_works", "s_work_awards", "s_authorships", "s_funders", "s_topics", "s_institutions")


def star(spark: SparkSession, sf: str) -> Star:
    return Star(spark, lambda name: shape(spark, sf, name))


def stored_star(spark: SparkSession, sf: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Cleaned tables and star as files, the way jobs that read every table several times meet them:
    stored once in a session."""
    cleaned = {n: workspace.once(spark, f"{n} {sf}", lambda n=n: shape(spark, sf, n)) for n in CLEANED}
    return cleaned, stored_once(spark, sf, Star(spark, cleaned.__getitem__))


def stored_once(spark: SparkSession, sf: str, built: Star) -> dict[str, DataFrame]:
    """The star's tables as files, stored once in a session."""
    stored = {}
    for name in Star.NAMES:  # dependencies come first, so each table is built from stored ones
        stored[name] = workspace.once(spark, f"{name} {sf}", lambda n=name: built[n])
        built._built[name] = stored[name]
    return stored


def read_once_star(spark: SparkSession, sf: str) -> Star:
    """The star for a job that reads each of its tables once. Of the cleaned tables those that several
    tables are built from by a shuffle of their rows are stored; nothing that holds long texts is."""
    kept = lambda name: workspace.once(spark, f"{name} {sf}", lambda: shape(spark, sf, name))
    return Star(spark, lambda name: kept(name) if name in ("s_awards", "s_authorships") else shape(spark, sf, name))


def date_key_sql(day: str) -> str:
    return (
        f"CASE WHEN {day} BETWEEN DATE '1950-01-01' AND DATE '2035-12-31' "
        f"THEN CAST(strftime({day}, '%Y%m%d') AS INTEGER) ELSE -1 END"
    )


GOLD = {
    "dim_date": """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, strftime(d, '%b') AS month_name,
       CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS day_of_week_iso,
       isodow(d) IN (6, 7) AS is_weekend,
       CAST(CASE WHEN month(d) >= 10 THEN year(d) + 1 ELSE year(d) END AS INTEGER) AS us_fiscal_year
FROM generate_series(DATE '1950-01-01', DATE '2035-12-31', INTERVAL 1 DAY) t(d)
UNION ALL SELECT -1, NULL, NULL, NULL, NULL, 'Desconocido', NULL, NULL, NULL, NULL""",
    "dim_topic": """
SELECT topic_id AS topic_key, topic_name, topic_description, keywords, subfield_id, subfield_name,
       field_id, field_name, domain_id, domain_name FROM {s_topics}
UNION ALL SELECT 'UNKNOWN', 'Tema desconocido', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL""",
    "dim_funder": """
SELECT funder_id AS funder_key, funder_name, country_code, is_global_south, ror_id, homepage_url,
       awards_count, works_count FROM {s_funders}
UNION ALL SELECT 'UNKNOWN', 'Financiador desconocido', NULL, NULL, NULL, NULL, NULL, NULL""",
    "dim_institution": """
SELECT * FROM {s_institutions}
UNION ALL SELECT 'UNKNOWN', 'Institución desconocida', NULL, NULL, NULL""",
    "dim_work": f"""
SELECT work_id AS work_key, doi, title, abstract_text, has_abstract, publication_year,
       {date_key_sql("publication_date")} AS publication_date_key, work_type, language,
       cited_by_count, fwci, is_retracted, coalesce(t.topic_key, 'UNKNOWN') AS topic_key,
       authors_count, _loaded_at
FROM {{s_works}} LEFT JOIN {{dim_topic}} t ON t.topic_key = primary_topic_id""",
    "dim_author": """
SELECT author_id AS author_key, author_name, orcid, _loaded_at FROM {s_authorships}
QUALIFY row_number() OVER (PARTITION BY author_id
                           ORDER BY _loaded_at DESC, (orcid IS NULL), author_name) = 1""",
    "brg_work_author": """
SELECT a.work_id AS work_key, a.author_id AS author_key, author_position, is_corresponding,
       institution_id, institution_country_code, a._loaded_at
FROM {s_authorships} a JOIN {dim_work} w ON w.work_key = a.work_id
JOIN {dim_author} u ON u.author_key = a.author_id""",
    "fact_awards": f"""
SELECT award_id AS award_key, coalesce(f.funder_key, 'UNKNOWN') AS funder_key,
       coalesce(t.topic_key, 'UNKNOWN') AS topic_key,
       coalesce(i.institution_key, 'UNKNOWN') AS institution_key,
       {date_key_sql("start_date")} AS start_date_key, {date_key_sql("end_date")} AS end_date_key,
       amount, currency, amount_usd,
       CAST(date_diff('day', start_date, end_date) AS INTEGER) AS duration_days,
       funded_outputs_count, institutions_count, 1 AS award_count, is_amount_invalid,
       is_start_date_from_year, has_inconsistent_dates, _loaded_at
FROM {{s_awards}} a
LEFT JOIN {{dim_funder}} f ON f.funder_key = a.funder_id
LEFT JOIN {{dim_topic}} t ON t.topic_key = a.primary_topic_id
LEFT JOIN {{dim_institution}} i ON i.institution_key = a.lead_institution_id""",
    "fact_award_works": """
SELECT award_id AS award_key, work_id AS work_key, fa.funder_key, w.topic_key,
       w.publication_date_key, 1 AS funded_work_count, wa._loaded_at
FROM {s_work_awards} wa JOIN {dim_work} w ON w.work_key = wa.work_id
JOIN {fact_awards} fa ON fa.award_key = wa.award_id""",
    "authors_by_work": """
SELECT work_key,
       array_to_string(list_sort(list_distinct(list(b.author_key))), '|') AS author_keys,
       CAST(count(DISTINCT b.author_key) AS INTEGER) AS linked_authors_count,
       max(CASE WHEN author_position = 'first' THEN b.author_key END) AS first_author_key,
       arg_max(author_name, b.author_key) FILTER (author_position = 'first') AS first_author_name,
       coalesce(array_to_string(list_sort(list_distinct(list(b.author_key) FILTER (is_corresponding))), '|'), '')
         AS corresponding_author_keys,
       coalesce(array_to_string(list_sort(list_distinct(list(institution_country_code)
         FILTER (institution_country_code IS NOT NULL))), '|'), '') AS author_country_codes
FROM {brg_work_author} b JOIN {dim_author} a ON a.author_key = b.author_key
GROUP BY work_key""",
}


def joined_sql(title: str, body: str) -> str:
    t, b = f"nullif(trim({title}), '')", f"nullif(trim({body}), '')"
    return (
        f"CASE WHEN {t} IS NULL THEN {b} WHEN {b} IS NULL THEN {t} "
        f"WHEN regexp_matches({t}, '[.!?:;…]$') THEN {t} || ' ' || {b} ELSE {t} || '. ' || {b} END"
    )


GOLD["obt"] = f"""
SELECT l.award_key, l.work_key, 1 AS label,
       da.funder_award_id, da.award_title, da.award_description, da.has_description,
       da.funder_scheme, da.funding_type,
       fa.funder_key, f.funder_name, f.country_code AS funder_country_code, f.is_global_south,
       fa.institution_key, i.institution_name AS lead_institution_name,
       i.country_code AS lead_institution_country_code, i.institution_type AS lead_institution_type,
       fa.topic_key AS award_topic_key, ta.topic_name AS award_topic_name,
       ta.subfield_name AS award_subfield_name, ta.field_name AS award_field_name,
       ta.domain_name AS award_domain_name,
       fa.start_date_key, sd.full_date AS award_start_date, sd.year AS award_start_year,
       sd.us_fiscal_year AS award_us_fiscal_year, fa.end_date_key,
       fa.amount, fa.currency, fa.amount_usd, fa.duration_days, fa.funded_outputs_count,
       fa.institutions_count, fa.is_amount_invalid, fa.has_inconsistent_dates,
       w.doi AS work_doi, w.title AS work_title, w.abstract_text, w.has_abstract, w.publication_year,
       l.publication_date_key, pd.full_date AS publication_date, w.work_type, w.language,
       w.cited_by_count, w.fwci, w.is_retracted, w.authors_count,
       l.topic_key AS work_topic_key, tw.topic_name AS work_topic_name,
       tw.subfield_name AS work_subfield_name, tw.field_name AS work_field_name,
       tw.domain_name AS work_domain_name,
       coalesce(ab.author_keys, '') AS author_keys,
       coalesce(ab.linked_authors_count, 0) AS linked_authors_count,
       ab.first_author_key, ab.first_author_name,
       coalesce(ab.corresponding_author_keys, '') AS corresponding_author_keys,
       coalesce(ab.author_country_codes, '') AS author_country_codes,
       {joined_sql("da.award_title", "da.award_description")} AS award_text,
       {joined_sql("w.title", "w.abstract_text")} AS work_text
FROM {{fact_award_works}} l
JOIN {{fact_awards}} fa ON fa.award_key = l.award_key
JOIN {{dim_award}} da ON da.award_key = l.award_key
JOIN {{dim_funder}} f ON f.funder_key = fa.funder_key
JOIN {{dim_institution}} i ON i.institution_key = fa.institution_key
JOIN {{dim_work}} w ON w.work_key = l.work_key
JOIN {{dim_topic}} ta ON ta.topic_key = fa.topic_key
JOIN {{dim_topic}} tw ON tw.topic_key = l.topic_key
JOIN {{dim_date}} sd ON sd.date_key = fa.start_date_key
JOIN {{dim_date}} pd ON pd.date_key = l.publication_date_key
LEFT JOIN {{authors_by_work}} ab ON ab.work_key = l.work_key"""
GOLD["dim_award"] = """
SELECT award_id AS award_key, funder_award_id, award_title, award_description, has_description,
       funder_scheme, funding_type, doi, landing_page_url, provenance, _loaded_at FROM {s_awards}"""


def gold_oracle(sql: str, **ctes: str) -> str:
    return oracle(sql, **GOLD, **ctes)


SECONDS = "strftime(_loaded_at, '%Y-%m-%d %H:%M:%S') AS _loaded_at"


# ---------------------------------------------------------------- dimensions and facts
@query("calendar_dim", gold_oracle("SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date) FROM {dim_date}"))
def calendar_dim(spark, sf):
    return gold.calendar(spark)


@query(
    "unknown_union",
    gold_oracle(
        "SELECT 'funder' AS dimension, funder_key AS member_key, funder_name AS member_name,"
        " country_code AS detail FROM {dim_funder}"
        " UNION ALL SELECT 'topic', topic_key, topic_name, field_name FROM {dim_topic}"
    ),
)
def unknown_union(spark, sf):
    funder = gold.dim_funder(shape(spark, sf, "s_funders"))
    topic = gold.dim_topic(shape(spark, sf, "s_topics"))
    member = lambda df, name, key, label, detail: df.select(
        F.lit(name).alias("dimension"), F.col(key).alias("member_key"),
        F.col(label).alias("member_name"), F.col(detail).alias("detail"),
    )
    return member(funder, "funder", "funder_key", "funder_name", "country_code").unionByName(
        member(topic, "topic", "topic_key", "topic_name", "field_name")
    )


@query(
    "dim_entity",
    gold_oracle(f"""
SELECT 'award' AS entity, award_key AS entity_key, award_title AS title, award_description AS detail,
       has_description AS flag, CAST(NULL AS VARCHAR) AS topic_key,
       CAST(NULL AS INTEGER) AS date_key, {SECONDS} FROM {{dim_award}}
UNION ALL SELECT 'work', work_key, title, md5(abstract_text), has_abstract, topic_key,
       publication_date_key, {SECONDS} FROM {{dim_work}}
UNION ALL SELECT 'author', author_key, author_name, orcid, orcid IS NOT NULL, NULL, NULL, {SECONDS}
       FROM {{dim_author}}"""),
)
def dim_entity(spark, sf):
    t = star(spark, sf)
    null = lambda ty: F.lit(None).cast(ty)
    loaded = F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at")
    award = t["dim_award"].select(
        F.lit("award").alias("entity"), F.col("award_key").alias("entity_key"),
        F.col("award_title").alias("title"), F.col("award_description").alias("detail"),
        F.col("has_description").alias("flag"), null("string").alias("topic_key"),
        null("int").alias("date_key"), loaded,
    )
    work = t["dim_work"].select(
        F.lit("work").alias("entity"), F.col("work_key").alias("entity_key"), "title",
        F.md5("abstract_text").alias("detail"), F.col("has_abstract").alias("flag"), "topic_key",
        F.col("publication_date_key").alias("date_key"), loaded,
    )
    author = t["dim_author"].select(
        F.lit("author").alias("entity"), F.col("author_key").alias("entity_key"),
        F.col("author_name").alias("title"), F.col("orcid").alias("detail"),
        F.col("orcid").isNotNull().alias("flag"), null("string").alias("topic_key"),
        null("int").alias("date_key"), loaded,
    )
    return award.unionByName(work).unionByName(author)


@query("bridge", gold_oracle(f"SELECT * REPLACE ({SECONDS}) FROM {{brg_work_author}}"))
def bridge(spark, sf):
    return star(spark, sf)["brg_work_author"]


@query(
    "fact_main",
    gold_oracle(
        f"SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount, CAST(amount_usd AS DOUBLE) AS amount_usd,"
        f" {SECONDS}) FROM {{fact_awards}}"
    ),
)
def fact_main(spark, sf):
    return star(spark, sf)["fact_awards"]


@query("fact_links", gold_oracle(f"SELECT * REPLACE ({SECONDS}) FROM {{fact_award_works}}"))
def fact_links(spark, sf):
    return star(spark, sf)["fact_award_works"]


# ---------------------------------------------------------------- joins
@query(
    "unknown_member",
    gold_oracle(
        "SELECT award_key, funder_key, topic_key, institution_key FROM {fact_awards}"
        " WHERE 'UNKNOWN' IN (funder_key, topic_key, institution_key)"
    ),
)
def unknown_member(spark, sf):
    rows = shape(spark, sf, "s_awards").select(
        F.col("award_id").alias("award_key"), "funder_id", "primary_topic_id", "lead_institution_id"
    )
    t = lambda name: shape(spark, sf, name)
    rows = L.resolve_key(rows, "funder_id", t("s_funders"), "funder_id", "funder_key")
    rows = L.resolve_key(rows, "primary_topic_id", t("s_topics"), "topic_id", "topic_key")
    rows = L.resolve_key(
        rows, "lead_institution_id", t("s_institutions"), "institution_key", "institution_key"
    )
    keys = ["funder_key", "topic_key", "institution_key"]
    unknown = F.array_contains(F.array(*keys), L.UNKNOWN)
    return rows.filter(unknown).select("award_key", *keys)


@query(
    "strict_links",
    oracle("""
SELECT wa.award_id, wa.work_id FROM {s_work_awards} wa
JOIN {s_works} w ON w.work_id = wa.work_id AND w.primary_topic_id IS NOT NULL
JOIN {s_awards} a ON a.award_id = wa.award_id AND a.funder_id IS NOT NULL"""),
)
def strict_links(spark, sf):
    links = shape(spark, sf, "s_work_awards").select("award_id", "work_id")
    works = shape(spark, sf, "s_works").filter(F.col("primary_topic_id").isNotNull())
    awards = shape(spark, sf, "s_awards").filter(F.col("funder_id").isNotNull())
    return L.in_scope(L.in_scope(links, works, "work_id"), awards, "award_id")


@query(
    "anti_orphans",
    oracle("""
SELECT lead_institution_id, count(*) AS awards FROM {s_awards} a
WHERE lead_institution_id IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM {s_institutions} i
  WHERE i.institution_key = a.lead_institution_id AND i.institution_type = 'company')
GROUP BY lead_institution_id"""),
)
def anti_orphans(spark, sf):
    awards = shape(spark, sf, "s_awards").filter(F.col("lead_institution_id").isNotNull())
    companies = shape(spark, sf, "s_institutions").filter("institution_type = 'company'")
    parents = companies.select(F.col("institution_key").alias("lead_institution_id"))
    lost = L.missing_parents(awards, parents, "lead_institution_id")
    return lost.groupBy("lead_institution_id").agg(F.count(F.lit(1)).alias("awards"))


@query(
    "orphan_markers",
    oracle("""
SELECT count_if(f.funder_id IS NULL) AS orphans_funder,
       count_if(t.topic_id IS NULL) AS orphans_topic,
       count_if(i.institution_key IS NULL) AS orphans_institution, count(*) AS links
FROM {s_work_awards} l JOIN {s_awards} a ON a.award_id = l.award_id
LEFT JOIN {s_funders} f ON f.funder_id = a.funder_id
LEFT JOIN {s_topics} t ON t.topic_id = a.primary_topic_id
LEFT JOIN {s_institutions} i ON i.institution_key = a.lead_institution_id"""),
)
def orphan_markers(spark, sf):
    t = lambda name: shape(spark, sf, name)
    awards = t("s_awards").select("award_id", "funder_id", "primary_topic_id", "lead_institution_id")
    rows = t("s_work_awards").select("award_id").join(awards, "award_id")
    rows = L.left_with_marker(rows, t("s_funders").select("funder_id"), "funder_id", "funder")
    topics = t("s_topics").select(F.col("topic_id").alias("primary_topic_id"))
    rows = L.left_with_marker(rows, topics, "primary_topic_id", "topic")
    places = t("s_institutions").select(F.col("institution_key").alias("lead_institution_id"))
    rows = L.left_with_marker(rows, places, "lead_institution_id", "institution")
    names = ("funder", "topic", "institution")
    return rows.agg(*L.orphan_counts(names), F.count(F.lit(1)).alias("links"))


@query(
    "role_playing",
    gold_oracle("""
SELECT 'W' || p_partkey AS work_key, cn.n_name AS customer_topic_name, cr.r_name AS customer_field_name,
       sn.n_name AS supplier_topic_name, sr.r_name AS supplier_field_name, count(*) AS n
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey
JOIN nation cn ON cn.n_nationkey = c_nationkey JOIN region cr ON cr.r_regionkey = cn.n_regionkey
JOIN nation sn ON sn.n_nationkey = s_nationkey JOIN region sr ON sr.r_regionkey = sn.n_regionkey
GROUP BY ALL"""),
)
def role_playing(spark, sf):
    t = lambda name: shape(spark, sf, name)
    topics = t("s_topics")
    role = lambda who: L.as_role(
        topics,
        {"topic_id": f"{who}_topic", "topic_name": f"{who}_topic_name", "field_name": f"{who}_field_name"},
    )
    topic_of = lambda c: F.concat(F.lit("T"), F.col(c))
    customers = t("customer").select(
        F.col("c_custkey").alias("o_custkey"), topic_of("c_nationkey").alias("customer_topic")
    )
    orders = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    suppliers = t("supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), topic_of("s_nationkey").alias("supplier_topic")
    )
    lines = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    lines = lines.join(orders.join(customers, "o_custkey"), "l_orderkey").join(suppliers, "l_suppkey")
    # counted per key pair first: the names join the counts, not the lines
    pairs = lines.groupBy("l_partkey", "customer_topic", "supplier_topic").agg(
        F.count(F.lit(1)).alias("n")
    )
    named = pairs.join(role("customer"), "customer_topic").join(role("supplier"), "supplier_topic")
    return named.select(
        F.concat(F.lit("W"), F.col("l_partkey")).alias("work_key"), "customer_topic_name",
        "customer_field_name", "supplier_topic_name", "supplier_field_name", "n",
    )


@query(
    "scoped_read",
    "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem"
    " WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_returnflag = 'R'",
)
def scoped_read(spark, sf):
    return read_columns(
        spark, f"{sf}/lineitem.parquet", "l_orderkey", "l_partkey", "l_quantity",
        where="l_shipdate >= TIMESTAMP_NTZ '1998-01-01 00:00:00' AND l_returnflag = 'R'",
    )


@query(
    "in_scope_semi",
    gold_oracle("""
SELECT institution_key, institution_name FROM {dim_institution} WHERE institution_key IN (
  SELECT institution_key FROM {fact_awards} WHERE is_amount_invalid AND award_key IN (
    SELECT award_id FROM {s_work_awards}))"""),
)
def in_scope_semi(spark, sf):
    t = star(spark, sf)
    awards = t["fact_awards"].filter("is_amount_invalid").select("award_key", "institution_key")
    linked = shape(spark, sf, "s_work_awards").select(F.col("award_id").alias("award_key"))
    used = L.in_scope(awards, linked, "award_key")
    return L.in_scope(t["dim_institution"], used, "institution_key").select(
        "institution_key", "institution_name"
    )


# ---------------------------------------------------------------- checks and the wide table
@query(
    "unique_check",
    gold_oracle("""
SELECT 'lines' AS name, count(*) AS "rows",
       (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS distinct_keys
FROM lineitem
UNION ALL SELECT 'links', count(*), (SELECT count(*) FROM (SELECT DISTINCT award_id, work_id FROM {s_work_awards}))
FROM {s_work_awards}
UNION ALL SELECT 'funder_of_award', count(*),
  (SELECT count(*) FROM (SELECT DISTINCT award_id, funder_id FROM {s_awards} WHERE funder_id IS NOT NULL))
FROM {s_awards}"""),
)
def unique_check(spark, sf):
    t = lambda name: shape(spark, sf, name)
    return K.union_all(
        [
            K.key_counts(t("lineitem"), ["l_orderkey", "l_linenumber"], "lines"),
            K.key_counts(t("s_work_awards"), ["award_id", "work_id"], "links"),
            K.key_counts(t("s_awards"), ["award_id", "funder_id"], "funder_of_award"),
        ]
    )


@query("authors_by_work", gold_oracle("SELECT * FROM {authors_by_work}"))
def authors_by_work(spark, sf):
    t = star(spark, sf)
    return obt.authors_by_work(t["brg_work_author"], t["dim_author"])


WIDE_ORACLE = gold_oracle(
    "SELECT * REPLACE (CAST(award_start_date AS VARCHAR) AS award_start_date,"
    " CAST(publication_date AS VARCHAR) AS publication_date, CAST(amount AS DOUBLE) AS amount,"
    " CAST(amount_usd AS DOUBLE) AS amount_usd, md5(abstract_text) AS abstract_text,"
    " md5(work_text) AS work_text) FROM {obt}"
)


@query("obt", WIDE_ORACLE)
def wide_table(spark, sf):
    """The wide table; the two long texts are shown by their digests."""
    shown = {"abstract_text": F.md5, "work_text": F.md5}
    return obt.published(obt.flatten(read_once_star(spark, sf), shown, compact=True)).drop("_obt_built_at")


@query(
    "obt_grain",
    gold_oracle("""
SELECT count(*) AS base_rows, count(*) AS obt_rows, count(*) AS obt_distinct_keys,
       CAST(0 AS BIGINT) AS orphans_total, 'OK' AS status FROM {s_work_awards}"""),
)
def obt_grain(spark, sf):
    """The whole job with its gates: check, write, validate, publish; one row of evidence."""
    store = SnapshotStore(spark, workspace.new_folder(spark, "obt"))
    row = reports.run_obt(stored_once(spark, sf, read_once_star(spark, sf)), store, "obt_award_work")
    return row.select(
        "base_rows", "obt_rows", "obt_distinct_keys", "orphans_total", "status"
    )


@query(
    "grain_check",
    gold_oracle("""
SELECT (SELECT count(*) FROM {s_awards}) AS parent_rows, count(*) AS fact_rows,
       count(DISTINCT award_key) AS fact_distinct FROM {fact_awards}"""),
)
def grain_check(spark, sf):
    return reports.grain_counts(
        shape(spark, sf, "s_awards"), star(spark, sf)["fact_awards"], "award_key"
    )


@query(
    "usd_rule",
    oracle("""
SELECT o_orderkey, count_if(o_totalprice > 300000 AND (o_orderstatus <> 'F' OR o_orderkey % 101 = 0)) AS violations
FROM orders GROUP BY o_orderkey
HAVING count_if(o_totalprice > 300000 AND (o_orderstatus <> 'F' OR o_orderkey % 101 = 0)) > 0"""),
)
def usd_rule(spark, sf):
    facts = shape(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("amount"),
        F.when(F.col("o_orderstatus") == "F", "USD").otherwise("EUR").alias("currency"),
        F.when(F.col("o_totalprice") > 300000, F.col("o_totalprice")
               + F.when(F.col("o_orderkey") % 101 == 0, 1).otherwise(0)).alias("amount_usd"),
    )
    bad = reports.usd_violations(facts)
    return bad.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("violations"))


# ---------------------------------------------------------------- roll-ups
@query(
    "funding_rollup",
    gold_oracle("""
SELECT funder_key, topic_key, start_date_key // 10000 AS start_year,
       CAST(sum(amount_usd) AS DOUBLE) AS usd, CAST(sum(award_count) AS BIGINT) AS awards
FROM {fact_awards} WHERE start_date_key > 0 GROUP BY ALL"""),
)
def funding_rollup(spark, sf):
    return reports.funding_by_funder_topic_year(star(spark, sf)["fact_awards"])


@query(
    "top_institutions",
    gold_oracle("""
SELECT institution_key, institution_name, awards FROM (
  SELECT institution_key, count(*) AS awards FROM {fact_awards}
  WHERE institution_key <> 'UNKNOWN' GROUP BY 1)
JOIN {dim_institution} USING (institution_key)
ORDER BY awards DESC, institution_key LIMIT 10"""),
)
def top_institutions(spark, sf):
    t = star(spark, sf)
    return reports.most_awarded(t["fact_awards"], t["dim_institution"], 10)


@query(
    "duration_by_type",
    gold_oracle("""
SELECT funding_type, count(*) AS awards, round(avg(duration_days), 6) AS mean_days,
       min(duration_days) AS min_days, max(duration_days) AS max_days
FROM {fact_awards} JOIN {dim_award} USING (award_key)
WHERE duration_days IS NOT NULL GROUP BY funding_type"""),
)
def duration_by_type(spark, sf):
    t = star(spark, sf)
    return reports.duration_by_type(t["fact_awards"], t["dim_award"])


@query(
    "calendar_rollup",
    gold_oracle("""
SELECT us_fiscal_year, quarter, day_of_week_iso, is_weekend, CAST(sum(award_count) AS BIGINT) AS awards,
       CAST(sum(amount_usd) AS DOUBLE) AS usd
FROM {fact_awards} f JOIN {dim_date} d ON d.date_key = f.start_date_key
GROUP BY ALL"""),
)
def calendar_rollup(spark, sf):
    t = star(spark, sf)
    return reports.awards_by_calendar(t["fact_awards"], t["dim_date"])


@query(
    "join_text",
    f"""
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority || '?'
                                   WHEN o_orderkey % 4 = 1 THEN ' ' ELSE o_orderpriority END AS title,
                  CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN '  '
                       ELSE ' body ' || o_custkey END AS body FROM orders)
SELECT o_orderkey, {joined_sql("title", "body")} AS joined FROM t""",
)
def join_text_query(spark, sf):
    t = select(spark, sf, """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority || '?'
                        WHEN o_orderkey % 4 = 1 THEN ' ' ELSE o_orderpriority END AS title,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN '  '
            ELSE ' body ' || CAST(o_custkey AS STRING) END AS body FROM {orders}""")
    return t.select("o_orderkey", join_text(F.col("title"), F.col("body")).alias("joined"))
