"""Star schema: conformed dimensions with an unknown member, facts, and the author bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import text as T
from ..functions import variant as V
from ..operators.lookup import resolve_key, with_unknown_member
from ..operators.ordering import first_per_key

# Names of the unknown members, as the published star schema spells them.
UNKNOWN_FUNDER = "Financiador desconocido"
UNKNOWN_TOPIC = "Tema desconocido"
UNKNOWN_INSTITUTION = "Institución desconocida"
UNKNOWN_MONTH = "Desconocido"


def calendar(
    spark: SparkSession,
    first: str = R.CALENDAR_FIRST_DAY,
    last: str = R.CALENDAR_LAST_DAY,
) -> DataFrame:
    """One row per day plus the -1 row."""
    span = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    day = F.col("full_date")
    iso_weekday = (F.weekday(day) + 1).alias("day_of_week_iso")
    days = spark.range(1).select(F.explode(span).alias("full_date")).select(
        R.date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.monthname(day).alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        iso_weekday,
        (F.weekday(day) >= 5).alias("is_weekend"),
        R.us_fiscal_year(day).alias("us_fiscal_year"),
    )
    return with_unknown_member(days, date_key=R.UNKNOWN_DATE_KEY, month_name=UNKNOWN_MONTH)


def dim_funder(funders: DataFrame) -> DataFrame:
    named = funders.select(
        F.col("funder_id").alias("funder_key"),
        "funder_name", "country_code", "is_global_south", "ror_id", "homepage_url",
        "awards_count", "works_count",
    )
    return with_unknown_member(named, funder_key="UNKNOWN", funder_name=UNKNOWN_FUNDER)


def dim_topic(topics: DataFrame) -> DataFrame:
    named = topics.select(
        F.col("topic_id").alias("topic_key"),
        "topic_name", "topic_description", "keywords",
        *[f"{level}_{part}" for level in ("subfield", "field", "domain") for part in ("id", "name")],
    )
    return with_unknown_member(named, topic_key="UNKNOWN", topic_name=UNKNOWN_TOPIC)


def dim_institution(awards: DataFrame, first_run: bool = True) -> DataFrame:
    """Institutions named in the awards' nested lists; the last load that names one describes it."""
    item = lambda path: V.text_at(F.col("element"), path)
    named = V.explode_elements(awards, "institutions_awarded", "_loaded_at").select(
        T.short_id(item("id")).alias("institution_key"),
        T.clean_text(item("display_name")).alias("institution_name"),
        T.upper_code(item("country_code")).alias("country_code"),
        T.lower_code(item("type")).alias("institution_type"),
        T.short_id(item("ror")).alias("ror_id"),
        "_loaded_at",
    )
    tie_break = [
        F.asc_nulls_last(c) for c in ("institution_name", "country_code", "institution_type", "ror_id")
    ]
    latest = first_per_key(
        named.filter(F.col("institution_key").isNotNull()),
        ["institution_key"],
        [F.desc("_loaded_at"), *tie_break],
    )
    if not first_run:
        return latest
    return with_unknown_member(
        latest,
        institution_key="UNKNOWN",
        institution_name=UNKNOWN_INSTITUTION,
        _loaded_at="1900-01-01 00:00:00",
    )


def dim_award(awards: DataFrame) -> DataFrame:
    return awards.select(
        F.col("award_id").alias("award_key"),
        "funder_award_id", "award_title", "award_description", "has_description",
        "funder_scheme", "funding_type", "doi", "landing_page_url", "provenance", "_loaded_at",
    )


def dim_work(works: DataFrame, topic_dim: DataFrame) -> DataFrame:
    keyed = resolve_key(works, "primary_topic_id", topic_dim, "topic_key", "topic_key")
    return keyed.select(
        F.col("work_id").alias("work_key"),
        "doi", "title", "abstract_text", "has_abstract", "publication_year",
        R.date_key(F.col("publication_date")).alias("publication_date_key"),
        "work_type", "language", "cited_by_count", "fwci", "is_retracted",
        "topic_key", "authors_count", "_loaded_at",
    )


def dim_author(authorships: DataFrame) -> DataFrame:
    """Newest authorship describes the author; one with an orcid is preferred within a load."""
    best = first_per_key(
        authorships.select("author_id", "author_name", "orcid", "_loaded_at"),
        ["author_id"],
        [F.desc("_loaded_at"), F.col("orcid").isNull(), F.asc_nulls_last("author_name"),
         F.asc_nulls_last("orcid")],
    )
    return best.withColumnRenamed("author_id", "author_key")


def bridge(authorships: DataFrame, works: DataFrame, authors: DataFrame) -> DataFrame:
    """Works are met last: what is listed by work then lies where it is needed."""
    links = authorships.select(
        F.col("work_id").alias("work_key"),
        F.col("author_id").alias("author_key"),
        "author_position", "is_corresponding", "institution_id", "institution_country_code",
        "_loaded_at",
    )
    return links.join(authors.select("author_key"), "author_key", "left_semi").join(
        works.select("work_key"), "work_key", "left_semi"
    )


def fact_awards(
    awards: DataFrame,
    award_dim: DataFrame,
    funder_dim: DataFrame,
    topic_dim: DataFrame,
    institution_dim: DataFrame,
) -> DataFrame:
    rows = awards.join(
        award_dim.select(F.col("award_key").alias("award_id")), "award_id", "left_semi"
    )
    rows = resolve_key(rows, "funder_id", funder_dim, "funder_key", "funder_key")
    rows = resolve_key(rows, "primary_topic_id", topic_dim, "topic_key", "topic_key")
    rows = resolve_key(
        rows, "lead_institution_id", institution_dim, "institution_key", "institution_key"
    )
    return rows.select(
        F.col("award_id").alias("award_key"),
        "funder_key", "topic_key", "institution_key",
        R.date_key(F.col("start_date")).alias("start_date_key"),
        R.date_key(F.col("end_date")).alias("end_date_key"),
        "amount", "currency", "amount_usd",
        F.datediff("end_date", "start_date").alias("duration_days"),
        "funded_outputs_count", "institutions_count",
        F.lit(1).alias("award_count"),
        "is_amount_invalid", "is_start_date_from_year", "has_inconsistent_dates", "_loaded_at",
    )


def fact_award_works(links: DataFrame, work_dim: DataFrame, awards: DataFrame) -> DataFrame:
    return (
        links.select(
            F.col("award_id").alias("award_key"), F.col("work_id").alias("work_key"), "_loaded_at"
        )
        .join(awards.select("award_key", "funder_key"), "award_key")
        .join(work_dim.select("work_key", "topic_key", "publication_date_key"), "work_key")
        .select(
            "award_key", "work_key", "funder_key", "topic_key", "publication_date_key",
            F.lit(1).alias("funded_work_count"), "_loaded_at",
        )
    )
