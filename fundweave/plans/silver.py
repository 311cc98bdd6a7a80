"""Raw records (one VARIANT per row) to typed, versioned and current-state tables.

Every raw table has the columns raw, _source_file, _source_row_number, _loaded_at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import text as T
from ..functions import variant as V
from ..operators.ordering import first_per_key, newest_first

LOAD_COLUMNS = ["_source_file", "_loaded_at"]


def _same_names(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def _keep_one_copy(versions: DataFrame, key: str) -> DataFrame:
    """A version loaded twice (retry, repeated backfill) keeps its most recent copy."""
    return first_per_key(versions, [key, "updated_at"], newest_first("_loaded_at", "_source_file"))


def latest_version(history: DataFrame, key: str) -> DataFrame:
    """The extra file order only breaks ties between versions loaded at the same instant."""
    order = newest_first("updated_at", "_loaded_at")
    if "_source_file" in history.columns:
        order += newest_first("_source_file")
    return first_per_key(history, [key], order)


def award_history(raw: DataFrame) -> DataFrame:
    """One row per award version (award_id, updated_at)."""
    texts = {
        **_same_names("id", "updated_date", "created_date", "display_name", "description",
                      "funder_award_id", "funder_scheme", "funding_type", "amount", "currency",
                      "start_date", "start_year", "end_date", "end_year", "funded_outputs_count",
                      "doi", "landing_page_url", "provenance"),
        "funder": "funder.id", "funder_display_name": "funder.display_name",
        "topic": "primary_topic.id", "lead_institution": "institution_awarded[0].id",
    }
    nodes = {"institutions_awarded": "institution_awarded", "funded_outputs": "funded_outputs"}
    c = F.col
    read = V.extract(raw, texts, nodes, LOAD_COLUMNS).select(
        T.short_id(c("id")).alias("award_id"),
        R.safe_timestamp(c("updated_date")).alias("updated_at"),
        R.safe_timestamp(c("created_date")).alias("created_at"),
        T.clean_text(c("display_name")).alias("award_title"),
        T.clean_text(c("description")).alias("award_description"),
        T.trimmed(c("funder_award_id")).alias("funder_award_id"),
        T.trimmed(c("funder_scheme")).alias("funder_scheme"),
        T.lower_code(c("funding_type")).alias("funding_type"),
        T.short_id(c("funder")).alias("funder_id"),
        T.clean_text(c("funder_display_name")).alias("funder_name"),
        R.safe_money(c("amount")).alias("_amount"),
        T.upper_code(c("currency")).alias("currency"),
        R.safe_date(c("start_date")).alias("_start"),
        R.safe_int(c("start_year")).alias("start_year"),
        R.safe_date(c("end_date")).alias("_end"),
        R.safe_int(c("end_year")).alias("end_year"),
        T.short_id(c("topic")).alias("primary_topic_id"),
        "institutions_awarded",
        T.short_id(c("lead_institution")).alias("lead_institution_id"),
        "funded_outputs",
        R.safe_int(c("funded_outputs_count")).alias("_outputs"),
        T.lower_code(c("doi")).alias("doi"),
        T.trimmed(c("landing_page_url")).alias("landing_page_url"),
        T.trimmed(c("provenance")).alias("provenance"),
        *LOAD_COLUMNS,
    ).filter(F.col("award_id").isNotNull())

    amount = F.col("_amount")
    start = F.coalesce("_start", R.start_from_year(F.col("start_year")))
    in_usd = F.when(F.col("currency") == "USD", R.positive_or_null(amount))
    ruled = read.withColumns(
        {
            "has_description": F.col("award_description").isNotNull(),
            "amount": R.positive_or_null(amount),
            "is_amount_invalid": R.is_non_positive(amount),
            "amount_usd": in_usd,
            "start_date": start,
            "is_start_date_from_year": F.col("_start").isNull()
            & R.start_from_year(F.col("start_year")).isNotNull(),
            "institutions_count": F.coalesce(V.array_length(F.col("institutions_awarded")), F.lit(0)),
            "funded_outputs_count": F.coalesce(
                "_outputs", V.array_length(F.col("funded_outputs")), F.lit(0)
            ),
        }
    ).withColumns(
        {
            "has_inconsistent_dates": R.ends_before(F.col("_end"), F.col("start_date")),
            "end_date": F.when(~R.ends_before(F.col("_end"), F.col("start_date")), F.col("_end")),
        }
    )
    return _keep_one_copy(ruled.drop("_amount", "_start", "_end", "_outputs"), "award_id")


def work_history(raw: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row per publication version (work_id, updated_at). `as_of` bounds plausible years."""
    today = F.current_date() if as_of is None else as_of
    texts = {
        **_same_names("id", "updated_date", "doi", "title", "display_name", "publication_year",
                      "publication_date", "type", "language", "cited_by_count", "fwci",
                      "is_retracted"),
        "topic": "primary_topic.id",
    }
    nodes = _same_names("abstract_inverted_index", "authorships", "awards")
    c = F.col
    read = V.extract(raw, texts, nodes, LOAD_COLUMNS).select(
        T.short_id(c("id")).alias("work_id"),
        R.safe_timestamp(c("updated_date")).alias("updated_at"),
        T.lower_code(c("doi")).alias("doi"),
        F.coalesce(T.clean_text(c("title")), T.clean_text(c("display_name"))).alias("title"),
        R.safe_int(c("publication_year")).alias("_year"),
        R.safe_date(c("publication_date")).alias("publication_date"),
        T.lower_code(c("type")).alias("work_type"),
        T.lower_code(c("language")).alias("language"),
        R.non_negative_or_null(R.safe_int(c("cited_by_count"))).alias("cited_by_count"),
        R.safe_double(c("fwci")).alias("fwci"),
        F.coalesce(R.safe_bool(c("is_retracted")), F.lit(False)).alias("is_retracted"),
        T.short_id(c("topic")).alias("primary_topic_id"),
        *nodes,
        *LOAD_COLUMNS,
    ).filter(F.col("work_id").isNotNull())

    plausible = R.year_in_range(F.col("_year"), today)
    ruled = read.withColumns(
        {
            "has_title": F.col("title").isNotNull(),
            "publication_year": F.when(plausible, F.col("_year")),
            "is_publication_year_invalid": F.coalesce(~plausible, F.lit(False)),
            "authors_count": F.coalesce(V.array_length(F.col("authorships")), F.lit(0)),
            "awards_count": F.coalesce(V.array_length(F.col("awards")), F.lit(0)),
        }
    )
    return _keep_one_copy(ruled.drop("_year"), "work_id")


def award_state(history: DataFrame) -> DataFrame:
    """Current version of every award that appears in `history`."""
    return latest_version(history, "award_id")


def work_state(history: DataFrame) -> DataFrame:
    """Current version of every publication, with its abstract back as running text."""
    current = latest_version(history, "work_id")
    return current.withColumn(
        "abstract_text", V.inverted_index_text(F.col("abstract_inverted_index"))
    ).withColumn("has_abstract", F.col("abstract_text").isNotNull()).drop("abstract_inverted_index")


def work_authorships(works: DataFrame) -> DataFrame:
    """One row per (work, author): the first mention, in list order."""
    item = lambda path: V.text_at(F.col("element"), path)
    listed = V.explode_elements(works, "authorships", "work_id", "_loaded_at").select(
        "work_id",
        T.short_id(item("author.id")).alias("author_id"),
        T.clean_text(item("author.display_name")).alias("author_name"),
        T.short_id(item("author.orcid")).alias("orcid"),
        T.lower_code(item("author_position")).alias("author_position"),
        F.coalesce(R.safe_bool(item("is_corresponding")), F.lit(False)).alias("is_corresponding"),
        T.short_id(item("institutions[0].id")).alias("institution_id"),
        T.clean_text(item("institutions[0].display_name")).alias("institution_name"),
        T.upper_code(item("institutions[0].country_code")).alias("institution_country_code"),
        F.col("position").alias("author_order"),
        "_loaded_at",
    )
    known = listed.filter(F.col("author_id").isNotNull())
    return first_per_key(known, ["work_id", "author_id"], [F.col("author_order")])


def work_awards(works: DataFrame) -> DataFrame:
    """One row per (work, award): the first mention, in list order."""
    item = lambda path: V.text_at(F.col("element"), path)
    listed = V.explode_elements(works, "awards", "work_id", "_loaded_at").select(
        "work_id",
        T.short_id(item("id")).alias("award_id"),
        T.short_id(item("funder_id")).alias("funder_id"),
        T.trimmed(item("funder_award_id")).alias("funder_award_id"),
        F.col("position").alias("award_order"),
        "_loaded_at",
    )
    known = listed.filter(F.col("award_id").isNotNull())
    return first_per_key(known, ["work_id", "award_id"], [F.col("award_order")])


def funders(raw: DataFrame) -> DataFrame:
    texts = {
        **_same_names("id", "display_name", "description", "country_code", "is_global_south",
                      "homepage_url", "awards_count", "works_count", "updated_date"),
        "ror": "ids.ror",
    }
    c = F.col
    read = V.extract(raw, texts, {}, LOAD_COLUMNS).select(
        T.short_id(c("id")).alias("funder_id"),
        T.clean_text(c("display_name")).alias("funder_name"),
        T.clean_text(c("description")).alias("funder_description"),
        T.upper_code(c("country_code")).alias("country_code"),
        R.safe_bool(c("is_global_south")).alias("is_global_south"),
        T.short_id(c("ror")).alias("ror_id"),
        T.trimmed(c("homepage_url")).alias("homepage_url"),
        R.non_negative_or_null(R.safe_int(c("awards_count"))).alias("awards_count"),
        R.non_negative_or_null(R.safe_int(c("works_count"))).alias("works_count"),
        R.safe_timestamp(c("updated_date")).alias("updated_at"),
        *LOAD_COLUMNS,
    )
    return latest_version(read.filter(F.col("funder_id").isNotNull()), "funder_id")


def topics(raw: DataFrame) -> DataFrame:
    levels = ("subfield", "field", "domain")
    texts = _same_names("id", "display_name", "description", "works_count", "updated_date")
    for level in levels:
        texts |= {level: f"{level}.id", f"{level}_display_name": f"{level}.display_name"}
    c = F.col
    hierarchy = []
    for level in levels:
        hierarchy += [
            T.short_id(c(level)).alias(f"{level}_id"),
            T.clean_text(c(f"{level}_display_name")).alias(f"{level}_name"),
        ]
    read = V.extract(raw, texts, {"keywords": "keywords"}, LOAD_COLUMNS).select(
        T.short_id(c("id")).alias("topic_id"),
        T.clean_text(c("display_name")).alias("topic_name"),
        T.clean_text(c("description")).alias("topic_description"),
        "keywords",
        *hierarchy,
        R.safe_int(c("works_count")).alias("works_count"),
        R.safe_timestamp(c("updated_date")).alias("updated_at"),
        *LOAD_COLUMNS,
    )
    return latest_version(read.filter(F.col("topic_id").isNotNull()), "topic_id")
