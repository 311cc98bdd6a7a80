"""Pair queries: sampling, splitting, checking, features and encodings over links of the star."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import pairs as X
from ..operators import encode as E
from ..operators import ranking as K
from ..operators import sampling as S
from ..operators.lookup import as_role
from ..operators.ordering import first_per_key as first
from ..plans import obt, pairs as P
from ..sources import workspace
from ..sources.tables import columns_between, load_split as read_split, read_wide_csv, write_wide_csv
from . import star
from .registry import query
from .shape import SHAPES, oracle, select, shape

TRAIN, TEST = (1995, 1999), 2000  # the test tables' publication years run from 1995 to 2001

SHAPES["links"] = "SELECT work_id AS work_key, award_id AS award_key FROM {s_work_awards}"

# observed links, plus for every line the award a few numbers further on as a negative
SHAPES["pair_keys"] = """
SELECT work_key, award_key, max(label) AS label FROM (
  SELECT work_key, award_key, 1 AS label FROM {links}
  UNION ALL SELECT 'W' || CAST(l_partkey AS STRING), 'G' || CAST(l_orderkey + 1 + l_partkey % 5 AS STRING), 0 FROM {lineitem}) t
GROUP BY work_key, award_key
"""
SHAPES["country_lists"] = """
SELECT work_id AS work_key, '["' || string_agg(DISTINCT institution_country_code, '", "') || '"]' AS author_country_codes
FROM {s_authorships} GROUP BY work_id
"""
SHAPES["pair_works"] = """
SELECT w.work_id AS work_key, w.publication_year, w.authors_count, w.work_type, w.title AS work_title,
       t.topic_name AS work_topic_name, t.subfield_name AS work_subfield_name, t.field_name AS work_field_name,
       t.domain_name AS work_domain_name, c.author_country_codes
FROM {s_works} w LEFT JOIN {s_topics} t ON t.topic_id = w.primary_topic_id
LEFT JOIN {country_lists} c ON c.work_key = w.work_id
"""
SHAPES["pair_awards"] = """
SELECT a.award_id AS award_key, a.award_title, a.award_description, year(a.start_date) AS award_start_year,
       CASE WHEN a.end_date IS NOT NULL THEN datediff(a.end_date, a.start_date) END AS duration_days,
       a.institutions_count,
       CASE WHEN CAST(substr(a.award_id, 2) AS BIGINT) % 700 = 0 THEN 'special ' || a.award_id ELSE a.funding_type END AS funding_type,
       t.topic_name AS award_topic_name, t.subfield_name AS award_subfield_name, t.field_name AS award_field_name,
       t.domain_name AS award_domain_name, f.country_code AS funder_country_code
FROM {s_awards} a LEFT JOIN {s_topics} t ON t.topic_id = a.primary_topic_id
LEFT JOIN {s_funders} f ON f.funder_id = a.funder_id
"""
SHAPES["pairs"] = """
SELECT k.work_key, k.award_key, k.label, w.publication_year, w.authors_count, w.work_type, w.work_title,
       w.work_topic_name, w.work_subfield_name, w.work_field_name, w.work_domain_name, w.author_country_codes,
       a.award_title, a.award_description, a.award_start_year, a.duration_days, a.institutions_count, a.funding_type,
       a.award_topic_name, a.award_subfield_name, a.award_field_name, a.award_domain_name, a.funder_country_code
FROM {pair_keys} k JOIN {pair_works} w ON w.work_key = k.work_key JOIN {pair_awards} a ON a.award_key = k.award_key
"""


def pairs_oracle(sql: str, **ctes: str) -> str:
    return oracle(sql, **ctes).replace(
        "datediff(a.end_date, a.start_date)", "date_diff('day', a.start_date, a.end_date)"
    )


# ---------------------------------------------------------------- draws both engines can repeat
MULTIPLIER, PRIME, SHIFT = 2_654_435_761, 2_147_483_647, 1_701_126


def key_hash(key: Column) -> Column:
    number = F.substring(key, 2, 18).cast("long")
    return F.pmod(number * F.lit(MULTIPLIER) + F.lit(SHIFT), F.lit(PRIME))


def hash_sql(key: str) -> str:
    return f"((CAST(substr({key}, 2) AS BIGINT) * {MULTIPLIER} + {SHIFT}) % {PRIME})"


def hash_order(key: str) -> str:
    h = hash_sql(key)
    return f"{h} % 64, {h}, {key}"


SAMPLE = {
    "chosen": f"SELECT work_id AS work_key FROM {{s_works}} WHERE publication_year BETWEEN {TRAIN[0]} AND {TRAIN[1]}"
    f" ORDER BY {hash_sql('work_id')}, work_id LIMIT 400",
    "pos": f"""SELECT work_key, award_key, row_number() OVER (PARTITION BY work_key ORDER BY {hash_order("award_key")}) AS turn
FROM {{links}} WHERE work_key IN (SELECT work_key FROM {{chosen}})""",
    "pool": f"""SELECT award_id AS award_key, row_number() OVER (ORDER BY {hash_order("award_id")}) - 1 AS number,
       count(*) OVER () AS size FROM {{s_awards}}""",
    "slots": "SELECT work_key, (turn - 1) * 5 + j AS slot FROM {pos}, range(5) r(j)",
    "drawn": f"""SELECT s.work_key, p.award_key, slot FROM (
  SELECT work_key, slot, ({hash_sql("work_key")} + slot * {PRIME}) % (SELECT max(size) FROM {{pool}}) AS number
  FROM {{slots}} WHERE slot < (SELECT max(size) FROM {{pool}})) s JOIN {{pool}} p ON p.number = s.number""",
    "neg": """SELECT work_key, award_key FROM (
  SELECT d.work_key, d.award_key, row_number() OVER (PARTITION BY d.work_key ORDER BY slot) AS rank
  FROM {drawn} d WHERE NOT EXISTS (SELECT 1 FROM {pos} p WHERE p.work_key = d.work_key AND p.award_key = d.award_key)) r
JOIN (SELECT work_key AS wk, count(*) AS n FROM {pos} GROUP BY 1) ON wk = work_key WHERE rank <= 4 * n""",
}


@query("sample_entities", oracle("SELECT * FROM {chosen}", **SAMPLE))
def sample_entities(spark, sf):
    works = shape(spark, sf, "s_works").filter(F.col("publication_year").between(*TRAIN))
    return S.sample_entities(works.select(F.col("work_id").alias("work_key")), "work_key", 400, key_hash)


@query(
    "sample_pairs",
    oracle(
        """
SELECT x.work_key, x.award_key, label, publication_year, work_type, award_title, currency FROM (
  SELECT work_key, award_key, 1 AS label FROM {pos} UNION ALL SELECT work_key, award_key, 0 FROM {neg}) x
JOIN {s_works} w ON w.work_id = x.work_key JOIN {s_awards} a ON a.award_id = x.award_key""",
        **SAMPLE,
    ),
)
def sample_pairs(spark, sf):
    works = shape(spark, sf, "s_works").withColumnRenamed("work_id", "work_key")
    awards = shape(spark, sf, "s_awards").withColumnRenamed("award_id", "award_key")
    in_range = works.filter(F.col("publication_year").between(*TRAIN)).select("work_key")
    chosen = S.sample_entities(in_range, "work_key", 400, key_hash)
    # drawn from several times below: stored once
    positives = workspace.cut(shape(spark, sf, "links").join(chosen, "work_key", "left_semi"), "positives")
    both = P.labelled(positives, S.random_negatives(positives, awards, key_hash))
    sides = (works.select("work_key", "publication_year", "work_type"), awards.select("award_key", "award_title", "currency"))
    return P.enriched(both, *sides)


PLACE = 7_919  # sets the order of the rows apart from that of the draws
IN_WIDE = {
    **SAMPLE,
    "chosen": f"""SELECT work_key FROM {{obt}} WHERE publication_year BETWEEN {TRAIN[0]} AND {TRAIN[1]} GROUP BY work_key
ORDER BY {hash_sql("work_key")}, work_key LIMIT 400""",
    "pos": f"""SELECT work_key, award_key, row_number() OVER (PARTITION BY work_key ORDER BY {hash_order("award_key")}) AS turn
FROM {{obt}} WHERE work_key IN (SELECT work_key FROM {{chosen}})""",
    "pool": f"""SELECT award_key, row_number() OVER (ORDER BY {hash_order("award_key")}) - 1 AS number,
       count(*) OVER () AS size FROM (SELECT DISTINCT award_key FROM {{obt}}) a""",
}


def place_hash(work: Column, award: Column) -> Column:
    return F.pmod(key_hash(work) * PLACE + key_hash(award), F.lit(PRIME))


@query(
    "development_sample",
    star.gold_oracle(f"""
SELECT x.work_key, x.award_key, label, publication_year, funder_name, CAST(NULL AS VARCHAR) AS award_description,
       CAST(row_number() OVER (ORDER BY ({hash_sql("x.work_key")} * {PLACE} + {hash_sql("x.award_key")}) % {PRIME}, x.work_key, x.award_key) AS BIGINT) AS position
FROM (SELECT work_key, award_key, 1 AS label FROM {{pos}} UNION ALL SELECT work_key, award_key, 0 FROM {{neg}}) x
JOIN (SELECT work_key, any_value(publication_year) AS publication_year FROM {{obt}} GROUP BY work_key) w USING (work_key)
JOIN (SELECT award_key, any_value(funder_name) AS funder_name FROM {{obt}} GROUP BY award_key) a USING (award_key)""", **IN_WIDE),
)
def development_sample(spark, sf):
    """From the wide table to a shuffled sample of pairs, in one flow."""
    # the sample leaves the long texts out, so they are not carried to the links and stored with them
    columns = [c for c in obt.OBT_COLUMNS if c not in P.LONG_TEXTS]
    wide = obt.flatten(star.star(spark, sf), columns=columns, compact=True).select(*columns)
    sample = P.development_sample(workspace.cut(wide, "wide"), 400, TRAIN, key_hash, place_hash)
    return sample.select("work_key", "award_key", "label", "publication_year", "funder_name", "award_description", "position")


HARD = {
    "in_force": """SELECT award_id AS award_key, primary_topic_id AS topic, country_code AS country, y.y AS year
FROM {s_awards} LEFT JOIN {s_funders} USING (funder_id), range(1995, 2002) y(y)
WHERE y.y >= year(start_date) AND y.y <= coalesce(year(end_date), 2001)""",
    "positives": """SELECT l.work_key, l.award_key, w.publication_year AS year, w.primary_topic_id AS topic, f.country_code AS country
FROM {links} l JOIN {s_works} w ON w.work_id = l.work_key JOIN {s_awards} a ON a.award_id = l.award_key
LEFT JOIN {s_funders} f ON f.funder_id = a.funder_id""",
    "buckets": f"""SELECT bucket, award_key, row_number() OVER (PARTITION BY bucket ORDER BY {hash_order("award_key")}) - 1 AS number,
       count(*) OVER (PARTITION BY bucket) AS size FROM (
  SELECT 'topic|' || year || '|' || topic AS bucket, award_key FROM {{in_force}} WHERE topic IS NOT NULL
  UNION ALL SELECT 'country|' || year || '|' || country, award_key FROM {{in_force}} WHERE country IS NOT NULL
  UNION ALL SELECT 'any|' || year, award_key FROM {{in_force}})""",
    "requests": f"""SELECT work_key, bucket, (row_number() OVER (PARTITION BY work_key, bucket ORDER BY {hash_order("award_key")}) - 1) * per + j AS slot
FROM (
  SELECT work_key, award_key, 'topic|' || year || '|' || topic AS bucket, 2 AS per FROM {{positives}} WHERE topic IS NOT NULL
  UNION ALL SELECT work_key, award_key, 'country|' || year || '|' || country, 2 FROM {{positives}} WHERE country IS NOT NULL
  UNION ALL SELECT work_key, award_key, 'any|' || year, 6 FROM {{positives}}) q, range(1) r(j)""",
    "all_slots": """SELECT work_key, bucket, slot + i AS slot FROM {requests}, range(8) t(i)
WHERE i < CASE WHEN bucket LIKE 'any|%' THEN 6 ELSE 2 END""",
    "picked": f"""SELECT s.work_key, b.award_key, min(CASE WHEN s.bucket LIKE 'any|%' THEN 1 ELSE 0 END) AS tier,
       min(slot) FILTER (s.bucket NOT LIKE 'any|%') AS hard_slot, min(slot) AS any_slot
FROM (SELECT s0.*, size, ({hash_sql("s0.work_key")} + slot * {PRIME}) % size AS number
      FROM {{all_slots}} s0 JOIN (SELECT DISTINCT bucket, size FROM {{buckets}}) USING (bucket) WHERE slot < size) s
JOIN {{buckets}} b ON b.bucket = s.bucket AND b.number = s.number
WHERE NOT EXISTS (SELECT 1 FROM {{positives}} p WHERE p.work_key = s.work_key AND p.award_key = b.award_key)
GROUP BY s.work_key, b.award_key""",
    "tiered": """SELECT work_key, award_key, n, slot,
       CASE WHEN tier = 1 THEN 1 WHEN row_number() OVER (PARTITION BY work_key, tier ORDER BY slot // 65536, slot, award_key) > 2 * n THEN 2 ELSE 0 END AS tier
FROM (SELECT *, coalesce(hard_slot, any_slot) AS slot FROM {picked}) p
JOIN (SELECT work_key, count(*) AS n FROM {positives} GROUP BY 1) USING (work_key)""",
    "negatives": """SELECT work_key, award_key, CASE tier WHEN 1 THEN 'random' ELSE 'hard' END AS kind FROM (
  SELECT *, row_number() OVER (PARTITION BY work_key ORDER BY tier, slot // 65536, slot, award_key) AS rank FROM {tiered})
WHERE rank <= 4 * n""",
}


def pair_positives(spark, sf):
    works = shape(spark, sf, "s_works").select(
        F.col("work_id").alias("work_key"), F.col("publication_year").alias("year"), F.col("primary_topic_id").alias("topic")
    )
    return shape(spark, sf, "links").join(award_traits(spark, sf).select("award_key", "country"), "award_key").join(works, "work_key")


def award_traits(spark, sf):
    funders = shape(spark, sf, "s_funders").select("funder_id", F.col("country_code").alias("country"))
    return shape(spark, sf, "s_awards").join(funders, "funder_id", "left").select(
        F.col("award_id").alias("award_key"), F.year("start_date").alias("first_year"),
        F.year("end_date").alias("last_year"), F.col("primary_topic_id").alias("topic"), "country",
    )


@query("hard_negatives", oracle("SELECT work_key, award_key, kind FROM {negatives}", **HARD))
def hard_negatives(spark, sf):
    positives = workspace.cut(pair_positives(spark, sf), "positives")
    return S.hard_negatives(positives, award_traits(spark, sf), key_hash)


# ---------------------------------------------------------------- reading the wide table back
@query(
    "obt_csv_split",
    star.gold_oracle("""
SELECT 'award' AS side, award_key AS entity_key, award_title AS title, funder_name AS detail, CAST(amount AS DOUBLE) AS n, md5(award_description) AS text_md5, count(*) AS links
FROM {obt} GROUP BY ALL
UNION ALL SELECT 'work', work_key, work_title, author_country_codes, CAST(cited_by_count AS DOUBLE), md5(abstract_text), count(*) FROM {obt} GROUP BY ALL"""),
)
def obt_csv_split(spark, sf):
    """Wide table out as CSV, in again under its schema, cut into its two sides by column range."""
    wide = obt.published(obt.flatten(star.read_once_star(spark, sf), compact=True)).drop("_obt_built_at")
    lists = [f.name for f in wide.schema if f.dataType.typeName() == "array"]
    flat = wide.withColumns({c: F.array_join(c, "|") for c in lists})
    path = workspace.new_folder(spark, "wide-csv")
    write_wide_csv(flat, path)
    back = read_wide_csv(spark, path, flat.schema)
    awards = back.select("award_key", *columns_between(back.columns, *P.AWARD_SPAN))
    works = back.select("work_key", *columns_between(back.columns, *P.WORK_SPAN))
    side = lambda df, name, key, title, detail, n, text: df.groupBy(
        F.lit(name).alias("side"), F.col(key).alias("entity_key"), F.col(title).alias("title"),
        F.col(detail).alias("detail"), F.col(n).cast("double").alias("n"), F.md5(text).alias("text_md5"),
    ).agg(F.count(F.lit(1)).alias("links"))
    codes = works.withColumn("codes", F.coalesce("author_country_codes", F.lit("")))
    return side(awards, "award", "award_key", "award_title", "funder_name", "amount", "award_description").unionByName(
        side(codes, "work", "work_key", "work_title", "codes", "cited_by_count", "abstract_text")
    )


@query(
    "first_per_key",
    star.gold_oracle("""
SELECT work_key, award_topic_name, funder_name, work_title, publication_year FROM {obt}
QUALIFY row_number() OVER (PARTITION BY work_key ORDER BY award_key) = 1"""),
)
def first_per_key(spark, sf):
    links = shape(spark, sf, "links")
    once = first(links, ["work_key"], [F.col("award_key")])
    t = star.star(spark, sf)
    # the choice needs keys only: attributes are looked up for the rows that were kept
    cut = {**t, "fact_award_works": t["fact_award_works"].join(once, ["work_key", "award_key"], "left_semi")}
    columns = ["work_key", "award_topic_name", "funder_name", "work_title", "publication_year"]
    return obt.flatten(cut, columns=columns).select(*columns)


# ---------------------------------------------------------------- splits, manifest, contract
SPLIT_SQL = f"""SELECT work_key, award_key, label, CASE WHEN publication_year BETWEEN {TRAIN[0]} AND {TRAIN[1]} THEN 'train'
       WHEN publication_year = {TEST} THEN 'test' END AS split FROM {{pairs}}
WHERE publication_year BETWEEN {TRAIN[0]} AND {TEST}"""


@query("temporal_split", pairs_oracle(SPLIT_SQL))
def temporal_split(spark, sf):
    return P.temporal_split(shape(spark, sf, "pairs"), TRAIN, TEST).select("work_key", "award_key", "label", "split")


@query("load_split", pairs_oracle("SELECT work_key, award_key, label FROM {split} WHERE split = 'test'", split=SPLIT_SQL))
def load_split(spark, sf):
    path = workspace.new_folder(spark, "splits")
    split = P.temporal_split(shape(spark, sf, "pairs"), TRAIN, TEST)
    P.write_splits(split.select("work_key", "award_key", "label", "split"), path)
    return read_split(spark, path, "test")


ROW_HASH = "(CAST(substr(work_key, 2) AS BIGINT) * 31 + CAST(substr(award_key, 2) AS BIGINT) * 17 + label) % 1000003"


@query(
    "manifest",
    pairs_oracle(f"""
SELECT 'pairs' AS tabla_origen, max(award_start_year) AS fecha_corte, CAST(sum({ROW_HASH}) AS BIGINT) AS content_hash,
       count(*) AS filas, CAST(sum(label) AS BIGINT) AS positivos, count(DISTINCT work_key) AS publicaciones FROM {{pairs}}"""),
)
def manifest(spark, sf):
    rows = shape(spark, sf, "pairs").select("work_key", "award_key", "label", "award_start_year")
    return P.manifest(rows, "pairs", F.col("award_start_year"), F.sum(F.expr(ROW_HASH)))


@query(
    "attach_text",
    pairs_oracle("""
SELECT k.work_key, k.award_key, label, award_description, md5(abstract_text) AS abstract_md5
FROM {pair_keys} k LEFT JOIN {s_works} w ON w.work_id = k.work_key LEFT JOIN {s_awards} a ON a.award_id = k.award_key"""),
)
def attach_text(spark, sf):
    works = shape(spark, sf, "s_works").select(F.col("work_id").alias("work_key"), F.col("abstract_text").alias("work_abstract"))
    awards = shape(spark, sf, "s_awards").select(F.col("award_id").alias("award_key"), "award_description")
    texted = P.attach_text(shape(spark, sf, "pair_keys"), works, awards)
    return texted.select("work_key", "award_key", "label", "award_description", F.md5("work_abstract").alias("abstract_md5"))


@query(
    "pair_contract",
    pairs_oracle(f"""
SELECT TRUE AS columns_present, (SELECT bool_and(label IN (0, 1)) FROM {{pairs}}) AS labels_binary,
       (SELECT count(*) = count(DISTINCT work_key || '|' || award_key) FROM {{pairs}}) AS keys_unique,
       (SELECT bool_and(publication_year BETWEEN 1995 AND 2001) FROM {{pairs}}) AS years_in_range,
       (SELECT bool_and(p >= 1 AND n > p) FROM (SELECT sum(label) AS p, count(*) AS n FROM {{pairs}} GROUP BY work_key)) AS groups_have_both"""),
)
def pair_contract(spark, sf):
    rows = shape(spark, sf, "pairs").withColumn("work_abstract", F.lit(None).cast("string"))
    return P.contract(rows, (1995, 2001))


@query("group_label_balance", pairs_oracle(
    "SELECT work_key, CAST(sum(label) AS BIGINT) AS positives, count(*) AS pairs FROM {pair_keys} GROUP BY work_key"))
def group_label_balance(spark, sf):
    return P.label_balance(shape(spark, sf, "pair_keys"))


@query("pair_balance", pairs_oracle(
    "SELECT count(*) AS pairs, round(avg(label), 6) AS positive_rate, count(DISTINCT work_key) AS works FROM {pair_keys}"))
def pair_balance(spark, sf):
    # per publication first, so the distinct count adds no second shuffle of the pairs
    per_work = P.label_balance(shape(spark, sf, "pair_keys"))
    return per_work.agg(
        F.sum("pairs").alias("pairs"), F.round(F.sum("positives") / F.sum("pairs"), 6).alias("positive_rate"),
        F.count(F.lit(1)).alias("works"),
    )


@query(
    "p_at_k_ceiling",
    pairs_oracle("""
SELECT round(avg(least(p, 3) / least(n, 3)), 6) AS ceiling, count(*) AS groups
FROM (SELECT sum(label) AS p, count(*) AS n FROM {pair_keys} GROUP BY work_key) t"""),
)
def p_at_k_ceiling(spark, sf):
    return K.ceiling_at_k(shape(spark, sf, "pair_keys"), "work_key").withColumn("ceiling", F.round("ceiling", 6))


@query("pairs_by_year", pairs_oracle(
    "SELECT publication_year, label, count(*) AS pairs FROM {pairs} GROUP BY publication_year, label"))
def pairs_by_year(spark, sf):
    return shape(spark, sf, "pairs").groupBy("publication_year", "label").agg(F.count(F.lit(1)).alias("pairs"))


@query(
    "leak_check",
    pairs_oracle("""
SELECT label, count_if(award_start_year > publication_year) AS started_later, count_if(award_start_year IS NULL) AS undated,
       count(*) AS pairs FROM {pairs} GROUP BY label"""),
)
def leak_check(spark, sf):
    """Pairs whose award only started after the publication appeared."""
    return shape(spark, sf, "pairs").groupBy("label").agg(
        F.count_if(F.col("award_start_year") > F.col("publication_year")).alias("started_later"),
        F.count_if(F.col("award_start_year").isNull()).alias("undated"), F.count(F.lit(1)).alias("pairs"),
    )


@query(
    "text_coverage",
    "SELECT lang, count(*) AS documents, count_if(nullif(trim(text), '') IS NOT NULL) AS with_text,"
    " CAST(sum(length(text)) AS BIGINT) AS characters FROM documents GROUP BY lang",
)
def text_coverage(spark, sf):
    return shape(spark, sf, "documents").groupBy("lang").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(F.trim("text") != "").alias("with_text"),
        F.sum(F.length("text")).alias("characters"),
    )


# ---------------------------------------------------------------- features
def known_equal(a: str, b: str) -> str:
    return f"CASE WHEN {a} = {b} THEN 1.0 ELSE 0.0 END::DOUBLE"


FEATURE_SQL = f"""
SELECT work_key, award_key, label, {", ".join(
    f"{known_equal(f'award_{n}_name', f'work_{n}_name')} AS mismo_{n}" for n in ("topic", "subfield", "field", "domain"))},
  CASE WHEN funder_country_code IS NOT NULL AND contains(coalesce(author_country_codes, ''), '"' || funder_country_code || '"')
       THEN 1.0 ELSE 0.0 END::DOUBLE AS pais_funder_en_autores,
  CAST(publication_year - award_start_year AS DOUBLE) AS anios_desde_inicio_award, CAST(duration_days AS DOUBLE) AS duration_days,
  CAST(institutions_count AS DOUBLE) AS institutions_count, CAST(authors_count AS DOUBLE) AS authors_count, funding_type, work_type
FROM {{pairs}}"""
FEATURES = {"feats": FEATURE_SQL}


def pair_numbers(spark, sf):
    """{pair_keys} as the numbers its keys are made of. Lines are dealt out once, by award, and both pairs of
    a line are grouped where they meet their award."""
    lines = shape(spark, sf, "lineitem").select(F.col("l_partkey").alias("_work"), F.col("l_orderkey").alias("_award"))
    seen = F.struct("_award", F.lit(1).alias("label"))
    other = F.struct((F.col("_award") + 1 + F.col("_work") % 5).alias("_award"), F.lit(0).alias("label"))
    rows = lines.select("_work", F.inline(F.array(seen, other)))
    return rows.repartition("_award").groupBy("_work", "_award").agg(F.max("label").alias("label"))


def feature_pairs(spark, sf):
    """The rows of {pairs} without the texts that no feature reads. Pairs travel as numbers, with what their
    award brings; publications, whose lists of countries are the widest, meet them last. Names of topics are
    looked up for both roles at the end, where the few topics need no shuffle."""
    t = lambda name: shape(spark, sf, name)
    number = lambda key: F.expr(f"CAST(substr({key}, 2) AS BIGINT)")
    works = t("s_works").select(
        F.col("work_id").alias("work_key"), "publication_year", "authors_count", "work_type",
        F.col("primary_topic_id").alias("_work_topic"),
    ).join(t("country_lists"), "work_key", "left")
    works = works.withColumn("_work", number("work_key")).drop("work_key")
    funders = t("s_funders").select("funder_id", F.col("country_code").alias("funder_country_code"))
    awards = t("s_awards").join(funders, "funder_id", "left").select(
        number("award_id").alias("_award"), F.year("start_date").alias("award_start_year"),
        F.datediff("end_date", "start_date").alias("duration_days"), "institutions_count",
        F.when(number("award_id") % 700 == 0, F.concat(F.lit("special "), "award_id")).otherwise(F.col("funding_type")).alias("funding_type"),
        "funder_country_code", F.col("primary_topic_id").alias("_award_topic"),
    )
    # merged, as Spark takes the exploded lines for half as many and would broadcast them
    rows = pair_numbers(spark, sf).join(awards.hint("merge"), "_award").join(works, "_work")
    rows = rows.withColumns({"work_key": F.concat(F.lit("W"), "_work"), "award_key": F.concat(F.lit("G"), "_award")})
    for role in ("work", "award"):
        names = {c: f"{role}_{c}" for c in obt.TOPIC_LEVELS}
        rows = rows.join(as_role(t("s_topics"), {"topic_id": f"_{role}_topic", **names}), f"_{role}_topic", "left")
    return rows.drop("_work_topic", "_award_topic", "_work", "_award")


def features(spark, sf):
    """Features over the pairs, which are a table: stored once in a session."""
    return X.with_features(workspace.once(spark, f"pairs {sf}", lambda: feature_pairs(spark, sf)))


@query("pair_features", pairs_oracle(FEATURE_SQL))
def pair_features(spark, sf):
    return features(spark, sf)


def _summary_sql(c: str) -> str:
    return (
        f"SELECT '{c}' AS name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min,"
        f" quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS max FROM {{feats}}"
    )


@query("feature_summary", pairs_oracle(" UNION ALL ".join(_summary_sql(c) for c in X.NUMERIC_FEATURES), **FEATURES))
def feature_summary(spark, sf):
    rows = workspace.cut(features(spark, sf).select(*X.NUMERIC_FEATURES), "features")
    return P.describe(rows, list(X.NUMERIC_FEATURES)).withColumns({c: F.round(c, 6) for c in ("mean", "std")})


GAPPY = ("anios_desde_inicio_award", "duration_days")


@query(
    "impute_median",
    pairs_oracle(
        "SELECT work_key, award_key, " + ", ".join(
            f"coalesce({c}, (SELECT median({c}) FROM {{feats}} WHERE label = 1)) AS {c}" for c in GAPPY) + " FROM {feats}",
        **FEATURES,
    ),
)
def impute_median(spark, sf):
    rows = features(spark, sf).select("work_key", "award_key", "label", *GAPPY)
    found = {r["name"]: r["q50"] for r in E.medians(rows.filter("label = 1"), GAPPY).collect()}
    return rows.select("work_key", "award_key", *[e.alias(c) for c, e in E.imputed(found).items()])


SCALED = ("institutions_count", "authors_count", "mismo_domain")


@query(
    "standardize",
    pairs_oracle(
        "SELECT work_key, award_key, " + ", ".join(
            f"round(({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1), 6) AS {c}" for c in SCALED)
        + " FROM {feats}",
        **FEATURES,
    ),
)
def standardize(spark, sf):
    rows = features(spark, sf).select("work_key", "award_key", *SCALED)
    m = E.moments(rows, SCALED).first()
    return rows.select(
        "work_key", "award_key",
        *[F.round(E.scaled(F.col(c), m[f"{c}_mean"], m[f"{c}_std"]), 6).alias(c) for c in SCALED],
    )


@query(
    "one_hot_rare",
    pairs_oracle(
        """
SELECT f.work_key, f.award_key, coalesce(slot, (SELECT max(slot) FROM {slots} WHERE slot = 'infrequent')) AS slot,
       CASE WHEN coalesce(slot, 'infrequent') = 'infrequent' THEN 1 ELSE 0 END AS is_rare,
       CASE WHEN slot = 'f' THEN 1 ELSE 0 END AS is_f
FROM {feats} f LEFT JOIN {slots} s ON s.category = coalesce(funding_type, 'desconocido')""",
        slots="""SELECT category, CASE WHEN n < 20 THEN 'infrequent' ELSE category END AS slot FROM (
  SELECT coalesce(funding_type, 'desconocido') AS category, count(*) AS n FROM {feats}
  WHERE CAST(substr(work_key, 2) AS BIGINT) % 5 <> 0 GROUP BY 1) t""",
        **FEATURES,
    ),
)
def one_hot_rare(spark, sf):
    """Slots learned on four fifths of the publications, applied to all: some categories are unseen."""
    rows = features(spark, sf).select("work_key", "award_key", "funding_type")
    seen = rows.filter(F.substring("work_key", 2, 18).cast("long") % 5 != 0)
    encoded = E.encode_category(rows, "funding_type", E.category_slots(seen, "funding_type"), "slot")
    flag = lambda name: F.when(F.col("slot") == name, 1).otherwise(0)
    return encoded.select(
        "work_key", "award_key", "slot", flag(E.RARE_CATEGORY).alias("is_rare"), flag("f").alias("is_f")
    )


@query(
    "rule_baseline",
    pairs_oracle(
        "SELECT work_key, award_key, 4 * mismo_topic + 2 * mismo_subfield + mismo_field + 0.5 * mismo_domain"
        " + pais_funder_en_autores AS score FROM {feats}",
        **FEATURES,
    ),
)
def rule_baseline(spark, sf):
    return features(spark, sf).select("work_key", "award_key", X.rule_score().alias("score"))
