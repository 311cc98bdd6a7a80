"""Ranking, models and run-log queries.

Metrics run over labelled documents (label = quality, group = source) with arithmetic scores both
engines can repeat; models are fitted on the pairs' features or on the labelled documents.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions import pairs as X
from ..operators import encode as E
from ..operators import ranking as K
from ..plans import compiled, search, similarity
from ..plans import models as M
from ..plans import pairs as P
from ..sources import registry, workspace
from ..sources import runs as R
from .pairs import FEATURES, features, pairs_oracle
from .registry import query
from .shape import SHAPES, oracle, shape

SHAPES["scored"] = """
SELECT doc_id, source, quality AS label, lang, n_chars, toxic,
       CAST(doc_id * 7919 % 53 AS DOUBLE) / 53 AS score, doc_id * 104729 % 1000003 AS tie
FROM {labels} JOIN {documents} USING (doc_id)
"""


# ---------------------------------------------------------------- folds and metrics
@query("group_folds", oracle("SELECT source, count(*) AS n, CAST(CAST(substr(source, 4) AS BIGINT) * 2654435761 % 5 AS INTEGER) AS fold FROM {scored} GROUP BY source"))
def group_folds(spark, sf):
    arithmetic = lambda g: F.substring(g, 4, 18).cast("long") * F.lit(2_654_435_761)
    rows = K.with_fold(shape(spark, sf, "scored"), "source", hash_of=arithmetic)
    return rows.groupBy("source", "fold").agg(F.count(F.lit(1)).alias("n"))


@query(
    "group_folds_balanced",
    """
WITH RECURSIVE sized AS (
  SELECT user_id, size, row_number() OVER (ORDER BY size DESC, user_id) AS turn
  FROM (SELECT user_id, count(*) AS size FROM events GROUP BY user_id) g
), dealt AS (
  SELECT CAST(0 AS BIGINT) AS turn, [0, 0, 0, 0, 0]::BIGINT[] AS loads, CAST(NULL AS INTEGER) AS fold
  UNION ALL
  SELECT s.turn, list_transform([1, 2, 3, 4, 5], lambda f: loads[f] + CASE WHEN f = list_position(loads, list_min(loads)) THEN s.size ELSE 0 END),
         CAST(list_position(loads, list_min(loads)) - 1 AS INTEGER)
  FROM dealt d JOIN sized s ON s.turn = d.turn + 1
)
SELECT user_id, size, d.fold FROM dealt d JOIN sized USING (turn)""",
)
def group_folds_balanced(spark, sf):
    """Each user's events stay together; users are dealt to the fold with the fewest events so far."""
    return K.balanced_folds(shape(spark, sf, "events").select("user_id"), "user_id")


@query("prior_baseline", oracle("SELECT doc_id, round((SELECT avg(label) FROM {scored} WHERE doc_id % 5 <> 0), 6) AS score FROM {scored} WHERE doc_id % 5 = 0"))
def prior_baseline(spark, sf):
    rows = shape(spark, sf, "scored")
    trained = M.train(M.candidates()["dummy_prior"], None, rows.filter("doc_id % 5 <> 0"))
    return trained.score(rows.filter("doc_id % 5 = 0")).select("doc_id", F.round("score", 6).alias("score"))


@query(
    "average_precision",
    oracle("""
SELECT lang, round(sum(tp * ctp / cn) / sum(tp), 9) AS ap FROM (
  SELECT lang, tp, sum(tp) OVER w AS ctp, sum(n) OVER w AS cn
  FROM (SELECT lang, score, sum(label) AS tp, count(*) AS n FROM {scored} GROUP BY lang, score) s
  WINDOW w AS (PARTITION BY lang ORDER BY score DESC)) t
GROUP BY lang"""),
)
def average_precision(spark, sf):
    rows = shape(spark, sf, "scored")
    return K.average_precision(rows, by=["lang"]).withColumn("ap", F.round("ap", 9))


@query(
    "precision_at_k",
    oracle("""
SELECT lang, round(avg(p), 9) AS p_at_3 FROM (
  SELECT lang, source, avg(label) AS p FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY score DESC, tie) AS rn FROM {scored}) r
  WHERE rn <= 3 GROUP BY lang, source) t
GROUP BY lang"""),
)
def precision_at_k(spark, sf):
    rows = shape(spark, sf, "scored")
    found = K.precision_at_k(rows, "source", tie=[F.col("tie")], by=["lang"])
    return found.withColumn("p_at_3", F.round("p_at_3", 9))


@query(
    "top_k_per_group",
    oracle("SELECT source, doc_id, score FROM {scored} QUALIFY row_number() OVER (PARTITION BY source ORDER BY score DESC, tie) <= 3"),
)
def top_k_per_group(spark, sf):
    best = K.top_k_per_group(shape(spark, sf, "scored"), ["source"], tie=[F.col("tie")])
    return best.select("source", "doc_id", "score")


# ---------------------------------------------------------------- embeddings
@query(
    "embedding_rank",
    """
SELECT label, vec_id, round(s, 5) AS similarity FROM (
  SELECT e.label, e.vec_id, list_sum(list_transform(list_zip(e.embedding, c.embedding), lambda p: CAST(p[1] AS DOUBLE) * CAST(p[2] AS DOUBLE))) AS s
  FROM embeddings e JOIN (SELECT label, embedding, vec_id AS anchor FROM embeddings
    QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1) c ON c.label = e.label AND e.vec_id <> c.anchor) t
QUALIFY row_number() OVER (PARTITION BY label ORDER BY s DESC, vec_id) <= 3""",
)
def embedding_rank(spark, sf):
    """Each label's first vector asks for its three most similar ones among the given candidates."""
    rows = shape(spark, sf, "embeddings")
    first = rows.groupBy("label").agg(F.min("vec_id").alias("anchor"))
    asks = rows.join(first, [rows.vec_id == first.anchor, rows.label == first.label], "left_semi")
    asks = asks.select("label", F.col("vec_id").alias("anchor"), "embedding")
    best = similarity.most_similar(asks, rows, "label", "anchor", "vec_id", "embedding", own="anchor")
    return best.select("label", "vec_id", F.round("score", 5).alias("similarity"))


@query(
    "embed_text",
    r"SELECT doc_id, 4096 AS width, CASE WHEN regexp_matches(text, '\S') THEN 1e0 ELSE 0e0 END AS norm FROM documents WHERE text IS NOT NULL",
)
def embed_text(spark, sf):
    """The offline embedding has unit length wherever there is a word."""
    vectors = M.embed_text(shape(spark, sf, "documents"), "doc_id", "text")
    return vectors.select("doc_id", F.size("embedding").alias("width"), F.round(M.similarity(F.col("embedding"), F.col("embedding")), 3).alias("norm"))


# What the arithmetic encoder counts; texts of the test tables are far shorter than 2^24 characters,
# so the counts are exact as floats.
COUNTED = ("a", "e", " ", ".")


def counting_encoder():
    """Stands where a real encoder's weights would be loaded: once in a worker."""

    def encode(texts):
        return np.array([[len(t), *[t.count(c) for c in COUNTED]] for t in texts], np.float32).reshape(len(texts), -1)

    return encode


@query(
    "embed_batches",
    "SELECT doc_id, " + ", ".join(
        f"CAST({e} AS DOUBLE) AS e{i}"
        for i, e in enumerate(["length(text)", *[f"length(text) - length(replace(text, '{c}', ''))" for c in COUNTED]])
    ) + " FROM documents WHERE text IS NOT NULL",
)
def embed_batches(spark, sf):
    """An injected encoder over Arrow batches."""
    vectors = M.embed_batches(shape(spark, sf, "documents"), "doc_id", "text", counting_encoder)
    return vectors.select("doc_id", *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(len(COUNTED) + 1)])


# ---------------------------------------------------------------- models
def documents(spark, sf):
    rows = shape(spark, sf, "scored").select(
        "doc_id", "source", "label", "lang", F.col("n_chars").cast("double").alias("n_chars"),
        F.col("toxic").cast("double").alias("toxic"), F.col("score").alias("signal"),
    )
    return workspace.cut(rows, "documents")


def document_encoder():
    return E.FeatureEncoder(["n_chars", "toxic", "signal"], ["lang"])


def doc_tie():
    return [K.tie_break("doc_id")]


TRAINED_ON = "CAST(substr(work_key, 2) AS BIGINT) % 5 <> 0"  # the publications that statistics come from


def _numeric_slot(c: str) -> str:
    seen = f"SELECT {c} FROM {{feats}} WHERE {TRAINED_ON}"
    filled = f"coalesce({c}, (SELECT median({c}) FROM ({seen})))"
    of_seen = f"FROM {{feats}} WHERE {TRAINED_ON}"
    return (
        f"SELECT label, '{c}' AS slot, sum(({filled} - (SELECT avg({filled}) {of_seen}))"
        f" / (SELECT coalesce(nullif(stddev_pop({filled}), 0), 1) {of_seen})) AS total FROM {{feats}} GROUP BY label"
    )


def _category_slots(c: str) -> str:
    return f"""
SELECT l.label, '{c}=' || k.slot AS slot, coalesce(sum(CASE WHEN f.slot = k.slot THEN 1 END), 0) AS total
FROM (SELECT DISTINCT slot FROM {{{c}_seen}}) k CROSS JOIN (SELECT DISTINCT label FROM {{feats}}) l
LEFT JOIN (SELECT label, coalesce(s.slot, 'infrequent') AS slot FROM {{feats}} LEFT JOIN {{{c}_seen}} s
  ON s.category = coalesce({c}, 'desconocido')) f ON f.label = l.label
GROUP BY l.label, k.slot"""


SEEN = {
    f"{c}_seen": f"""
SELECT category, CASE WHEN n < 20 THEN 'infrequent' ELSE category END AS slot FROM (
  SELECT coalesce({c}, 'desconocido') AS category, count(*) AS n FROM {{feats}} WHERE {TRAINED_ON} GROUP BY 1) t"""
    for c in X.CATEGORICAL_FEATURES
}


@query(
    "fit_apply",
    pairs_oracle(
        "SELECT label, slot, round(CAST(total AS DOUBLE), 4) AS total FROM ("
        + " UNION ALL ".join([*map(_numeric_slot, X.NUMERIC_FEATURES), *map(_category_slots, X.CATEGORICAL_FEATURES)]) + ") t",
        **FEATURES, **SEEN,
    ),
)
def fit_apply(spark, sf):
    """Statistics from four fifths of the publications, saved, loaded again, and applied to every pair:
    the sum of each slot of the vector."""
    rows = workspace.cut(features(spark, sf), "features")
    path = workspace.new_folder(spark, "encoder")
    E.FeatureEncoder(X.NUMERIC_FEATURES, X.CATEGORICAL_FEATURES).fit(rows.filter(TRAINED_ON)).write().save(path)
    fitted = E.FeatureEncoderModel.load(path)
    names = F.array(*[F.lit(n) for n in fitted.slots()])
    places = fitted.transform(rows).select("label", F.posexplode(vector_to_array("features")).alias("at", "value"))
    return places.groupBy("label", "at").agg(F.sum("value").alias("total")).select(
        "label", F.get(names, F.col("at")).alias("slot"), F.round("total", 4).alias("total")
    )


#: Largest part of the penalised loss's gradient at a fit that counts as optimal.
FLAT = 1e-4


def logistic_facts(spark, sf, class_weight):
    """A fit on four fifths of the publications: whether it is the minimum of its penalised loss, and
    whether its plain expression scores the held-out pairs as Spark ML does."""
    rows = workspace.cut(features(spark, sf), "features")
    encoder = E.FeatureEncoder(X.NUMERIC_FEATURES, X.CATEGORICAL_FEATURES)
    candidate, params = M.candidates()["logistica"], {"class_weight": class_weight} if class_weight else None
    trained = M.train(candidate, encoder, rows.filter(TRAINED_ON), params)
    ready = M.with_weight(trained.encoder.transform(rows.filter(TRAINED_ON)), class_weight)
    weights = trained.model.coefficients.toArray().tolist()
    margin = F.lit(float(trained.model.intercept)) + M.similarity(
        vector_to_array("features"), F.array(*[F.lit(w) for w in weights])
    )
    slopes = compiled.penalised_gradient(ready, margin, F.col("weight"), weights, trained.model.getRegParam())
    flat = slopes.agg((F.max(F.abs("gradient")) <= FLAT).alias("optimal"))
    held_out = workspace.cut(trained.encoder.transform(rows.filter(f"NOT ({TRAINED_ON})")), "held_out")
    scored = trained.model.transform(held_out).withColumn("score", vector_to_array("probability")[1])
    both = compiled.scored(trained.model, scored, len(weights))
    counts = both.agg(
        F.count(F.lit(1)).alias("held_out"), F.sum(F.col("label").cast("long")).alias("positives"),
        F.count_if(F.abs(F.col("score") - F.col("compiled")) < 1e-9).alias("agree"),
    )
    return counts.crossJoin(flat).select(F.lit(class_weight or "none").alias("class_weight"), "*")  # one row each


def logistic_sql(class_weight: str) -> str:
    return pairs_oracle(
        f"SELECT '{class_weight}' AS class_weight, count(*) AS held_out, CAST(sum(label) AS BIGINT) AS positives,"
        f" count(*) AS agree, TRUE AS optimal FROM {{feats}} WHERE NOT ({TRAINED_ON})", **FEATURES)


@query("logistic", logistic_sql("balanced"))
def logistic(spark, sf):
    return logistic_facts(spark, sf, "balanced")


@query("logistic_unweighted", logistic_sql("none"))
def logistic_unweighted(spark, sf):
    return logistic_facts(spark, sf, None)


@query(
    "tree_models",
    oracle("""
SELECT model, count(*) AS held_out, CAST(sum(label) AS BIGINT) AS positives, count(*) AS agree, 0 AS out_of_range
FROM {scored}, (SELECT unnest(['bosque', 'boosting', 'red']) AS model) WHERE doc_id % 5 = 0 GROUP BY model"""),
)
def tree_models(spark, sf):
    """Forest, boosting and network on held-out documents: Spark ML's score and the one of the model
    written out as a SQL expression."""
    rows = documents(spark, sf)
    known = M.candidates()
    parts = []
    for name in ("bosque", "boosting", "red"):
        trained = M.train(known[name], document_encoder(), rows.filter("doc_id % 5 <> 0"))
        encoded = trained.encoder.transform(rows.filter("doc_id % 5 = 0"))
        predicted = trained.model.transform(encoded)
        scored = predicted.select("label", "features", M.positive_score(predicted).alias("score"))
        both = compiled.scored(trained.model, scored, trained.encoder.width())
        parts.append(both.select(F.lit(name).alias("model"), "label", "score", "compiled"))
    scored = workspace.cut(parts[0].unionByName(parts[1]).unionByName(parts[2]), "scores")
    return scored.groupBy("model").agg(
        F.count(F.lit(1)).alias("held_out"), F.sum(F.col("label").cast("long")).alias("positives"),
        F.count_if(F.abs(F.col("score") - F.col("compiled")) < 1e-9).alias("agree"),
        F.count_if(~F.col("score").between(0, 1)).cast("int").alias("out_of_range"),
    )


FOLD_SQL = "CAST(substr(source, 4) AS BIGINT) * 2654435761 % 5"
FOLD = lambda g: F.substring(g, 4, 18).cast("long") * F.lit(2_654_435_761)
# The prior of a fold is the share of positives outside it; the rule is the documents' arithmetic score.
FOLD_SHAPES = {
    "folded": f"SELECT *, CAST({FOLD_SQL} AS INTEGER) AS fold FROM {{scored}}",
    "fold_scores": """
SELECT 'dummy_prior' AS name, fold, source, doc_id, tie, label, CAST(0 AS DOUBLE) AS score FROM {folded}
UNION ALL SELECT 'regla', fold, source, doc_id, tie, label, score FROM {folded}
UNION ALL SELECT 'dummy_prior', -1, source, doc_id, tie, label, 0 FROM {folded}
UNION ALL SELECT 'regla', -1, source, doc_id, tie, label, score FROM {folded}""",
    "fold_ap": """
SELECT name, fold, sum(tp * ctp / cn) / nullif(sum(tp), 0) AS ap FROM (
  SELECT name, fold, tp, sum(tp) OVER w AS ctp, sum(n) OVER w AS cn
  FROM (SELECT name, fold, score, sum(label) AS tp, count(*) AS n FROM {fold_scores} GROUP BY ALL) s
  WINDOW w AS (PARTITION BY name, fold ORDER BY score DESC)) t
GROUP BY name, fold""",
    "fold_p": """
SELECT name, fold, avg(p) AS p_at_3 FROM (
  SELECT name, fold, source, avg(label) AS p FROM (
    SELECT * FROM {fold_scores}
    QUALIFY row_number() OVER (PARTITION BY name, fold, source ORDER BY score DESC, doc_id) <= 3) r
  GROUP BY name, fold, source) t
GROUP BY name, fold""",
    "fold_summary": """
SELECT name, avg(ap) FILTER (WHERE fold >= 0) AS cv_ap_mean, avg(p_at_3) FILTER (WHERE fold >= 0) AS cv_p_at_3_mean,
       stddev_samp(ap) FILTER (WHERE fold >= 0) AS cv_ap_std, stddev_samp(p_at_3) FILTER (WHERE fold >= 0) AS cv_p_at_3_std,
       count(ap) FILTER (WHERE fold >= 0) AS cv_folds,
       max(ap) FILTER (WHERE fold < 0) AS train_ap, max(p_at_3) FILTER (WHERE fold < 0) AS train_p_at_3
FROM {fold_ap} JOIN {fold_p} USING (name, fold) GROUP BY name""",
}
SCORERS = ("dummy_prior", "regla")


def rounded(df, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query(
    "grouped_cv",
    oracle("""
SELECT name, round(cv_ap_mean, 6) AS cv_ap_mean, round(cv_p_at_3_mean, 6) AS cv_p_at_3_mean,
       round(cv_ap_std, 6) AS cv_ap_std, round(cv_p_at_3_std, 6) AS cv_p_at_3_std, cv_folds FROM {fold_summary}""", **FOLD_SHAPES),
)
def grouped_cv(spark, sf):
    """Grouped folds of the two scorers whose values both engines can repeat."""
    rows, known = documents(spark, sf), M.candidates(F.col("signal"))
    parts = [
        M.summary_of(M.cross_validate(known[n], None, rows, "source", [F.col("doc_id")], hash_of=FOLD)).select(
            F.lit(n).alias("name"), "cv_ap_mean", "cv_p_at_3_mean", "cv_ap_std", "cv_p_at_3_std", "cv_folds")
        for n in SCORERS
    ]
    return rounded(parts[0].unionByName(parts[1]))


@query(
    "grouped_cv_fitted",
    oracle("SELECT 'logistica' AS name, count(DISTINCT fold) AS cv_folds, TRUE AS in_range FROM {folded} WHERE label = 1", **FOLD_SHAPES),
)
def grouped_cv_fitted(spark, sf):
    """A fitted candidate over all folds; its metrics are shares."""
    folds = M.cross_validate(M.candidates()["logistica"], document_encoder(), documents(spark, sf), "source", doc_tie(), hash_of=FOLD)
    shares = [F.col(f"cv_{m}_mean").between(0, 1) for m in R.MEASURED]
    return M.summary_of(folds).select(F.lit("logistica").alias("name"), "cv_folds", (shares[0] & shares[1]).alias("in_range"))


def document_manifest(rows):
    return P.manifest(rows.withColumnRenamed("source", "work_key"), "documents", F.lit("2024-01-01")).first().asDict()


# ---------------------------------------------------------------- tuning and selection
# Scorers whose values both engines can repeat; `tasa` learns the share of positives by language.
TUNED_SQL = {
    "mezcla": "CAST(a * (doc_id * 7919 % 53) + b * (chars % 17) + c * toxic AS DOUBLE)",
    "modular": "CAST((doc_id * (a + 7) + chars * b + c) % 101 AS DOUBLE)",
    "tasa": "a * rate + b * signal + c * CAST(toxic AS DOUBLE)",
    "resto": "CAST(0 - chars % (a + 3) - b * toxic + doc_id % (c + 30) AS DOUBLE)",
}
FIRST_TRY = {"a": 3, "b": 2, "c": 1}
CONFIGURATIONS = 30


def learned_rates(train):
    """Share of positives by language, as a literal: one entry for each language of the encoder."""
    found = train.groupBy("lang").agg(F.avg(F.col("label").cast("double")).alias("rate")).collect()
    pairs = [x for r in sorted(found, key=lambda r: str(r["lang"])) if r["lang"] is not None for x in (F.lit(r["lang"]), F.lit(r["rate"]))]
    return F.create_map(*pairs)[F.col("lang")]


def tuned_score(name):
    def score(train, params):
        if name == "tasa":
            a, b, c = (F.lit(float(params[p])) for p in "abc")
            return a * learned_rates(train) + b * F.col("signal") + c * F.col("toxic")
        whole = {"toxic": "CAST(toxic AS BIGINT)", "chars": "CAST(n_chars AS BIGINT)"}
        known = {p: f"({params[p]})" for p in "abc"} | whole
        return F.expr(re.sub(r"\b(a|b|c|toxic|chars)\b", lambda m: known[m[0]], TUNED_SQL[name]))

    return score


def tuned_candidates():
    space = {"a": M.whole(0, 20), "b": M.whole(0, 20), "c": M.whole(-20, 20)}
    return {n: M.Candidate("regla", score=tuned_score(n), space=space) for n in TUNED_SQL}


def configuration_rows() -> str:
    drawn = [FIRST_TRY, *M.sampled_params(tuned_candidates()["mezcla"].space, CONFIGURATIONS)]
    return ", ".join(f"('{n}', {i - 1}, {p['a']}, {p['b']}, {p['c']})" for n in TUNED_SQL for i, p in enumerate(drawn))


def tuning_shapes(rows: str, configurations: str = "TRUE") -> dict[str, str]:
    """Scores, metrics and summary of all configurations over grouped folds; fold -1 is the training rows."""
    cases = " ".join(f"WHEN '{n}' THEN {e}" for n, e in TUNED_SQL.items())
    return {
        "t_rows": f"SELECT doc_id, source, label, lang, toxic, n_chars AS chars, score AS signal, CAST({FOLD_SQL} AS INTEGER) AS fold FROM {{scored}} WHERE {rows}",
        "t_configs": f"SELECT * FROM (VALUES {configuration_rows()}) v(name, config, a, b, c) WHERE {configurations}",
        "t_held": "SELECT unnest([-1, 0, 1, 2, 3, 4]) AS held",
        "t_rates": "SELECT held, lang, avg(label) AS rate FROM {t_rows}, {t_held} WHERE fold <> held GROUP BY held, lang",
        "t_scores": f"""
SELECT name, config, held, source, doc_id, label, CASE name {cases} END AS score
FROM {{t_rows}} JOIN {{t_held}} ON held = fold OR held = -1 CROSS JOIN {{t_configs}} LEFT JOIN {{t_rates}} USING (held, lang)""",
        "t_ap": """
SELECT name, config, held, sum(tp * ctp / cn) / nullif(sum(tp), 0) AS ap FROM (
  SELECT name, config, held, tp, sum(tp) OVER w AS ctp, sum(n) OVER w AS cn
  FROM (SELECT name, config, held, score, sum(label) AS tp, count(*) AS n FROM {t_scores} GROUP BY ALL) s
  WINDOW w AS (PARTITION BY name, config, held ORDER BY score DESC)) t
GROUP BY name, config, held""",
        "t_p": """
SELECT name, config, held, avg(p) AS p_at_3 FROM (
  SELECT name, config, held, source, avg(label) AS p FROM (
    SELECT * FROM {t_scores}
    QUALIFY row_number() OVER (PARTITION BY name, config, held, source ORDER BY score DESC, doc_id) <= 3) r
  GROUP BY name, config, held, source) t
GROUP BY name, config, held""",
        "t_summary": """
SELECT name, config, avg(ap) FILTER (held >= 0) AS cv_ap_mean, avg(p_at_3) FILTER (held >= 0) AS cv_p_at_3_mean,
       stddev_samp(ap) FILTER (held >= 0) AS cv_ap_std, count(ap) FILTER (held >= 0) AS cv_folds,
       max(ap) FILTER (held < 0) AS train_ap
FROM {t_ap} JOIN {t_p} USING (name, config, held) GROUP BY name, config""",
        "t_best": "SELECT *, row_number() OVER (ORDER BY cv_ap_mean DESC) AS place FROM {t_summary} WHERE config = -1",
    }


def first_tries():
    return [search.Configuration(n, c, FIRST_TRY) for n, c in tuned_candidates().items()]


@query(
    "random_search",
    oracle("""
SELECT name, a, b, c, round(cv_ap_mean, 6) AS cv_ap_mean, round(cv_p_at_3_mean, 6) AS cv_p_at_3_mean,
       round(cv_ap_std, 6) AS cv_ap_std, CAST(cv_folds AS DOUBLE) AS cv_folds, round(train_ap, 6) AS train_ap,
       round(train_ap - cv_ap_mean, 6) AS brecha_ap, 'tuning' AS fase, name AS parent
FROM {t_summary} JOIN {t_configs} USING (name, config)
WHERE config >= 0 AND name IN (SELECT name FROM {t_best} WHERE place <= 3)""", **FOLD_SHAPES, **tuning_shapes("TRUE")),
)
def random_search(spark, sf):
    """The three best of four candidates, 30 seeded configurations each, as runs below three parents."""
    rows, log = documents(spark, sf), workspace.new_folder(spark, "runs")
    facts, known = document_manifest(rows), tuned_candidates()
    parts = search.folds(rows, None, "source", hash_of=FOLD)
    search.compare(log, first_tries(), parts, "source", ["doc_id"], facts)
    best = search.finalists(R.read_runs(spark, log), known)
    search.random_search(log, best, parts, "source", ["doc_id"], facts, CONFIGURATIONS)
    runs = R.read_runs(spark, log)
    parents = runs.select(F.col("run_id").alias("parent_run_id"), F.col("name").alias("parent"))
    shown = runs.join(parents, "parent_run_id").select(
        "name", *[F.col("params")[p].cast("int").alias(p) for p in "abc"],
        *[F.col("metrics")[m].alias(m) for m in ("cv_ap_mean", "cv_p_at_3_mean", "cv_ap_std", "cv_folds", "train_ap", "brecha_ap")],
        "fase", "parent",
    )
    return rounded(shown)


@query("random_search_fitted")
def random_search_fitted(spark, sf):
    """The same search over a fitted family: 30 configurations, six fits each."""
    rows, log = documents(spark, sf), workspace.new_folder(spark, "runs")
    facts, known = document_manifest(rows), M.candidates()
    parts = search.folds(rows, document_encoder(), "source")
    search.random_search(log, {"logistica": known["logistica"]}, parts, "source", ["doc_id"], facts, CONFIGURATIONS)
    return R.leaderboard(R.read_runs(spark, log)).drop("run_id")


@query(
    "final_selection",
    oracle("""
SELECT CASE place WHEN 1 THEN 'champion' ELSE 'challenger' END AS alias, CAST(place AS INTEGER) AS version, t.name,
       round(cv_ap_mean, 6) AS cv_ap_mean, round(test_ap, 6) AS test_ap, round(test_p, 6) AS test_p_at_3, TRUE AS refused
FROM {t_best} t
LEFT JOIN (
  SELECT name, sum(tp * ctp / cn) / nullif(sum(tp), 0) AS test_ap FROM (
    SELECT name, tp, sum(tp) OVER w AS ctp, sum(n) OVER w AS cn
    FROM (SELECT name, score, sum(label) AS tp, count(*) AS n FROM {t_test} GROUP BY ALL) s
    WINDOW w AS (PARTITION BY name ORDER BY score DESC)) x GROUP BY name) a ON a.name = t.name AND place = 1
LEFT JOIN (
  SELECT name, avg(p) AS test_p FROM (
    SELECT name, source, avg(label) AS p FROM (
      SELECT * FROM {t_test} QUALIFY row_number() OVER (PARTITION BY name, source ORDER BY score DESC, doc_id) <= 3) r
    GROUP BY name, source) y GROUP BY name) p ON p.name = t.name AND place = 1
WHERE place <= 2""", **FOLD_SHAPES, **tuning_shapes("doc_id % 5 <> 0", "config = -1"), t_test=f"""
SELECT name, source, doc_id, label, CASE name {" ".join(f"WHEN '{n}' THEN {e}" for n, e in TUNED_SQL.items())} END AS score
FROM (SELECT doc_id, source, label, lang, toxic, n_chars AS chars, score AS signal FROM {{scored}} WHERE doc_id % 5 = 0) r
CROSS JOIN {{t_configs}} LEFT JOIN (SELECT lang, rate FROM {{t_rates}} WHERE held = -1) USING (lang)"""),
)
def final_selection(spark, sf):
    """From the leaderboard to one look at the test rows and the registry's aliases; a second look is
    refused."""
    rows, log = documents(spark, sf), workspace.new_folder(spark, "runs")
    train, test = rows.filter("doc_id % 5 <> 0"), rows.filter("doc_id % 5 = 0")
    facts, known = document_manifest(train), {n: (c, FIRST_TRY) for n, c in tuned_candidates().items()}
    search.compare(log, first_tries(), search.folds(train, None, "source", hash_of=FOLD), "source", ["doc_id"], facts)
    args = (log, R.read_runs(spark, log), known, None, train, test, "source", [F.col("doc_id")], facts, "documents")
    M.final_evaluation(*args)
    try:
        M.final_evaluation(*args)
        refused = False
    except M.AlreadyEvaluated:
        refused = True
    runs = R.read_runs(spark, log)
    final = runs.filter("fase = 'final'").select(
        F.col("parent_run_id").alias("run_id"), F.col("metrics")["test_ap"].alias("test_ap"),
        F.col("metrics")["test_p_at_3"].alias("test_p_at_3"),
    )
    shown = registry.aliases(spark, f"{log}-registry", "documents").join(
        runs.select("run_id", "name", F.col("metrics")["cv_ap_mean"].alias("cv_ap_mean")), "run_id"
    ).join(final, "run_id", "left")
    return rounded(shown.select(
        "alias", "version", "name", "cv_ap_mean", "test_ap", "test_p_at_3", F.lit(refused).alias("refused")
    ))


@query(
    "runs_log",
    oracle("""
SELECT name, 'baseline' AS fase, CASE name WHEN 'regla' THEN 'regla' ELSE 'dummy' END AS familia,
       '42' AS semilla, 'GroupKFold(source)' AS esquema_cv, (SELECT CAST(count(*) AS VARCHAR) FROM {scored}) AS datos_filas,
       round(cv_ap_mean, 6) AS cv_ap_mean, round(train_p_at_3, 6) AS train_p_at_3,
       round(train_ap - cv_ap_mean, 6) AS brecha_ap, round(train_p_at_3 - cv_p_at_3_mean, 6) AS brecha_p_at_3
FROM {fold_summary}""", **FOLD_SHAPES),
)
def runs_log(spark, sf):
    rows, log = documents(spark, sf), workspace.new_folder(spark, "runs")
    facts, known = document_manifest(rows), M.candidates(F.col("signal"))
    for name in SCORERS:
        M.run(log, name, "baseline", known[name], None, rows, "source", [F.col("doc_id")], facts, hash_of=FOLD)
    shown = R.read_runs(spark, log).select(
        "name", "fase", "familia", *[F.col("params")[p].alias(p) for p in ("semilla", "esquema_cv", "datos_filas")],
        *[F.col("metrics")[m].alias(m) for m in ("cv_ap_mean", "train_p_at_3", "brecha_ap", "brecha_p_at_3")],
    )
    return rounded(shown)


@query(
    "fitted_runs",
    oracle("""
SELECT name, 'baseline' AS fase, familia, 7 AS params, 'ap,p_at_3' AS measured, count(*) > 0 AS has_rows
FROM {scored}, (VALUES ('dummy_prior', 'dummy'), ('logistica', 'lineal')) v(name, familia) GROUP BY name, familia"""),
)
def fitted_runs(spark, sf):
    """A fitted candidate's run beside the prior's, as logged."""
    rows, log = documents(spark, sf), workspace.new_folder(spark, "runs")
    facts = document_manifest(rows)
    for name in ("dummy_prior", "logistica"):
        M.run(log, name, "baseline", M.candidates()[name], document_encoder(), rows, "source", doc_tie(), facts)
    runs = R.read_runs(spark, log)
    measured = F.array_sort(F.transform(
        F.filter(F.map_keys("metrics"), lambda m: m.startswith("train_")), lambda m: F.substring(m, 7, 99)
    ))
    return runs.select(
        "name", "fase", "familia", F.size("params").alias("params"), F.array_join(measured, ",").alias("measured"),
        (F.col("params")["datos_filas"].cast("long") > 0).alias("has_rows"),
    )


# ---------------------------------------------------------------- run log reports
# one run per (source, language): its metrics are averages over the labelled documents
RUN_SQL = """
SELECT 'run-' || source || '-' || lang AS run_id, 'model ' || lang AS name, 'lineal' AS familia,
       CAST(min(doc_id) AS BIGINT) AS started, round(avg(label), 6) AS train_ap, round(avg(toxic), 6) AS cv_ap,
       round(avg(score), 6) AS train_p, round(avg(score * score), 6) AS cv_p
FROM {scored} GROUP BY source, lang
"""
SHAPES["run_facts"] = RUN_SQL


def document_runs(spark, sf):
    facts = shape(spark, sf, "run_facts")
    metric = lambda **m: F.create_map(*[x for k, c in m.items() for x in (F.lit(k), F.col(c))])
    return facts.select(
        "run_id", "name", F.lit("candidato").alias("fase"), "familia", F.lit(R.UNKNOWN_COMMIT).alias("git_commit"),
        F.lit(None).cast("string").alias("parent_run_id"), F.timestamp_seconds("started").alias("start_time"),
        F.lit("FINISHED").alias("status"), F.create_map(F.lit("semilla"), F.lit("42")).alias("params"),
        metric(train_ap="train_ap", cv_ap_mean="cv_ap", train_p_at_3="train_p", cv_p_at_3_mean="cv_p").alias("metrics"),
    )


@query("train_cv_gap", oracle("SELECT run_id, name, round(train_ap - cv_ap, 6) AS brecha_ap, round(train_p - cv_p, 6) AS brecha_p_at_3 FROM {run_facts}"))
def train_cv_gap(spark, sf):
    return R.train_cv_gap(document_runs(spark, sf)).withColumns(
        {c: F.round(c, 6) for c in ("brecha_ap", "brecha_p_at_3")}
    )


@query(
    "leaderboard",
    oracle("""
SELECT run_id, name, familia, cv_ap AS cv_ap_mean, place, CASE place WHEN 1 THEN 'champion' WHEN 2 THEN 'challenger' END AS alias
FROM (SELECT *, CAST(row_number() OVER (ORDER BY cv_ap DESC NULLS LAST, run_id) AS INTEGER) AS place FROM {run_facts}) t WHERE place <= 3"""),
)
def leaderboard(spark, sf):
    return R.finalists(document_runs(spark, sf))


@query(
    "runs_export",
    oracle("""
SELECT run_id, name, 'candidato' AS fase, familia, 'desconocido' AS git_commit, CAST(NULL AS VARCHAR) AS parent_run_id,
       'FINISHED' AS status, cv_ap AS "metrics.cv_ap_mean", cv_p AS "metrics.cv_p_at_3_mean", train_ap AS "metrics.train_ap",
       train_p AS "metrics.train_p_at_3", '42' AS "params.semilla" FROM {run_facts}"""),
)
def runs_export(spark, sf):
    """Written as CSV and read back under the exported header."""
    path = workspace.new_folder(spark, "runs-csv")
    written = R.export_csv(document_runs(spark, sf), path)
    back = spark.read.schema(written.schema).option("header", True).csv(path)
    return back.select(*[F.col(f"`{c}`") for c in back.columns if c != "start_time"])
