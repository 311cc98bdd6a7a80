"""Tuning, selection, saved models, models as expressions, and similarity in blocks."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fundweave.operators.encode import FeatureEncoder, FeatureEncoderModel
from fundweave.plans import compiled, models, search, similarity
from fundweave.sources import registry, runs, workspace

FACTS = {"tabla_origen": "t", "fecha_corte": "2024-01-01", "content_hash": "h", "filas": 300}


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(3)
    data = []
    for i in range(400):
        a, b, kind = r.gauss(0, 1), r.choice([None, 1.0, 2.0, 5.0]), r.choice(["x", "y", None, f"rare{i}"])
        label = int(a + (b or 0) / 3 + (kind == "x") + r.gauss(0, 1) > 1)
        data.append((f"W{i % 40}", i, label, a, b, None, kind))
    schema = "work_key string, doc_id long, label int, a double, b double, empty double, kind string"
    return workspace.cut(spark.createDataFrame(data, schema), "rows")


def encoder():
    return FeatureEncoder(["a", "b", "empty"], ["kind"])


def vectors(df):
    return {r.doc_id: tuple(r.features) for r in df.select("doc_id", "features").collect()}


# ---------------------------------------------------------------- saving


def test_a_loaded_encoder_gives_the_same_vectors(spark, rows):
    fitted = encoder().fit(rows)
    path = workspace.new_folder(spark, "encoder")
    fitted.write().save(path)
    fitted.write().overwrite().save(path)
    again = FeatureEncoderModel.load(path)
    assert (again.uid, again.output, again.statistics) == (fitted.uid, fitted.output, fitted.statistics)
    assert again.slots() == ["a", "b", "kind=desconocido", "kind=x", "kind=y", "kind=infrequent"]
    new = rows.withColumn("kind", F.lit("unseen")).limit(5).unionByName(rows)
    assert vectors(again.transform(new)) == vectors(fitted.transform(new))


@pytest.mark.parametrize("name", ["logistica", "bosque", "boosting", "red"])
def test_a_loaded_model_scores_the_same(spark, rows, name):
    trained = models.train(models.candidates()[name], encoder(), rows, {"class_weight": None})
    path = workspace.new_folder(spark, "model")
    trained.save(path)
    again = models.Trained.load(spark, path)
    scores = [{r.doc_id: r.score for r in t.score(rows).collect()} for t in (trained, again)]
    assert scores[0] == scores[1] and len(set(scores[0].values())) > 5
    assert again.params == {"class_weight": "None"} and again.seconds == trained.seconds
    with pytest.raises(ValueError):
        models.train(models.candidates()["dummy_prior"], None, rows).save(path)


# ---------------------------------------------------------------- expressions


@pytest.mark.parametrize("name", ["logistica", "bosque", "boosting", "red"])
def test_two_engines_agree_with_the_model(spark, rows, name):
    trained = models.train(models.candidates()[name], encoder(), rows)
    ready = trained.encoder.transform(rows)
    predicted = trained.model.transform(ready)
    scored = predicted.select("doc_id", "features", models.positive_score(predicted).alias("score"))
    width = trained.encoder.width()
    both = compiled.scored(trained.model, scored, width).collect()
    assert all(abs(r.score - r.compiled) < 1e-9 for r in both) and len(both) == 400
    plain, names = compiled.slot_columns(scored.select("doc_id", "features", "score"), width)
    con = duckdb.connect()
    con.register("rows", plain.drop("features").toPandas())
    sql = compiled.score_sql(trained.model, names.__getitem__)
    assert con.execute(f"SELECT count(*) FROM rows WHERE abs(score - ({sql})) < 1e-9").fetchone() == (400,)


@pytest.mark.parametrize("class_weight", [None, "balanced"])
def test_logistic_fit_is_the_minimum(spark, rows, class_weight):
    trained = models.train(models.candidates()["logistica"], encoder(), rows, {"class_weight": class_weight, "C": 0.5})
    ready = workspace.cut(models.with_weight(trained.encoder.transform(rows), class_weight), "ready")
    weights, penalty = trained.model.coefficients.toArray(), trained.model.getRegParam()
    assert penalty == pytest.approx(1 / (0.5 * 400))
    data = ready.select("features", "label", "weight").collect()
    x = np.array([r.features.toArray() for r in data])
    y, w = np.array([r.label for r in data]), np.array([r.weight for r in data])
    # Newton's method on the same loss
    full, theta = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    ridge = np.diag([penalty] * x.shape[1] + [0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-full @ theta))
        g = full.T @ (w * (p - y)) / w.sum() + ridge @ theta
        theta -= np.linalg.solve((full * (w * p * (1 - p))[:, None]).T @ full / w.sum() + ridge, g)
    assert np.allclose([*weights, trained.model.intercept], theta, atol=2e-3)
    for at, flat in ((weights, True), (weights + 0.5, False)):
        margin = F.lit(float(trained.model.intercept)) + models.similarity(
            models.vector_to_array("features"),
            F.array(*[F.lit(float(v)) for v in at]),
        )
        found = {r.slot: r.gradient for r in compiled.penalised_gradient(ready, margin, F.col("weight"), at, penalty).collect()}
        theta_at = np.r_[at, trained.model.intercept]
        want = full.T @ (w * (1 / (1 + np.exp(-full @ theta_at)) - y)) / w.sum() + ridge @ theta_at
        assert [found[i] for i in (*range(len(at)), -1)] == pytest.approx(list(want), abs=1e-9)
        assert (max(map(abs, found.values())) < 1e-3) == flat


# ---------------------------------------------------------------- search


def test_search_equals_cross_validation_and_goes_on_where_it_stopped(spark, rows, monkeypatch):
    known = models.candidates()
    tried = [search.Configuration("logistica", known["logistica"], {"C": c, "class_weight": k}) for c, k in ((0.1, None), (3.0, "balanced"))]
    tried.append(search.Configuration("regla", models.Candidate("regla", score=lambda train, p: F.col("a") * p["k"]), {"k": -1.0}))
    parts = search.folds(rows, encoder(), "work_key")
    assert sorted(f.number for f in parts) == [-1, 0, 1, 2, 3, 4] and {f.width for f in parts} != {None}
    folder = workspace.new_folder(spark, "search")
    found = search.evaluate(tried, parts, "work_key", ["doc_id"], folder)
    tie = [F.col("doc_id")]
    for c, got in zip(tried, found):
        final = models.train(c.candidate, encoder(), rows, c.params)
        sets = models.cross_validate(c.candidate, encoder(), rows, "work_key", tie, c.params, final=final)
        want = models.summary_of(sets).first().asDict()
        assert {k: got[k] for k in want} == {k: pytest.approx(v, abs=1e-6) for k, v in want.items()}
        assert got["segundos_entrenamiento"] >= 0
    fits = []
    plain = search._scores
    monkeypatch.setattr(search, "_scores", lambda c, f: fits.append(c.name) or plain(c, f))
    assert search.evaluate(tried, parts, "work_key", ["doc_id"], folder) == found and fits == []
    more = [*tried[:2], search.Configuration("logistica", known["logistica"], {"C": 9.0})]
    search.evaluate(more, parts, "work_key", ["doc_id"], folder)
    assert len(fits) == 6


def test_search_logs_every_configuration_below_its_parent(spark, rows):
    log = workspace.new_folder(spark, "runs")
    space = {"k": models.whole(1, 50)}
    best = {n: models.Candidate("regla", score=lambda train, p, n=n: F.col(n) * p["k"], space=space) for n in ("a", "b")}
    parts = search.folds(rows.fillna(0.0, ["b"]), None, "work_key")
    parents = search.random_search(log, best, parts, "work_key", ["doc_id"], FACTS, n=7)
    logged = runs.read_runs(spark, log).collect()
    children = [r for r in logged if r.parent_run_id]
    assert len(logged) == 16 and {r.fase for r in logged} == {"tuning"}
    for name, parent in parents.items():
        mine = [r.params["k"] for r in children if r.parent_run_id == parent and r.name == name]
        assert sorted(mine) == sorted(str(p["k"]) for p in models.sampled_params(space, 7))
    again = search.finalists(runs.read_runs(spark, log).filter("parent_run_id IS NOT NULL"), best, n=1)
    assert list(again) == [max(children, key=lambda r: (r.metrics["cv_ap_mean"], r.run_id)).name]


def test_the_test_rows_are_looked_at_once(spark, rows):
    log = workspace.new_folder(spark, "runs")
    known = {n: (models.Candidate("regla", score=lambda train, p, s=s: F.col("a") * s), {}) for n, s in (("up", 1), ("down", -1))}
    parts = search.folds(rows, None, "work_key")
    search.compare(log, [search.Configuration(n, c) for n, (c, _) in known.items()], parts, "work_key", ["doc_id"], FACTS)
    broken = {n: (models.Candidate("regla", score=lambda train, p: F.col("nowhere")), {}) for n in known}
    args = (None, rows, rows.filter("doc_id < 100"), "work_key", [F.col("doc_id")], FACTS, "m")
    with pytest.raises(Exception, match="nowhere"):
        models.final_evaluation(log, runs.read_runs(spark, log), broken, *args)
    final = models.final_evaluation(log, runs.read_runs(spark, log), known, *args)
    with pytest.raises(models.AlreadyEvaluated):
        models.final_evaluation(log, runs.read_runs(spark, log), known, *args)
    logged = {r.run_id: r for r in runs.read_runs(spark, log).collect()}
    assert [r.run_id for r in logged.values() if r.fase == "final"] == [final]
    there = {r.alias: (r.version, logged[r.run_id].name) for r in registry.aliases(spark, f"{log}-registry", "m").collect()}
    assert there == {"champion": (1, "up"), "challenger": (2, "down")}
    registry.register(spark, f"{log}-registry", "m", [("later", "champion")])
    assert {r.alias: r.version for r in registry.aliases(spark, f"{log}-registry", "m").collect()} == {"champion": 3, "challenger": 2}


# ---------------------------------------------------------------- similarity


@pytest.mark.parametrize("block,tile", [(8192, 256), (7, 2)])
def test_similarity_equals_brute_force(spark, block, tile):
    r = np.random.default_rng(5)
    data = [("hot" if i % 10 else f"g{i % 30}", i, r.integers(-3, 4, 6).astype(float).tolist()) for i in range(300)]
    data += [("hot", 1000, None), (None, 1001, [0.0] * 6), ("alone", 1002, [1.0] * 6)]
    df = spark.createDataFrame(data, "label string, vec_id long, v array<float>")
    asks = df.filter("vec_id % 12 = 1 OR vec_id >= 1000").withColumnRenamed("vec_id", "ask")
    got = similarity.most_similar(asks, df, "label", "ask", "vec_id", "v", k=4, own="ask", block=block, tile=tile).collect()
    there = [x for x in data if x[0] is not None and x[2] is not None]
    want = []
    for label, ask, v in there:
        if ask % 12 == 1 or ask >= 1000:
            near = sorted((-float(np.dot(v, w)), key) for g, key, w in there if g == label and key != ask)
            want += [(label, ask, key, -s) for s, key in near[:4]]
    assert sorted(tuple(x) for x in got) == sorted(want)


def test_similarity_never_gathers_a_label(spark):
    """One label with every row: no product sees more than about a block of it."""
    df = spark.range(4000).select(F.lit("one").alias("label"), F.col("id").alias("vec_id"), F.array(F.rand(1), F.rand(2)).alias("v"))
    df = workspace.cut(df, "vectors")
    left = similarity._dealt(df.select("label", F.col("vec_id").alias("key")), "label", "key", 100, "block", "blocks")
    sizes = [r["count"] for r in left.groupBy("block").count().collect()]
    assert len(sizes) == 40 and max(sizes) < 200
    asks = df.filter("vec_id < 5").withColumnRenamed("vec_id", "ask")
    found = similarity.most_similar(asks, df, "label", "ask", "vec_id", "v", block=100, tile=2)
    assert found.count() == 15
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "block" in plan and "CartesianProduct" not in plan


def test_vectors_of_different_widths_are_refused(spark):
    df = spark.createDataFrame([("a", 1, [1.0]), ("a", 2, [1.0, 2.0])], "label string, vec_id long, v array<double>")
    with pytest.raises(Exception, match="different widths"):
        similarity.most_similar(df.withColumnRenamed("vec_id", "ask"), df, "label", "ask", "vec_id", "v").collect()


# ---------------------------------------------------------------- batches


@pytest.mark.parametrize("batch_size", [1, 3, 1000])
def test_an_encoder_sees_batches_of_the_given_size(spark, batch_size):
    def load():
        state = {"loads": 1, "calls": 0}

        def encode(texts):
            state["calls"] += 1
            return np.array([[len(t), len(texts), state["loads"]] for t in texts], np.float32)

        return encode

    texts = ["x" * (i % 9) for i in range(50)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string").repartition(2)
    got = {r.k: r.embedding for r in models.embed_batches(df, "k", "text", load, batch_size).collect()}
    assert got.keys() == {i for i, t in enumerate(texts) if t is not None}
    assert all(e[0] == len(texts[k]) and 1 <= e[1] <= batch_size for k, e in got.items())
