import pytest
from pyspark.sql import functions as F

from fundweave.plans import models
from fundweave.sources import runs, workspace


def test_queries_train_with_the_stated_defaults(spark, monkeypatch):
    """The reference's 1000 iterations at most, and no query trains less than a candidate's default."""
    from fundweave.workload import scoring

    found = models.candidates()
    assert found["logistica"].build({"n": 10}).getMaxIter() == 1000
    asked, plain = [], models.train
    monkeypatch.setattr(models, "train", lambda c, e, r, params=None: asked.append((c.family, params)) or plain(c, e, r, params))
    scoring.tree_models(spark, "/root/testdata/sf0.001")
    scoring.logistic(spark, "/root/testdata/sf0.001")
    assert asked == [("bagging", None), ("boosting", None), ("red_neuronal", None), ("lineal", {"class_weight": "balanced"})]


def test_best_run_is_measured_once_on_the_test_rows(spark):
    """The rule orders by a score that is the label; the prior knows nothing. The rule wins and is perfect."""
    data = [(f"W{i % 30}", i, int(i % 3 == 0)) for i in range(300)]
    rows = spark.createDataFrame(data, "work_key string, doc_id long, label int").withColumn("s", F.col("label") * 2.0)
    log, tie = workspace.new_folder(spark, "runs"), [F.col("doc_id")]
    facts = {"tabla_origen": "t", "fecha_corte": "2024-01-01", "content_hash": "h", "filas": 300}
    found = models.candidates(F.col("s"))
    by_group = lambda g: F.substring(g, 2, 9).cast("long")
    for name in ("dummy_prior", "regla"):
        _, measured = models.run(log, name, "baseline", found[name], None, rows, "work_key", tie, facts, hash_of=by_group)
        assert measured["cv_folds"] == 5
        assert measured["brecha_ap"] == pytest.approx(measured["train_ap"] - measured["cv_ap_mean"])
    known = {name: (found[name], {}) for name in found}
    run_id = models.final_evaluation(log, runs.read_runs(spark, log), known, None, rows, rows.filter("doc_id < 90"), "work_key", tie, facts)
    logged = {r.run_id: r for r in runs.read_runs(spark, log).collect()}
    final = logged[run_id]
    assert (final.name, final.fase, logged[final.parent_run_id].name) == ("regla", "final", "regla")
    assert final.metrics["test_ap"] == pytest.approx(1.0)
