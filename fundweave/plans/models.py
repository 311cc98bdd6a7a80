"""Candidates, grouped cross-validation, final evaluation and text embedding."""

from __future__ import annotations

import hashlib
import math
import random
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import HashingTF, IDF, Normalizer, RegexTokenizer
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import ranking as K
from ..operators.encode import FeatureEncoder, FeatureEncoderModel
from ..operators.quality import union_all
from ..operators.sampling import SEED
from ..sources import registry, workspace
from ..sources import runs as R


@dataclass(frozen=True)
class Candidate:
    """`build(params)` gives a Spark ML estimator over `features` and `label`, or None for a scorer
    that only needs `score(train, params)`, a column over the rows."""

    family: str
    build: Callable[[Mapping], object] | None = None
    score: Callable[[DataFrame, Mapping], Column] | None = None
    space: Mapping[str, Callable[[random.Random], object]] = field(default_factory=dict)
    params: Mapping[str, object] = field(default_factory=dict)


def log_uniform(low: float, high: float):
    return lambda rng: math.exp(rng.uniform(math.log(low), math.log(high)))


def one_of(*values):
    return lambda rng: rng.choice(values)


def whole(low: int, high: int):
    return lambda rng: rng.randint(low, high)


def prior_score(train: DataFrame, params: Mapping) -> Column:
    """Every row gets the training positive rate: one number comes back."""
    return F.lit(train.agg(F.avg(F.col("label").cast("double"))).first()[0])


def logistic(params: Mapping) -> LogisticRegression:
    """`C` is the inverse penalty on the summed loss; Spark penalises the mean, hence C * n."""
    return LogisticRegression(
        maxIter=params.get("max_iter", 1000),
        regParam=1.0 / (params.get("C", 1.0) * params["n"]),
        elasticNetParam=0.0,
        standardization=False,
        weightCol="weight",
    )


def candidates(rule: Column | None = None) -> dict[str, Candidate]:
    found = {
        "dummy_prior": Candidate("dummy", score=prior_score),
        "logistica": Candidate(
            "lineal", logistic,
            space={"C": log_uniform(1e-3, 1e2), "class_weight": one_of(None, "balanced")},
        ),
        "bosque": Candidate(
            "bagging",
            lambda p: RandomForestClassifier(
                numTrees=p.get("trees", 20), maxDepth=p.get("depth", 5), weightCol="weight", seed=SEED
            ),
            space={"trees": whole(10, 60), "depth": whole(3, 10)},
        ),
        "boosting": Candidate(
            "boosting",
            lambda p: GBTClassifier(
                maxIter=p.get("rounds", 10), maxDepth=p.get("depth", 3), stepSize=p.get("step", 0.1),
                weightCol="weight", seed=SEED,
            ),
            space={"rounds": whole(5, 30), "depth": whole(2, 6), "step": log_uniform(0.02, 0.3)},
        ),
        "red": Candidate(
            "red_neuronal",
            lambda p: MultilayerPerceptronClassifier(
                layers=[p["width"], p.get("hidden", 8), 2], maxIter=p.get("max_iter", 30), seed=SEED
            ),
            space={"hidden": whole(4, 32)},
        ),
    }
    if rule is not None:
        found["regla"] = Candidate("regla", score=lambda train, params: rule)
    return found


def with_weight(train: DataFrame, class_weight: str | None) -> DataFrame:
    n, positives = train.agg(F.count(F.lit(1)), F.sum(F.col("label").cast("long"))).first()
    return train.withColumn("weight", weight_of(class_weight, n, positives or 0))


def weight_of(class_weight: str | None, n: int, positives: int) -> Column:
    """'balanced' gives each class the same total weight: n / (2 * n_class)."""
    if class_weight is None:
        return F.lit(1.0)
    positive, negative = n / (2.0 * max(positives, 1)), n / (2.0 * max(n - positives, 1))
    return F.when(F.col("label") == 1, positive).otherwise(negative)


def positive_score(prediction: DataFrame) -> Column:
    """Probability of the positive class, or the margin for a model without probabilities."""
    column = "probability" if "probability" in prediction.columns else "rawPrediction"
    return vector_to_array(column)[1]


@dataclass
class Trained:
    encoder: object
    model: object | None
    scorer: Column | None
    params: Mapping
    seconds: float = 0.0

    def score(self, rows: DataFrame) -> DataFrame:
        """The rows plus `score`."""
        if self.model is None:
            return rows.withColumn("score", self.scorer)
        predicted = self.model.transform(self.encoder.transform(rows))
        return predicted.select(*rows.columns, positive_score(predicted).alias("score"))

    def save(self, path: str) -> None:
        """Encoder, model and parameters below `path`, by Spark ML's own writers."""
        if self.model is None:
            raise ValueError("a scorer without a fitted model has nothing to save")
        self.encoder.write().save(f"{path}/encoder")
        self.model.write().save(f"{path}/model")
        rows = [({k: str(v) for k, v in self.params.items()}, float(self.seconds))]
        SparkSession.active().createDataFrame(rows, "params map<string,string>, seconds double").write.parquet(f"{path}/facts")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Trained:
        """What `save` wrote; parameters come back as text."""
        facts = spark.read.parquet(f"{path}/facts").first()  # one row
        model = DefaultParamsReader.loadParamsInstance(f"{path}/model", spark)
        return Trained(FeatureEncoderModel.load(f"{path}/encoder"), model, None, facts["params"], facts["seconds"])


def train(candidate: Candidate, encoder: FeatureEncoder, rows: DataFrame, params: Mapping | None = None) -> Trained:
    params, began = {**candidate.params, **(params or {})}, time.perf_counter()
    if candidate.build is None:
        return Trained(None, None, candidate.score(rows, params), params, time.perf_counter() - began)
    fitted = encoder.fit(rows)
    ready = with_weight(fitted.transform(rows), params.get("class_weight"))
    ready = ready.select("features", F.col("label").cast("double").alias("label"), "weight")
    estimator = candidate.build({**params, "n": ready.count(), "width": fitted.width()})
    return Trained(fitted, estimator.fit(ready), None, params, time.perf_counter() - began)


def metrics_of(scored: DataFrame, group: str, tie: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    ap = K.average_precision(scored, by=by)
    p = K.precision_at_k(scored, group, tie=tie, by=by)
    return ap.join(p, list(by)) if by else ap.crossJoin(p)  # one row each


#: Stands for "the rows the final model was fitted on" where sets of rows are told apart by fold.
TRAINING = -1


def _scored(trained: Trained, rows: DataFrame, group: str, fold: int) -> DataFrame:
    kept = [c for c in ("award_key", "doc_id") if c in rows.columns and c != group]
    return trained.score(rows).select(group, "label", "score", F.lit(fold).alias("fold"), *kept)


def cross_validate(
    candidate: Candidate,
    encoder: FeatureEncoder,
    rows: DataFrame,
    group: str,
    tie: Sequence[Column],
    params: Mapping | None = None,
    n_folds: int = K.N_FOLDS,
    final: Trained | None = None,
    hash_of=None,
) -> DataFrame:
    """Per fold: ap and p_at_3 on rows whose group the model has not seen; with a `final` model also
    those of the rows it was fitted on, as fold TRAINING.

    Each fit is a distributed job of its own and the folds' jobs are submitted side by side; the
    scores of all sets are then measured together, keyed by fold. A fold without rows has no line,
    and one without positives no ap: `summary_of` says how many folds it is about.
    """
    folded = K.with_fold(rows, group, n_folds, hash_of)

    def held_out(fold: int) -> DataFrame:
        outside, inside = folded.filter(F.col("fold") != fold), folded.filter(F.col("fold") == fold)
        return _scored(train(candidate, encoder, outside, params), inside, group, fold)

    with ThreadPool(n_folds) as pool:
        parts = pool.map(inheritable_thread_target(rows.sparkSession)(held_out), range(n_folds))
    if final is not None:
        parts.append(_scored(final, rows, group, TRAINING))
    return metrics_of(workspace.cut(union_all(parts), "folds"), group, tie, by=["fold"])


def summary_of(sets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row (for each `by`): mean and sample deviation over held-out folds, the number of folds with
    an ap, and where the training rows were measured too, their metrics and the gap to the folds' mean."""
    inside = lambda m: F.when(F.col("fold") != TRAINING, F.col(m))
    on_train = lambda m: F.max(F.when(F.col("fold") == TRAINING, F.col(m)))
    one = sets.groupBy(*by).agg(
        *[F.avg(inside(m)).alias(f"cv_{m}_mean") for m in R.MEASURED],
        *[F.stddev_samp(inside(m)).alias(f"cv_{m}_std") for m in R.MEASURED],
        F.count(inside("ap")).alias("cv_folds"),
        *[on_train(m).alias(f"train_{m}") for m in R.MEASURED],
    )
    return one.select("*", *[R.gap(m, F.col) for m in R.MEASURED])


def origin_of(manifest: Mapping, group: str) -> dict[str, object]:
    """Where a run's rows came from and how they were split, under the log's fixed names."""
    read = {"datos_tabla": "tabla_origen", "datos_corte": "fecha_corte", "datos_hash": "content_hash", "datos_filas": "filas"}
    split = {"semilla": SEED, "n_folds": K.N_FOLDS, "esquema_cv": f"GroupKFold({group})"}
    return split | {logged: manifest[name] for logged, name in read.items()}


def run(
    log_path: str,
    name: str,
    phase: str,
    candidate: Candidate,
    encoder: FeatureEncoder,
    rows: DataFrame,
    group: str,
    tie: Sequence[Column],
    manifest: Mapping,
    params: Mapping | None = None,
    parent: str | None = None,
    commit: str = R.UNKNOWN_COMMIT,
    hash_of=None,
) -> tuple[str, dict]:
    """Fits on all rows, measures that model and the folds' in one frame, and logs the run."""
    R.check(phase, candidate.family)
    final = train(candidate, encoder, rows, params)
    sets = cross_validate(candidate, encoder, rows, group, tie, params, final=final, hash_of=hash_of)
    measured = summary_of(sets).first().asDict() | {"segundos_entrenamiento": final.seconds}
    logged = origin_of(manifest, group) | dict(params or {})
    run_id = R.log_run(rows.sparkSession, log_path, name, candidate.family, phase, logged, measured, commit, parent)
    return run_id, measured


def sampled_params(space: Mapping, n: int, seed: int = SEED) -> list[dict]:
    """n seeded draws from a parameter space."""
    rng = random.Random(seed)
    return [{k: draw(rng) for k, draw in sorted(space.items())} for _ in range(n)]


class AlreadyEvaluated(RuntimeError):
    """The test rows have been looked at for this selection."""


def final_evaluation(
    log_path: str,
    runs: DataFrame,
    known: Mapping[str, tuple[Candidate, Mapping]],
    encoder: FeatureEncoder | None,
    rows: DataFrame,
    test: DataFrame,
    group: str,
    tie: Sequence[Column],
    manifest: Mapping,
    model: str = "model",
) -> str:
    """The best logged run, fitted again on all training rows and measured once on the test rows; the
    id of the logged run. `known`: run name -> its candidate and parameters.

    The selection, which is the best run and the data it was chosen on, is claimed before the test rows
    are read: a second evaluation raises `AlreadyEvaluated`, also from another session. A failed
    evaluation gives its claim back. The two best runs get the registry's aliases.
    """
    spark = rows.sparkSession
    best = R.finalists(runs, n=len(R.ALIASES)).orderBy("place").collect()  # one row for each alias
    first = best[0]
    candidate, params = known[first["name"]]
    facts = f"{first['run_id']} {manifest['content_hash']}"
    claim = f"{log_path}-claims/{hashlib.sha256(facts.encode()).hexdigest()}"
    if not workspace.claim(spark, claim):
        raise AlreadyEvaluated(f"run {first['run_id']} has been measured on the test rows")
    try:
        trained = train(candidate, encoder, rows, params)
        found = metrics_of(trained.score(test), group, tie).first().asDict()
        run_id = R.log_run(
            spark, log_path, first["name"], candidate.family, "final", origin_of(manifest, group) | dict(params),
            {f"test_{m}": v for m, v in found.items()}, parent=first["run_id"],
        )
    except Exception:
        workspace.discard(spark, [claim])
        raise
    registry.register(spark, f"{log_path}-registry", model, [(r["run_id"], r["alias"]) for r in best])
    return run_id


# Width of the offline embedding. Words share a slot where their hashes do: raise it for corpora whose
# vocabulary is much larger.
EMBEDDING_SIZE = 4096


def text_embedder(input_col: str, output_col: str, size: int = EMBEDDING_SIZE) -> Pipeline:
    """Offline embedding: hashed term weights, unit length. Any estimator with the same columns can
    stand in for it."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=input_col, outputCol="_words", pattern=r"\s+"),
            HashingTF(inputCol="_words", outputCol="_counts", numFeatures=size),
            IDF(inputCol="_counts", outputCol="_weights"),
            Normalizer(inputCol="_weights", outputCol=output_col),
        ]
    )


def embed_text(df: DataFrame, key: str, text: str, embedder=None, size: int = EMBEDDING_SIZE) -> DataFrame:
    """key -> ARRAY<FLOAT>; keys without text have no row."""
    rows = df.select(key, text).filter(F.col(text).isNotNull())
    stage = embedder or text_embedder(text, "_embedding", size)
    fitted = stage.fit(rows)
    return fitted.transform(rows).select(key, vector_to_array("_embedding", "float32").alias("embedding"))


def embed_batches(
    df: DataFrame, key: str, text: str, load: Callable[[], Callable], batch_size: int = 256
) -> DataFrame:
    """key -> ARRAY<FLOAT> by any encoder of whole batches; keys without text have no row.

    `load()` runs once in each Python worker and returns encode(texts), which takes an array of texts
    and returns one row of numbers for each. Spark cuts the Arrow stream into `batch_size` texts.
    """
    encode = predict_batch_udf(load, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
    rows = df.select(key, text).filter(F.col(text).isNotNull())
    return rows.select(key, encode(text).alias("embedding"))


def similarity(a: Column, b: Column) -> Column:
    """Dot product of two arrays of the same length."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
