"""Tuning: many configurations over the same folds.

Folds are encoded and stored once. Every fit is a distributed job over a stored fold, several are
submitted side by side, and each writes its held-out scores to a folder of its own, so a search that is
cut short goes on where it stopped. All configurations are then measured in one frame keyed by
(configuration, fold), and logged in one append.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import ranking as K
from ..operators.encode import FeatureEncoder
from ..operators.sampling import SEED
from ..sources import workspace
from ..sources import runs as R
from .models import TRAINING, Candidate, metrics_of, origin_of, positive_score, sampled_params, summary_of, weight_of

#: Fits submitted side by side.
PARALLEL = 8


@dataclass(frozen=True)
class Configuration:
    name: str
    candidate: Candidate
    params: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class Fold:
    """Stored rows a model is fitted on, and those it is measured on."""

    number: int
    fitted_on: DataFrame
    measured_on: DataFrame
    n: int
    positives: int
    width: int | None


def folds(
    rows: DataFrame, encoder: FeatureEncoder | None, group: str, n_folds: int = K.N_FOLDS, hash_of=None
) -> list[Fold]:
    """The grouped folds, and as TRAINING all rows on both sides. Without an encoder the rows stay as
    they are. A fold without rows is left out."""
    folded = K.with_fold(rows, group, n_folds, hash_of)

    def one(number: int) -> Fold | None:
        outside, inside = folded.filter(F.col("fold") != number), folded.filter(F.col("fold") == number)
        if number == TRAINING:
            inside = folded
        outside, inside, width = outside.drop("fold"), inside.drop("fold"), None
        if encoder is not None:
            fitted = encoder.fit(outside)
            outside, inside, width = fitted.transform(outside), fitted.transform(inside), fitted.width()
        outside, inside = workspace.cut(outside, "fitted_on"), workspace.cut(inside, "measured_on")
        if inside.isEmpty():
            return None
        n, positives = outside.agg(F.count(F.lit(1)), F.sum(F.col("label").cast("long"))).first()
        return Fold(number, outside, inside, n, positives or 0, width)

    with ThreadPool(n_folds + 1) as pool:
        found = pool.map(inheritable_thread_target(rows.sparkSession)(one), [TRAINING, *range(n_folds)])
    return [f for f in found if f is not None]


def _scores(configuration: Configuration, fold: Fold) -> tuple[DataFrame, Column, float]:
    """Rows of the fold, their score by the configuration, and the seconds of the fit."""
    candidate, params, began = configuration.candidate, dict(configuration.params), time.perf_counter()
    params = {**candidate.params, **params}
    if candidate.build is None:
        return fold.measured_on, candidate.score(fold.fitted_on, params), time.perf_counter() - began
    weight = weight_of(params.get("class_weight"), fold.n, fold.positives).alias("weight")
    ready = fold.fitted_on.select("features", F.col("label").cast("double").alias("label"), weight)
    model = candidate.build({**params, "n": fold.n, "width": fold.width}).fit(ready)
    seconds = time.perf_counter() - began
    predicted = model.transform(fold.measured_on)
    return predicted, positive_score(predicted), seconds


def evaluate(
    configurations: Sequence[Configuration],
    parts: Sequence[Fold],
    group: str,
    tie: Sequence[str],
    folder: str | None = None,
    parallel: int = PARALLEL,
) -> list[dict]:
    """For each configuration its summary over the folds and `segundos_entrenamiento` of the fit on all
    rows. `tie` names the columns that order equal scores. With a `folder` of an earlier call with the
    same arguments, what is stored there already is not fitted again."""
    spark = parts[0].fitted_on.sparkSession
    folder = folder or workspace.new_folder(spark, "search")
    keys = [group, *[c for c in tie if c != group]]
    # Scorers without a fit share one pass over a fold; a fitted model has a pass of its own.
    scorers = [i for i, c in enumerate(configurations) if c.candidate.build is None]
    units = [([i], f) for i, c in enumerate(configurations) if c.candidate.build is not None for f in parts]
    units += [(scorers, f) for f in parts if scorers]
    kept = [parts[0].measured_on.schema[c] for c in (*keys, "label")]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    schema = f"{columns}, config int, score double, seconds double, fold int"

    def run(unit: tuple[list[int], Fold]) -> str:
        members, fold = unit
        # Named by what is fitted, so that a later search finds its own results only.
        told = repr([(i, configurations[i].name, sorted(configurations[i].params.items())) for i in members])
        place = f"{folder}/fold{fold.number}-{hashlib.sha256(told.encode()).hexdigest()[:24]}"
        if not workspace.exists(spark, f"{place}/_SUCCESS"):
            found = [(i, *_scores(configurations[i], fold)) for i in members]
            each = F.array(*[
                F.struct(F.lit(i).alias("config"), score.cast("double").alias("score"), F.lit(s).alias("seconds"))
                for i, _, score, s in found
            ])
            rows = found[0][1].select(*keys, "label", F.explode(each).alias("x"))
            rows = rows.select(*keys, "label", "x.*", F.lit(fold.number).alias("fold"))
            rows.write.mode("overwrite").parquet(place)
        return place

    with ThreadPool(parallel) as pool:
        places = pool.map(inheritable_thread_target(spark)(run), units, chunksize=1)
    scores = spark.read.schema(schema).parquet(*places)
    measured = metrics_of(scores, group, [F.col(c) for c in tie], by=["config", "fold"])
    fits = scores.filter(F.col("fold") == TRAINING).groupBy("config").agg(
        F.max("seconds").alias("segundos_entrenamiento")
    )
    # one row per configuration
    found = {r["config"]: r.asDict() for r in summary_of(measured, ["config"]).join(fits, "config", "left").collect()}
    return [{k: v for k, v in found.get(i, {}).items() if k != "config"} for i in range(len(configurations))]


def compare(
    log_path: str,
    configurations: Sequence[Configuration],
    parts: Sequence[Fold],
    group: str,
    tie: Sequence[str],
    manifest: Mapping,
    phase: str = "candidato",
    parents: Mapping[str, str] | None = None,
    **options,
) -> list[str]:
    """Evaluates all configurations and logs a run for each, below the parent of its name if it has
    one; their run ids."""
    spark, origin = parts[0].fitted_on.sparkSession, origin_of(manifest, group)
    rows = [
        R.run_row(c.name, c.candidate.family, phase, origin | dict(c.params), m, parent=(parents or {}).get(c.name))
        for c, m in zip(configurations, evaluate(configurations, parts, group, tie, **options))
    ]
    R.log_rows(spark, log_path, rows)
    return [r[0] for r in rows]


def random_search(
    log_path: str,
    best: Mapping[str, Candidate],
    parts: Sequence[Fold],
    group: str,
    tie: Sequence[str],
    manifest: Mapping,
    n: int = 30,
    seed: int = SEED,
    **options,
) -> dict[str, str]:
    """`n` seeded configurations of each of the `best` candidates, as runs below one parent run for
    each candidate; the parents' ids by name."""
    spark, origin = parts[0].fitted_on.sparkSession, origin_of(manifest, group)
    parents = [R.run_row(name, c.family, "tuning", origin | {"n": n}, {}) for name, c in best.items()]
    R.log_rows(spark, log_path, parents)
    ids = dict(zip(best, (p[0] for p in parents)))
    drawn = [Configuration(name, c, p) for name, c in best.items() for p in sampled_params(c.space, n, seed)]
    compare(log_path, drawn, parts, group, tie, manifest, "tuning", ids, **options)
    return ids


def finalists(runs: DataFrame, known: Mapping[str, Candidate], n: int = 3) -> dict[str, Candidate]:
    """The candidates of the n best runs, best first."""
    return {r["name"]: known[r["name"]] for r in R.finalists(runs, n=n).orderBy("place").collect()}  # n rows
