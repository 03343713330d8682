"""Training runs: folds, out-of-fold predictions, blend, calibration, output.

Learner settings default to the full budgets; pass learners of your own for a quick run.
"""

from __future__ import annotations

from contextlib import ExitStack
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe import config
from riskframe.functions.cleaning import coerce_numeric
from riskframe.functions.features import clip_unit
from riskframe.learners.base import FeatureSet, Learner
from riskframe.learners.boosting import BoostedTrees, StagedTrees
from riskframe.learners.crossval import CrossValidation, cross_validate
from riskframe.learners.histogram import HistogramBoost
from riskframe.learners.network import Network
from riskframe.learners.search import best_settings, search_settings
from riskframe.operators.columns import feature_columns, split_kinds
from riskframe.operators.encode import add_fold_native_codes, fill_medians
from riskframe.operators.ensemble import (
    best_calibration, blend_centre, calibrated, optimal_weights, weighted_blend)
from riskframe.operators.evaluation import class_report, confusion, metrics_by_fold
from riskframe.operators.folds import fold_train_rows, group_kfold, kfold
from riskframe.operators.joins import align_models
from riskframe.operators.rows import test_rows, train_rows
from riskframe.operators.spatial import add_spatial_groups
from riskframe.plans.features import (
    code_sizes, ensemble_features, fold_encoded, minimal_features, staged_features)
from riskframe.sources.runs import RunLog, load_models, logged_values
from riskframe.session import cut_lineage, held, training_run


@dataclass
class TrainingRun:
    """`oof`: id, fold, target, one column per model and `blend`; `test`: id and columns."""

    oof: DataFrame
    test: DataFrame
    models: list[str]
    weights: dict[str, float]
    scores: DataFrame
    fitted: dict = field(default_factory=dict)

    def submission(self, column: str = "blend") -> DataFrame:
        return self.test.select(config.ID, clip_unit(F.col(column)).alias(config.TARGET))


def tree_learners(rounds: int | None = None, patience: int | None = None,
                  overrides: dict | None = None) -> list[Learner]:
    """The three squared-loss boosters on MLlib's trees: native categories, depth-wise, categorical."""
    extra = {k: v for k, v in (("rounds", rounds), ("patience", patience),
                               ("overrides", overrides)) if v is not None}
    return [BoostedTrees("wide", "wide", True, **extra),
            BoostedTrees("depthwise", "depthwise", False, **extra),
            BoostedTrees("categorical", "categorical", True, **extra)]


def leafwise_learners(**changes) -> list[Learner]:
    """The same three roles by histograms: leaf-wise with native categories, depth-wise, and with
    categories and a penalty on leaf values. `changes` to their settings hold for all."""
    return [HistogramBoost.of("wide", uses_nominal=True, **changes),
            HistogramBoost.of("depthwise", **changes),
            HistogramBoost.of("categorical", uses_nominal=True, **changes)]


def _train_folds(df: DataFrame, folds: DataFrame) -> DataFrame:
    """Attach train folds by id; test rows keep a null fold."""
    return df.drop("fold").join(folds.select(config.ID, "fold"), config.ID, "left")


def finish(df: DataFrame, result: CrossValidation, names: list[str]) -> TrainingRun:
    """Blend with optimal weights and score every model per fold and overall."""
    wide = result.wide(names)
    truth = train_rows(df).select(config.ID, "fold", config.TARGET)
    oof = cut_lineage(truth.join(train_rows(wide).drop(config.SPLIT), config.ID))
    weights = (optimal_weights(oof, names) if len(names) > 1 else {names[0]: 1.0})
    blend = weighted_blend(weights).alias("blend")
    oof = oof.select("*", blend)
    test = test_rows(wide).drop(config.SPLIT).select("*", blend)
    scores = metrics_by_fold(oof, [*names, "blend"])
    return TrainingRun(oof, test, names, weights, scores, result.models)


def _record(log: RunLog | None, run: TrainingRun, params: dict, learners: list,
            extra: dict | None = None) -> None:
    """Settings of the run and its learners, weights, scores per fold and overall, saved models."""
    if log is None:
        return
    log.params(params)
    for learner in learners:
        settings = learner.settings() if isinstance(learner, Learner) else vars(learner)
        log.params({f"{learner.name}.{key}": value for key, value in settings.items()})
    log.params({f"blend_w_{m}": round(w, 4) for m, w in run.weights.items()})
    log.params({f"weight.{m}": repr(float(w)) for m, w in run.weights.items()})
    for r in run.scores.collect():                 # (folds + 1) × models rows
        where = "oof" if r["fold"] is None else f"fold{r['fold']}"
        log.metrics({f"{where}_{r['model']}_{s}": r[s] for s in ("custom", "rmse", "mae", "r2")
                     if r[s] is not None})
    log.metrics(extra or {})
    for name, models in run.fitted.items():
        log.save_models(name, models)
    log.flush()


def score_saved(data: DataFrame, features: dict[str, FeatureSet], path: str, run_id: str,
                nominal: tuple[str, ...] = (), clip: bool = False) -> DataFrame:
    """id, a column per learner and `blend` from the models and weights of a logged run.

    `data` is prepared like that of the run. A learner's value is the mean over its fold models;
    learners named in `nominal` see categories as such.
    """
    spark = data.sparkSession
    models = load_models(spark, path, run_id, StagedTrees.load)
    weights = {m: float(w) for m, w in logged_values(spark, path, run_id, "weight.").items()}
    scored = None
    for name, folds in models.items():
        for f, model in folds.items():
            rows = features[name].assemble(data, f, name in nominal)
            value = clip_unit(F.col("_p")) if clip else F.col("_p")
            part = model.predict(rows, "_p").select(config.ID, F.lit(name).alias("model"), value.alias("prediction"))
            scored = part if scored is None else scored.unionByName(part)
    wide = align_models(scored, list(models))
    return wide.select("*", weighted_blend({m: weights[m] for m in models}).alias("blend"))


# --- runs ------------------------------------------------------------------

@training_run
def baseline_run(df: DataFrame, learner: Learner | None = None, k: int = config.N_FOLDS,
                 log: RunLog | None = None) -> TrainingRun:
    """One booster on raw columns with native categories, shuffled folds."""
    learner = learner or HistogramBoost.of("baseline", uses_nominal=True)
    df = coerce_numeric(df)
    features = feature_columns(train_rows(df), test_rows(df).drop(config.TARGET), "baseline")
    scalars, categories = split_kinds(df, features)
    data = _shuffled(df, k)
    data = add_fold_native_codes(data, categories, k, suffix="_native")
    native = [f"{c}_native" for c in categories]
    data = data.select(config.ID, config.SPLIT, "fold", config.TARGET, *scalars, *native)
    with held(data) as data:
        sets = {learner.name: FeatureSet(scalars, native, code_sizes(data, native, arrays=True))}
        run = finish(data, cross_validate(data, [learner], sets, k), [learner.name])
    _record(log, run, {"n_folds": k, "n_features": len(scalars) + len(native)}, [learner])
    return run


def _shuffled(df: DataFrame, k: int) -> DataFrame:
    return kfold(df, k).withColumn(
        "fold", F.when(F.col(config.SPLIT) == config.TRAIN, F.col("fold")))


@training_run
def grouped_run(df: DataFrame, learner: Learner | None = None, k: int = config.N_FOLDS,
                log: RunLog | None = None, group: str = "district") -> TrainingRun:
    """Huber booster on label codes, folds by group, predictions limited to [0, 1]."""
    learner = learner or HistogramBoost.of("huber")
    data, names, codes = minimal_features(df, group)
    with held(fold_train_rows(data.drop("fold"), "fold_group", k)) as data:
        sets = {learner.name: FeatureSet(names)}
        run = finish(data, cross_validate(data, [learner], sets, k, clip=True), [learner.name])
        if log is not None:
            cells = confusion(run.oof, learner.name).first().asDict()
            report = {}
            for r in class_report(run.oof, learner.name).collect():
                label = "flood" if r["class"] == 1 else "noflood"
                report.update({f"oof_{s}_{label}": r[s] for s in ("precision", "recall", "f1")})
                report["oof_binary_accuracy"] = r["accuracy"]
            _record(log, run, {"n_folds": k, "cv_strategy": f"group_{group}",
                               "num_features": len(names), "cat_cols": codes}, [learner],
                    {**report, **{f"cm_{c}": v for c, v in cells.items()}})
        return run


@training_run
def ensemble_run(df: DataFrame, learners: list[Learner] | None = None,
                 k: int = config.N_FOLDS, restarts: int = config.KMEANS_RESTARTS,
                 log: RunLog | None = None) -> TrainingRun:
    """Three boosters on whole-train encodings with shuffled folds, optimal blend."""
    learners = learners or leafwise_learners()
    data, names, codes = ensemble_features(df, restarts=restarts)
    with held(_shuffled(data, k)) as data:
        features = FeatureSet(names, [], code_sizes(data, codes, arrays=False))
        sets = {m.name: features for m in learners}
        run = finish(data, cross_validate(data, learners, sets, k), [m.name for m in learners])
        _record(log, run, {"models": "+".join(run.models), "n_folds": k,
                           "n_features": len(names)}, learners)
        return run


@training_run
def spatial_run(df: DataFrame, learners: list[Learner] | None = None, stage: int = 3,
                density: str = "near", network: Network | None = None,
                k: int = config.N_FOLDS, groups: int = config.SPATIAL_GROUPS,
                restarts: int = config.KMEANS_RESTARTS, log: RunLog | None = None
                ) -> TrainingRun:
    """Boosters, and optionally a network, with spatial group folds and leak-free encodings."""
    learners = list(learners or leafwise_learners())
    with ExitStack() as stack:
        def keep(table: DataFrame) -> DataFrame:
            return stack.enter_context(held(table))
        built = keep(staged_features(df, stage, density))
        labelled = add_spatial_groups(
            built.select(config.ID, config.SPLIT, *config.COORDINATES), groups, restarts=restarts)
        folds = keep(group_kfold(train_rows(labelled), "spatial_group", k).select(config.ID, "fold"))
        data, sets = fold_encoded(_train_folds(built, folds), k, keep=keep)
        chosen = {m.name: sets["native" if m.name == "wide" else "coded"] for m in learners}
        result = cross_validate(data, learners, chosen, k)
        names = [m.name for m in learners]
        if network is not None:
            result = _with_network(data, result, network, sets["coded"], k)
            names.append(network.name)
        run = finish(data, result, names)
        _record(log, run, {"models": "+".join(names), "n_folds": k, "stage": stage},
                [*learners, *([network] if network is not None else [])])
        return run


@training_run
def network_run(df: DataFrame, network: Network | None = None,
                used: list[str] = config.GROUP_STAT_COLUMNS, k: int = config.N_FOLDS,
                log: RunLog | None = None) -> TrainingRun:
    """The network alone on numeric columns, shuffled folds."""
    network = network or Network()
    with held(_shuffled(df, k).select(config.ID, config.SPLIT, "fold", config.TARGET, *used)) as data:
        run = finish(data, _with_network(data, None, network, FeatureSet(used), k), [network.name])
        _record(log, run, {"n_folds": k, "n_features": len(used)}, [network])
        return run


def _with_network(data: DataFrame, result: CrossValidation | None, network: Network,
                  features: FeatureSet, k: int) -> CrossValidation:
    """Fold models of a learner that needs fold-train medians instead of a fill value, after those
    of `result`."""
    predictions, models = (result.predictions, dict(result.models)) if result else (None, {})
    models[network.name] = {}
    for f in range(k):
        flat = data.select(
            config.ID, config.SPLIT, "fold", config.TARGET,
            *[(F.get(c, F.lit(f)) if c in features.per_fold else F.col(c)).cast("double").alias(c)
              for c in features.names])
        holed = [c for c in features.names if c not in features.per_fold]
        filled = fill_medians(flat, holed, train_rows(flat).filter(F.col("fold") != f))
        vectors = FeatureSet(features.names, fill=0.0).assemble(filled, None).persist()
        train = train_rows(vectors)
        model = network.fit(train.filter(F.col("fold") != f), train.filter(F.col("fold") == f))
        models[network.name][f] = model
        rows = train.filter(F.col("fold") == f).unionByName(test_rows(vectors))
        part = cut_lineage(model.predict(rows, "_p").select(
            config.ID, config.SPLIT, F.lit(f).alias("fold"),
            F.lit(network.name).alias("model"), F.col("_p").alias("prediction")))
        vectors.unpersist()
        predictions = part if predictions is None else predictions.unionByName(part)
    return CrossValidation(predictions, models)


def calibrate_run(run: TrainingRun, column: str = "blend", log: RunLog | None = None
                  ) -> tuple[DataFrame, float, float]:
    """Test predictions with `raw` and `calibrated`, the factor found and its OOF score.

    Centre and factor come from the train rows and are applied to test unchanged.
    """
    factor, score = best_calibration(run.oof, column)
    centre = blend_centre(run.oof, column)
    if log is not None:
        log.params({"calibration_factor": factor, "calibration_centre": centre})
        log.metric("oof_calibrated_custom", score)
        log.flush()
    return run.test.select(
        config.ID, F.col(column).alias("raw"),
        calibrated(F.col(column), centre, factor).alias("calibrated")), factor, score


@training_run
def tuned_run(df: DataFrame, trials: int = 60, tuning_rounds: int = 2000, rounds: int = 3000,
              patience: int = 100, k: int = config.N_FOLDS, limits: dict | None = None,
              restarts: int = config.KMEANS_RESTARTS, parallelism: int = 8,
              log: RunLog | None = None) -> tuple[TrainingRun, DataFrame]:
    """Search settings with three folds, then refit the best on all folds."""
    data, names, codes = ensemble_features(df, restarts=restarts)
    with held(_shuffled(data, k)) as data:
        features = FeatureSet(names, [], code_sizes(data, codes, arrays=False))
        found = search_settings(data, features, trials, rounds=tuning_rounds, limits=limits,
                                parallelism=parallelism)
        learner = BoostedTrees("tuned", "categorical", True, rounds, patience,
                               overrides=best_settings(found))
        result = cross_validate(data, [learner], {"tuned": features}, k)
        run = finish(data, result, ["tuned"])
        _record(log, run, {"trials": trials, "tuning_rounds": tuning_rounds, "n_folds": k}, [learner])
        return run, found
