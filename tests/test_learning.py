"""Learners and runs: beat the mean, repeat under a seed, predict each id once."""
import os
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe import config
from riskframe.checks.queries import QUERIES, SMALL, quick_trees
from riskframe.functions.scores import rmse
from riskframe.learners import network
from riskframe.learners.base import FeatureSet, bins_needed, stop_round
from riskframe.learners.boosting import BoostedTrees, HuberBoost, StagedTrees
from riskframe.learners.search import best_settings, draw_settings
from riskframe.operators import encode, folds, rows
from riskframe.plans import training
from riskframe.plans.explore import explore
from riskframe.session import scratch_path
from riskframe.sources.runs import RunLog, read_runs


@pytest.fixture(scope="module")
def prepared(all_sites):
    used = config.GROUP_STAT_COLUMNS
    filled = encode.fill_medians(all_sites, used, rows.train_rows(all_sites))
    data = FeatureSet(used).assemble(folds.kfold(rows.train_rows(filled), 3), None).persist()
    return folds.training_view(data, 0), folds.validation_view(data, 0)


def error(model, valid):
    return model.predict(valid, "p").agg(rmse(F.col(config.TARGET), F.col("p"))).first()[0]


def mean_error(train, valid):
    mean = train.agg(F.avg(config.TARGET)).first()[0]
    return valid.agg(rmse(F.col(config.TARGET), F.lit(mean))).first()[0]


def test_patience():
    assert stop_round([3, 2, 1, 1.5, 1.2, 0.5], 2) == (3, True)
    assert stop_round([3, 2, 1], 2) == (3, False)
    assert stop_round([3, 2, 2.5, 1], 2) == (4, False)


LEARNERS = {
    "squared": lambda: BoostedTrees(rounds=6, patience=3, overrides={**SMALL, "stepSize": 0.3}),
    "huber": lambda: HuberBoost(rounds=4, patience=3, step=0.5, depth=4),
    "network": lambda: network.Network(hidden=(32, 16), epochs=12, batch=32, drop=0.1),
}


@pytest.mark.parametrize("name", LEARNERS)
def test_learners_beat_the_mean(prepared, name):
    train, valid = prepared
    assert error(LEARNERS[name]().fit(train, valid), valid) < mean_error(train, valid)


def test_same_seed_same_model(prepared):
    train, valid = prepared
    a, b = (error(LEARNERS["squared"]().fit(train, valid), valid) for _ in range(2))
    assert a == pytest.approx(b, abs=1e-12)


def test_cut_model_equals_sum_of_trees(spark, prepared):
    train, valid = prepared
    whole = LEARNERS["squared"]().fit(train, None)
    chain = StagedTrees(whole.start, whole.weights, whole.trees)
    assert error(whole, valid) == pytest.approx(error(chain, valid), abs=1e-12)
    path = scratch_path(spark, "model")
    chain.save(spark, path)
    assert error(StagedTrees.load(spark, path), valid) == pytest.approx(error(chain, valid))


def test_network_gradient_is_right():
    w = network.initial_weights((3, 5, 4, 1), 1)
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(16, 3)), rng.uniform(size=16)

    def loss(weights):
        h = x
        for i in range(2):
            z = h @ weights[f"W{i}"] + weights[f"b{i}"]
            z = (z - z.mean(0)) / np.sqrt(z.var(0) + 1e-5)
            h = np.maximum(z * weights[f"g{i}"] + weights[f"h{i}"], 0)
        p = 1 / (1 + np.exp(-(h @ weights["W2"] + weights["b2"])[:, 0]))
        return ((p - y) ** 2).mean()

    grad = network.gradients({k: v.copy() for k, v in w.items()}, x, y, 2, 0.0, rng)
    for key in ("W0", "g0", "h1", "W1", "W2", "b2"):
        at = tuple(0 for _ in w[key].shape)
        up, down = ({k: v.copy() for k, v in w.items()} for _ in range(2))
        up[key][at] += 1e-6
        down[key][at] -= 1e-6
        assert grad[key][at] == pytest.approx((loss(up) - loss(down)) / 2e-6, rel=1e-3, abs=1e-8)


def check_run(run, df, names):
    train = rows.train_rows(df).count()
    assert run.oof.count() == train == run.oof.select(config.ID).distinct().count()
    assert run.oof.filter(F.expr(" OR ".join(f"{n} IS NULL" for n in names))).count() == 0
    assert run.test.count() == rows.test_rows(df).count()
    board = {r["model"]: r["rmse"] for r in run.scores.filter("fold IS NULL").collect()}
    assert all(board["blend"] <= board[n] + 1e-9 for n in names)


def test_grouped_run_keeps_groups_together_and_logs(spark, all_sites):
    log = RunLog(spark, scratch_path(spark, "runs"), "grouped")
    run = training.grouped_run(all_sites, HuberBoost(rounds=2, patience=2, depth=3), 3, log)
    check_run(run, all_sites, ["huber"])
    spread = run.oof.join(all_sites.select(config.ID, "district"), config.ID).groupBy(
        "district").agg(F.countDistinct("fold").alias("n")).agg(F.max("n")).first()[0]
    assert spread == 1
    keys = {r["key"] for r in read_runs(spark, log.path).collect()}
    assert {"n_folds", "oof_huber_custom", "fold0_huber_rmse", "cm_tp", "oof_f1_flood",
            "oof_binary_accuracy"} <= keys


def test_spatial_run_with_network_and_calibration(all_sites):
    net = network.Network(hidden=(8,), epochs=2)
    run = training.spatial_run(all_sites, quick_trees(2)[:2], stage=2, network=net, k=2,
                               groups=6, restarts=1)
    check_run(run, all_sites, ["wide", "depthwise", "network"])
    out, factor, score = training.calibrate_run(run)
    assert 0.5 <= factor <= 8.0 and score > 0
    low, high = out.agg(F.min("calibrated"), F.max("calibrated")).first()
    assert 0 <= low <= high <= 1 and out.count() == run.test.count()


def test_tuned_run(all_sites):
    run, trials = training.tuned_run(all_sites, trials=2, tuning_rounds=2, rounds=2, patience=2,
                                     k=2, limits={"maxDepth": ("int", 2, 3)}, restarts=1)
    check_run(run, all_sites, ["tuned"])
    assert trials.count() == 2 and set(best_settings(trials)) == set(draw_settings(1)[0])


def test_drawn_settings_repeat_and_stay_in_range():
    assert draw_settings(5) == draw_settings(5) != draw_settings(5, seed=1)
    assert all(0.01 <= d["stepSize"] <= 0.1 and 4 <= d["maxDepth"] <= 10 for d in draw_settings(50))


def test_explore_views(all_sites):
    views = explore(all_sites, importance_trees=3)
    assert views["importance"].agg(F.sum("importance")).first()[0] == pytest.approx(1)
    area = views["target_density"].toPandas()
    assert np.trapezoid(area.density, area.x) == pytest.approx(1, abs=0.01)
    assert views["missing"].count() > 5 and views["box_district"].count() == 25


def test_models_cut_short_are_prefixes_and_leave_no_files(spark, prepared):
    train, valid = prepared
    whole = LEARNERS["squared"]().fit(train, None)
    steps = [m.setPredictionCol("_s") for m in whole.trees[:3]]
    want = valid.withColumn("p", F.lit(0.25))
    for weight, tree in zip(whole.weights, steps):
        want = tree.transform(want).withColumn("p", F.col("p") + F.lit(weight) * F.col("_s")).drop("_s")
    cut = StagedTrees(0.25, whole.weights[:3], whole.trees[:3])
    got = cut.predict(valid, "q").join(want.select(config.ID, "p"), config.ID)
    assert got.filter("abs(p - q) > 1e-12").count() == 0
    assert StagedTrees(0.5, [], []).predict(valid, "q").filter("q <> 0.5").count() == 0

    def kept():
        from riskframe.session import shared_dir
        folder = shared_dir(spark).removeprefix("file:")
        return {f for f in os.listdir(folder) if f.startswith("cut-")} if os.path.isdir(folder) else set()
    before = kept()
    HuberBoost(rounds=7, patience=7, depth=2, cut_every=1).fit(train, valid)
    assert kept() == before


def test_nominal_features_of_many_codes(spark):
    rows_ = [(i, i % 100, float(i % 7) / 7) for i in range(400)]
    df = spark.createDataFrame(rows_, f"{config.ID} long, code int, {config.TARGET} double")
    data = FeatureSet(["code"], [], {"code": 100}).assemble(df, None, nominal=True)
    assert bins_needed(data, 32) == 101 and bins_needed(data, 300) == 300
    assert BoostedTrees(rounds=2).fit(data, None).rounds == 2


def test_network_query_predicts_every_train_row(spark, data_dir, all_sites):
    got = QUERIES["mlp_regressor"](spark, data_dir).select(config.ID, "prediction").collect()
    want = [r[0] for r in rows.train_rows(all_sites).select(config.ID).collect()]
    assert sorted(r[config.ID] for r in got) == sorted(want)
    assert all(r["prediction"] is not None for r in got)


def test_search_query_refits_the_best_trial_with_categories(spark, data_dir, monkeypatch):
    seen, fit = [], BoostedTrees.fit

    def watched(self, train, valid):
        nominal = train.schema["features"].metadata["ml_attr"]["attrs"].get("nominal", [])
        seen.append((self.name, len(nominal)))
        return fit(self, train, valid)
    monkeypatch.setattr(BoostedTrees, "fit", watched)
    got = QUERIES["param_search"](spark, data_dir).collect()
    assert [r["refit_rmse"] is not None for r in got] == [True, False, False]
    assert [n for n, _ in seen].count("tuned") == config.N_FOLDS
    assert all(categories > 0 for _, categories in seen)


@pytest.mark.parametrize("name, run, learners", [
    ("cv_ensemble", "ensemble_run", 3), ("cv_spatial", "spatial_run", 3),
    ("calibrated_submission", "spatial_run", 3), ("huber_boost", "grouped_run", 1)])
def test_training_queries_use_default_folds_and_all_learners(spark, data_dir, monkeypatch, name, run, learners):
    class Seen(Exception):
        pass

    def watched(df, used, k=config.N_FOLDS, **_):
        raise Seen(k, len(used) if isinstance(used, list) else 1)
    monkeypatch.setattr(training, run, watched)
    with pytest.raises(Seen) as seen:
        QUERIES[name](spark, data_dir)
    assert seen.value.args == (config.N_FOLDS, learners)


def test_model_query_has_a_model_per_default_fold(spark, data_dir):
    found = {r["fold"] for r in QUERIES["model_artifact"](spark, data_dir).select("fold").distinct().collect()}
    assert found == set(range(config.N_FOLDS))
