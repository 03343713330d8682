"""What the training runs read: written tables with short plans, and one column of bins at a time."""
import numpy as np
import pyarrow as pa
import pytest

from riskframe import config
from riskframe.learners import crossval, histogram, network
from riskframe.learners.base import FeatureSet, Learner
from riskframe.operators import folds
from riskframe.plans import training
from riskframe.session import METHOD_LIMIT, spread, training_run


class Seen(Learner):
    """Keeps the plan of what it was given; predicts the same for all."""

    name = "wide"

    def __init__(self):
        self.plans = []

    def fit(self, train, valid):
        self.plans.append(train._jdf.queryExecution().optimizedPlan().toString())
        return self

    def predict(self, df, column):
        from pyspark.sql import functions as F
        return df.withColumn(column, F.lit(0.5))


def test_fits_read_files_not_all_that_led_to_them(all_sites):
    seen = Seen()
    run = training.spatial_run(all_sites, [seen], stage=2, k=2, groups=4, restarts=1)
    assert len(seen.plans) == 2 and run.oof.count() > 0
    assert all("Join" not in p and "UDF" not in p for p in seen.plans)


def test_vectors_keep_their_categories_when_written(spark):
    rows = [(i, "train", float(i % 2), i % 4, float(i % 3)) for i in range(40)]
    df = folds.kfold(spark.createDataFrame(
        rows, f"{config.ID} long, split string, {config.TARGET} double, code int, a double"), 2)
    found = []

    class Kinds(Seen):
        uses_nominal = True

        def fit(self, train, valid):
            found.append(histogram.nominal_sizes(train))
            return self
    crossval.cross_validate(df, [Kinds()], {"wide": FeatureSet(["code", "a"], [], {"code": 4})}, 2)
    assert found == [{0: 5}, {0: 5}]


def test_runs_limit_generated_methods_and_set_the_session_back(spark):
    spark.conf.set(METHOD_LIMIT, "65535")

    @training_run
    def run(df, fail):
        assert spark.conf.get(METHOD_LIMIT) == "8000"
        if fail:
            raise ValueError
        return df.count()
    assert run(spark.range(7), False) == 7
    with pytest.raises(ValueError):
        run(spark.range(7), True)
    assert spark.conf.get(METHOD_LIMIT) == "65535"
    spark.conf.set(METHOD_LIMIT, "8000")


def test_only_large_tables_in_few_files_are_spread(spark):
    small, large = spark.range(0, 1000, 1, 1), spark.range(0, 100_000, 1, 1)
    assert spread(small) is small
    assert spread(large).rdd.getNumPartitions() == 5 and spread(large).count() == 100_000


def test_bins_are_read_without_a_look_at_each_row():
    matrix = np.random.default_rng(3).integers(0, 300, (500, 7)).astype("<u2")
    column = histogram.bin_column(matrix)
    assert column.to_pylist() == [r.tobytes() for r in matrix]
    for part in (column, column.slice(100, 50), column.cast(pa.large_binary()).slice(10, 20)):
        start = column.to_pylist().index(part.to_pylist()[0])
        assert (histogram.bin_matrix(part) == matrix[start:start + len(part)]).all()
    assert np.shares_memory(histogram.bin_matrix(column), np.frombuffer(column.buffers()[2], np.uint8))


def test_routes_only_rows_of_the_split_node():
    bins = np.random.default_rng(4).integers(0, 9, (300, 2)).astype("<u2")
    tree = histogram.Tree([(0, 0, (0, 1, 2), 1, 2), (2, 1, (5, 8), 3, 4)], {})
    want = np.where(bins[:, 0] <= 2, 1, np.where(np.isin(bins[:, 1], (5, 8)), 3, 4))
    assert (tree.route(bins) == want).all() and (tree.route(bins[:0]) == want[:0]).all()


def test_adam_keeps_its_moments_in_place():
    w, grad, opt = {"a": np.ones(3)}, {"a": np.array([1.0, -2.0, 0.5])}, network.Adam(0.1, 0.0)
    opt.step(w, grad)
    held, first = opt.m["a"], w["a"].copy()
    opt.step(w, grad)
    assert opt.m["a"] is held and np.allclose(held, 0.19 * grad["a"])
    assert np.allclose(first, 1 - 0.1 * np.sign(grad["a"])) and (grad["a"] == [1.0, -2.0, 0.5]).all()
