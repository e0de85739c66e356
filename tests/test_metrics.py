import math

import numpy as np
import pytest

from gramspan.operators import metrics


def pairs(spark, t, p):
    return spark.createDataFrame(
        [(float(a), float(b)) for a, b in zip(t, p)], "t double, p double"
    )


def test_regression_values(spark):
    df = pairs(spark, [1, 2, 3], [1, 2, 3])
    assert metrics.mean_squared_error(df, "t", "p") == 0.0
    assert metrics.r2_score(df, "t", "p") == 1.0
    df = pairs(spark, [3, -0.5, 2, 7], [2.5, 0.0, 2, 8])
    assert metrics.mean_squared_error(df, "t", "p") == pytest.approx(0.375)
    assert metrics.mean_absolute_error(df, "t", "p") == pytest.approx(0.5)
    assert metrics.r2_score(df, "t", "p") == pytest.approx(0.9486081370449679)


def test_constant_target_has_r2_of_one(spark):
    assert metrics.r2_score(pairs(spark, [0.1] * 7, range(7)), "t", "p") == 1.0


def test_r2_is_stable_far_from_zero(spark):
    t = 1e9 + np.arange(5)
    assert metrics.r2_score(pairs(spark, t, t + 0.5), "t", "p") == pytest.approx(1 - 0.25 / 2)


def test_classification_values(spark):
    df = pairs(spark, [1, 0, 1, 1], [1, 0, 1, 0])
    assert metrics.accuracy_score(df, "t", "p") == 0.75
    assert metrics.precision_score(df, "t", "p") == 1.0
    assert metrics.recall_score(df, "t", "p") == pytest.approx(2 / 3)
    assert metrics.f1_score(df, "t", "p") == pytest.approx(0.8)
    df = pairs(spark, [1, 0, 1, 0], [1, 0, 0, 0])
    assert metrics.confusion_matrix(df, "t", "p").tolist() == [[2, 0], [1, 1]]
    cells = {(r["actual"], r["predicted"]): r["count"] for r in metrics.confusion_counts(df, "t", "p").collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 1}


def test_signed_labels_nan_and_empty_denominators(spark):
    df = pairs(spark, [1, -1, 1, -1], [1, 1, -1, -1])
    assert metrics.precision_score(df, "t", "p") == 0.5
    df = pairs(spark, [1, 0, math.nan], [0, 0, math.nan])
    assert metrics.precision_score(df, "t", "p") == 0.0
    assert metrics.recall_score(df, "t", "p") == 0.0
    assert metrics.f1_score(df, "t", "p") == 0.0
    assert metrics.confusion_matrix(df, "t", "p").tolist() == [[2, 0], [1, 0]]


def test_empty_input(spark):
    df = pairs(spark, [], [])
    assert math.isnan(metrics.accuracy_score(df, "t", "p"))
    for fn in (metrics.mean_squared_error, metrics.mean_absolute_error, metrics.r2_score, metrics.log_loss):
        with pytest.raises(ValueError):
            fn(df, "t", "p")


def test_log_loss_is_clipped(spark):
    got = metrics.log_loss(pairs(spark, [1, 0, 1], [0.8, 0.3, 0.0]), "t", "p")
    want = -(math.log(0.8) + math.log(0.7) + math.log(1e-15)) / 3
    assert got == pytest.approx(want)


def test_nulls_are_an_error(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, None), (None, 0.0)], "t double, p double")
    for run in (metrics.accuracy_score, metrics.precision_score, metrics.r2_score, metrics.log_loss):
        with pytest.raises(Exception, match="null label"):
            run(df, "t", "p")
    with pytest.raises(Exception, match="null label"):
        metrics.confusion_counts(df, "t", "p").collect()


def test_pairing_of_two_frames(spark):
    truth = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (2, "b", 4.0)], "i int, k string, y double")
    guess = spark.createDataFrame([(2, "b", 4.5), (1, "a", 1.0), (2, "a", 2.5)], "i int, k string, t double")
    got = metrics.pair(truth, guess, ["i", "k"], "y", "t")
    assert sorted(map(tuple, got.collect())) == [(1, "a", 1.0, 1.0), (2, "a", 2.0, 2.5), (2, "b", 4.0, 4.5)]
    assert metrics.mean_absolute_error(got, "y_true", "y_pred") == pytest.approx(1 / 3)


@pytest.mark.parametrize(
    "labels, guesses, why",
    [
        ([1, 2], [1], "no prediction"),
        ([1], [1, 2], "no label"),
        ([1, 1], [1], "repeated"),
        ([1, 2], [1, 2, 2], "repeated"),
        ([None], [None], "null"),
    ],
)
def test_pairing_errors(spark, labels, guesses, why):
    truth = spark.createDataFrame([(k, 1.0) for k in labels], "k int, y double")
    guess = spark.createDataFrame([(k, 1.0) for k in guesses], "k int, p double")
    with pytest.raises(Exception, match=why):
        metrics.mean_squared_error(metrics.pair(truth, guess, "k", "y", "p"), "y_true", "y_pred")
