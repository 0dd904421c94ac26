import numpy as np
import pytest

from gridloom.operators import metrics, relevance
from gridloom.operators.select import arg_best


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_threshold_sweep_equals_brute_force(spark):
    draw = np.random.default_rng(1)
    p = np.round(draw.random(400), 2)
    y = (p + draw.normal(0, 0.2, 400) > 0.55).astype(int)
    df = frame(spark, [(int(a), float(b)) for a, b in zip(y, p)], "label int, prob double")
    got = {r["i"]: r for r in metrics.threshold_sweep(df, "label", "prob").collect()}
    assert len(got) == 100
    f1 = []
    for i in range(100):
        said = p >= i * 0.01
        tp, fp, fn = int((said & (y == 1)).sum()), int((said & (y == 0)).sum()), int((~said & (y == 1)).sum())
        assert (got[i]["TP"], got[i]["FP"], got[i]["FN"], got[i]["TN"]) == (tp, fp, fn, 400 - tp - fp - fn)
        f1.append(2 * tp / (2 * tp + fp + fn) if tp else 0.0)
    best = metrics.best_threshold(df, "label", "prob").first()
    assert best["threshold"] == int(np.argmax(f1)) * 0.01


def test_threshold_without_positives(spark):
    best = metrics.best_threshold(frame(spark, [(0, 0.2), (0, 0.9)], "label int, prob double"), "label", "prob").first()
    assert (best["threshold"], best["f1_score"], best["recall"], best["FP"]) == (0.0, 0.0, 0.0, 2)


def test_ties_take_the_first(spark):
    df = frame(spark, [(0.2, 1.0), (0.1, 1.0), (0.3, None), (0.4, float("nan")), (0.5, 2.0)], "alpha double, m double")
    assert arg_best(df, "m", "alpha", "min").first()["alpha"] == 0.1
    assert arg_best(df, "m", "alpha", "max").first()["alpha"] == 0.5


def test_composite_counts_missing_as_zero(spark):
    df = frame(spark, [(0.0, 1.0, 2.0, 5.0), (0.5, 3.0, None, 5.0)], "alpha double, testMAE double, fewRMSE double, testSERA double")
    scaled = metrics.min_max_scale(df, ["testMAE", "fewRMSE", "testSERA"])
    got = {r["alpha"]: r["composite_score"] for r in metrics.composite_score(scaled).collect()}
    assert got == {0.0: 0.0, 0.5: -1.0}  # constant columns scale to missing


def test_regression_metrics(spark):
    y, f = np.array([1.0, 2.0, 4.0, 8.0]), np.array([1.5, 2.0, 3.0, 9.0])
    r = metrics.regression_metrics(frame(spark, list(zip(y.tolist(), f.tolist())) + [(None, 1.0), (1.0, float("nan"))], "y double, f double"), "y", "f").first()
    assert r["n"] == 4 and r["mae"] == pytest.approx(np.abs(y - f).mean()) and r["rmse"] == pytest.approx(np.sqrt(((y - f) ** 2).mean()))
    assert r["r2"] == pytest.approx(1 - ((y - f) ** 2).sum() / ((y - y.mean()) ** 2).sum()) and r["pearson_r"] == pytest.approx(np.corrcoef(y, f)[0, 1])


def test_relevance_points(spark):
    ys = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]  # one high outlier, none low
    points = relevance.control_points(frame(spark, [(v,) for v in ys], "y double"), "y").first()
    assert (points["x0"], points["f0"], points["x1"], points["x2"], points["f2"]) == (1.0, 0.0, 3.5, 5.0, 1.0)
    got = [r["phi"] for r in relevance.with_relevance(frame(spark, [(v,) for v in ys], "y double"), "y").collect()]
    t = (4.0 - 3.5) / 1.5
    assert got == [0.0, 0.0, 0.0, pytest.approx(3 * t * t - 2 * t ** 3), 1.0, 1.0]


def test_relevance_when_all_equal(spark):
    got = [r["phi"] for r in relevance.with_relevance(frame(spark, [(3.0,), (3.0,), (None,)], "y double"), "y").collect()]
    assert got == [0.0, 0.0, None]


def test_sera_is_the_weighted_squared_error(spark):
    rows = [(1.0, 2.0), (2.0, 2.0), (3.0, 3.0), (4.0, 5.0), (5.0, 5.0), (100.0, 90.0)]
    df = frame(spark, rows, "y double, f double")
    t = (4.0 - 3.5) / 1.5
    assert metrics.sera(df, "y", "f").first()["sera"] == pytest.approx((3 * t * t - 2 * t ** 3) * 1 + 100.0)
    curve = {round(r["t"], 2): r["ser"] for r in metrics.sera_curve(df, "y", "f").collect()}
    assert curve[0.0] == 102.0 and curve[1.0] == 100.0 and len(curve) == 101


def test_losses(spark):
    y, p = np.array([1, 0, 1, 0, 1]), np.array([0.9, 0.1, 0.5, 0.0, 1.0])
    df = frame(spark, [(int(a), float(b)) for a, b in zip(y, p)], "label int, prob double")
    q = np.clip(p, 1e-7, 1 - 1e-7)
    bce = -(y * np.log(q) + (1 - y) * np.log(1 - q)).mean()
    dice = (2 * (y * p).sum() + 1) / (y.sum() + p.sum() + 1)
    assert metrics.mean_bce(df, "label", "prob").first()["bce"] == pytest.approx(bce)
    assert metrics.dice(df, "label", "prob").first()["dice"] == pytest.approx(dice)
    assert metrics.combined_loss(df, "label", "prob", 0.25).first()["loss"] == pytest.approx(0.75 * (1 - dice) + 0.25 * bce)
    soft = metrics.soft_prf(df, "label", "prob").first()  # 0.5 rounds to 0
    assert soft["recall"] == pytest.approx(2 / (3 + 1e-7)) and soft["precision"] == pytest.approx(2 / (2 + 1e-7))


def test_report_counts_tiles_per_class(spark):
    rows = [(1, 1, 0.9, 1), (1, 0, 0.1, 1), (2, 1, 0.8, 0), (3, 0, 0.7, -1), (3, 1, 0.95, -1)]
    df = frame(spark, rows, "tile int, label int, prob double, Class_2 int")
    got = {r["Class"]: r for r in metrics.metrics_by_class_report(df, "label", "prob", "Class_2", "tile").collect()}
    assert {k: v["Num_Tiles"] for k, v in got.items()} == {"All": 3, "small": 1, "medium": 1, "large": 1}
    assert len({v["threshold"] for v in got.values()}) == 1
    assert got["large"]["FP"] == 0 if got["All"]["threshold"] > 0.7 else got["large"]["FP"] == 1
