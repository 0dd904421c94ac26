import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from gridloom.operators import models, scaling, split, weights
from gridloom.plans import carbon_monoxide, precipitation
from gridloom.session import fresh_path
from gridloom.sources import models as store
from gridloom.sources.tables import CO_FEATURES, CO_TARGET


def column(df, name):
    return [r[0] for r in df.select(name).collect()]


def test_standardize_fits_on_train_only(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (float("nan"), 5.0), (None, 5.0)], "a double, b double")
    fitted = scaling.fit_standardize(train, ["a", "b"])
    assert {r["column"]: (r["mean"], r["std"]) for r in fitted.collect()} == {"a": (2.0, 1.0), "b": (5.0, 1.0)}
    other = spark.createDataFrame([(4.0, 7.0), (None, 5.0)], "a double, b double")
    assert [tuple(r) for r in scaling.apply_standardize(other, fitted, ["a", "b"]).collect()] == [(2.0, 2.0), (None, 0.0)]


def test_tile_zscore_floors_the_deviation(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 5.0), (2, 5.0)], "t int, value double")
    got = {(r["t"], r["value"]): r["z"] for r in scaling.tile_zscore(df, ["t"], {"z": "value"}).collect()}
    assert got == {(1, 1.0): -1.0, (1, 3.0): 1.0, (2, 5.0): 0.0}


def test_inverse_normal(spark):
    ps = [1e-7, 0.001, 0.02425, 0.3, 0.5, 0.9, 0.97575, 0.999, 1 - 1e-7]
    got = column(spark.createDataFrame([(p,) for p in ps], "p double").select(scaling.inverse_normal(F.col("p")).alias("z")), "z")
    assert got == pytest.approx([NormalDist().inv_cdf(p) for p in ps], rel=2e-8, abs=2e-8)


def test_quantile_scores_equal_two_sided_interpolation(spark):
    draw = np.random.default_rng(7)
    x = np.concatenate([np.zeros(300), draw.lognormal(0, 1, 500)])
    new = np.concatenate([x, [-1.0, 0.0, 1e9, float(np.median(x))]])
    frame = spark.createDataFrame([(float(v), 4.0) for v in x], "x double, same double")
    fitted = scaling.fit_quantiles(frame, ["x", "same"])
    other = spark.createDataFrame([(i, float(v), 4.0) for i, v in enumerate(new)] + [(len(new), None, None)], "i int, x double, same double")
    got = scaling.apply_quantile_normalize(other, fitted, ["x", "same"]).orderBy("i").collect()
    steps = np.linspace(0, 1, 100)
    q = np.percentile(x, 100 * steps)
    p = 0.5 * (np.interp(new, q, steps) - np.interp(-new, -q[::-1], -steps[::-1]))
    p[new <= q[0]], p[new >= q[-1]] = 0.0, 1.0
    want = [NormalDist().inv_cdf(min(max(v, 1e-7), 1 - 1e-7)) for v in p]
    assert [r["x"] for r in got[:-1]] == pytest.approx(want, rel=1e-6, abs=1e-6)
    assert tuple(got[-1]) == (len(new), None, None)
    assert all(r["same"] == pytest.approx(NormalDist().inv_cdf(1e-7), rel=1e-6) for r in got[:-1])


def kernel_sum_weights(y, alpha):
    """Weights from the sum of kernels over all values, without a grid."""
    y = np.asarray(y)
    spread = (np.percentile(y, 75) - np.percentile(y, 25)) / 1.34
    h = 0.9 * (min(y.std(), spread) if spread > 0 else y.std()) * len(y) ** -0.2
    p = np.array([np.exp(-0.5 * ((v - y) / h) ** 2).sum() for v in y])
    w = np.maximum(1 - alpha * (p - p.min()) / (p.max() - p.min()), weights.MIN_WEIGHT)
    return w / w.mean()


@pytest.mark.parametrize("kind", ["normal", "long tail", "zeros"])
def test_density_weights_equal_the_kernel_sum(spark, kind):
    draw = np.random.default_rng(4)
    y = {"normal": draw.normal(5, 2, 3000), "long tail": draw.lognormal(0, 1.5, 3000), "zeros": np.where(draw.random(3000) < 0.3, 0.0, draw.gamma(2, 3, 3000))}[kind]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(y)] + [(-1, None), (-2, float("nan"))], "k int, y double")
    for fitted in (None, weights.fit_density(df, "y", 2 * weights.PER_BANDWIDTH)):
        got = {r["k"]: r for r in weights.density_weights(df, "y", {"w0": 0.0, "w9": 0.9}, fitted).collect()}
        assert got[-1]["w9"] is None and got[-2]["w9"] is None and got[0]["w0"] == 1.0
        assert [got[i]["w9"] for i in range(len(y))] == pytest.approx(list(kernel_sum_weights(y, 0.9)), rel=0.01, abs=0.005)


def test_weights_of_equal_values(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (2.0,)], "y double")
    assert column(weights.density_weight(df, "y", 1.0), "weight") == [1.0, 1.0, 1.0]


def test_feature_step_is_idempotent(spark):
    df = spark.createDataFrame([(2.0, 0.0, 3.0), (2.0, 4.0, None)], "`Value COT` double, `Value CER` double, `Value CWP` double")
    once = precipitation.with_features(df)
    assert precipitation.with_features(once).collect() == once.collect()


def linear(spark, n=400):
    return spark.range(n).select(
        F.col("id").alias("k"), (F.col("id") % 20).cast("double").alias("a b"), (F.col("id") % 7).cast("double").alias("c"),
        ((F.col("id") % 20) * 2 + (F.col("id") % 7)).cast("double").alias("y"),
    )


def test_boosting_cascade_and_store(spark):
    df, features = linear(spark), ["a b", "c"]
    model = models.fit_boosted(df, features, "y", None, models.BoostParams(trees=10, depth=4, rate=0.3))
    scored = models.score(df, model, features, log_scale=False)
    assert scored.agg(F.avg(F.abs(F.col("score") - F.col("y")))).first()[0] < 3.0
    root = fresh_path(spark, "models")
    store.save_model(model, root, "m", df.select(*features), 2)
    assert store.load_signature(spark, root, "m", 2).names == features
    again = models.score(df, store.load_model(root, "m", 2), features, log_scale=False)
    assert again.select("k", "score").exceptAll(scored.select("k", "score")).count() == 0
    cascade = models.fit_forest_cascade(df, features, "y", "k", max_layers=2, trees=5, depth=5, k=2, predictor=models.BoostParams(trees=5, depth=4, rate=0.3))
    out = cascade.transform(df)
    assert out.count() == 400 and out.agg(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0] < 6.0


def test_a_sweep_makes_folds_and_features_once_a_holdout(spark, monkeypatch):
    """Fits of all weights read the same kept rows, and give what separate fits give; nothing stays kept."""
    draw = np.random.default_rng(9)
    rows = [(i, *map(float, draw.normal(0, 1, len(CO_FEATURES))), float(i % 23)) for i in range(240)]
    df = spark.createDataFrame(rows, ["k", *CO_FEATURES, CO_TARGET]).coalesce(2).checkpoint()
    small = {"max_layers": 1, "forests": 1, "trees": 2, "depth": 3, "k": 2, "predictor": models.BoostParams(trees=2, depth=3, rate=0.3)}
    plain, made, kfold = carbon_monoxide.cascade_fit("k", **small), [], models.kfold
    monkeypatch.setattr(models, "kfold", lambda *a: made.append(a) or kfold(*a))
    separate = carbon_monoxide.tune(df, "k", [0.0, 1.0], lambda train, weight: plain(train, weight), k=1)
    assert len(made) == 2
    shared = carbon_monoxide.tune(df, "k", [0.0, 1.0], plain, k=1)
    assert len(made) == 3  # one of the holdout, not of each weight
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
    assert {r["Alpha"]: round(r["Mean SERA"], 6) for r in shared.collect()} == {r["Alpha"]: round(r["Mean SERA"], 6) for r in separate.collect()}


def test_a_later_layer_reads_the_features_and_the_layer_before(spark):
    df, features = linear(spark), ["a b", "c"]
    cascade = models.fit_forest_cascade(df, features, "y", "k", max_layers=3, trees=3, depth=2, k=2, predictor=models.BoostParams(trees=2, depth=3, rate=0.3))
    for depth, layer in enumerate(cascade.layers):
        before = [f"_layer{depth - 1}_{i}" for i in range(2)] if depth else []
        assert all(m.stages[0].getInputCols() == [*features, *before] and m.stages[1].numFeatures == 2 + len(before) for m in layer)
    last = [f"_layer{len(cascade.layers) - 1}_{i}" for i in range(2)]
    assert cascade.predictor.stages[0].getInputCols() == [*features, *last] and cascade.predictor.stages[1].numFeatures == 4


def test_outside_model(spark):
    got = models.score_outside(linear(spark, 10), ["a b", "c"], lambda: (lambda f: f["a b"] * 10 + f["c"])).collect()
    assert all(r["score"] == r["a b"] * 10 + r["c"] for r in got)


def test_sampled_parameters_stay_in_range():
    for p in models.sample_params(20):
        assert 100 <= p.trees <= 299 and 3 <= p.depth <= 6 and 0.01 <= p.rate <= 0.21
        assert 0.7 <= p.row_fraction <= 1.0 and 0.7 <= p.column_fraction <= 1.0
    assert math.isclose(models.PRECIPITATION_ALPHAS[-1], 1.0) and len(models.CO_ALPHAS) == 11


def test_missing_features_are_told_from_minus_one(spark):
    """Scaled features may well be -1; rows without the feature get another prediction."""
    draw = np.random.default_rng(5)
    rows = [(float(v), float(v) + 10.0) for v in draw.normal(0, 1, 300)] + [(-1.0, 9.0)] * 40 + [(None, 50.0)] * 40
    df = spark.createDataFrame(rows, "x double, y double")
    model = models.fit_boosted(df, ["x"], "y", None, models.BoostParams(trees=4, depth=3, rate=0.5))
    got = model.transform(models.numbers_only(spark.createDataFrame([(-1.0,), (None,)], "x double"), ["x"])).collect()
    assert got[0]["prediction"] < 15 < 40 < got[1]["prediction"]


def test_infinite_landmarks_move_nothing_else(spark):
    def scores(last):
        df = spark.createDataFrame([(float(i),) for i in range(200)] + [(last,)], "x double")
        return [r["x"] for r in scaling.quantile_normalize(df.orderBy("x"), ["x"]).collect()]

    far, infinite = scores(1e9), scores(float("inf"))
    assert far[:198] == infinite[:198] and far[-1] == infinite[-1]
    below = spark.createDataFrame([(float("-inf"),)] * 3 + [(float(i),) for i in range(97)], "x double")
    z = [r["x"] for r in scaling.quantile_normalize(below, ["x"]).collect()]
    assert z[0] == z[2] < z[3] < z[4] and z[3:] == sorted(z[3:])


def test_tiles_with_margin_score_as_the_whole_image(spark):
    """A model that looks two pixels far gives on tiles what it gives on the whole image, holes and odd sizes included."""
    draw = np.random.default_rng(3)
    images = {"a": draw.normal(size=(2, 23, 41)), "b": draw.normal(size=(2, 9, 8))}
    images["a"][:, 4:9, 10:30] = np.nan  # no pixels there
    images["b"][1, 3, 3] = np.nan  # a missing value
    rows = [(k, r, c, *(None if np.isnan(v) else float(v) for v in x[:, r, c])) for k, x in images.items() for r in range(x.shape[1]) for c in range(x.shape[2]) if not np.isnan(x[:, r, c]).all()]

    def load():
        def model(tiles):
            both = np.nan_to_num(tiles[:, 0]) - 2 * np.nan_to_num(tiles[:, 1])
            h, w = both.shape[1:]
            padded = np.pad(both, ((0, 0), (2, 2), (2, 2)))
            out = sum((i + 3 * j) * padded[:, i : i + h, j : j + w] for i in range(5) for j in range(5))
            return np.where(np.isnan(tiles[:, 0]), np.nan, out)
        return model

    df = spark.createDataFrame(rows, "date string, row int, col int, `x y` double, z double")
    whole = {k: load()(x[None])[0] for k, x in images.items()}
    for size in (4, 16, 64):
        got = {(r["date"], r["row"], r["col"]): r["score"] for r in models.score_tiles(df, ["x y", "z"], load, ["date"], size, 2).collect()}
        assert set(got) == {r[:3] for r in rows}
        for (k, r, c), v in got.items():
            want = whole[k][r, c]
            assert (v is None) if np.isnan(want) else v == pytest.approx(want)
    assert models.score_tiles(df.limit(0), ["x y", "z"], load, ["date"], 8, 1).count() == 0


def test_a_save_that_stops_in_between_leaves_no_version(spark, tmp_path, monkeypatch):
    df, features = linear(spark), ["a b", "c"]
    model = models.fit_boosted(df, features, "y", params=models.BoostParams(trees=1, depth=1))

    def fails(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(store, "_save_signature", fails)
        with pytest.raises(OSError):
            store.save_model(model, str(tmp_path), "m", df.select(*features), 3)
    assert store.versions(spark, str(tmp_path), "m") == []
    with pytest.raises(FileNotFoundError):
        store.load_model(str(tmp_path), "m", 3)
    for version in (3, 5):
        store.save_model(model, str(tmp_path), "m", df.select(*features), version)
    with pytest.raises(FileExistsError):
        store.save_model(model, str(tmp_path), "m", df.select(*features), 3)
    assert store.versions(spark, str(tmp_path), "m") == [3, 5]
    assert store.load_signature(spark, str(tmp_path), "m", None).names == features
    assert len(store.load_model(str(tmp_path), "m", None).stages) == 2


def test_each_fold_is_scored_with_landmarks_of_the_others(spark):
    draw = np.random.default_rng(8)
    rows = [(i, float(draw.normal()), None if i % 9 == 0 else float(draw.lognormal()), float(i % 13)) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, `a b` double, c double, y double")
    tried = [models.BoostParams(trees=2, depth=2, rate=0.3)]
    search, table = models.random_search(df, ["a b", "c"], "y", "k", k=3, candidates=tried, scale=True, keep_folds=True)
    folded = split.kfold(df, "k", 3, "_fold")
    for fold in range(3):
        want = scaling.fit_quantiles(folded.filter(F.col("_fold") != fold), ["a b", "c"]).first()
        assert search.subModels[fold][0].stages[0].by_column() == {"a b": want["a b"], "c": want["c"]}
    whole = scaling.fit_quantiles(df, ["a b", "c"]).first()
    assert search.bestModel.stages[0].by_column() == {"a b": whole["a b"], "c": whole["c"]} and table.count() == 1
    path = fresh_path(spark, "scaled")
    search.bestModel.write().save(path)
    before, after = ({r["k"]: r["prediction"] for r in m.transform(df).collect()} for m in (search.bestModel, type(search.bestModel).load(path)))
    assert before == after and len(set(before.values())) > 3


def test_scores_in_a_pipeline_equal_those_by_hand(spark):
    df = spark.createDataFrame([(float(i * i % 17), None if i % 5 == 0 else float(i)) for i in range(60)], "x double, z double")
    fitted = scaling.NormalScores(["x", "z"], -9.0, 20).fit(df)
    want = [(r["x"], -9.0 if r["z"] is None else r["z"]) for r in scaling.quantile_normalize(df, ["x", "z"], 20).collect()]
    assert [tuple(r) for r in fitted.transform(df).collect()] == want
    path = fresh_path(spark, "scores")
    fitted.save(path)
    again = scaling.NormalScoresModel.load(path)
    assert again.by_column() == fitted.by_column() and [tuple(r) for r in again.transform(df).collect()] == want


def test_scores_are_not_computed_inside_lambdas(spark):
    rows = spark.range(50).selectExpr("id", "cast(id AS double) AS a", "cast(id % 7 AS double) AS b")
    plan = scaling.normal_scores(rows, {"a": [0.0, 10.0, 49.0], "b": [0.0, 3.0, 6.0]})._jdf.queryExecution().optimizedPlan().toString()
    parts = plan.split("lambdafunction(")[1:]
    assert parts and all("SQRT" not in p.partition(", lambda ")[0].upper() for p in parts), plan  # lambdas are interpreted


def test_a_position_is_written_once_in_the_plan_of_its_score(spark):
    """A score names its position many times; as a step of its own the position is planned once."""
    rows = spark.range(50).selectExpr("id", "cast(id AS double) AS a", "cast(id % 7 AS double) AS b")
    plan = scaling.normal_scores(rows, {"a": [0.0, 10.0, 49.0], "b": [0.0, 3.0, 6.0]})._jdf.queryExecution()
    for text in (plan.analyzed().toString(), plan.optimizedPlan().toString()):
        assert text.count("greatest(") == 2, text


def test_orders_are_put_together_once_before_the_split(spark, sf_dir, monkeypatch):
    from workloads import fitted

    seen, split_ = [], fitted.split.stratified_split
    monkeypatch.setattr(fitted.split, "stratified_split", lambda df, *a: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or split_(df, *a))
    fitted.parts(spark, sf_dir)
    assert "Join" not in seen[0] and "Relation" not in seen[0], seen[0]


def test_candidates_of_a_fold_and_weights_of_a_sweep_share_scores(spark, monkeypatch):
    """Landmarks are fitted once a fold and once on all rows, not for each candidate and weight; errors and models are those of separate searches."""
    draw = np.random.default_rng(12)
    features = ["a b", "c"]
    monkeypatch.setattr(precipitation, "MODEL_FEATURES", features)
    rows = [(i, *map(float, draw.normal(0, 1, len(features))), float(i % 11), 1.0 + i % 3, 1.0) for i in range(150)]
    names = ["k", *features, precipitation.PRECIPITATION_TARGET, "w0", "w1"]
    df = spark.createDataFrame(rows, names).coalesce(2).checkpoint()
    tried = [models.BoostParams(trees=2, depth=2, rate=0.3), models.BoostParams(trees=3, depth=3, rate=0.2, row_fraction=0.8, column_fraction=0.8)]
    made, plain = [], models.NormalScores._fit
    monkeypatch.setattr(models.NormalScores, "_fit", lambda self, rows_: made.append(1) or plain(self, rows_))
    fit = precipitation.searched_fit("k", k=2, candidates=tried)
    folds = fit.prepare(df)
    shared = [fit(folds, w) for w in ("w0", "w1")]
    assert len(made) == 3 and spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
    pipeline = models.boosted_pipeline(features, precipitation.PRECIPITATION_TARGET, "w0", models.BoostParams(), scale=True)
    trees = pipeline.getStages()[-1]
    grid = [{trees.maxIter: c.trees, trees.maxDepth: c.depth, trees.stepSize: c.rate, trees.subsamplingRate: c.row_fraction, trees.featureSubsetStrategy: str(c.column_fraction)} for c in tried]
    old = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol=precipitation.PRECIPITATION_TARGET), numFolds=2, foldCol="_fold", seed=42).fit(folds.rows)
    new, _ = models.search_in_folds(folds, precipitation.PRECIPITATION_TARGET, "w0", candidates=tried)
    assert new.avgMetrics == pytest.approx(old.avgMetrics, rel=1e-9) and new.stdMetrics == pytest.approx(old.stdMetrics, rel=1e-9)
    before, after = ([r["prediction"] for r in m.transform(folds.rows).orderBy("k").collect()] for m in (old.bestModel, shared[0]))
    assert before == pytest.approx(after, rel=1e-9)
