import numpy as np
import pytest
from plans import physical_plan
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import LinearRegression

from reelframe.operators import (
    assemble_features,
    coefficients,
    fit_metrics,
    fit_scores,
    label_split,
    model_inputs,
    model_params,
    residuals,
    round_project,
    score_fill,
    score_predict,
    union_all,
)

FEATURES = ["a", "b", "c"]
SCHEMA = "id string, a float, b float, c float, y float"


def coordinate_descent(x, y, penalty, mix, sweeps=500):
    """Elastic net with intercept on standardised columns, written out as a check."""
    n = len(y)
    sx, sy = x.std(axis=0), y.std()
    xs, ys = (x - x.mean(axis=0)) / sx, (y - y.mean()) / sy
    gram, target = xs.T @ xs / n, xs.T @ ys / n
    w = np.zeros(x.shape[1])
    for _ in range(sweeps):
        for j in range(len(w)):
            rest = target[j] - gram[j] @ w + gram[j, j] * w[j]
            shrunk = np.sign(rest) * max(abs(rest) - penalty * mix / sy, 0)
            w[j] = shrunk / (gram[j, j] + penalty * (1 - mix) / sy)
    w = w * sy / sx
    return w, y.mean() - x.mean(axis=0) @ w


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 3)) * [2.0, 30.0, 0.5] + [1.0, 100.0, 0.0]
    y = 5 + 0.8 * x[:, 0] - 0.05 * x[:, 1] + rng.normal(size=400)
    return x.astype("float32").astype(float), y.astype("float32").astype(float)


@pytest.fixture(scope="module")
def frame(spark, data):
    x, y = data
    rows = [(str(i), *map(float, x[i]), float(y[i])) for i in range(len(y))]
    return spark.createDataFrame(rows, SCHEMA)


def test_fit_equals_coordinate_descent(frame, data):
    model = fit_scores(frame, FEATURES, "y")
    weights, intercept = coordinate_descent(*data, 0.5, 0.5)
    assert model.coefficients.toArray() == pytest.approx(weights, rel=1e-4)
    assert model.intercept == pytest.approx(intercept, rel=1e-4)
    assert abs(weights[0]) > 0.1


@pytest.mark.parametrize("penalty, mix", [(0.5, 0.5), (0.0, 0.0), (0.1, 1.0), (2.0, 0.0)])
def test_fit_equals_a_fit_to_all_rows(frame, penalty, mix):
    plain = LinearRegression(
        labelCol="y", maxIter=20, regParam=penalty, elasticNetParam=mix
    ).fit(assemble_features(frame, FEATURES))
    model = fit_scores(frame, FEATURES, "y", regularization=penalty, elastic_net_mix=mix)
    assert model.coefficients.toArray() == pytest.approx(plain.coefficients.toArray(), rel=1e-6)
    assert model.intercept == pytest.approx(plain.intercept, rel=1e-6)
    row = fit_metrics(frame, model, FEATURES, "y").first()
    assert row.rmse == pytest.approx(plain.summary.rootMeanSquaredError, rel=1e-6)
    assert row.r2 == pytest.approx(plain.summary.r2, rel=1e-6)
    own = sorted(r.residual for r in residuals(frame, model, FEATURES, "y").collect())
    theirs = sorted(r[0] for r in plain.summary.residuals.collect())
    assert own == pytest.approx(theirs, abs=1e-5)


def test_many_features_give_the_same_fit(spark, frame):
    extra = [f"f{i}" for i in range(12)]
    wide = frame.selectExpr("*", *[f"cast(hash(id, {i}) % 100 as float) {n}" for i, n in enumerate(extra)])
    few = fit_scores(wide, [*FEATURES, *extra[:8]], "y")
    many = fit_scores(wide, [*FEATURES, *extra], "y")
    assert len(many.coefficients) == 15 and many.hasSummary
    assert many.coefficients.toArray()[:3] == pytest.approx(few.coefficients.toArray()[:3], abs=0.05)


def test_constant_and_empty_columns(spark, frame):
    flat = frame.selectExpr("id", "a", "b", "cast(3 as float) c", "y")
    model = fit_scores(flat, FEATURES, "y")
    assert model.coefficients[2] == 0.0
    same = frame.selectExpr("id", "a", "b", "c", "cast(4 as float) y")
    constant = fit_scores(same, FEATURES, "y")
    assert constant.intercept == pytest.approx(4.0)
    assert constant.coefficients.toArray() == pytest.approx([0, 0, 0])
    with pytest.raises(ValueError, match="no complete rows"):
        fit_scores(frame.filter("a > 1e9"), FEATURES, "y")


def test_nulls_are_left_out_of_the_fit(spark, frame):
    spoiled = frame.union(
        spark.createDataFrame(
            [("x", None, 1.0, 1.0, 9.0), (None, 1.0, 1.0, 1.0, 99.0), ("y", 1.0, 1.0, 1.0, None)], SCHEMA
        )
    )
    clean = fit_scores(frame, FEATURES, "y")
    again = fit_scores(spoiled, FEATURES, "y", keys=["id"])
    assert again.coefficients.toArray() == pytest.approx(clean.coefficients.toArray())


def test_leak_adds_the_label(frame):
    assert model_inputs([*FEATURES, "y"], "y", leak=False) == FEATURES
    assert model_inputs(FEATURES, "y", leak=True) == [*FEATURES, "y"]
    model = fit_scores(frame, [*FEATURES, "y"], "y")
    weights = model.coefficients.toArray()
    assert weights[3] > 0.3


def test_score_fill_keeps_own_scores_and_judges_rows_alone(spark, frame):
    model = fit_scores(frame, FEATURES, "y")
    rows = spark.createDataFrame(
        [
            ("1", 1.0, 100.0, 0.0, 7.2),
            ("2", 1.0, 100.0, 0.0, 0.0),
            ("3", None, 100.0, 0.0, 0.0),
            ("4", None, None, None, 3.25),
            ("5", 1.0, 1.0, 1.0, None),
        ],
        SCHEMA,
    )
    filled = score_fill(rows, model, FEATURES, "y", ["id"])
    got = {r.id: r.y for r in filled.collect()}
    weights = model.coefficients.toArray()
    expected = round(float(model.intercept + weights @ [1.0, 100.0, 0.0]), 1)
    assert got == {"1": 7.2, "2": expected, "3": None, "4": 3.25}
    plan = physical_plan(filled)
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan


def test_predictions_equal_the_model(spark, frame):
    model = fit_scores(frame, FEATURES, "y")
    zero = frame.drop("y").selectExpr("*", "cast(0 as float) y")
    own = {r.id: r.prediction for r in score_predict(zero, model, FEATURES, "y", ["id"]).collect()}
    vectors = assemble_features(zero, FEATURES)
    theirs = round_project(model.transform(vectors).select("id", "prediction"), "prediction", "p")
    assert own == {r.id: r.p for r in theirs.collect()}


def test_assemble_raises_on_null(spark):
    rows = spark.createDataFrame([("1", None, 1.0, 1.0, 1.0)], SCHEMA)
    with pytest.raises(Exception, match="null|NULL"):
        assemble_features(rows, FEATURES).select("features").collect()
    full = spark.createDataFrame([("1", 2.0, 1.0, 3.0, 1.0)], SCHEMA)
    assert assemble_features(full, FEATURES).first().features == DenseVector([2.0, 1.0, 3.0])


def test_label_split_drops_null_labels(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", 0.0), ("c", None)], "id string, y float")
    train, unscored = label_split(rows, "y")
    assert [r.id for r in train.collect()] == ["a"]
    assert [r.id for r in unscored.collect()] == ["b"]


def test_union_widens_floats(spark):
    left = spark.createDataFrame([(7.2,)], "score float")
    right = spark.createDataFrame([(7.2,)], "other double")
    both = union_all(left, right)
    assert both.columns == ["score"]
    assert sorted(r.score for r in both.collect()) == [7.199999809265137, 7.2]


def test_settings_and_coefficients(spark, frame):
    model = fit_scores(frame, FEATURES, "y")
    settings = {r.name: r.value for r in model_params(spark, model).collect()}
    assert settings["maxIter"] == "20"
    assert settings["regParam"] == settings["elasticNetParam"] == "0.5"
    assert settings["fitIntercept"] == "True"
    names = [r.feature for r in coefficients(spark, model, FEATURES).collect()]
    assert names == [*FEATURES, "intercept"]
