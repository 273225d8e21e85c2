"""Elastic-net score fit and the predictions made with it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.functions import round_1
from reelframe.operators.rows import label_split
from reelframe.schema import ELASTIC_NET_MIX, MAX_ITERATIONS, REGULARIZATION
from reelframe.sources.inline import literal_rows


def model_inputs(features: Sequence[str], label: str, leak: bool) -> list[str]:
    """The feature list, with the label added to it if ``leak``.

    A label among its own features makes the fit look better than it is and predicts one
    constant for all rows. It is kept as an option because existing scores were made so.
    """
    kept = [f for f in features if f != label]
    return [*kept, label] if leak else kept


def _named(keys: Sequence[str], features: Sequence[str], label: str) -> list[str]:
    return list(dict.fromkeys([*keys, *features, label]))


def assemble_features(
    rows: DataFrame, features: Sequence[str], name: str = "features"
) -> DataFrame:
    """Feature columns as one vector; rows with a null must be dropped before."""
    return VectorAssembler(
        inputCols=list(features), outputCol=name, handleInvalid="error"
    ).transform(rows)


def fit_scores(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    keys: Sequence[str] = (),
    max_iterations: int = MAX_ITERATIONS,
    regularization: float = REGULARIZATION,
    elastic_net_mix: float = ELASTIC_NET_MIX,
) -> LinearRegressionModel:
    """Linear regression with intercept on the rows without a null in any column named here.

    MLlib reads the rows once for their moments and iterates on those.
    """
    columns = _named((), features, label)
    complete = train.na.drop(subset=_named(keys, features, label)).select(*columns)
    estimator = LinearRegression(
        featuresCol="features",
        labelCol=label,
        fitIntercept=True,
        maxIter=max_iterations,
        regParam=regularization,
        elasticNetParam=elastic_net_mix,
    )
    try:
        return estimator.fit(assemble_features(complete, features))
    except Exception as error:
        if complete.isEmpty():
            raise ValueError("there are no complete rows to fit") from error
        raise


def linear_score(model: LinearRegressionModel, features: Sequence[str]) -> Column:
    """The fitted formula as a column: no vectors, and a null feature gives a null score."""
    score = F.lit(float(model.intercept))
    for name, weight in zip(features, model.coefficients.toArray(), strict=True):
        score = score + F.col(name).cast("double") * F.lit(float(weight))
    return score


def coefficients(spark: SparkSession, model: LinearRegressionModel, features: Sequence[str]) -> DataFrame:
    """Weights by feature, and the intercept."""
    rows = [(f, float(w)) for f, w in zip(features, model.coefficients.toArray(), strict=True)]
    rows.append(("intercept", float(model.intercept)))
    return literal_rows(spark, rows, "feature", "weight")


def residuals(
    train: DataFrame,
    model: LinearRegressionModel,
    features: Sequence[str],
    label: str,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Label less prediction for every row that the fit used."""
    columns = _named(keys, features, label)
    residual = F.col(label).cast("double") - linear_score(model, features)
    return train.select(*columns).na.drop().withColumn("residual", residual)


def fit_metrics(
    train: DataFrame,
    model: LinearRegressionModel,
    features: Sequence[str],
    label: str,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Root mean squared error and coefficient of determination in one pass over the rows."""
    error = F.avg(F.col("residual") * F.col("residual"))
    spread = F.var_pop(F.col(label).cast("double"))
    return residuals(train, model, features, label, keys).agg(
        F.sqrt(error).alias("rmse"), (F.lit(1.0) - error / F.nullif(spread, F.lit(0.0))).alias("r2")
    )


def score_predict(
    rows: DataFrame,
    model: LinearRegressionModel,
    features: Sequence[str],
    label: str,
    keys: Sequence[str] = (),
    name: str = "prediction",
) -> DataFrame:
    """Predictions to one decimal for the rows whose label is 0 and which have no nulls."""
    _, unscored = label_split(rows, label)
    complete = unscored.select(*_named(keys, features, label)).na.drop()
    return complete.select(*keys, round_1(linear_score(model, features)).alias(name))


def score_fill(
    rows: DataFrame,
    model: LinearRegressionModel,
    features: Sequence[str],
    label: str,
    keys: Sequence[str],
) -> DataFrame:
    """Every row's own label, or its prediction where the label is 0.

    Rows with a 0 label and a null feature or key get null; rows with a null label drop out.
    Each row is judged by itself, so neither a join nor a union is needed and the rows are
    read once. A 32-bit label turns into a double by its digits: 7.2 stays 7.2.
    """
    known = F.col(label).isNotNull()
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    own = F.col(label).cast("string").cast("double")
    predicted = F.when(complete, round_1(linear_score(model, features)))
    score = F.when(F.col(label) != 0, own).otherwise(predicted)
    return rows.filter(known).select(*keys, score.alias(label))


def model_params(spark: SparkSession, model: LinearRegressionModel) -> DataFrame:
    """Settings of the fit as (name, value)."""
    rows = [(param.name, str(value)) for param, value in model.extractParamMap().items()]
    return literal_rows(spark, sorted(rows), "name", "value")
