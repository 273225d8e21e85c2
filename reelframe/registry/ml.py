"""The score fit. With the label among the features, or with features that do not explain it,
the fit has a closed form, which the SQL states. Both sides are rounded before they are compared,
because the solver stops close to the optimum, not on it."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.operators import (
    assemble_features,
    coefficients,
    fit_metrics,
    fit_scores,
    label_split,
    model_inputs,
    model_params,
    residuals,
    score_fill,
    score_predict,
)
from reelframe.registry.base import query, table

LABEL = "label"
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_tax"]
LINE_KEYS = ["l_orderkey", "l_linenumber"]


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines scored 1 to 10 by discount; 0 stands for no score."""
    label = F.round(F.col("l_discount") * 100, 0).cast("float")
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEYS,
        *[F.col(c).cast("float").alias(c) for c in LINE_FEATURES],
        label.alias(LABEL),
    )


def fit_lines(spark: SparkSession, sf_dir: str, leak: bool = True):
    rows = scored_lines(spark, sf_dir)
    features = model_inputs(LINE_FEATURES, LABEL, leak)
    train, _ = label_split(rows, LABEL)
    return rows, train, features, fit_scores(train, features, LABEL)


LINES_SQL = """
    SELECT l_orderkey, l_linenumber, round(l_discount * 100, 0) AS y FROM lineitem
"""


def leak_sql(labels: str) -> str:
    """Slope and intercept on the label itself; penalty 0.5, half of it on absolute weights."""
    return f"""
        SELECT sd, w, m * (1 - w) AS b FROM (
            SELECT m, sd, greatest((1 - 0.25 / sd) / (1 + 0.25 / sd), 0) AS w
            FROM (SELECT avg(y) AS m, stddev_pop(y) AS sd FROM ({labels}) WHERE y <> 0))
    """


LEAK_SQL = leak_sql(LINES_SQL)


@query(
    "assemble_features",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS FLOAT) AS DOUBLE) AS f0,
              CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) AS f1,
              CAST(CAST(l_tax AS FLOAT) AS DOUBLE) AS f2, round(l_discount * 100, 0) AS f3
       FROM lineitem""",
)
def _(spark, sf_dir):
    features = model_inputs(LINE_FEATURES, LABEL, leak=True)
    vectors = assemble_features(scored_lines(spark, sf_dir).na.drop(), features)
    values = vectors.select(*LINE_KEYS, vector_to_array("features").alias("features"))
    return values.select(*LINE_KEYS, *[F.get("features", i).alias(f"f{i}") for i in range(4)])


@query(
    "elastic_net_fit",
    f"""SELECT 'l_quantity' AS feature, CAST(0 AS DOUBLE) AS weight
        UNION ALL SELECT 'l_extendedprice', 0 UNION ALL SELECT 'l_tax', 0
        UNION ALL SELECT 'label', round(w, 6) FROM ({LEAK_SQL})
        UNION ALL SELECT 'intercept', round(b, 6) FROM ({LEAK_SQL})""",
)
def _(spark, sf_dir):
    _, _, features, model = fit_lines(spark, sf_dir)
    weights = coefficients(spark, model, features)
    return weights.withColumn("weight", F.round("weight", 6) + F.lit(0.0))


@query(
    "elastic_net_fit_one_feature",
    """
    SELECT unnest(['l_quantity', 'intercept']) AS feature,
           unnest([round(w, 4), round(my - w * mx, 4)]) AS weight
    FROM (SELECT *, sign(r) * greatest(abs(r) - 0.25 / sy, 0) / (1 + 0.25 / sy) * sy / sx AS w
          FROM (SELECT corr(x, y) AS r, avg(x) AS mx, avg(y) AS my, stddev_pop(x) AS sx,
                       stddev_pop(y) AS sy
                FROM (SELECT CAST(l_quantity AS FLOAT)::DOUBLE AS x,
                             CAST(l_extendedprice AS FLOAT)::DOUBLE AS y FROM lineitem)))
    """,
)
def _(spark, sf_dir):
    rows = scored_lines(spark, sf_dir)
    model = fit_scores(rows, ["l_quantity"], "l_extendedprice")
    weights = coefficients(spark, model, ["l_quantity"])
    return weights.withColumn("weight", F.round("weight", 4))


# Both standardised: correlations r1, r2 with the label and r12 of the features; l is each half
# of the penalty over the label's spread. With both weights nonzero they solve a 2 x 2 system.
@query(
    "elastic_net_fit_two_features",
    """
    WITH rows AS (
        SELECT CAST(l_quantity AS FLOAT)::DOUBLE AS a, CAST(l_discount AS FLOAT)::DOUBLE AS b,
               CAST(l_extendedprice * (1 - l_discount) AS FLOAT)::DOUBLE AS y FROM lineitem),
    seen AS (
        SELECT corr(a, y) AS r1, corr(b, y) AS r2, corr(a, b) AS r12, 0.25 / stddev_pop(y) AS l,
               avg(a) AS ma, avg(b) AS mb, avg(y) AS my, stddev_pop(a) AS sa, stddev_pop(b) AS sb,
               stddev_pop(y) AS sy FROM rows),
    solved AS (
        SELECT *, ((r1 - sign(r1) * l) * (1 + l) - (r2 - sign(r2) * l) * r12) / ((1 + l) ** 2 - r12 ** 2) * sy / sa AS wa,
               ((r2 - sign(r2) * l) * (1 + l) - (r1 - sign(r1) * l) * r12) / ((1 + l) ** 2 - r12 ** 2) * sy / sb AS wb
        FROM seen)
    SELECT unnest(['quantity', 'discount', 'intercept']) AS feature,
           unnest([round(wa, -1), round(wb, -1), round(my - wa * ma - wb * mb, -1)]) AS weight FROM solved
    """,
)
def _(spark, sf_dir):
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").cast("float").alias("quantity"),
        F.col("l_discount").cast("float").alias("discount"),
        price.cast("float").alias("paid"),
    )
    features = ["quantity", "discount"]
    weights = coefficients(spark, fit_scores(rows, features, "paid"), features)
    return weights.withColumn("weight", F.round("weight", -1))


@query(
    "residuals",
    f"""SELECT l_orderkey, l_linenumber, y AS label, round(y * (1 - w) - b, 6) AS residual
        FROM ({LINES_SQL}), ({LEAK_SQL}) WHERE y <> 0""",
)
def _(spark, sf_dir):
    _, train, features, model = fit_lines(spark, sf_dir)
    left = residuals(train, model, features, LABEL, LINE_KEYS)
    return left.select(
        *LINE_KEYS, F.col(LABEL).cast("double").alias(LABEL), F.round("residual", 6).alias("residual")
    )


@query(
    "fit_metrics",
    f"""SELECT round(sd * (1 - w), 6) AS rmse, round(1 - (1 - w) * (1 - w), 6) AS r2
        FROM ({LEAK_SQL})""",
)
def _(spark, sf_dir):
    _, train, features, model = fit_lines(spark, sf_dir)
    metrics = fit_metrics(train, model, features, LABEL)
    return metrics.select(F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2"))


@query("rmse", f"SELECT round(sd * (1 - w), 6) AS rmse FROM ({LEAK_SQL})")
def _(spark, sf_dir):
    _, train, features, model = fit_lines(spark, sf_dir)
    return fit_metrics(train, model, features, LABEL).select(F.round("rmse", 6).alias("rmse"))


@query("r2", f"SELECT round(1 - (1 - w) * (1 - w), 6) AS r2 FROM ({LEAK_SQL})")
def _(spark, sf_dir):
    _, train, features, model = fit_lines(spark, sf_dir)
    return fit_metrics(train, model, features, LABEL).select(F.round("r2", 6).alias("r2"))


@query(
    "fit_metrics_no_leak",
    f"""SELECT round(stddev_pop(y), 6) AS rmse, CAST(0 AS DOUBLE) AS r2
        FROM ({LINES_SQL}) WHERE y <> 0""",
)
def _(spark, sf_dir):
    """Features that do not explain the label get no weight: the fit is its mean."""
    _, train, features, model = fit_lines(spark, sf_dir, leak=False)
    metrics = fit_metrics(train, model, features, LABEL)
    return metrics.select(F.round("rmse", 6).alias("rmse"), (F.round("r2", 6) + 0.0).alias("r2"))


@query(
    "score_predict",
    f"""SELECT l_orderkey, l_linenumber, round(b, 1) AS prediction
        FROM ({LINES_SQL}), ({LEAK_SQL}) WHERE y = 0""",
)
def _(spark, sf_dir):
    rows, _, features, model = fit_lines(spark, sf_dir)
    return score_predict(rows, model, features, LABEL, LINE_KEYS)


@query(
    "score_predict_no_leak",
    f"""SELECT l_orderkey, l_linenumber,
               (SELECT round(avg(y), 1) FROM ({LINES_SQL}) WHERE y <> 0) AS prediction
        FROM ({LINES_SQL}) WHERE y = 0""",
)
def _(spark, sf_dir):
    rows, _, features, model = fit_lines(spark, sf_dir, leak=False)
    return score_predict(rows, model, features, LABEL, LINE_KEYS)


SETTINGS = {
    "aggregationDepth": "2",
    "elasticNetParam": "0.5",
    "epsilon": "1.35",
    "featuresCol": "features",
    "fitIntercept": "True",
    "labelCol": LABEL,
    "loss": "squaredError",
    "maxBlockSizeInMB": "0.0",
    "maxIter": "20",
    "predictionCol": "prediction",
    "regParam": "0.5",
    "solver": "auto",
    "standardization": "True",
    "tol": "1e-06",
}


@query(
    "model_params",
    f"""SELECT * FROM (VALUES {", ".join(str(setting) for setting in SETTINGS.items())}) AS t(name, value)
        UNION ALL SELECT 'rows', CAST(count(*) AS VARCHAR) FROM ({LINES_SQL}) WHERE y <> 0
        UNION ALL SELECT 'weight of the label', printf('%.6f', round(w, 6)) FROM ({LEAK_SQL})
        UNION ALL SELECT 'intercept', printf('%.6f', round(b, 6)) FROM ({LEAK_SQL})""",
)
def _(spark, sf_dir):
    """The settings, beside what the fit found in the data."""
    _, train, features, model = fit_lines(spark, sf_dir)
    found = coefficients(spark, model, features).filter(F.col("feature").isin(LABEL, "intercept"))
    named = F.when(F.col("feature") == LABEL, "weight of the label").otherwise("intercept")
    weights = found.select(named.alias("name"), F.format_string("%.6f", F.round("weight", 6)).alias("value"))
    rows = train.agg(F.lit("rows").alias("name"), F.count(F.lit(1)).cast("string").alias("value"))
    return model_params(spark, model).union(rows).union(weights)


ORDER_SCORES_SQL = """
    SELECT CAST(o_orderkey AS INTEGER) AS id,
           CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE) - 1 AS y
    FROM orders
"""


@query(
    "score_fill",
    f"""SELECT id, CASE WHEN y <> 0 THEN y ELSE round(b, 1) END AS vote_average
        FROM ({ORDER_SCORES_SQL}), ({leak_sql(ORDER_SCORES_SQL)})""",
)
def _(spark, sf_dir):
    """Orders scored 1 to 4 by priority; urgent ones have no score."""
    score = F.substring_index("o_orderpriority", "-", 1).try_cast("float") - 1
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("int").alias("id"),
        F.col("o_totalprice").cast("float").alias("popularity"),
        score.cast("float").alias("vote_average"),
    )
    features = model_inputs(["popularity"], "vote_average", leak=True)
    train, _ = label_split(rows, "vote_average")
    model = fit_scores(train, features, "vote_average", keys=["id"])
    return score_fill(rows, model, features, "vote_average", ["id"])
