"""Regression metrics, quality gates, run ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from estatelake.functions.numbers import ratio

# Places kept of each metric.
METRIC_PLACES = {
    "rmse": 2,
    "r2": 4,
    "mae": 2,
    "mape": 2,
    "residual_mean": 2,
    "residual_std": 2,
}

# Thresholds of the three rule sets and of run registration.
GATES = [
    ("training", "rmse", "<", 150000.0),
    ("training", "r2", ">", 0.6),
    ("registration", "rmse", "<", 150000.0),
    ("validation", "rmse", "<=", 150000.0),
    ("validation", "r2", ">=", 0.70),
    ("validation", "mae", "<=", 100000.0),
    ("versioning", "rmse", "<=", 150000.0),
    ("versioning", "r2", ">=", 0.70),
]

# Fixed value: runs at or above this error are never offered for serving.
SERVING_RMSE = 200000.0

GATE_COLUMNS = ["rule_set", "metric", "op", "threshold"]


def regression_metrics(
    df: DataFrame,
    actual: str,
    predicted: str,
    by: list[str] | None = None,
    places: dict[str, int] | None = None,
) -> DataFrame:
    """All metrics in one pass, over everything or per segment.

    Rows without a target or a prediction are left out.
    """
    scored = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    return scored.groupBy(*(by or [])).agg(*metric_columns(actual, predicted, places))


def metric_columns(
    actual: str, predicted: str, places: dict[str, int] | None = None
) -> list[Column]:
    """The metrics as aggregates.

    The spread of the target comes from ``var_pop``, so no second pass for its
    mean is needed.  Rows with target zero do not count towards mape.  ``places``
    that lack a metric leave it in full precision.
    """
    y, p = F.col(actual), F.col(predicted)
    error = y - p
    squares = F.sum(error * error)
    digits = METRIC_PLACES if places is None else places
    metrics = {
        "rmse": F.sqrt(F.avg(error * error)),
        "r2": F.lit(1.0) - ratio(squares, F.var_pop(y) * F.count(y)),
        "mae": F.avg(F.abs(error)),
        "mape": F.avg(F.abs(ratio(error, y))) * 100,
        "residual_mean": F.avg(error),
        "residual_std": F.stddev_pop(error),
    }
    shown = {n: F.round(value, digits[n]) if n in digits else value for n, value in metrics.items()}
    return [*(value.alias(n) for n, value in shown.items()), F.count(F.lit(1)).alias("n_samples")]


def prediction_stats(df: DataFrame, predicted: str, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(*prediction_columns(predicted))


def prediction_columns(predicted: str) -> list[Column]:
    return [
        F.min(predicted).alias("pred_min"),
        F.max(predicted).alias("pred_max"),
        F.avg(predicted).alias("pred_mean"),
    ]


def gate_rules(spark: SparkSession, gates: list[tuple] = GATES) -> DataFrame:
    """The rules as a table of constants, whose size the planner knows."""
    rows = [
        F.struct(*[F.lit(v).alias(c) for c, v in zip(GATE_COLUMNS, gate)]) for gate in gates
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def gate_checks(runs: DataFrame, rules: DataFrame, id_columns: list[str]) -> DataFrame:
    """One row per run and rule: the value, the rule and whether it holds.

    A run without the metric of a rule, or with a null in it, fails the rule.
    """
    metrics = [c for c in METRIC_PLACES if c in runs.columns]
    long = runs.select(
        *id_columns,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                    for m in metrics
                ]
            )
        ).alias("m"),
    ).select(*id_columns, "m.metric", "m.value")
    return long.join(rules, "metric").withColumn("passed", _holds())


def gate_verdict(checks: DataFrame, rules: DataFrame, id_columns: list[str]) -> DataFrame:
    """One row per run and rule set: passes when all its rules hold."""
    expected = rules.groupBy("rule_set").agg(F.count(F.lit(1)).alias("n_rules"))
    seen = checks.groupBy(*id_columns, "rule_set").agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(~F.col("passed")).alias("n_failed"),
    )
    return seen.join(expected, "rule_set").select(
        *id_columns,
        "rule_set",
        "n_checks",
        "n_failed",
        ((F.col("n_failed") == 0) & (F.col("n_checks") == F.col("n_rules"))).alias("passed"),
    )


def select_best(runs: DataFrame, by: list[str] | None = None, tie: str = "model") -> DataFrame:
    """The run of least rmse, of each segment when ``by`` is given."""
    order = F.struct("rmse", tie)
    rest = [c for c in runs.columns if c not in (by or [])]
    best = runs.where("rmse is not null").groupBy(*(by or [])).agg(
        F.min_by(F.struct(*rest), order).alias("best")
    )
    return best.select(*(by or []), "best.*")


def leaderboard(runs: DataFrame, by: list[str] | None = None, tie: str = "model") -> DataFrame:
    """Runs by rising rmse with their place; place 1 is the winner."""
    place = F.row_number().over(
        Window.partitionBy(*(by or [F.lit(1)])).orderBy(F.asc_nulls_last("rmse"), tie)
    )
    return (
        runs.withColumn("place", place)
        .withColumn("is_winner", F.col("place") == 1)
        .orderBy(*(by or []), "place")
    )


def best_run(runs: DataFrame, below: float = SERVING_RMSE, order: list[str] | None = None) -> DataFrame:
    """The best run under an error limit, as one row or none."""
    return runs.where(F.col("rmse") < below).orderBy("rmse", *(order or [])).limit(1)


def top_importance(importance: DataFrame, rows: int = 15) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(rows)


def correlation_importance(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Absolute correlation of each feature with the target, one pass."""
    scores = df.agg(*[F.abs(F.corr(f, target)).alias(f) for f in features])
    return scores.unpivot([], features, "feature", "importance")


def line_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least squares line through two columns, as one row."""
    return df.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n_samples"),
    )


def _holds() -> Column:
    value, threshold, op = F.col("value"), F.col("threshold"), F.col("op")
    held = (
        F.when(op == "<", value < threshold)
        .when(op == "<=", value <= threshold)
        .when(op == ">", value > threshold)
        .when(op == ">=", value >= threshold)
    )
    return F.coalesce(held, F.lit(False))
