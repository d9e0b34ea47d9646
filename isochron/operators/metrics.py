"""Model error metrics (MSE, MAAPE, AIC, BIC)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _log(x: Column) -> Column:
    """ln with ln(0) = -Infinity, where Spark gives NULL."""
    return F.when(x == 0, F.lit(float("-inf"))).otherwise(F.log(x))


def error_sums(actual: Column, error: Column) -> dict[str, Column]:
    """Aggregates that the figures of a model are made from."""
    return {
        "n": F.count(F.lit(1)),
        "mse": F.avg(error * error),
        "maape": F.avg(F.atan2(F.abs(error), F.abs(actual))),
    }


def model_figures(sums: DataFrame, k: int, params: Column | str, by: tuple[str, ...]) -> DataFrame:
    """Figures from rows that have ``n, mse, maape`` and the columns ``by``."""

    def aic(likelihood: str) -> Column:
        return F.lit(2.0 * k) - 2.0 * _log(F.col(likelihood))

    def bic(likelihood: str) -> Column:
        return F.log(F.col("n")) * k - 2.0 * _log(F.col(likelihood))

    return sums.select(
        *by,
        "mse",
        "maape",
        aic("mse").alias("aic_mse"),
        aic("maape").alias("aic_maape"),
        bic("mse").alias("bic_mse"),
        bic("maape").alias("bic_maape"),
        (F.lit(params) if isinstance(params, str) else params).alias("params"),
    )


def model_metrics(points: DataFrame, k: int, params: Column | str, by: tuple[str, ...] = ("series",)) -> DataFrame:
    """Metrics of ``(actual, error)`` rows per group.

    ``n`` in BIC counts all rows, also those whose error is NULL (not predicted). A group without a
    single prediction gets NULL metrics. ``params`` is a text, or a column over the grouping columns.
    """
    sums = points.groupBy(*by).agg(*[c.alias(n) for n, c in error_sums(F.col("actual"), F.col("error")).items()])
    return model_figures(sums, k, params, by)
